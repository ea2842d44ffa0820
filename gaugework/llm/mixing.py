"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Sources in code point order, null last, weigh 5, 2, 1 and so on, and share the words of the whole table. No
source gives more than three times its words; what it cannot give is shared by weight among the others.

The documents of a source stand on a line in the order of a seeded hash, each as long as it has words; the
line repeats for a second and third pass. Blocks of equal length cut it, and a source's block quota is what
reaches its target, the last block ending there: a copy is taken if its middle lies before the target, so a
source misses its target by half a document at most. A tree splits the quotas of all sources over the output
shards: at each node the left half of its shards draws its share of blocks without replacement, exactly
as many of each source as a multivariate hypergeometric draw gives, the right half gets the others. The
blocks of a source are permuted, and each shard takes the next ones of the permutation, so no block goes to two
shards. Inside a shard the copies are ordered by a hash.

Places on the lines come from a range partitioning with one total per (source, partition): neither a source
that holds most rows nor an id that repeats gathers in one task. What grows with the number of sources
alone (weights, levels, one array of quotas per shard) is one small table; ``BLOCKS`` bounds the blocks.

Edge cases: a null text has no words and is taken as often as its middle allows, which adds no words. Null
sources are one source, after all others; the empty string is a source. Null ids take part. Repeated
rows are rows, each with its own copies. Without any words nothing is taken. An empty table gives an empty result.
Texts are used whole. Extra columns do not matter, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugework.functions.exprs import hash_order
from gaugework.llm.common import bounded_broadcast, fresh, written

#: Weights of the sources in their order, repeating.
WEIGHTS = (5, 2, 1)
#: Passes over a source at most.
PASSES = 3
#: Blocks of the whole mix, besides one begun block per source; bounds the tables of blocks.
BLOCKS = 16_384
#: Rows of a table of blocks or sources that are sent to all executors at most.
MAX_BROADCAST_ROWS = 200_000
#: Standard deviations of a draw beyond which its probability is below 1e-30.
REACH = 12
_PARTITION_SHIFT = 33
_SPACE = r"\x20\x09-\x0D"


def words(text: Column) -> Column:
    """How many ``[^\\x20\\x09-\\x0D]+`` the text has; one letter is left of each, so no list of words is made."""
    left = F.regexp_replace(text, rf"[{_SPACE}]*[^{_SPACE}]+[{_SPACE}]*", "x")
    return F.when(text.rlike(rf"[^{_SPACE}]"), F.octet_length(left)).otherwise(0).cast("long")


@dataclass
class Mix:
    """``rows``: one per input row (id, digest, size, source_size, target, shards: one entry per copy taken).

    ``sources``: source, missing, total, weight, target, quota. ``splits``: shard, place of the source, blocks.
    """

    rows: DataFrame
    sources: DataFrame
    splits: DataFrame
    block: int


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, passes: int = PASSES) -> DataFrame:
    """``sizes`` (source, missing, total) with place, weight and target; one row per source."""
    by_name = Window.orderBy("missing", "source")
    place = (F.row_number().over(by_name) - 1).cast("long")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    named = sizes.withColumn("place", place).withColumn("weight", cycle[(F.col("place") % len(weights)).cast("int")])
    # fill up: sources reach their limit in the order of limit / weight; the level is what the others get per weight
    limit = F.col("total") * passes
    everyone = Window.partitionBy()
    full_first = Window.orderBy(limit / F.col("weight"), "place")
    earlier = full_first.rowsBetween(Window.unboundedPreceding, -1)
    since = full_first.rowsBetween(0, Window.unboundedFollowing)
    filled = F.coalesce(F.sum(limit).over(earlier), F.lit(0))
    filling = named.withColumn("level", (F.sum("total").over(everyone) - filled) / F.sum("weight").over(since)).withColumn(
        "full", limit <= F.col("weight") * F.col("level")).withColumn("turn", F.row_number().over(full_first))
    # a source of equal ratio may be full by the last bit only: those before the first one that is not full are full
    first = F.min(F.when(~F.col("full"), F.struct("turn", "level"))).over(everyone)
    return filling.withColumn("first", first).select(
        "source", "missing", "total", "place", "weight",
        F.when(F.col("first").isNull() | (F.col("turn") < F.col("first.turn")), limit.cast("double")).otherwise(
            F.col("weight") * F.col("first.level")).alias("target"))


def _let(name: str, value: str, body: str) -> str:
    """SQL text: ``body`` with ``name`` for a value that is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def hypergeometric(a: str, b: str, drawn: str, u: str) -> str:
    """SQL text: how many of ``a`` are among ``drawn`` of ``a + b`` (longs), by inversion of ``u`` in [0, 1).

    Numbers are tried from the most likely one outwards; their probabilities follow from it by ratios. Text,
    because one expression of this size takes Python's column objects half a second to build.
    """
    ratio_up = "acc.w * (s.a - k + 1) * (s.x - k + 1) / (k * (s.b - s.x + k))"
    ratio_down = "(CASE WHEN k = t.mode - 1 THEN 1D ELSE acc.w END) * ((k + 1) * (s.b - s.x + k + 1)) / ((s.a - k) * (s.x - k))"
    weight = f"CASE WHEN k = t.mode THEN 1D WHEN k > t.mode THEN {ratio_up} ELSE {ratio_down} END"
    total = f"aggregate(ks, named_struct('w', 1D, 'sum', 0D), (acc, k) -> {_let('w', weight, "named_struct('w', w, 'sum', acc.sum + w)")}).sum"
    step = "named_struct('w', w, 'sum', acc.sum + w, 'found', coalesce(acc.found, CASE WHEN acc.sum + w > goal THEN k END))"
    found = f"aggregate(ks, named_struct('w', 1D, 'sum', 0D, 'found', CAST(NULL AS BIGINT)), (acc, k) -> {_let('w', weight, step)}).found"
    numbers = """concat(sequence(t.mode, t.high),
        CASE WHEN t.low < t.mode THEN sequence(t.mode - 1, t.low) ELSE CAST(array() AS ARRAY<BIGINT>) END)"""
    picked = _let("ks", numbers, _let("goal", f"s.u * {total}", f"coalesce({found}, t.mode)"))
    deviation = "sqrt(s.x * s.a * s.b * (s.n - s.x) / (s.n * s.n * greatest(s.n - 1, 1D)))"
    reach = f"CASE WHEN s.n > 0 THEN CAST(ceil({deviation} * {REACH}) + {REACH} AS DOUBLE) ELSE 0D END"
    middle = "least(greatest(CAST(floor((s.x + 1) * (s.a + 1) / (s.n + 2)) AS DOUBLE), s.x - s.b, 0D), s.a, s.x)"
    bounds = """named_struct('mode', CAST(m AS BIGINT), 'low', CAST(greatest(s.x - s.b, 0D, m - r) AS BIGINT),
        'high', CAST(least(s.a, s.x, m + r) AS BIGINT))"""
    inner = _let("t", bounds, f"CASE WHEN t.low = t.high THEN t.low ELSE {picked} END")
    given = f"named_struct('a', CAST({a} AS DOUBLE), 'b', CAST({b} AS DOUBLE), 'n', CAST({a} + {b} AS DOUBLE), 'x', CAST({drawn} AS DOUBLE), 'u', {u})"
    return _let("s", given, _let("m", middle, _let("r", reach, inner)))


def _left_draw(nodes: DataFrame, depth: int, shards: int, seed: int) -> DataFrame:
    """``nodes`` with ``draw0``, the blocks of each source that the left half of a node's shards draws.

    ``q0`` are the quotas, ``q1`` those of pairs of sources and so on; what is drawn from a pair is split within it.
    """
    def add(df: DataFrame, name: str, value: str) -> DataFrame:
        return df.selectExpr("*", f"explode(array({value})) AS {name}")  # computed here, not wherever a lambda names it

    upto = lambda at: f"floor(`all` * ({at}) / {shards})"
    nodes = nodes.selectExpr("*", "quotas AS q0")
    for j in range(1, depth + 1):
        nodes = add(nodes, f"q{j}", f"transform(sequence(0, {(1 << (depth - j)) - 1}), i -> q{j - 1}[2 * i] + q{j - 1}[2 * i + 1])")
    nodes = add(nodes, f"draw{depth}", f"array(CAST({upto('first + `left`')} - {upto('first')} AS BIGINT))")
    for j in range(depth, 0, -1):
        u = f"shiftrightunsigned(xxhash64({seed}L, first, n, {j}, i), 11) * {2.0**-53}D"
        nodes = add(nodes, "lefts", f"transform(draw{j}, (x, i) -> {hypergeometric(f'q{j - 1}[2 * i]', f'q{j - 1}[2 * i + 1]', 'x', u)})")
        nodes = add(nodes, f"draw{j - 1}", f"flatten(zip_with(draw{j}, lefts, (x, y) -> array(y, x - y)))").drop("lefts")
    return nodes


def split_quotas(sources: DataFrame, shards: int, seed: int) -> DataFrame:
    """(shard, place, blocks): the quotas of ``sources`` split over the shards, whose totals differ by one at most.

    A node is a range of shards with the quotas of all sources. The draw for its left half goes down a binary
    tree over the sources: what falls to a pair of halves is split between them by a hypergeometric draw.
    """
    depth = max(0, (sources.count() - 1).bit_length())
    root = sources.agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "quota"))), lambda s: s["quota"]).alias("quotas"))
    root = root.withColumn("quotas", F.concat("quotas", F.array_repeat(F.lit(0).cast("long"), F.lit(1 << depth) - F.size("quotas"))))
    nodes = root.selectExpr("0L AS first", f"{shards}L AS n", "quotas", "aggregate(quotas, 0L, (s, q) -> s + q) AS `all`")
    for level in range(max(0, (shards - 1).bit_length())):
        nodes = _left_draw(nodes.selectExpr("*", "n DIV 2 AS `left`"), depth, shards, seed).selectExpr("`all`", """inline(array(
            named_struct('first', first, 'n', `left`, 'quotas', draw0),
            named_struct('first', first + `left`, 'n', n - `left`, 'quotas', zip_with(quotas, draw0, (q, x) -> q - x))))""").filter("n > 0")
        if level % 4 == 3:  # many shards: their nodes are dealt to the tasks
            nodes = nodes.repartition("first")
        nodes = written(nodes, "mix-nodes")  # else the plan holds every draw of every level
    return written(nodes.select(F.col("first").cast("int").alias("shard"), F.posexplode("quotas").alias("place", "blocks")).select(
        "shard", F.col("place").cast("long").alias("place"), "blocks").filter("blocks > 0"), "mix-splits")


def _drawn(sources: DataFrame, splits: DataFrame, seed: int) -> DataFrame:
    """(place, block, shard): each shard takes its number of blocks off the permuted blocks of every source."""
    hashed = Window.partitionBy("place").orderBy(F.xxhash64(F.lit(seed), "place", "block"), "block")  # at most BLOCKS + 1 rows
    blocks = sources.filter("quota > 0").select("place", F.explode(F.sequence(F.lit(0).cast("long"), F.col("quota") - 1)).alias("block"))
    permuted = blocks.withColumn("turn", (F.row_number().over(hashed) - 1).cast("long"))
    before = Window.partitionBy("place").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    taken = splits.withColumn("from", F.coalesce(F.sum("blocks").over(before), F.lit(0))).select(
        "place", "shard", F.explode(F.sequence(F.col("from"), F.col("from") + F.col("blocks") - 1)).alias("turn"))
    return written(permuted.join(taken, ["place", "turn"]).select("place", "block", "shard"), "mix-blocks")


def lines(rows: DataFrame) -> DataFrame:
    """``rows`` (written) with ``start``, the words before each row on the line of its source.

    The lines are range-partitioned; a row's start is its running sum within its partition and source, and
    the words of earlier partitions, of which there is one number per (source, partition).
    """
    keys = ["missing", "source", "order", "digest", "row"]
    laid = written(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("at", F.monotonically_increasing_id()), "mix-lines")
    laid = laid.withColumn("part", F.shiftright("at", _PARTITION_SHIFT))
    of_part = laid.groupBy("missing", "source", "part").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("missing", "source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = written(of_part.select("missing", "source", "part", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset")), "mix-offsets")
    running = Window.partitionBy("part", "missing", "source").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    placed = laid.withColumn("within", F.coalesce(F.sum("size").over(running), F.lit(0)))
    return placed.join(bounded_broadcast(offsets, MAX_BROADCAST_ROWS), ["missing", "source", "part"]).withColumn(
        "start", F.col("offset") + F.col("within")).drop("offset", "within", "at", "part", "row")


def mix(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[int] = WEIGHTS, passes: int = PASSES, seed: int = 1, blocks: int = BLOCKS) -> Mix:
    """The mix of ``docs``: which rows are taken, how often, and into which shards."""
    rows = written(docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(source_col), F.lit("")).alias("source"), F.col(source_col).isNull().alias("missing"),
        words(F.col(text_col)).alias("size"), F.coalesce(hash_order(seed, F.col(id_col)), F.lit("")).alias("order"),
        F.xxhash64(*docs.columns).alias("digest"), F.monotonically_increasing_id().alias("row"),
    ), "mix-rows")
    found = written(targets(rows.groupBy("missing", "source").agg(F.sum("size").alias("total")), weights, passes), "mix-targets")
    total = found.agg(F.sum("total")).first()[0] or 0
    block = max(1, -(-total // blocks))
    sources = found.withColumn("quota", F.ceil(F.col("target") / block).cast("long"))
    splits = split_quotas(sources, shards, seed)
    drawn = bounded_broadcast(_drawn(sources, splits, seed), MAX_BROADCAST_ROWS)
    placed = lines(rows).join(bounded_broadcast(sources.drop("weight", "quota"), MAX_BROADCAST_ROWS), ["missing", "source"])
    for p in range(passes):
        at = F.col("start") + F.lit(p) * F.col("total")
        # in doubles, as the target is one; places below 2**52 words are exact
        inside = F.when(2.0 * at.cast("double") + F.col("size") < 2.0 * F.col("target"), F.floor(at / block).cast("long"))
        here = drawn.select(F.col("place").alias(f"place_{p}"), F.col("block").alias(f"block_{p}"), F.col("shard").alias(f"shard_{p}"))
        placed = placed.withColumn("wanted", inside).join(
            here, (F.col("place") == F.col(f"place_{p}")) & (F.col("wanted") == F.col(f"block_{p}")), "left").drop(f"place_{p}", f"block_{p}", "wanted")
    taken = F.array_compact(F.array(*[F.col(f"shard_{p}") for p in range(passes)]))
    chosen = placed.select("id", "digest", "size", F.col("total").alias("source_size"), "target", taken.alias("shards"))
    return Mix(chosen, sources, splits, block)


def copies(docs: DataFrame, mixed: Mix, id_col: str = "doc_id", seed: int = 1) -> DataFrame:
    """The rows of the mix: the columns of ``docs``, and ``shard`` and ``turn``, the place of a copy in its shard.

    Equal rows are read once and repeated as often as all of them together are taken.
    """
    shard, turn = fresh(docs, "shard"), fresh(docs, "turn")
    key, digest = fresh(docs, "mix_id"), fresh(docs, "mix_digest")
    n, copy = fresh(docs, "mix_n"), fresh(docs, "mix_copy")
    wanted = mixed.rows.select(F.col("id").alias("its_id"), F.col("digest").alias("its_digest"), F.explode("shards").alias("its_shard")).groupBy(
        "its_id", "its_digest", "its_shard").count().select("its_id", "its_digest", F.col("its_shard").alias(shard), F.col("count").alias(n))
    keyed = docs.withColumn(digest, F.xxhash64(*docs.columns)).withColumn(key, F.col(id_col))
    same = F.col(key).eqNullSafe(wanted["its_id"]) & (F.col(digest) == wanted["its_digest"])
    found = keyed.dropDuplicates([key, digest]).join(wanted, same)
    each = found.select(*docs.columns, key, digest, shard, F.explode(F.sequence(F.lit(1).cast("long"), F.col(n))).alias(copy))
    return each.withColumn(turn, F.xxhash64(F.lit(seed), key, digest, shard, copy)).select(*docs.columns, shard, turn)


def write(docs: DataFrame, mixed: Mix, folder: str, id_col: str = "doc_id", seed: int = 1) -> None:
    """The mix as Parquet files in one folder per shard, shuffled inside the shard; a large shard has several files."""
    rows = copies(docs, mixed, id_col, seed)
    shard, turn = rows.columns[-2:]
    rows.repartitionByRange(shard, turn).sortWithinPartitions(shard, turn).write.partitionBy(shard).parquet(folder)
