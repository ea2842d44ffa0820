"""Benchmark decontamination as a prefix-filtered set join of windows with documents.

Every run of ``window`` consecutive words of a benchmark item is a window (an item of fewer words,
but not none, is one window). A window is held as the set of its placed shingles of up to three
words. As containment must be complete, one shingle is the necessary prefix: shingles are ordered
by how often they occur in the documents, and the rarest one indexes the window. A document's
shingles join that index; a hit must leave room for the rest of the window on both sides
(positions and length), and then the whole window is compared word by word.

Everything happens in one scan of the documents: the words of a text stay beside the exploded
positions only inside the join's generated code, so no text is shuffled. The index is broadcast in
blocks of a bounded number of windows; a larger benchmark takes more passes, not more memory.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. Edge cases: null and empty
texts have no words and no hits; an item without words has no window; equal windows of several
items hit for all of them; repeated rows of documents give repeated result rows; an empty table of
either kind gives zero hits or no rows. Extra columns do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugework.llm.common import bounded_broadcast, lower_ascii, written
from gaugework.session import broadcast_if_small

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW_WORDS = 10
SHINGLE_WORDS = 3
#: Windows in one broadcast block; a window is at most ``window`` words.
BLOCK_WINDOWS = 100_000
#: Bytes of a block that is broadcast.
BLOCK_BYTES = 64 << 20


def words(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), SEPARATORS), "")


def shingle_hash(tokens: Column, at: Column, size: int) -> Column:
    """Hash of ``size`` words from the 0-based place ``at``; words past the end count as null."""
    return F.xxhash64(F.lit(size), *(F.get(tokens, at + i) for i in range(size)))


def item_windows(benchmark: DataFrame, item_col: str, text_col: str, window: int) -> DataFrame:
    """(item, tokens): every window of every item."""
    items = benchmark.select(F.col(item_col).cast("string").alias("item"), words(F.col(text_col)).alias("w"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0)))
    return items.filter(F.size("w") > 0).select("item", "w", F.explode(starts).alias("s")).select(
        "item", F.slice("w", F.col("s") + 1, F.lit(window)).alias("tokens"),
    )


def _exploded(docs: DataFrame, text_col: str, sizes: list[int], *keep: Column) -> DataFrame:
    """One row per word place and shingle size: kept columns, w, pos, shingle.

    ``w`` holds the words after an empty first entry, so that every document has a row of place 0,
    once and without a shingle; word i of the text is at place i + 1.
    """
    sentinel = F.concat(F.array(F.lit("")), words(F.col(text_col)))
    base = docs.select(*keep, sentinel.alias("w"))
    placed = base.select("*", F.posexplode("w").alias("pos", "word")).drop("word")
    nothing = F.lit(None).cast("long")
    each = [shingle_hash(F.col("w"), F.col("pos"), n) for n in sizes]
    if len(each) == 1:
        return placed.withColumn("shingle", F.when(F.col("pos") > 0, each[0]).otherwise(nothing))
    return placed.withColumn("shingle", F.explode(F.when(F.col("pos") > 0, F.array(*each)).otherwise(F.array(nothing))))


def rarest_shingles(docs: DataFrame, text_col: str, windows: DataFrame, sizes: list[int]) -> DataFrame:
    """(wid, tokens, n, off, shingle): each window with the shingle that is rarest in the documents."""
    size = F.least(F.size("tokens"), F.lit(SHINGLE_WORDS))
    places = windows.select("wid", "tokens", F.explode(F.sequence(F.lit(0), F.size("tokens") - size)).alias("off"))
    shingle = F.lit(None).cast("long")
    for n in sizes:
        shingle = F.when(size == n, shingle_hash(F.col("tokens"), F.col("off"), n)).otherwise(shingle)
    places = written(places.withColumn("shingle", shingle), "decontaminate-shingles")
    wanted = written(places.select("shingle").distinct(), "decontaminate-wanted")
    blocks = -(-wanted.count() // (BLOCK_WINDOWS * 8))
    counts = None
    for i in range(blocks):
        block = wanted.filter(F.pmod("shingle", F.lit(blocks)) == i) if blocks > 1 else wanted
        part = _exploded(docs, text_col, sizes).join(F.broadcast(block), "shingle").groupBy("shingle").count()
        counts = part if counts is None else counts.unionByName(part)
    ranked = places.join(counts, "shingle", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    first = Window.partitionBy("wid").orderBy("count", "off")
    return ranked.withColumn("rank", F.row_number().over(first)).filter("rank = 1").select(
        "wid", "tokens", F.size("tokens").alias("n"), "off", "shingle",
    )


def covered(spans: Column) -> Column:
    """Number of places in the union of ``spans``, an array of (start, n)."""
    step = lambda acc, x: F.struct(
        F.greatest(acc["end"], x["start"] + x["n"]).alias("end"),
        (acc["total"] + F.greatest(x["start"] + x["n"] - F.greatest(acc["end"], x["start"]), F.lit(0))).alias("total"),
    )
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))
    return F.aggregate(F.array_sort(spans), zero, step, lambda acc: acc["total"])


def contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW_WORDS,
) -> DataFrame:
    """One row per input row: id, digest (MD5 of the text), n_words, n_hit, items (item ids as sorted strings)."""
    key = [F.col(id_col).alias("id"), F.md5(F.coalesce(F.col(text_col), F.lit(""))).alias("digest")]
    per_item = item_windows(benchmark, item_col, item_text_col, window)
    windows = written(per_item.groupBy("tokens").agg(F.collect_set("item").alias("items")).withColumn(
        "wid", F.monotonically_increasing_id()), "decontaminate-windows")
    sizes = sorted(r[0] for r in windows.select(F.least(F.size("tokens"), F.lit(SHINGLE_WORDS))).distinct().collect())
    if not sizes:
        return docs.select(
            *key, F.size(words(F.col(text_col))).cast("long").alias("n_words"),
            F.lit(0).cast("long").alias("n_hit"), F.array().cast("array<string>").alias("items"),
        )
    index = written(rarest_shingles(docs, text_col, windows, sizes), "decontaminate-index")
    blocks = max(1, -(-index.count() // BLOCK_WINDOWS))
    start = F.col("pos") - F.col("off")  # 1-based, as place 0 is no word
    fits = (start >= 1) & (start + F.col("n") <= F.size("w"))
    same = F.slice("w", F.greatest(start, F.lit(1)) + 1, F.col("n")) == F.col("tokens")
    found = None
    for i in range(blocks):
        block = index.filter(F.pmod("shingle", F.lit(blocks)) == i) if blocks > 1 else index
        # words may be of any length, so bytes are checked too; beyond them Spark shuffles the join
        block = broadcast_if_small(block.withColumnRenamed("shingle", "prefix"), 2 * BLOCK_WINDOWS, BLOCK_BYTES)
        joined = _exploded(docs, text_col, sizes, *key).join(
            block, (F.col("shingle") == F.col("prefix")) & fits & same, "inner" if i else "left",
        )
        part = joined.filter(F.col("wid").isNotNull() | (F.col("pos") == 0)).select(
            "id", "digest", (F.size("w") - 1).cast("long").alias("n_words"), start.alias("start"), "n", "wid",
            (F.col("pos") == 0).cast("int").alias("one"),
        )
        found = part if found is None else found.unionByName(part)
    hit = F.col("wid").isNotNull()
    per_text = written(found.groupBy("id", "digest", "n_words").agg(
        F.sum("one").cast("int").alias("copies"),
        F.collect_set(F.when(hit, F.struct("start", "n"))).alias("spans"),
        F.collect_set("wid").alias("wids"),
    ), "decontaminate-found")
    items = per_text.filter(F.size("wids") > 0).select("id", "digest", F.explode("wids").alias("wid")).join(
        windows.select("wid", F.explode("items").alias("item")), "wid",
    ).groupBy(F.col("id").alias("its_id"), F.col("digest").alias("its_digest")).agg(
        F.array_sort(F.collect_set("item")).alias("items"),
    )
    none = F.array().cast("array<string>")
    same_text = per_text["id"].eqNullSafe(items["its_id"]) & (per_text["digest"] == items["its_digest"])
    return per_text.join(items, same_text, "left").select(
        "id", "digest", "n_words", covered(F.col("spans")).cast("long").alias("n_hit"), F.coalesce("items", none).alias("items"),
        F.explode(F.array_repeat(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      max_broadcast_rows: int = 500_000, **options) -> DataFrame:
    """The rows of ``docs`` without any hit, with all their columns.

    Rows are told apart by id and text digest, so a repeated id with a clean text stays.
    """
    found = contamination(docs, benchmark, id_col, text_col, **options)
    hit = written(found.filter("n_hit > 0").select("id", "digest").distinct(), "decontaminate-hit")
    hit = bounded_broadcast(hit, max_broadcast_rows)
    same = docs[id_col].eqNullSafe(hit["id"]) & (F.md5(F.coalesce(docs[text_col], F.lit(""))) == hit["digest"])
    return docs.join(hit, same, "left_anti")
