"""MinHash near-deduplication with compressed HyperMinHash registers.

A text's set is its distinct five-word shingles (words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z;
fewer words count as one shingle). A hash places each shingle in one of 128 buckets; a bucket keeps the
leading zeros of its smallest hash and ten bits after them in 16 bits. Four registers form a band;
32 bands. Two sets share no band with a probability of about 5e-11 at similarity 0.85 and 5e-8 at 0.80. Registers of
1024 buckets, folded to four bits each, compare the pairs that share a band.

Texts with equal sets are one node. Links are found without making the pairs of a bucket:

1. every node of a band bucket is paired with the bucket's first node, which is one row per member;
   registers rule out most, the others are verified on full sets; linked nodes form components;
2. buckets that still hold several components are compared inside tasks, pair by pair on registers. What
   comes out is not the pairs that may be links but a spanning forest of them: its trees are the groups
   in which such pairs lie, and a task sends at most as many rows as it has nodes;
3. the full sets of a group's nodes meet in a task, which settles every pair of different components that
   registers cannot rule out and sends the links that join components, again fewer than it has nodes.

Large buckets and groups are dealt in blocks that meet in pairs, so a task never holds more than two
blocks. Pairs within a component need no look: the largest component's nodes meet only the others' blocks.

A pair is ruled out by the sizes of the sets; by the mismatching registers, each of which proves a
shingle that is in one set only; and by the Jaccard estimate, corrected for chance collisions of
folded registers, if it is more than 5.5 standard deviations below the threshold. The first two are
exact. What registers leave open is settled on full sets, whatever their size.

Edge cases: null texts and texts without words have an empty set and are linked with nothing.
Repeated rows are members of one node. Null ids take part and never become a component's id while
another id is there. Empty tables give empty results. Extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from gaugework.llm.common import Memo, arrow_type, bounded_broadcast, discard, grouped, slices, without, written
from gaugework.llm.components import connected_components

SHINGLE = 5
BUCKET_BITS = 7
BUCKETS = 1 << BUCKET_BITS
MANTISSA_BITS = 10
BAND = 4
BANDS = BUCKETS // BAND
#: Similarity in percent from which sets are linked, unless the caller gives another.
PERCENT = 85
DEVIATIONS = 5.5
BLOCK = 1024
FINE_BITS = 10
FINE = 1 << FINE_BITS
#: Bytes of full sets in a block.
BLOCK_BYTES = 4 << 20
#: Values of a folded register besides 0 for an empty bucket.
FOLD = 15
MAX_BROADCAST_IDS = 500_000

_STEPS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                   0xE7037ED1A0B428DB], dtype=np.uint64)


@lru_cache(maxsize=1)
def _word_hashes() -> Memo:
    return Memo(xxhash.xxh64_intdigest)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text."""
    words = (text or "").encode().lower().split()  # bytes: white space and case of ASCII only
    h = np.fromiter(map(_word_hashes().__getitem__, words), np.uint64, len(words))
    if not len(h):
        return h
    n = min(SHINGLE, len(h))
    total = np.full(len(h) - n + 1, n, dtype=np.uint64) * _STEPS[SHINGLE]
    for i in range(n):
        total += h[i:len(h) - n + 1 + i] * _STEPS[i]
    return np.unique(_mixed(total))


def registers(found: np.ndarray, bits: int = BUCKET_BITS) -> np.ndarray:
    """HyperMinHash registers of a sorted set: (leading zeros + 1) and mantissa of each bucket's minimum; 0 if empty."""
    out = np.zeros(1 << bits, dtype=np.uint16)
    if len(found):
        bucket, first = np.unique(found >> np.uint64(64 - bits), return_index=True)
        low = (found[first] << np.uint64(bits)) | np.uint64(1 << (bits - 1))  # never zero
        length = np.floor(np.log2(low.astype(np.float64))).astype(np.int64)
        length -= (low >> length.clip(0, 63).astype(np.uint64)) == 0  # a float may round up to the next power
        mantissa = np.where(length >= MANTISSA_BITS, low >> (length - MANTISSA_BITS).clip(0).astype(np.uint64),
                            low << (MANTISSA_BITS - length).clip(0).astype(np.uint64)) & np.uint64((1 << MANTISSA_BITS) - 1)
        zeros = (64 - length).astype(np.uint64)
        out[bucket.astype(np.int64)] = ((zeros.clip(1, 63) << np.uint64(MANTISSA_BITS)) | mantissa).astype(np.uint16)
    return out


def folded(found: np.ndarray) -> np.ndarray:
    """The registers of 1024 buckets in four bits each, two to a byte; 0 only for an empty bucket."""
    r = registers(found, FINE_BITS)
    four = np.where(r > 0, r % FOLD + 1, 0).astype(np.uint8)
    return four[0::2] | (four[1::2] << 4)


def may_link(a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Which rows of folded registers ``a`` (set sizes ``n``) and ``b`` (sizes ``m``) can belong to linked sets."""
    keep = 100 * np.minimum(n, m) >= percent * np.maximum(n, m)
    apart, either = a ^ b, a | b
    different = np.count_nonzero(apart & 15, axis=-1) + np.count_nonzero(apart >> 4, axis=-1)
    # every mismatch is an element of one set only: with s of them, similarity <= (n + m - s) / (n + m + s)
    keep &= 100 * (n + m - different) >= percent * (n + m + different)
    used = np.maximum(np.count_nonzero(either & 15, axis=-1) + np.count_nonzero(either >> 4, axis=-1), 1)
    # one in FOLD of the registers that differ collides by chance
    estimate = 1 - different * FOLD / (FOLD - 1) / used
    limit = percent / 100
    return keep & (estimate >= limit - DEVIATIONS * np.sqrt(limit * (1 - limit) / used))


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def sketch(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, digest, n, a, b, registers, fine): a and b are a 128-bit hash of the whole set."""
    named = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("digest"), F.col(text_col).alias("text"))
    kind = arrow_type(named, "id")
    names = ["id", "digest", "n", "a", "b", "registers", "fine"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = [shingles(t) for t in part.column("text").to_pylist()]
            both = np.array([np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), dtype=">i8") for s in sets], dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([
                part.column("id"), part.column("digest"), pa.array([len(s) for s in sets], pa.int64()), pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()),
                pa.array([registers(s).tobytes() for s in sets], pa.binary()),
                pa.array([folded(s).tobytes() for s in sets], pa.binary()),
            ], names=names)
        _word_hashes().clear()

    long = T.LongType()
    out = T.StructType([named.schema["id"], *(T.StructField(c, long) for c in names[1:5]), T.StructField("registers", T.BinaryType()),
                        T.StructField("fine", T.BinaryType())])
    assert kind is not None
    return named.mapInArrow(run, out)


def band_keys(nodes: DataFrame) -> DataFrame:
    """(key, node): one row per band that is not all empty."""
    size = 2 * BAND
    part = [F.substring("registers", size * i + 1, size) for i in range(BANDS)]
    keys = F.array(*(F.when(p != F.lit(bytearray(size)), F.xxhash64(F.lit(i), p)) for i, p in enumerate(part)))
    return nodes.select(F.explode(keys).alias("key"), "node").filter("key IS NOT NULL")


def _table(column: pa.Array) -> np.ndarray:
    """Folded registers of a column of binaries, one row each."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, FINE // 2)


def _possible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) that may be links: sizes first, so that fewer rows carry registers."""
    for side in ("x", "y"):
        pairs = pairs.join(nodes.select(F.col("node").alias(side), F.col("n").alias(f"n_{side}")), side)
    low, high = F.least("n_x", "n_y"), F.greatest("n_x", "n_y")
    pairs = pairs.filter(100 * low >= percent * high)
    for side in ("x", "y"):
        pairs = pairs.join(nodes.select(F.col("node").alias(side), F.col("fine").alias(f"r_{side}")), side)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n, m = (batch.column(c).to_numpy() for c in ("n_x", "n_y"))
                keep = may_link(_table(batch.column("r_x")), n, _table(batch.column("r_y")), m, percent)
                yield batch.select(["x", "y"]).filter(pa.array(keep))

    return pairs.select("x", "y", "n_x", "n_y", "r_x", "r_y").mapInArrow(run, "x long, y long")


def full_sets(needed: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Written (node, members): the whole sets of the nodes in ``needed`` (written, distinct)."""
    needed = written(needed.join(nodes, "node").select("node", "a", "b", F.col("first_id").alias("its_id")), "near-needed")
    ids = bounded_broadcast(needed.select("its_id").distinct(), MAX_BROADCAST_IDS)
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    texts = named.join(ids, named["id"].eqNullSafe(ids["its_id"]), "left_semi").select("text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found = [s.tobytes() for s in map(shingles, part.column("text").to_pylist())]
            both = np.array([np.frombuffer(xxhash.xxh3_128_digest(s), dtype=">i8") for s in found], dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()), pa.array(found, pa.binary())], names=["a", "b", "members"])
        _word_hashes().clear()

    full = texts.mapInArrow(sets, "a long, b long, members binary").join(needed.select("node", "a", "b"), ["a", "b"])
    full = written(full.select("node", "members").dropDuplicates(["node"]), "near-sets")
    discard(needed)
    return full


def verify(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """The pairs (x, y) that are links on their full sets. ``pairs`` is a written table."""
    needed = written(pairs.select(F.col("x").alias("node")).unionByName(pairs.select(F.col("y").alias("node"))).distinct(), "near-needed")
    full = full_sets(needed, nodes, docs, id_col, text_col)
    for side in ("x", "y"):
        pairs = pairs.join(full.select(F.col("node").alias(side), F.col("members").alias(f"s_{side}")), side)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [linked(np.frombuffer(a.as_buffer(), dtype=np.uint64), np.frombuffer(b.as_buffer(), dtype=np.uint64), percent)
                    for a, b in zip(batch.column("s_x"), batch.column("s_y"), strict=True)]
            yield batch.select(["x", "y"]).filter(pa.array(keep, pa.bool_()))

    found = written(pairs.mapInArrow(check, "x long, y long"), "near-links")
    discard(needed, full)
    return found


def deal(members: DataFrame, limit: int) -> DataFrame:
    """(key, i, j, own, node, label): the nodes of every key with several labels, dealt so that all pairs of labels meet.

    ``members`` is (key, node, label, weight). The nodes of the label that weighs most are dealt into blocks of
    about ``limit``, the others too. Each block of the former (``i`` below 0) meets each of the latter, and the
    others' blocks meet in pairs. Nodes travel here alone; what tasks need of them is fetched after.
    """
    of_label = members.groupBy("key", "label").agg(F.sum("weight").alias("weight"))
    of_key = of_label.groupBy("key").agg(
        F.max(F.struct("weight", "label")).alias("most"), F.sum("weight").alias("all"), F.count(F.lit(1)).alias("labels")).filter("labels > 1")
    blocks = lambda weight: F.ceil(weight / limit).cast("int")
    of_key = of_key.select("key", F.col("most.label").alias("main"), blocks(F.col("most.weight")).alias("mains"),
                           blocks(F.col("all") - F.col("most.weight")).alias("others"))
    placed = members.join(of_key, "key").withColumn("is_main", F.col("label") == F.col("main"))
    own = F.pmod(F.xxhash64("node"), F.when(F.col("is_main"), F.col("mains")).otherwise(F.col("others"))).cast("int")
    placed = placed.withColumn("own", F.when(F.col("is_main"), -1 - own).otherwise(own))
    meets = F.when(F.col("is_main"), F.sequence(F.lit(0), F.col("others") - 1)).otherwise(
        F.concat(F.sequence(-F.col("mains"), F.lit(-1)), F.sequence(F.lit(0), F.col("others") - 1)))
    dealt = placed.withColumn("other", F.explode(meets))
    return dealt.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "label")


def _sides(own: np.ndarray, i: int, j: int) -> tuple[np.ndarray, Callable[[int], int]]:
    """Places of the nodes that look for partners, and from which place on the partners of one stand; nodes are ordered by ``own``."""
    if i == j:
        return np.arange(len(own)), lambda at: at + 1
    first = np.flatnonzero(own == i)
    return first, lambda at: len(first)


def _groups(dealt: DataFrame, run: Callable) -> DataFrame:
    keys = ["key", "i", "j"]
    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
        lambda batches: (out for group in grouped(batches, keys) if group.num_rows > 1 for out in run(group)), "x long, y long")


def _forest(dealt: DataFrame, percent: int) -> DataFrame:
    """Edges (x, y) that connect all nodes of different labels that share a bucket and may be linked."""

    def run(group: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        order = np.argsort(group.column("own").to_numpy(), kind="stable")
        own, node, label, n = (group.column(c).to_numpy()[order] for c in ("own", "node", "label", "n"))
        table, tree = _table(group.column("fine"))[order], np.arange(len(order))
        places, after = _sides(own, group.column("i")[0].as_py(), group.column("j")[0].as_py())
        left, right = [], []
        for at in places.tolist():
            rest = np.arange(after(at), len(own))
            # partners of a tree this node is in already bring nothing new
            fit = rest[(label[rest] != label[at]) & (tree[rest] != tree[at]) & (100 * np.minimum(n[rest], n[at]) >= percent * np.maximum(n[rest], n[at]))]
            if len(fit):
                fit = fit[may_link(table[at], n[at], table[fit], n[fit], percent)]
            if len(fit):
                trees, one = np.unique(tree[fit], return_index=True)
                left.append(np.full(len(one), node[at]))
                right.append(node[fit[one]])
                tree[np.isin(tree, trees)] = tree[at]
        if left:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], names=["x", "y"])

    return _groups(dealt, run)


def _joining(dealt: DataFrame, percent: int) -> DataFrame:
    """Links (x, y) on full sets that connect all labels that any link of the group connects."""

    def run(group: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        order = np.argsort(group.column("own").to_numpy(), kind="stable")
        own, node, label = (group.column(c).to_numpy()[order] for c in ("own", "node", "label"))
        sets = [np.frombuffer(m.as_buffer(), dtype=np.uint64) for m in group.column("members").take(pa.array(order))]
        n, tree = np.array([len(s) for s in sets]), label.copy()
        table = np.stack([folded(s) for s in sets])
        places, after = _sides(own, group.column("i")[0].as_py(), group.column("j")[0].as_py())
        left, right = [], []
        for at in places.tolist():
            rest = np.arange(after(at), len(own))
            fit = rest[(tree[rest] != tree[at]) & (100 * np.minimum(n[rest], n[at]) >= percent * np.maximum(n[rest], n[at]))]
            if len(fit):
                fit = fit[may_link(table[at], n[at], table[fit], n[fit], percent)]
            for other in fit.tolist():
                if tree[other] != tree[at] and linked(sets[at], sets[other], percent):
                    left.append(node[at])
                    right.append(node[other])
                    tree[tree == tree[other]] = tree[at]
        if left:
            yield pa.RecordBatch.from_arrays([pa.array(left), pa.array(right)], names=["x", "y"])

    return _groups(dealt, run)


def across(members: DataFrame, labels: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """Written links between different components of nodes that share a bucket; joins every pair of components that a link joins.

    ``members`` is (key, node), ``labels`` the components (node, label) of the nodes that have links.
    """
    labelled = members.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"), F.lit(1).alias("weight"))
    dealt = written(deal(labelled, BLOCK), "near-dealt")
    forest = written(_forest(dealt.join(nodes.select("node", "n", "fine"), "node"), percent).distinct(), "near-forest")
    discard(dealt)
    if forest.isEmpty():
        return forest
    trees = connected_components(forest)
    full = full_sets(trees.select("node"), nodes, docs, id_col, text_col)
    sized = trees.join(nodes.select("node", "n"), "node").join(labels.withColumnRenamed("label", "component"), "node", "left")
    sized = sized.select(F.col("label").alias("key"), "node", F.coalesce("component", "node").alias("label"), (8 * F.col("n")).alias("weight"))
    dealt = written(deal(sized, BLOCK_BYTES), "near-dealt")
    found = written(_joining(dealt.join(full, "node"), percent).distinct(), "near-joining")
    discard(dealt, full, forest)
    return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per input row: id, digest (of the text), n_shingles, component_id (smallest id reachable by links)."""
    rows = written(sketch(docs, id_col, text_col), "near-sketches")
    # sets of equal hashes are equal, and so are their registers
    nodes = rows.filter("n > 0").groupBy("a", "b", "n").agg(
        F.first("registers").alias("registers"), F.first("fine").alias("fine"), F.min("id").alias("first_id"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "near-nodes")
    keys = band_keys(nodes)
    shared = keys.groupBy("key").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = written(keys.join(shared.select("key", "head"), "key"), "near-members")
    stars = members.filter("node <> head").select(F.col("head").alias("x"), F.col("node").alias("y")).distinct()
    stars = written(_possible(stars, nodes, percent), "near-stars")
    links = verify(stars, nodes, docs, id_col, text_col, percent)
    labels = connected_components(links)
    more = across(members, labels, nodes, docs, id_col, text_col, percent)
    discard(members, stars)
    if not more.isEmpty():
        labels = connected_components(links.unionByName(more))
    of_node = written(nodes.join(labels, "node", "left").select("a", "b", F.coalesce("label", "node").alias("label"), "first_id"), "near-labels")
    smallest = of_node.groupBy("label").agg(F.min("first_id").alias("component_id"))
    named_nodes = of_node.join(smallest, "label").select("a", "b", "component_id")
    grouped_rows = rows.filter("n > 0").join(named_nodes, ["a", "b"]).select("id", "digest", F.col("n").alias("n_shingles"), "component_id")
    alone = rows.filter("n = 0").select("id", "digest", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    return grouped_rows.unionByName(alone)


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay: one of each component, and every text without words."""
    found = written(near_duplicates(docs, id_col, text_col, percent).filter("n_shingles > 0"), "near-found")
    named = F.col("id").eqNullSafe(F.col("component_id"))
    chosen = found.filter(named).groupBy("id").agg(F.min("digest").alias("stays"))
    chosen = chosen.select(F.col("id").alias("head"), "stays")
    candidates = found.filter(named).join(chosen, F.col("id").eqNullSafe(F.col("head")))
    gone = found.filter(~named).select("id", "digest").unionByName(candidates.filter("digest <> stays").select("id", "digest"))
    once = candidates.filter("digest = stays").groupBy("id", "digest").count().filter("count > 1").select("id", "digest")
    return without(docs, id_col, F.xxhash64(docs[text_col]), written(gone.distinct(), "near-gone"), written(once, "near-once"))
