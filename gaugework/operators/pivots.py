"""Exact k-nearest neighbours of vectors with many features, by distances to pivots.

Boxes around cells prune nothing once vectors have tens of features. The triangle inequality still does: with the
distances of all rows to a few pivots, two rows are at least as far apart as their distances to any pivot differ.

1. Pivots are the rows first in a hash order, at most ``PIVOTS``. Every row gets its distance to each and belongs to the
   nearest one; the rows of a pivot are cut into blocks of about ``BLOCK`` rows by their distance to it.
2. The rows of a block travel as one row of matrices. The k-th distance among neighbours in depth, or to the pivots, which are
   rows too, bounds a row's search radius; a block knows the largest radius of its rows.
3. Blocks know the range of their rows' distances to every pivot. A nested-loop join of the blocks leaves out pairs that cannot be
   within a radius of each other. It reads the blocks again and again and writes nothing: a block is never copied for the blocks it meets.
4. Where two blocks meet, ranges of rows next to each other in depth, then their rows, are ruled out by their distances to the pivots. Of what is
   left one matrix product gives squared distances up to a known rounding error; those that may be among the k best are
   computed from differences. A task keeps the k best of its rows over all meetings, whose k-th is the radius from then on. Every
   ``READ_BYTES`` of blocks that are met are a round, and rounds know the radii after those before.

The result is exact: neighbours are rows of other folds, ties go to the smaller id. How many distances
were computed is part of the result (``distances``). Vectors without any structure in hundreds of dimensions have all distances nearly
alike; then little is ruled out, as for every exact method, and the work approaches all pairs. Disk and memory do not: a task holds
``READ_BYTES`` of blocks, and what is written is proportional to the rows.

Rows without fold, or whose vector is null, empty or holds a null or a value that is not finite, have no neighbours and are none.
Vectors have one length, the commonest; others are treated like these.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from gaugework.functions.exprs import hash_order, ratio
from gaugework.session import broadcast_if_small, materialise

# Tasks get this module's code with the function, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIVOTS = 64
#: Rows and bytes of a block, and rows that are compared at a time.
BLOCK, BLOCK_BYTES, PIECE = 4096, 4 << 20, 512
#: Blocks that a task has in memory, and numbers of pairs whose differences it holds.
READ_BYTES, PAIR_SIZE = 64 << 20, 4 << 20
#: Rounding of distances never rules out a candidate that is as near as the k-th.
_SLACK = 1 + 1e-9


@dataclass
class Search:
    """``near``: (id, fold_id, rank, neighbour_id, neighbour_label, distance); ``distances``: one row (computed, all_pairs)."""

    near: DataFrame
    distances: DataFrame


def _rows(folds: DataFrame, vector: str, key: str, label: str) -> DataFrame:
    whole = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    named = folds.filter(F.col("fold_id").isNotNull() & (F.size(vector) > 0) & whole).select(
        F.col(key).alias("id"), F.col("fold_id").cast("long").alias("fold"), F.col(label).alias("label"),
        F.transform(vector, lambda c: c.cast("double")).alias("x"))
    common = named.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return named.filter(F.size("x") == (common["d"] if common else 0))


def _matrix(batch: pa.RecordBatch, column: str) -> np.ndarray:
    lists = batch.column(column)
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _gaps(x: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Euclidean distances of one vector to others, from differences, so that equal vectors have distance 0."""
    return np.sqrt(((others - x) ** 2).sum(axis=1))


def _to_pivots(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch, "x")
                far = np.stack([_gaps(p, x) for p in shared.value], axis=1)
                home = far.argmin(axis=1)
                offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * far.shape[1])
                yield pa.RecordBatch.from_arrays([
                    *batch.columns, pa.ListArray.from_arrays(offsets, pa.array(far.ravel())), pa.array(home),
                    pa.array(far[np.arange(len(x)), home])], names=[*batch.schema.names, "far", "home", "depth"])

    kinds = ", ".join(f"`{n}` {t}" for n, t in rows.dtypes)
    return rows.mapInArrow(run, f"{kinds}, far array<double>, home long, depth double")


def _blocked(rows: DataFrame, block: int) -> DataFrame:
    """``rows`` with ``ring``: the rows of a home are cut at quantiles of their depth."""
    sizes = rows.groupBy("home").agg(F.count(F.lit(1)).alias("n"), F.percentile_approx(
        "depth", [i / 256 for i in range(1, 256)], 4000).alias("q"))
    ways = F.least(F.lit(256), F.ceil(F.col("n") / block)).cast("int")
    cuts = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(ways - 1, F.lit(1))), lambda i: F.element_at(
        "q", F.greatest(F.floor(i * 256 / ways).cast("int"), F.lit(1)).cast("int"))))
    sizes = sizes.select("home", F.when(ways > 1, cuts).otherwise(F.array().cast("array<double>")).alias("cuts"), F.ceil(F.col("n") / (block * 256)).alias("salts"))
    placed = rows.join(broadcast_if_small(materialise(sizes)), "home")
    # homes of more than 256 blocks are also cut by a hash
    salt = F.pmod(F.xxhash64("id"), F.col("salts"))
    return placed.withColumn("ring", (F.size(F.filter("cuts", lambda c: c < F.col("depth"))) * F.col("salts") + salt).cast("long")).drop("cuts", "salts")


def _flat(batch: pa.RecordBatch, column: str) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False)


def _rounding(x: np.ndarray, y: np.ndarray) -> float:
    """More than the rounding error of a squared distance from squares and products."""
    return 16 * (x.shape[1] + 8) * np.finfo(float).eps * float((x**2).sum(axis=1).max(initial=0.0) + (y**2).sum(axis=1).max(initial=0.0))


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th smallest value of each line, infinite with fewer."""
    return np.partition(values, k - 1, axis=1)[:, k - 1] if values.shape[1] >= k else np.full(len(values), np.inf)


def _bounds(x: np.ndarray, far: np.ndarray, fold: np.ndarray, pivot_folds: np.ndarray, k: int) -> np.ndarray:
    """Per row a bound of the k-th distance to rows of other folds, from rows next to it and from the pivots; infinite with fewer of them."""
    radius = _kth(np.where(pivot_folds != fold[:, None], far, np.inf), k)
    for at in range(0, len(x), PIECE):
        own, folds = x[at:at + PIECE], fold[at:at + PIECE]
        squares = (own**2).sum(axis=1)
        upto = squares[:, None] + squares - 2 * (own @ own.T) + _rounding(own, own)
        upto = np.where((folds[:, None] == folds) | np.isnan(upto), np.inf, upto)
        radius[at:at + PIECE] = np.minimum(radius[at:at + PIECE], np.sqrt(_kth(upto, k)))
    return radius * _SLACK


def _packed(rows: DataFrame, k: int, pivot_folds: np.ndarray) -> DataFrame:
    """One row per block: its rows in the order of their depth, their radius, and the range of distances to each pivot."""
    kinds = dict(rows.dtypes)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        batch = table.sort_by("depth").combine_chunks().to_batches()[0]
        x, far, fold = _matrix(batch, "x"), _matrix(batch, "far"), batch.column("fold").to_numpy()
        radius = _bounds(x, far, fold, pivot_folds, k)
        one = lambda v: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v) if isinstance(v, np.ndarray) else v)
        return pa.table({
            "home": [key[0].as_py()], "ring": [key[1].as_py()],
            "ids": one(batch.column("id")), "labels": one(batch.column("label")), "fold": one(fold), "x": one(x.ravel()), "far": one(far.ravel()),
            "radius": one(radius), "lo": one(far.min(axis=0)), "hi": one(far.max(axis=0))})

    return rows.groupBy("home", "ring").applyInArrow(run, (
        f"home long, ring long, ids array<{kinds['id']}>, labels array<{kinds['label']}>, fold array<long>, x array<double>, "
        "far array<double>, radius array<double>, lo array<double>, hi array<double>"))


class _Block:
    """The rows of one block, as they come with column ``suffix`` in line ``i`` of a batch."""

    def __init__(self, batch: pa.RecordBatch, i: int, suffix: str = ""):
        line = batch.slice(i, 1)
        self.fold, self.ids, self.batch = _flat(line, "fold" + suffix), line.column("ids" + suffix).flatten(), line
        self.x, self.far = (_flat(line, c + suffix).reshape(len(self.fold), -1) for c in ("x", "far"))
        self.squares = (self.x**2).sum(axis=1)
        self.starts = np.arange(0, len(self.fold), PIECE)
        self.lo, self.hi = np.minimum.reduceat(self.far, self.starts), np.maximum.reduceat(self.far, self.starts)


def _in_order(ids: pa.Array) -> np.ndarray:
    """``ids`` as numbers of the same order."""
    if pa.types.is_integer(ids.type):
        return ids.to_numpy(zero_copy_only=False)
    return np.unique(np.array(ids.to_pylist(), dtype=object), return_inverse=True)[1]


class _Best:
    """The k best neighbours so far of the rows of a block."""

    def __init__(self, block: _Block, k: int, radius: np.ndarray, before: np.ndarray):
        self.k, self.ids, self.fold, self.radius = k, block.ids, block.fold, radius.copy()
        #: distances found in earlier rounds
        self.before = before.reshape(-1, k) if len(before) else np.full((len(radius), k), np.inf)
        self.row, self.distance = np.zeros(0, np.int64), np.zeros(0)
        self.nid = self.nlabel = None

    def add(self, row: np.ndarray, distance: np.ndarray, nid: pa.Array, nlabel: pa.Array) -> None:
        """Further candidates, of which the k best of each row stay."""
        row, distance = np.concatenate([self.row, row]), np.concatenate([self.distance, distance])
        if self.nid is not None:
            nid, nlabel = pa.concat_arrays([self.nid, nid]), pa.concat_arrays([self.nlabel, nlabel])
        order = np.lexsort((_in_order(nid), distance, row))
        row = row[order]
        first = np.searchsorted(row, row, side="left")
        stays = np.arange(len(row)) - first < self.k
        self.row, self.distance = row[stays], distance[order[stays]]
        self.nid, self.nlabel = nid.take(pa.array(order[stays])), nlabel.take(pa.array(order[stays]))
        rows, near = self.near()
        self.radius[rows] = np.minimum(self.radius[rows], near[:, -1] * _SLACK)

    def near(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows with candidates, and the k smallest distances of each over all rounds."""
        rows, first, at = np.unique(self.row, return_index=True, return_inverse=True)
        own = np.full((len(rows), self.k), np.inf)
        own[at, np.arange(len(self.row)) - first[at]] = self.distance
        return rows, np.sort(np.concatenate([self.before[rows], own], axis=1), axis=1)[:, :self.k]

    def close(self) -> np.ndarray:
        """Drop candidates that are none any more; the k smallest distances of all rows."""
        rows, near = self.near()
        self.before[rows] = near
        stays = self.distance <= self.radius[self.row]
        if self.nid is not None:
            self.nid, self.nlabel = (v.filter(pa.array(stays)) for v in (self.nid, self.nlabel))
        self.row, self.distance = self.row[stays], self.distance[stays]
        return self.before.ravel()


def _meet(asks: _Block, told: _Block, best: _Best) -> int:
    """Compare two blocks; returns how many distances of rows of different folds were computed."""
    computed, rounding = 0, _rounding(asks.x, told.x)
    for p, a0 in enumerate(asks.starts):
        for q, c0 in enumerate(told.starts):
            a, c = (np.arange(at, min(at + PIECE, len(b.fold))) for at, b in ((a0, asks), (c0, told)))
            a = a[np.maximum(told.lo[q] - asks.far[a], asks.far[a] - told.hi[q]).max(axis=1) <= best.radius[a]]
            if not len(a):
                continue
            c = c[np.maximum(asks.lo[p] - told.far[c], told.far[c] - asks.hi[p]).max(axis=1) <= best.radius[a].max()]
            if not len(c):
                continue
            folds, n = np.unique(asks.fold[a], return_counts=True)
            others, m = np.unique(told.fold[c], return_counts=True)
            computed += len(a) * len(c) - int(((folds[:, None] == others) * n[:, None] * m).sum())
            about = told.squares[c] - 2 * (asks.x[a] @ told.x[c].T)
            near = ~(about > (best.radius[a] ** 2 * _SLACK - asks.squares[a] + rounding)[:, None])  # what is no number is computed
            if near.sum() > 16 * best.k * len(a):
                upto = np.where((asks.fold[a][:, None] == told.fold[c]) | np.isnan(about), np.inf, about + 2 * rounding)
                near &= ~(about > _kth(upto, best.k)[:, None])
            left, right = np.nonzero(near & (asks.fold[a][:, None] != told.fold[c]))
            step = max(1, PAIR_SIZE // asks.x.shape[1])
            rows, distance = a[left], np.zeros(len(left))
            for at in range(0, len(left), step):
                gap = told.x[c[right[at:at + step]]] - asks.x[rows[at:at + step]]
                distance[at:at + step] = np.sqrt((gap**2).sum(axis=1))
            stays = distance <= best.radius[rows]
            if stays.any():
                at = pa.array(c[right[stays]])
                best.add(rows[stays], distance[stays], told.ids.take(at), told.batch.column("labels_2").flatten().take(at))
    return computed


@contextmanager
def _small_batches(spark: SparkSession):
    """Batches of one line, since a line holds two blocks."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _round(asks: DataFrame, told: DataFrame, k: int, kinds: dict[str, str]) -> DataFrame:
    """Compare the blocks of ``asks`` with those of ``told``, which every task reads whole.

    One line per block that met another: the radius and the k smallest distances of its rows from now on, the k best of each row if they are within its radius (lists of equal
    length), and the number of distances computed.
    """
    gap = F.array_max(F.zip_with(F.zip_with("lo_2", "hi", lambda a, b: a - b), F.zip_with("lo", "hi_2", lambda a, b: a - b), lambda a, b: F.greatest(a, b)))
    other = told.select(*[F.col(c).alias(f"{c}_2") for c in ("ids", "labels", "fold", "x", "far", "lo", "hi")]).repartition(1)
    met = asks.hint("shuffle_replicate_nl").join(other, gap <= F.array_max("radius")).select(
        "home", "ring", "ids", "fold", "x", "far", "radius", "near", "ids_2", "labels_2", "fold_2", "x_2", "far_2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple[int, int], _Best] = {}
        computed: dict[tuple[int, int], int] = {}
        held: tuple | None = None
        for batch in batches:
            for i in range(batch.num_rows):
                key = (batch.column("home")[i].as_py(), batch.column("ring")[i].as_py())
                if held is None or held[0] != key:
                    held = (key, _Block(batch, i))
                if key not in best:
                    best[key] = _Best(held[1], k, _flat(batch.slice(i, 1), "radius"), _flat(batch.slice(i, 1), "near").copy())
                computed[key] = computed.get(key, 0) + _meet(held[1], _Block(batch, i, "_2"), best[key])
        one = lambda v: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v)
        for key, b in best.items():
            near = b.close()
            at = pa.array(b.row)
            nid = b.ids[:0] if b.nid is None else b.nid
            nlabel = pa.array([], batch.schema.field("labels_2").type.value_type) if b.nlabel is None else b.nlabel
            yield pa.RecordBatch.from_arrays([
                pa.array([key[0]]), pa.array([key[1]]), one(pa.array(b.radius)), one(pa.array(near)), one(b.ids.take(at)), one(pa.array(b.fold[b.row])), one(pa.array(b.distance)),
                one(nid), one(nlabel), pa.array([computed[key]])], names=["home", "ring", "radius", "near", "id", "fold", "distance", "nid", "nlabel", "computed"])

    with _small_batches(asks.sparkSession):
        return materialise(met.mapInArrow(run, (
            f"home long, ring long, radius array<double>, near array<double>, id array<{kinds['id']}>, fold array<long>, distance array<double>, nid array<{kinds['id']}>, "
            f"nlabel array<{kinds['label']}>, computed long")))


def _nearest(blocks: DataFrame, k: int, parts: int, kinds: dict[str, str]) -> DataFrame:
    """Candidates for the k best of every row, and lines that tell how many distances were computed.

    The blocks are read in ``parts`` rounds. A round knows the radii after those before, so it adds fewer and fewer candidates.
    """
    found, radii = [], blocks.select("home", "ring", "radius", F.array().cast("array<double>").alias("near"))
    for part in range(parts):
        asks = blocks.drop("radius").join(broadcast_if_small(radii), ["home", "ring"]) if part else blocks.withColumn("near", F.array().cast("array<double>"))
        lines = _round(asks, blocks.filter(F.pmod(F.xxhash64("home", "ring"), F.lit(parts)) == part), k, kinds)
        found.append(lines)
        if part + 1 < parts:
            later = lines.select("home", "ring", F.struct("radius", "near").alias("later"))
            radii = materialise(radii.join(later, ["home", "ring"], "left").select(
                "home", "ring", F.coalesce("later", F.struct("radius", "near")).alias("now")).select("home", "ring", "now.*"))
    lines = reduce(DataFrame.unionByName, found)
    columns = ("id", "fold", "distance", "nid", "nlabel")
    near = lines.select(F.inline(F.arrays_zip(*columns))).withColumn("computed", F.lit(None).cast("long"))
    types = dict(near.dtypes)
    return near.unionByName(lines.select(*[F.lit(None).cast(types[c]).alias(c) for c in columns], "computed"))


def search(folds: DataFrame, vector: str, k: int, key: str = "id", label: str = "label", pivots: int = PIVOTS, block: int = BLOCK) -> Search:
    """The k nearest rows of other folds for every row of ``folds`` (key, fold_id, label, vector)."""
    if k < 1:
        raise ValueError(f"k must be at least 1, got {k}")
    spark = folds.sparkSession
    rows = materialise(_rows(folds, vector, key, label))
    kinds = dict(rows.dtypes)
    chosen = rows.select("x", "fold", hash_order(7, F.col("id")).alias("order")).orderBy("order", "id").limit(pivots).collect()
    points = np.array([r["x"] for r in chosen])
    out = f"id {kinds['id']}, fold long, distance double, nid {kinds['id']}, nlabel {kinds['label']}, computed long"
    if not len(points):
        empty = spark.createDataFrame([], out)
        return _answer(empty, rows, k, key, label)
    pivot_folds = np.array([r["fold"] for r in chosen])
    width = 8 * (points.shape[1] + len(points))
    parts = -(-rows.count() * width // READ_BYTES)
    packed = _packed(_blocked(_to_pivots(rows, points), min(block, max(1, BLOCK_BYTES // width))), k, pivot_folds)
    blocks = materialise(packed.repartition(max(parts, 4 * spark.sparkContext.defaultParallelism)))
    return _answer(_nearest(blocks, k, parts, kinds), rows, k, key, label)


def _answer(found: DataFrame, rows: DataFrame, k: int, key: str, label: str) -> Search:
    # a row with a repeated id is asked for as often as it occurs; each occurrence has the same answer
    closest = Window.partitionBy("id", "fold").orderBy("distance", "nid")
    near = found.filter("computed IS NULL").withColumn("rank", F.row_number().over(closest)).filter(F.col("rank") <= k)
    near = near.select(F.col("id").alias(key), F.col("fold").alias("fold_id"), "rank", F.col("nid").alias("neighbour_id"),
                       F.col("nlabel").alias("neighbour_label"), "distance")
    n = rows.groupBy("fold").count().agg(F.sum("count").alias("n"), F.sum(F.col("count") * F.col("count")).alias("same"))
    computed = found.agg(F.coalesce(F.sum("computed"), F.lit(0)).alias("computed"))
    distances = computed.crossJoin(n.select(F.coalesce(F.col("n") * F.col("n") - F.col("same"), F.lit(0)).alias("all_pairs")))  # one row each
    return Search(near, distances)


def predict(folds: DataFrame, vector: str, k: int, key: str = "id", label: str = "label", **options) -> DataFrame:
    """(key, fold_id, actual, predicted, confidence) for every row with a fold: votes of the k neighbours, ties to the smaller label."""
    near = search(folds, vector, k, key, label, **options).near
    best = near.groupBy(key, "neighbour_label").agg(F.count(F.lit(1)).alias("votes")).groupBy(key).agg(
        F.min(F.struct((-F.col("votes")).alias("v"), F.col("neighbour_label").alias("l"))).alias("best"))
    return folds.filter(F.col("fold_id").isNotNull()).join(best, key, "left").select(
        key, "fold_id", F.col(label).alias("actual"), F.col("best.l").alias("predicted"), ratio(-F.col("best.v"), F.lit(k)).alias("confidence"))
