"""Streaming ingest into the unified metrics table.

A batch writes only its own rows, in a folder of its own per stream and batch number, so its cost
does not grow with the table and streams do not overwrite each other. The current table is the
newest row per key over the last snapshot and the batches after it; compaction writes that down as
the next snapshot with a mark per stream, and later reads skip the batches below the marks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from gaugework.operators.checks import latest_per_key
from gaugework.plans.mlmetrics import enforce, with_defaults, write_layout
from gaugework.schemas import ML_METRICS, ML_METRICS_KEY

_STORED = [*ML_METRICS.fields, StructField("ingested_at", TimestampType()), StructField("place", LongType())]
_BATCHES = StructType([*_STORED, StructField("stream", StringType()), StructField("batch", LongType())])
_SNAPSHOTS = StructType([*_STORED, StructField("number", LongType())])
_MARKS = StructType([StructField("stream", StringType()), StructField("batch", LongType()), StructField("number", LongType())])


def _newest(rows: DataFrame) -> DataFrame:
    order = [F.col(c) for c in ("ingested_at", "place", "recorded_at", "metric_value")]
    return latest_per_key(rows, ML_METRICS_KEY, order)


def _written(spark: SparkSession, folder: str) -> bool:
    try:
        spark.read.format("binaryFile").load(f"{folder}/_SUCCESS").limit(1).count()
    except AnalysisException:
        return False
    return True


def _read(spark: SparkSession, schema: StructType, path: str) -> DataFrame:
    """The table at ``path``, empty if nothing was written there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def ingest_stream(stream: DataFrame, root: str, checkpoint: str, name: str, **trigger) -> StreamingQuery:
    """Start writing a stream of metric rows below ``root``.

    ``name`` tells the stream from all others that write there, also from an earlier one with
    another checkpoint. A repeated batch that was written completely is left as it is, so the times
    it filled in stay; one that was cut off was never visible and is written anew.
    """
    def write(batch: DataFrame, number: int) -> None:
        folder = f"{root}/batches/stream={name}/batch={number}"
        if _written(batch.sparkSession, folder):
            return
        rows = enforce(with_defaults(batch)).withColumns({
            "ingested_at": F.current_timestamp(), "place": F.lit(number).cast("long")})
        _newest(rows).write.mode("overwrite").parquet(folder)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _last_marks(spark: SparkSession, root: str) -> tuple[int, dict[str, int]]:
    """Number of the last snapshot (0: none) and the last batch of each stream in it: a row per stream."""
    marks = _read(spark, _MARKS, f"{root}/marks")
    last = marks.agg(F.max("number")).first()[0] or 0
    return last, {r["stream"]: r["batch"] for r in marks.filter(F.col("number") == last).collect()}


def _since(batches: DataFrame, marks: dict[str, int]) -> DataFrame:
    """The batches after the marks; the condition prunes folders."""
    known = [(F.col("stream") == s) & (F.col("batch") > b) for s, b in marks.items()]
    return batches.filter(reduce(lambda a, b: a | b, known, ~F.col("stream").isin(list(marks)))) if marks else batches


def _state(spark: SparkSession, root: str, last: int, marks: dict[str, int]) -> DataFrame:
    fresh = _since(_read(spark, _BATCHES, f"{root}/batches"), marks).drop("stream", "batch")
    if not last:
        return _newest(fresh)
    snapshot = _read(spark, _SNAPSHOTS, f"{root}/snapshots").filter(F.col("number") == last).drop("number")
    return _newest(snapshot.unionByName(fresh))


def current(spark: SparkSession, root: str) -> DataFrame:
    """The table as of now: per key the row that was ingested last."""
    return _state(spark, root, *_last_marks(spark, root)).drop("ingested_at", "place")


def compact(spark: SparkSession, root: str, path: str | None = None) -> None:
    """Write the next snapshot, so that batches up to now need not be read again.

    The marks are written last; a compaction that fails before them has no effect. With ``path``
    the table is also written there in the layout of the unified metrics table.
    """
    last, marks = _last_marks(spark, root)
    batches = _read(spark, _BATCHES, f"{root}/batches")
    seen = {r["stream"]: r["batch"] for r in _since(batches, marks).groupBy("stream").agg(F.max("batch").alias("batch")).collect()}
    upto = marks | seen
    bounded = [(F.col("stream") == s) & (F.col("batch") <= b) for s, b in upto.items()]
    fresh = _since(batches, marks).filter(reduce(lambda a, b: a | b, bounded, F.lit(False))).drop("stream", "batch")
    if last:
        fresh = fresh.unionByName(_read(spark, _SNAPSHOTS, f"{root}/snapshots").filter(F.col("number") == last).drop("number"))
    _newest(fresh).write.mode("overwrite").parquet(f"{root}/snapshots/number={last + 1}")
    spark.createDataFrame(list(upto.items()), "stream string, batch long").write.mode("overwrite").parquet(f"{root}/marks/number={last + 1}")
    if path:
        write_layout(current(spark, root), path)
