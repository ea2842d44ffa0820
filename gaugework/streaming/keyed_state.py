"""The unified metrics table as a stream with state per key.

The state of a key is its newest row (of equal times that with the larger value, of equal ones the first) and the time of the batch that brought it.
It is a streaming aggregate, which combines rows before the shuffle and touches the state of a batch's own keys alone, in the JVM. What goes out are the rows
that the batch at hand brought, numbered by the batch; rows that are older than the state change nothing. So the work of a batch follows its own rows,
wherever the table stands, and the table does not depend on how rows fall into batches or on their order. Each batch replaces its own folder, so it is
there once, also after a restart; the table is the change with the highest number of each key.

Key parts must not be null and texts must fit their columns, as in batch ingest. A null or NaN value counts as smaller than all others and is null
in the table. State lies in RocksDB, so the number of keys is not bounded by memory.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gaugework.operators.checks import latest_per_key
from gaugework.plans.mlmetrics import enforce, with_defaults
from gaugework.schemas import ML_METRICS, ML_METRICS_KEY

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_CHANGES = T.StructType([*ML_METRICS.fields, T.StructField("change", T.LongType())])


@contextmanager
def _rocks(spark: SparkSession):
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def changes(stream: DataFrame) -> DataFrame:
    """The rows of each batch of ``stream`` that change the table, in update mode. The stream needs RocksDB state."""
    value = F.col("metric_value")
    rows = enforce(with_defaults(stream)).select(*ML_METRICS_KEY, F.struct(*[f.name for f in ML_METRICS.fields]).alias("row"), F.struct(
        F.unix_micros("recorded_at"), F.when(value.isNull() | F.isnan(value), float("-inf")).otherwise(value),
        -F.unix_micros(F.current_timestamp())).alias("place"))  # in a stream, the time of the batch
    newest = rows.groupBy(*ML_METRICS_KEY).agg(F.max_by("row", "place").alias("row"), F.max("place").alias("place"))
    return newest.filter(F.col("place.col3") == -F.unix_micros(F.current_timestamp())).select("row.*")


def start(stream: DataFrame, root: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Start writing the changes that ``stream`` makes below ``root``."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/changes/change={number + 1}")

    with _rocks(stream.sparkSession):  # a query keeps the settings it was started with
        return (changes(stream).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
                .outputMode("update").trigger(**(trigger or {"availableNow": True})).start())


def current(spark: SparkSession, root: str) -> DataFrame:
    """The table as of now."""
    return latest_per_key(spark.read.schema(_CHANGES).parquet(f"{root}/changes"), ML_METRICS_KEY, [F.col("change")]).drop("change")
