"""The unified, keyed metrics table: ingest, layout, filters, comparison."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugework.functions.exprs import split_tags
from gaugework.operators.checks import key_violations, latest_per_key
from gaugework.schemas import ML_METRICS, ML_METRICS_KEY, ML_METRICS_LENGTHS
from gaugework.sources.tables import conform


def with_defaults(rows: DataFrame, now: Column | None = None) -> DataFrame:
    """The table's ten columns; missing metric_type is 'scalar', missing time is ``now``."""
    now = F.current_timestamp() if now is None else now
    if dict(rows.dtypes).get("tags") == "string":
        rows = rows.withColumn("tags", split_tags(F.col("tags")))
    return conform(rows, ML_METRICS, {"metric_type": "scalar", "recorded_at": now})


def enforce(rows: DataFrame) -> DataFrame:
    """Fail at run time on a NULL key part or on text longer than its column allows."""
    checked = rows
    for k in ML_METRICS_KEY:
        checked = checked.withColumn(k, F.coalesce(
            k, F.raise_error(F.lit(f"{k} must not be NULL")).cast("string")
        ))
    for c, most in ML_METRICS_LENGTHS.items():
        checked = checked.withColumn(c, F.when(
            F.length(c) > most, F.raise_error(F.lit(f"{c} is longer than {most}")).cast("string")
        ).otherwise(F.col(c)))
    return checked


def violations(rows: DataFrame) -> DataFrame:
    """Keys that break the table's primary key."""
    return key_violations(rows, ML_METRICS_KEY)


def from_log(
    log: DataFrame,
    pipeline_id: str,
    model_version: Column,
    environment: str,
    now: Column | None = None,
) -> DataFrame:
    """Metric log rows as rows of the unified table.

    The key has no model and no fold, so both become part of the metric's name; the fold,
    the model and the hyper-parameters are also kept as JSON.
    """
    rows = log.select(
        F.lit(pipeline_id).alias("pipeline_id"),
        "run_id",
        F.concat_ws("/", "model_name", F.concat(F.lit("fold"), F.col("fold_number").cast("string")),
                    "metric_name").alias("metric_name"),
        "metric_value",
        F.col("created_at").alias("recorded_at"),
        model_version.alias("model_version"),
        F.lit(environment).alias("environment_label"),
        F.array("platform", "metric_name").alias("tags"),
        F.to_json(F.struct(
            F.col("fold_number").alias("fold"), F.col("model_name").alias("model"),
            F.col("hyperparameters").alias("hyperparameters"),
        )).alias("metadata_json"),
    )
    return with_defaults(rows, now)


def ingest(existing: DataFrame, rows: DataFrame) -> DataFrame:
    """The table after adding ``rows``: checked, one row per key, the latest time wins.

    A row older than the one in the table does not replace it; one of the same time does.
    """
    new = enforce(rows).select(*existing.columns)
    both = existing.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    order = [F.col("recorded_at"), F.col("_new"), F.col("metric_value")]
    return latest_per_key(both, ML_METRICS_KEY, order).drop("_new")


def write_layout(rows: DataFrame, path: str) -> None:
    """Write partitioned by year, clustered by pipeline and sorted by time.

    Range partitioning on all three keeps a pipeline's rows together yet splits a pipeline
    that holds much of the table, and gives narrow min/max statistics for time filters.
    """
    layout = ["year", "pipeline_id", "recorded_at"]
    (
        rows.withColumn("year", F.year("recorded_at"))
        .repartitionByRange(*layout)
        .sortWithinPartitions(*layout)
        .write.mode("overwrite").partitionBy("year").parquet(path)
    )


def read_range(spark: SparkSession, path: str, start: datetime, end: datetime) -> DataFrame:
    """Rows of [start, end): prunes years, and pushes the time filter into the scan."""
    year = F.col("year")
    return time_range(
        spark.read.parquet(path).filter((year >= start.year) & (year <= end.year)), start, end
    ).drop("year")


def time_range(rows: DataFrame, start, end, at: str = "recorded_at") -> DataFrame:
    """Rows recorded in [start, end)."""
    return rows.filter((F.col(at) >= F.lit(start)) & (F.col(at) < F.lit(end)))


def json_number(path: str, column: str = "metadata_json") -> Column:
    """A numeric value of the JSON payload; NULL if absent or not a number."""
    return F.get_json_object(column, path).try_cast("double")


def with_any_tag(rows: DataFrame, tags: Sequence[str]) -> DataFrame:
    """Rows that carry at least one of the tags."""
    return rows.filter(F.arrays_overlap("tags", F.array(*[F.lit(t) for t in tags])))


def with_all_tags(rows: DataFrame, tags: Sequence[str]) -> DataFrame:
    """Rows that carry every one of the tags."""
    for t in tags:
        rows = rows.filter(F.array_contains("tags", t))
    return rows


def latest(rows: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """The first ``n`` rows in the given order (a bounded report)."""
    return rows.orderBy(*order).limit(n)


def compare(
    rows: DataFrame,
    by: Sequence[str] = ("pipeline_id", "model_version", "environment_label", "metric_name"),
) -> DataFrame:
    """Per group: number of values, mean, best and worst value, the run with the best value.

    Equal best values go to the smallest run id.
    """
    value = F.col("metric_value")
    return rows.filter(value.isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_values"),
        F.avg(value).alias("mean_value"),
        F.max(value).alias("best_value"),
        F.min(value).alias("worst_value"),
        F.min(F.struct(-value, F.col("run_id").alias("run"))).alias("_best"),
    ).withColumn("best_run", F.col("_best.run")).drop("_best")
