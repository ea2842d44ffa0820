"""A keyed table in files: merges touch only the partitions of the keys they bring.

Keys are hashed into a fixed number of partitions. A merge reads the partitions its updates fall into, puts matched rows in
place of old ones, adds the others, and replaces those partitions alone (dynamic partition overwrite); files of other
partitions stay as they are. The new files are complete before old ones go. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugework.operators.checks import latest_per_key
from gaugework.session import broadcast_if_small, materialise

PART = "key_part"
PARTITIONS = 64


def _part(keys: Sequence[str], partitions: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(partitions)).cast("int")


def _replace(rows: DataFrame, path: str) -> None:
    (rows.repartition(PART).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(path))


def create(rows: DataFrame, path: str, keys: Sequence[str], recency: Sequence[Column], partitions: int = PARTITIONS) -> None:
    """Write a new keyed table: of rows with equal keys the most recent."""
    latest_per_key(rows, keys, recency).withColumn(PART, _part(keys, partitions)).repartition(PART).write.partitionBy(PART).parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop(PART)


def merge(path: str, updates: DataFrame, keys: Sequence[str], recency: Sequence[Column], partitions: int = PARTITIONS) -> int:
    """Merge ``updates`` into the table at ``path``; returns how many partitions were written.

    Several updates of one key count once, the most recent. ``partitions`` is that of ``create``.
    """
    spark = updates.sparkSession
    new = materialise(latest_per_key(updates, keys, recency).withColumn(PART, _part(keys, partitions)))
    touched = [r[PART] for r in new.select(PART).distinct().collect()]  # at most ``partitions``
    if not touched:
        return 0
    try:
        old = spark.read.parquet(path)
    except AnalysisException:  # nothing was written yet
        old = new.limit(0)
    own = broadcast_if_small(new.select(*keys))
    kept = old.filter(F.col(PART).isin(touched)).join(own, list(keys), "left_anti")
    _replace(kept.select(*new.columns).unionByName(new), path)
    return len(touched)
