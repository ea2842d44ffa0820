"""Exact row ranks over whole tables without sending a group through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugework.functions.exprs import hash_order
from gaugework.session import broadcast_if_small, materialise

# monotonically_increasing_id() puts the partition number above bit 33.
_PARTITION_SHIFT = 33


def hashed_rank(
    df: DataFrame,
    key: str,
    seed: int,
    by: Sequence[str] = (),
    rank: str = "rank",
    rows: str = "rows",
    hex_digits: int = 4,
) -> DataFrame:
    """Rank rows by ``md5(seed:key), key`` within ``by``, and add the group's row count.

    The hash is uniform, so its leading hex digits cut every group, also one that holds
    most of the table, into equal buckets in rank order. Bucket totals (at most
    16**hex_digits per group) give each bucket's starting rank; the row-level window then
    runs per bucket. The rows are shuffled once, and no sampling or checkpoint is needed. Rows
    without a key come first.
    """
    group = F.struct(*by) if by else F.lit(0)
    keyed = (
        df.withColumn("_hash", F.coalesce(hash_order(seed, F.col(key)), F.lit("")))
        .withColumn("_bucket", F.substring("_hash", 1, hex_digits))
        .withColumn("_group", group)
    )
    totals = keyed.groupBy("_group", "_bucket").agg(F.count(F.lit(1)).alias("_in_bucket"))
    in_group = Window.partitionBy("_group")
    earlier = in_group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "_group",
        "_bucket",
        F.coalesce(F.sum("_in_bucket").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_in_bucket").over(in_group).alias(rows),
    )
    local = Window.partitionBy("_group", "_bucket").orderBy("_hash", key)
    return (
        keyed.withColumn("_local", F.row_number().over(local))
        .join(starts, ["_group", "_bucket"])
        .withColumn(rank, F.col("_start") + F.col("_local"))
        .drop("_group", "_bucket", "_hash", "_start", "_local")
    )


def sorted_rank(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    rank: str = "rank",
    rows: str = "rows",
) -> DataFrame:
    """Rank rows by ``order`` (which must be unique within ``by``) and add the row count.

    The table is range-partitioned and sorted on (by, order), so one large group or one
    frequent sort value spreads over many tasks. A row's place in its partition comes from
    ``monotonically_increasing_id``; the checkpoint fixes it. Only one line per
    (group, partition) is needed to turn local places into ranks.
    """
    keys = [F.col(c) for c in by]
    laid = materialise(
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_place", F.monotonically_increasing_id())
        .withColumn("_group", F.struct(*by) if by else F.lit(0))
    )
    part = F.shiftright("_place", _PARTITION_SHIFT)
    runs = laid.groupBy("_group", part.alias("_part")).agg(
        F.count(F.lit(1)).alias("_in_run"), F.min("_place").alias("_first")
    )
    in_group = Window.partitionBy("_group")
    earlier = in_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialise(
        runs.select(
            "_group",
            "_part",
            (F.coalesce(F.sum("_in_run").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"),
            F.sum("_in_run").over(in_group).alias(rows),
        )
    )
    return (
        laid.withColumn("_part", part)
        .join(broadcast_if_small(starts), ["_group", "_part"])
        .withColumn(rank, F.col("_place") + F.col("_shift"))
        .drop("_group", "_part", "_place", "_shift")
    )
