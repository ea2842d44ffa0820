"""Reproducible folds and holdout splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from gaugework.functions.exprs import tile_of
from gaugework.operators.ordering import hashed_rank


def check_folds(k: int) -> None:
    if k < 2:
        raise ValueError(f"k-fold needs at least 2 folds, got {k}")


def assign_folds(
    df: DataFrame, k: int, key: str = "id", seed: int = 42, stratify: Sequence[str] = ()
) -> DataFrame:
    """Add ``fold_id`` 1..k: NTILE(k) in seeded random order, over the table or per stratum."""
    check_folds(k)
    ranked = hashed_rank(df, key, seed, by=stratify, rank="_rank", rows="_rows")
    return ranked.withColumn(
        "fold_id", tile_of(F.col("_rank"), F.col("_rows"), k).cast("int")
    ).drop("_rank", "_rows")


def holdout(folds: DataFrame, fold: int) -> tuple[DataFrame, DataFrame]:
    """(train, test) for one fold. Rows without a fold are in neither."""
    return folds.filter(F.col("fold_id") != fold), folds.filter(F.col("fold_id") == fold)


def holdout_sizes(folds: DataFrame, k: int, key: str = "id") -> DataFrame:
    """Train and test row counts and key ranges of all k splits, in one pass."""
    check_folds(k)
    aggs = []
    for f in range(1, k + 1):
        for side, cond in (("train", F.col("fold_id") != f), ("test", F.col("fold_id") == f)):
            aggs.append(F.struct(
                F.lit(f).cast("bigint").alias("fold_id"),
                F.lit(side).alias("side"),
                F.count_if(cond).alias("n_rows"),
                F.min(F.when(cond, F.col(key))).alias("min_key"),
                F.max(F.when(cond, F.col(key))).alias("max_key"),
            ))
    return folds.agg(F.array(*aggs).alias("s")).select(F.inline("s"))


def fold_list(folds: DataFrame) -> DataFrame:
    """The folds present."""
    return folds.select("fold_id").distinct()


def class_presence(
    df: DataFrame, label: str, positive: str, by: Sequence[str] = ("fold_id",)
) -> DataFrame:
    """Per group: 1 if the class occurs, and 1 if any other class occurs."""
    def flag(cond):
        return F.coalesce(F.max(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("bigint")

    return df.groupBy(*by).agg(
        flag(F.col(label) == positive).alias("has_positive"),
        flag(F.col(label) != positive).alias("has_negative"),
    )
