"""Data validation, key checks and keyed upserts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from gaugework.functions.exprs import any_outside


class ValidationError(ValueError):
    """Raised by :func:`require_valid`; the message lists the failed checks."""


def validate(
    df: DataFrame,
    label: str,
    expected_rows: int,
    expected_labels: Sequence[str],
    ranges: Mapping[str, tuple[float, float]],
) -> DataFrame:
    """(check, expected, actual, passed): every check in one pass over the table.

    Checks: the row count, the number of distinct labels, one line per expected label, the
    number of rows with any value out of range, the number of rows with a NULL value.
    """
    nulls = F.lit(False)
    for c in [label, *ranges]:
        nulls = nulls | F.col(c).isNull()
    measures = [("row_count", expected_rows, F.count(F.lit(1))),
                ("distinct_labels", len(expected_labels), F.count_distinct(label))]
    measures += [
        (f"label_present:{v}", 1, F.coalesce(F.max((F.col(label) == v).cast("int")), F.lit(0)))
        for v in expected_labels
    ]
    measures += [("rows_out_of_range", 0, F.count_if(any_outside(ranges))),
                 ("rows_with_null", 0, F.count_if(nulls))]
    # Column aliases first, so that Spark plans one aggregate with one distinct column.
    totals = df.agg(*[m.cast("bigint").alias(f"m{i}") for i, (_, _, m) in enumerate(measures)])
    lines = F.array(*[
        F.struct(
            F.lit(name).alias("check"),
            F.lit(want).cast("bigint").alias("expected"),
            F.col(f"m{i}").alias("actual"),
            (F.col(f"m{i}") == want).alias("passed"),
        )
        for i, (name, want, _) in enumerate(measures)
    ])
    return totals.select(F.inline(lines))


def require_valid(report: DataFrame) -> None:
    """Raise if any check of a validation report failed (the report has a line per check)."""
    failed = report.filter(~F.col("passed")).collect()
    if failed:
        raise ValidationError("; ".join(
            f"{r['check']}: expected {r['expected']}, found {r['actual']}" for r in failed
        ))


def range_violations(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """The rows with any of the named columns outside its closed range."""
    return df.filter(any_outside(ranges))


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, cnt, problem): keys that occur more than once, or have a NULL part."""
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt"))
    return counted.filter(has_null | (F.col("cnt") > 1)).withColumn(
        "problem", F.when(has_null, "null_key").otherwise("duplicate_key")
    )


def orphans(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """(foreign_key, n_rows): references without a parent. NULL references are allowed.

    Child rows are counted per reference before the join, so a frequent one is a single row.
    """
    refs = child.filter(F.col(foreign_key).isNotNull()).groupBy(foreign_key).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    parents = parent.select(F.col(key).alias(foreign_key))
    return refs.join(parents, foreign_key, "left_anti")


def latest_per_key(df: DataFrame, keys: Sequence[str], recency: Sequence[Column]) -> DataFrame:
    """One row per key, the one with the greatest ``recency``.

    A running maximum per key instead of a sorted window: it combines before the shuffle, so
    a key with very many rows costs one row per task. A NULL recency counts as oldest.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*recency))
    return df.groupBy(*keys).agg(newest.alias("_row")).select(
        *[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def upsert(
    existing: DataFrame, updates: DataFrame, keys: Sequence[str], recency: Sequence[Column]
) -> DataFrame:
    """``existing`` with matched keys replaced and unmatched ones added.

    Several updates of one key count once, the most recent. Both inputs stay whole tables;
    the result is a new table for the caller to write.
    """
    fresh = latest_per_key(updates.select(*existing.columns), keys, recency)
    kept = existing.join(fresh.select(*keys), list(keys), "left_anti")
    return kept.unionByName(fresh)
