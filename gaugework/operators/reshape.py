"""Wide and long metric forms, and the textual forms of hyper-parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def to_long(
    wide: DataFrame,
    ids: Sequence[str],
    metrics: Sequence[str],
    name: str = "metric_name",
    value: str = "metric_value",
) -> DataFrame:
    """One row per metric, in one scan of the wide table."""
    doubles = wide.select(*ids, *[F.col(m).cast("double").alias(m) for m in metrics])
    return doubles.unpivot(list(ids), list(metrics), name, value)


def to_wide(
    long: DataFrame,
    ids: Sequence[str],
    metrics: Sequence[str],
    name: str = "metric_name",
    value: str = "metric_value",
) -> DataFrame:
    """The inverse of :func:`to_long`; the metric names are given, so no extra job finds them."""
    return long.groupBy(*ids).agg(*[
        F.max(F.when(F.col(name) == m, F.col(value))).alias(m) for m in metrics
    ])


def unpivot_structs(
    wide: DataFrame,
    ids: Sequence[str],
    metrics: Sequence[tuple[str, str]],
) -> DataFrame:
    """As :func:`to_long`, from an inline array of (name, value) structs."""
    pairs = F.array(*[
        F.struct(F.lit(n).alias("metric_name"), F.col(c).cast("double").alias("metric_value"))
        for n, c in metrics
    ])
    return wide.select(*ids, F.inline(pairs))


def parameters_text(parameters: DataFrame, by: Sequence[str], out: str = "hyperparameters") -> DataFrame:
    """``name=value; name=value`` per group, ordered by name."""
    return parameters.groupBy(*by).agg(
        F.expr(
            "listagg(parameter_name || '=' || parameter_value, '; ')"
            " WITHIN GROUP (ORDER BY parameter_name)"
        ).alias(out)
    )


def parameters_json(parameters: DataFrame, by: Sequence[str], out: str = "hyperparameters") -> DataFrame:
    """One JSON object per group, keys in name order."""
    return parameters.groupBy(*by).agg(
        F.to_json(F.map_from_entries(F.array_sort(
            F.collect_list(F.struct("parameter_name", "parameter_value"))
        ))).alias(out)
    )
