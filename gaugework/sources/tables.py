"""Typed reads and Parquet tables: load, replace, append to a log."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def load_rows(spark: SparkSession, rows: Iterable[tuple], schema: StructType | str) -> DataFrame:
    """A small literal table."""
    return spark.createDataFrame(list(rows), schema)


def load_csv(
    spark: SparkSession, path: str, schema: StructType | str, delimiter: str = ",", header: bool = True
) -> DataFrame:
    """A delimited file with a declared schema; a malformed line fails the read."""
    return (
        spark.read.schema(schema).option("header", header).option("sep", delimiter)
        .option("mode", "FAILFAST").csv(path)
    )


def load_table(spark: SparkSession, path: str, columns: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Scan Parquet into a typed table; ``columns`` maps a name to (SQL expression, type)."""
    return spark.read.parquet(path).select(*[
        F.expr(source).cast(kind).alias(name) for name, (source, kind) in columns.items()
    ])


def conform(df: DataFrame, schema: StructType, defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Select, cast and order the columns of ``schema``.

    A missing column becomes its default, or NULL; a NULL in a column with a default takes
    the default. A column outside the schema is an error, not dropped.
    """
    defaults = dict(defaults or {})
    extra = set(df.columns) - set(schema.names)
    if extra:
        raise ValueError(f"columns not in the table: {sorted(extra)}")
    out = []
    for f in schema.fields:
        value = F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        if f.name in defaults:
            default = defaults[f.name]
            default = default if not isinstance(default, (str, int, float)) else F.lit(default)
            value = F.coalesce(value, default.cast(f.dataType))
        out.append(value.alias(f.name))
    return df.select(*out)


def replace_table(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> DataFrame:
    """Write ``df`` as the whole table at ``path`` (drop and create) and read it back."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)


def append_log(
    df: DataFrame, path: str, schema: StructType, defaults: Mapping[str, object] | None = None
) -> DataFrame:
    """Append rows to a log, which is created if absent, and return the log."""
    conform(df, schema, defaults).write.mode("append").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)
