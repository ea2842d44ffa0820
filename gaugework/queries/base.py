"""Registration of queries, and helpers that keep result columns comparable."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its own name, with an equivalent SQL text if there is one."""
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tidy(df: DataFrame) -> DataFrame:
    """Integers as bigint, doubles to six places, instants as zone-free timestamps."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(name)
        if kind == "int":
            c = c.cast("bigint")
        elif kind == "double":
            c = F.round(c, 6)
        elif kind == "timestamp":
            c = c.cast("timestamp_ntz")
        out.append(c.alias(name))
    return df.select(*out)
