"""Compare registered queries with their SQL in DuckDB: columns, row count, values."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = []
    for row in df[cols].itertuples(index=False):
        rows.append(tuple("NULL" if pd.isna(v) else f"{v:.6f}" if isinstance(v, float) else str(v) for v in row))
    return sorted(rows)


def whole_numbers(got: pd.DataFrame, want: pd.DataFrame) -> None:
    """Nulls turn a column of integers into floats on one side or the other: make such columns integers again."""
    for c in want.columns:
        if pd.api.types.is_integer_dtype(got[c]) != pd.api.types.is_integer_dtype(want[c]):
            for df in (got, want):
                if pd.api.types.is_float_dtype(df[c]) and (df[c].dropna() % 1 == 0).all():
                    df[c] = df[c].astype("Int64")


def differences(spark, con, fn, sql: str, sf_dir: str) -> str | None:
    got = fn(spark, sf_dir).toPandas()
    want = con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    whole_numbers(got, want)
    for c in got.columns:
        if pd.api.types.is_numeric_dtype(want[c]) != pd.api.types.is_numeric_dtype(got[c]):
            return f"type of {c}: {got[c].dtype} != {want[c].dtype}"
    a, b = canonical(got), canonical(want)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(bad)} rows differ, first: {bad[0]}"
    return None


def main(sf_dir: str, names: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from gaugework.session import build_session

    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    oracles = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in oracles:
                problem = differences(spark, con, fn, oracles[name], sf_dir)
            else:
                problem = None if len(fn(spark, sf_dir).toPandas()) else "no rows"
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        failed += problem is not None
        print(f"{name:26s} {time.time() - start:6.1f}s {problem or 'ok'}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
