"""Helpers shared by the text operators: written tables, checked broadcasts, text columns."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import gaugework
from gaugework.session import new_table_path

#: The 26 letters that the text contracts lower-case.
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def written(df: DataFrame, name: str, mode: str = "error", path: str | None = None, by: str | list[str] | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, survives lost executors. ``by`` partitions it.

    The shuffles of the job are given up as soon as the table stands, as nothing reads them again.
    """
    spark, path = df.sparkSession, path or new_table_path(df.sparkSession, name)
    with lean(spark):
        (df.write.mode(mode).partitionBy(by) if by else df.write.mode(mode)).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Settings of jobs that write tables: shuffles are given up after the job, Arrow batches are bounded by bytes too.
LEAN = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


@contextmanager
def lean(spark: SparkSession) -> Iterator[None]:
    """Jobs run with ``LEAN``; the session's own settings come back after them."""
    before = {key: spark.conf.get(key, None) for key in LEAN}
    for key, value in LEAN.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder of a table made here."""
    assert "/tables/" in folder, folder
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` (without ``by``) that nothing will read again."""
    for table in tables:
        files = table.inputFiles()
        if files:
            delete(table.sparkSession, files[0].rsplit("/", 1)[0])


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows, else unchanged.

    For narrow rows of fixed width over a written table, so that rows bound bytes and the
    count is cheap. Without the hint Spark shuffles both sides: same rows, another plan.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased and nothing else; the fast built-in where the text is all ASCII."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def empty_batch(schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([], schema=schema)


def slices(batches: Iterator[pa.RecordBatch], text: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that the texts of one slice hold about ``max_bytes`` (one row at least)."""
    for batch in batches:
        column = batch.column(text)
        start, size = 0, 0
        lengths = pa.compute.binary_length(column).fill_null(0).to_pylist()
        for i, n in enumerate(lengths):
            if i > start and size + n > max_bytes:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start, batch.num_rows - start)
    give_back()


def give_back() -> None:
    """Return free memory to the system: workers are reused, and what one stage held is free for the next."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim:
        trim(0)


def shrink(spark: SparkSession) -> None:
    """Collect the executors' garbage: heap that earlier stages grew is returned, and free for Python workers."""
    n = spark.sparkContext.defaultParallelism
    spark.range(0, n, 1, n).select(F.expr("java_method('java.lang.System', 'gc')")).collect()


def arrow_type(df: DataFrame, column: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[column].dataType)


def find_package(spark: SparkSession) -> None:
    """Let Python workers of this session import the package from where the driver has it."""
    root, env = str(Path(gaugework.__file__).resolve().parents[1]), spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def without(docs: DataFrame, id_col: str, digest: Column, gone: DataFrame, once: DataFrame, max_rows: int = 250_000) -> DataFrame:
    """``docs`` less the rows whose (id, digest) is in ``gone``, and one row for each pair in ``once``.

    ``gone`` and ``once`` are written tables of distinct (id, digest); ``once`` names rows that occur
    several times with the same id and text.
    """
    def meet(keys: DataFrame, how: str, frame: DataFrame) -> DataFrame:
        keys = bounded_broadcast(keys.select("id", "digest"), max_rows)
        return frame.join(keys, frame[id_col].eqNullSafe(keys["id"]) & (digest == keys["digest"]), how)

    stay = meet(gone, "left_anti", docs)
    if once.isEmpty():
        return stay
    name = fresh(docs, "row_key")
    single = meet(once, "left_semi", docs).withColumn(name, F.struct(F.col(id_col), digest)).dropDuplicates([name]).drop(name)
    return meet(once, "left_anti", stay).unionByName(single)


class Memo(dict):
    """Values of ``make`` by key; emptied at ``limit`` entries, so it does not grow with the input."""

    def __init__(self, make: Callable, limit: int = 400_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches with the rows of one key each, from batches sorted by ``keys``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = np.zeros(batch.num_rows, dtype=bool)
        for key in keys:
            column = batch.column(key).to_numpy(zero_copy_only=False)
            new[1:] |= column[1:] != column[:-1]
            new[0] |= bool(held) and held[-1].column(key)[-1] != batch.column(key)[0]
        cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            if start and held or start == 0 and new[0] and held:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            if end > start:
                held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
