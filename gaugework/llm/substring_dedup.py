"""Substring deduplication: seed and extend on winnowed anchors.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged. A repeat is a run of at least ``window`` words that starts
anywhere else too, in another document or the same one.

Seeds: every window of ``window`` words selects the smallest hash of its ``SEED``-word runs (the last
one among equals). The selected places are a text's anchors. Two equal windows select the same run at the same
offset, so every repeat has a common anchor, and anchors that occur once need no further look.

Extension: documents meet in the join on the anchor. An occurrence is extended both ways as far as a window that selects
its anchor can reach. Occurrences that extend equally far to both ends are one class, found
by a hash of the extended run: with two or more of them, every window around is repeated. What
is left are classes of one occurrence whose anchor has other classes; for those and one
member of each other class the extension is taken shift by shift, as hashes of the
extended runs per anchor, and equal ones are repeats. No pairs of occurrences are made, so an anchor
with m occurrences costs m rows. Adjacent windows join into maximal repeats.

Equal texts are handled once with their number of copies; where there are two or more, all
words of a text of at least ``window`` words are repeated. Texts are dealt once by their hash into a bucketed
table in the shared folder, which later joins read in place.

Edge cases: null and empty texts have no words; texts with fewer words than ``window`` keep all;
repeated rows are copies of each other; null ids stay null; empty tables give empty results. Extra
columns do not matter.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, functions as F

from gaugework.llm.common import Memo, slices, written
from gaugework.session import new_table_path

WINDOW = 35
SEED = 16

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(maxsize=1)
def _word_hashes() -> Memo:
    return Memo(xxhash.xxh64_intdigest)


class _Powers:
    """Powers of an odd base modulo 2 ** 64, made as far as they are needed."""

    def __init__(self, base: int):
        self.base, self.values = base, np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.values) < n:
            step = np.uint64(pow(self.base, len(self.values), 1 << 64))
            self.values = np.concatenate((self.values, self.values * step))
        return self.values[:n]


_up, _down = _Powers(_BASE), _Powers(_INVERSE)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Runs:
    """Hashes of runs of words of one text, its windows and their anchors."""

    def __init__(self, words: list[bytes], window: int = WINDOW):
        n = len(words)
        self.n, self.window = n, window
        self.selected = np.zeros(0, dtype=np.int64)
        if n < window:
            return
        h = np.fromiter(map(_word_hashes().__getitem__, words), np.uint64, n)
        self.before = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * _up.upto(n))))
        self.seeds = self.hashes(np.arange(n - SEED + 1), np.arange(SEED, n + 1))
        reach = window - SEED + 1
        views = sliding_window_view(self.seeds, reach)[:, ::-1]
        #: The anchor that each window selects, by the window's start; it never decreases.
        self.selected = np.arange(n - window + 1) + reach - 1 - views.argmin(axis=1)

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of the runs [start, end); equal runs have equal hashes wherever they are."""
        return _mixed((self.before[end] - self.before[start]) * _down.upto(self.n + 1)[start] + (end - start).astype(np.uint64))

    def anchors(self) -> np.ndarray:
        return self.selected[np.concatenate(([True], self.selected[1:] != self.selected[:-1]))] if len(self.selected) else self.selected

    def extended(self, at: np.ndarray) -> np.ndarray:
        """Hash of all words that windows around each anchor can reach, and of how they lie around it."""
        start, end = np.maximum(at - (self.window - SEED), 0), np.minimum(at + self.window, self.n)
        return _mixed(self.hashes(start, end) + (at - start).astype(np.uint64) * np.uint64(_BASE))

    def starts_of(self, at: np.ndarray) -> np.ndarray:
        """Starts of the windows that select one of the anchors ``at``."""
        return np.flatnonzero(np.isin(self.selected, at))


def _split(text: str | None) -> list[bytes]:
    return (text or "").encode().split()  # bytes: white space of ASCII only


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def distinct_texts(docs: DataFrame, text_col: str) -> DataFrame:
    """Bucketed table (a, b, text, copies) of the distinct texts; a and b are hashes that name a text."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    texts = texts.groupBy(*_names("text")).agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies"))
    name = f"texts_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts.write.bucketBy(buckets, "a", "b").option("path", new_table_path(spark, name)).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the entry of the catalog alone: the files and the frame that reads them stay
    return table


def _names(text_col: str) -> list:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [F.xxhash64(text).alias("a"), F.xxhash64(F.md5(text)).alias("b")]


def occurrences(texts: DataFrame, window: int) -> DataFrame:
    """(anchor, extended, a, b, at): the anchors of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            anchor, extended, at, counts = [], [], [], []
            for text in part.column("text").to_pylist():
                runs = Runs(_split(text), window)
                places = runs.anchors()
                counts.append(len(places))
                if len(places):
                    anchor.append(runs.seeds[places])
                    extended.append(runs.extended(places))
                    at.append(places)
            if at:
                a, b = (np.repeat(part.column(c).to_numpy(), counts) for c in ("a", "b"))
                yield pa.RecordBatch.from_arrays(
                    [_signed(np.concatenate(anchor)), _signed(np.concatenate(extended)), pa.array(a), pa.array(b),
                     pa.array(np.concatenate(at).astype(np.int32))], names=["anchor", "extended", "a", "b", "at"])
        _word_hashes().clear()

    return texts.select("a", "b", "text").mapInArrow(run, "anchor long, extended long, a long, b long, at int")


def shifted_windows(texts: DataFrame, members: DataFrame, window: int) -> DataFrame:
    """(anchor, run, a, b, start, single): the windows around the given members, one row each."""
    lists = members.groupBy("a", "b").agg(F.collect_list("at").alias("places"), F.collect_list("single").alias("singles"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            columns: list[list[np.ndarray]] = [[], [], [], []]
            counts = []
            for text, places, singles in zip(*(part.column(c).to_pylist() for c in ("text", "places", "singles")), strict=True):
                runs = Runs(_split(text), window)
                at = np.array(places)
                order = np.argsort(at)
                starts = runs.starts_of(at)
                own = runs.selected[starts]
                counts.append(len(starts))
                single = np.array(singles)[order][np.searchsorted(at[order], own)]
                for column, values in zip(columns, (runs.seeds[own], runs.hashes(starts, starts + window), starts, single), strict=True):
                    column.append(values)
            if counts:
                anchor, hashed, start, single = map(np.concatenate, columns)
                a, b = (np.repeat(part.column(c).to_numpy(), counts) for c in ("a", "b"))
                yield pa.RecordBatch.from_arrays(
                    [_signed(anchor), _signed(hashed), pa.array(a), pa.array(b), pa.array(start.astype(np.int32)), pa.array(single)],
                    names=["anchor", "run", "a", "b", "start", "single"])

    joined = texts.join(lists, ["a", "b"]).select("a", "b", "text", "places", "singles")
    return joined.mapInArrow(run, "anchor long, run long, a long, b long, start int, single boolean")


def repeats(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """(a, b, places, starts): anchors all of whose windows are repeated, and starts of other repeated windows."""
    found = occurrences(texts, window)
    # of all copies one text is left, but an anchor may recur within it
    # written, so that the join deals its rows anew and Spark can split those of a frequent anchor
    recurring = written(found.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"), F.min("extended").alias("low"), F.max("extended").alias("high"),
    ).filter("n > 1").select("anchor", (F.col("low") != F.col("high")).alias("several")), "substring-recurring")
    hits = written(found.join(recurring, "anchor"), "substring-hits")
    classes = written(hits.groupBy("anchor", "extended").agg(
        F.count(F.lit(1)).alias("n"), F.first("a").alias("a"), F.first("b").alias("b"), F.first("at").alias("at"),
        F.first("several").alias("several"),
    ), "substring-classes")
    whole = hits.join(classes.filter("n > 1").select("anchor", "extended"), ["anchor", "extended"]).select("a", "b", "at")
    members = classes.filter("several").select("a", "b", "at", (F.col("n") == 1).alias("single"))
    windows = written(shifted_windows(texts, members, window), "substring-windows")
    equal = windows.groupBy("anchor", "run").agg(F.count(F.lit(1)).alias("n"), F.max("single").alias("wanted"))
    equal = equal.filter("n > 1 AND wanted").select("anchor", "run")
    partial = windows.filter("single").join(equal, ["anchor", "run"]).select("a", "b", "start")
    nothing = F.lit(None).cast("int")
    both = whole.select("a", "b", "at", nothing.alias("start")).unionByName(partial.select("a", "b", nothing.alias("at"), "start"))
    return both.groupBy("a", "b").agg(F.collect_list("at").alias("places"), F.collect_list("start").alias("starts"))


def clean_texts(docs: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per distinct text: a, b, copies, n_words, spans (maximal repeats as word places), kept (text without them)."""
    texts = distinct_texts(docs, text_col)
    found = texts.join(written(repeats(texts, window), "substring-repeats"), ["a", "b"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sizes, spans, kept = [], [], []
            rows = zip(*(part.column(c).to_pylist() for c in ("text", "copies", "places", "starts")), strict=True)
            for text, copies, places, starts in rows:
                words = _split(text)
                edge = np.zeros(len(words) + 1, dtype=np.int32)
                if len(words) >= window:
                    if copies > 1:
                        edge[0], edge[-1] = 1, -1
                    elif places or starts:
                        runs = Runs(words, window)
                        at = np.unique(np.concatenate((runs.starts_of(np.array(places, dtype=np.int64)), np.array(starts, dtype=np.int64))))
                        edge[at] += 1
                        edge[at + window] -= 1
                covered = np.concatenate(([False], np.cumsum(edge)[:-1] > 0, [False]))
                begin, end = np.flatnonzero(~covered[:-1] & covered[1:]), np.flatnonzero(covered[:-1] & ~covered[1:])
                sizes.append(len(words))
                spans.append([{"start": s, "stop": e} for s, e in zip(begin.tolist(), end.tolist(), strict=True)])
                bounds = [0, *np.column_stack((begin, end)).ravel().tolist(), len(words)]
                kept.append(b" ".join(w for s, e in zip(bounds[::2], bounds[1::2], strict=True) for w in words[s:e]).decode())
            span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [part.column("a"), part.column("b"), part.column("copies"), pa.array(sizes, pa.int64()), pa.array(spans, span), pa.array(kept, pa.string())],
                names=["a", "b", "copies", "n_words", "spans", "kept"])

    return found.select("a", "b", "text", "copies", "places", "starts").mapInArrow(
        run, "a long, b long, copies long, n_words long, spans array<struct<start: long, stop: long>>, kept string")


def text_names(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, a, b): which distinct text each row has."""
    return docs.select(F.col(id_col).alias("id"), *_names(text_col))
