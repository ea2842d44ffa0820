"""Language identification by the nearest of several centroids per language.

A text becomes a TF-IDF vector of its letter n-grams: runs of letters (everything else is one
space), case folded, cut into n-grams of one to three characters that are hashed to ``DIMENSIONS`` places;
term counts enter as 1 + log, weighted by inverse document frequency and scaled to length 1. The vectors of each
language are clustered by spherical k-means; a text goes to the language of the centroid with the
largest cosine. It is rejected, and called ``und``, when its distance to that centroid is beyond
what ``REJECT`` of the language's own training texts reach.

Fitting takes at most about ``SAMPLE`` labelled texts of each language, those with the smallest hash of their text,
and within them all statistics; predicting takes every whole text.

Edge cases: null texts and texts without letters are ``und`` with score 0. Rows with a null
language are not learned from. Without any labelled text everything is ``und``. Repeated rows are
rows; empty tables give empty results. Columns other than id and text do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from gaugework.llm.common import arrow_type, bounded_broadcast, slices, written

DIMENSIONS = 1 << 12
SAMPLE = 1_500
CLUSTERS = 3
ROUNDS = 12
REJECT = 0.999
UNDETERMINED = "und"


def features(text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Places and 1 + log counts of a text's n-grams; None without letters."""
    if not text:
        return None
    points = np.frombuffer(text.casefold().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    known, place = np.unique(points, return_inverse=True)
    letters = np.array([chr(c).isalpha() for c in known.tolist()])[place]
    if not letters.any():
        return None
    p = np.concatenate(([32], np.where(letters, points, 32), [32])).astype(np.uint64)
    p = p[np.concatenate(([True], (p[1:] != 32) | (p[:-1] != 32)))]
    counts = np.zeros(DIMENSIONS)
    for n in (1, 2, 3):
        code = p[:len(p) - n + 1].copy()
        for i in range(1, n):
            code = code * np.uint64(1_114_112) + p[i:len(p) - n + 1 + i]
        code = (code * np.uint64(8) + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
        counts += np.bincount((code >> np.uint64(64 - 12)).astype(np.int64), minlength=DIMENSIONS)
    found = np.flatnonzero(counts)
    return found, 1 + np.log(counts[found])


@dataclass
class Model:
    languages: list[str]  # of each centroid
    centroids: np.ndarray  # one per row, length 1
    limits: np.ndarray  # largest accepted distance of each centroid's language
    idf: np.ndarray


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-12)


def vector(found: tuple[np.ndarray, np.ndarray], idf: np.ndarray) -> np.ndarray:
    out = np.zeros(DIMENSIONS, dtype=np.float32)
    out[found[0]] = found[1] * idf[found[0]]
    return _unit(out)


def cluster(x: np.ndarray, clusters: int = CLUSTERS) -> np.ndarray:
    """Spherical k-means with farthest-point starts: unit centroids of the unit rows of ``x``."""
    centers = _unit(x.mean(axis=0))[None, :]
    while len(centers) < min(clusters, len(x)):
        nearest = (x @ centers.T).max(axis=1)
        centers = np.vstack((centers, x[nearest.argmin()]))
    for _ in range(ROUNDS):
        own = (x @ centers.T).argmax(axis=1)
        centers = np.vstack([_unit(x[own == c].mean(axis=0)) if (own == c).any() else centers[c] for c in range(len(centers))])
    return centers


def sample(docs: DataFrame, per_language: int = SAMPLE) -> DataFrame:
    """At most about ``per_language`` texts (lang, text) of each language: hash below a share of the hash space.

    Copies of one text share its hash, so they are in or out together; they count once, in the share too, so
    a language with no more distinct texts than that is learned from all of them.
    """
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    distinct = rows.select("lang", F.xxhash64("text").alias("digest")).distinct()
    shares = distinct.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).select("lang", (per_language / F.col("n")).alias("share"))
    rows = rows.join(bounded_broadcast(written(shares, "language-shares"), 10_000), "lang")
    return rows.filter(F.pmod(F.xxhash64("text"), F.lit(1_000_003)) < F.col("share") * 1_000_003).select("lang", "text").distinct()


def fit(docs: DataFrame, per_language: int = SAMPLE) -> Model | None:
    """Learn from columns lang and text; None if there is nothing to learn from."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found = [(lang, f) for lang, t in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True) if (f := features(t))]
            yield pa.RecordBatch.from_arrays([
                pa.array([lang for lang, _ in found], pa.string()),
                pa.array([f[0].astype(np.int32).tobytes() for _, f in found], pa.binary()),
                pa.array([f[1].astype(np.float32).tobytes() for _, f in found], pa.binary()),
            ], names=["lang", "places", "weights"])

    rows = written(sample(docs, per_language).mapInArrow(count, "lang string, places binary, weights binary"), "language-sample")
    n = rows.count()
    if not n:
        return None

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DIMENSIONS, dtype=np.int64)
        for batch in batches:
            for b in batch.column("places"):
                total[np.frombuffer(b.as_py(), dtype=np.int32)] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(DIMENSIONS)), pa.array(total)], names=["place", "n"])

    df = rows.select("places").mapInArrow(frequencies, "place long, n long").groupBy("place").agg(F.sum("n").alias("n"))
    seen = np.zeros(DIMENSIONS)
    for r in df.collect():
        seen[r["place"]] = r["n"]
    idf = np.log((1 + n) / (1 + seen)) + 1

    def centroids(group: pd.DataFrame) -> pd.DataFrame:
        x = np.vstack([
            vector((np.frombuffer(p, dtype=np.int32), np.frombuffer(w, dtype=np.float32)), idf)
            for p, w in zip(group["places"], group["weights"], strict=True)
        ])
        centers = cluster(x)
        limit = np.quantile(1 - (x @ centers.T).max(axis=1), REJECT)
        return pd.DataFrame({
            "lang": group["lang"].iloc[0], "cluster": range(len(centers)), "limit": float(limit),
            "centroid": [c.astype(np.float32).tobytes() for c in centers],
        })

    found = rows.groupBy("lang").applyInPandas(centroids, "lang string, cluster int, limit double, centroid binary")
    found = sorted(found.collect(), key=lambda r: (r["lang"], r["cluster"]))
    return Model(
        [r["lang"] for r in found], np.vstack([np.frombuffer(r["centroid"], dtype=np.float32) for r in found]),
        np.array([r["limit"] for r in found]), idf.astype(np.float32),
    )


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, nearest (language or und without letters), score (cosine), lang (und if rejected)."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = arrow_type(named, "id")
    schema = pa.schema([("id", kind), ("nearest", pa.string()), ("score", pa.float64()), ("lang", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for part in slices(batches, "text"):
            nearest, scores, langs = [], [], []
            for text in part.column("text").to_pylist():
                found = features(text) if m else None
                if found is None:
                    best, cosine, lang = UNDETERMINED, 0.0, UNDETERMINED
                else:
                    weights = (found[1] * m.idf[found[0]]).astype(np.float32)
                    cosines = m.centroids[:, found[0]] @ _unit(weights)
                    at = int(cosines.argmax())
                    cosine = float(min(max(cosines[at], 0.0), 1.0))
                    best = m.languages[at]
                    lang = best if 1 - cosine <= m.limits[at] else UNDETERMINED
                nearest.append(best)
                scores.append(cosine)
                langs.append(lang)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array(nearest, pa.string()), pa.array(scores, pa.float64()), pa.array(langs, pa.string())], schema=schema)

    out = T.StructType([named.schema["id"], T.StructField("nearest", T.StringType()),
                        T.StructField("score", T.DoubleType()), T.StructField("lang", T.StringType())])
    return named.mapInArrow(run, out)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))
