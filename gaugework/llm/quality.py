"""Quality by perplexity under interpolated modified Kneser-Ney models of trusted text.

The units are words: trigrams are counted over all trusted texts (every row whose labels say so, no sample)
and the models and the scores are joins and aggregates of the count tables (``words``).

Texts are halved by a hash; every document, trusted or not, is scored by the model of the trusted texts of the other
half, so trusted documents are judged like all others. A document is judged by its excess: the mean bits per word above the
median of trusted documents of its language, times the square root of its words, so that a short text needs a larger
deviation. It is accepted up to the ``keep`` quantile of that excess among trusted documents of its language. A language
with too few trusted texts for a quantile of its own keeps its median and takes the quantile of all languages' excesses.

Edge cases: null and empty texts have no perplexity and are not accepted. A language without
trusted documents, null included, takes the figures of all trusted documents. Texts whose model has no trusted text
(few trusted documents, all in one half, or none) have a null perplexity and are accepted if they have content. An id with several labels is
trusted only if all agree; null labels are not trust. Equal texts get equal verdicts within a language; repeated rows are scored as rows. Empty tables
give empty results. Texts are taken whole. Added columns get names that the table does not have.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from gaugework.llm import words
from gaugework.llm.common import bounded_broadcast, fresh, written

KEEP = 0.997
#: Trusted texts beyond the quantile that a language needs for a limit of its own: 1,000 texts at ``KEEP``.
SUPPORT = 3


def half_of(text: Column) -> Column:
    """0 or 1; copies of a text are in one half."""
    return F.pmod(F.xxhash64(text), F.lit(2))


def trusted_ids(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Ids that all their labels call good and none calls toxic."""
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    agreed = labels.groupBy(F.col(id_col).alias("trusted_id")).agg(F.min(F.coalesce(good, F.lit(False)).cast("int")).alias("good"))
    return agreed.filter((F.col("good") == 1) & F.col("trusted_id").isNotNull()).select("trusted_id")


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", keep: float = KEEP) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with perplexity and accepted; the dictionary gives the names of the added columns."""
    ids = bounded_broadcast(written(trusted_ids(labels, id_col), "kn-trusted"), 1_000_000)
    trusted = docs.select(F.col(id_col).alias("trusted_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    trusted = trusted.join(ids, "trusted_id", "left_semi").drop("trusted_id")
    texts = docs.select(F.col(text_col).alias("text"), half_of(F.col(text_col)).alias("half"))
    models = words.train(words.count(trusted.withColumn("half", half_of(F.col("text")))), texts)
    scores = words.score(texts, models)
    base = _means(trusted, scores)
    figures = _thresholds(base, keep)
    overall = _thresholds(base.withColumn("lang", F.lit("all")), keep).first()
    center_all, limit_all = (overall["center"], overall["limit"]) if overall else (0.0, float("inf"))
    bytes_col = fresh(docs, "kn_bytes")
    found = docs.withColumn(bytes_col, F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long"))
    bits_col, units_col = fresh(found, "kn_bits"), fresh(found, "kn_units")
    a, b = fresh(found, "kn_a"), fresh(found, "kn_b")
    keys = dict(zip((a, b), words.text_key(text_col)))
    found = found.withColumns(keys).join(bounded_broadcast(scores.toDF(a, b, bits_col, units_col), 250_000), [a, b], "left").drop(a, b)
    names = {n: fresh(found, n) for n in ("perplexity", "excess", "threshold", "accepted")}
    center, limit = fresh(found, "kn_center"), fresh(found, "kn_limit")
    lang = fresh(found, "kn_lang")
    figures = written(figures.select(F.col("lang").alias(lang), F.col("center").alias(center), F.col("limit").alias(limit)), "kn-limits")
    mean = F.col(bits_col) / F.col(units_col)
    joined = found.join(bounded_broadcast(figures, 10_000), F.col(lang_col) == F.col(lang), "left")
    excess = (mean - F.coalesce(center, F.lit(center_all))) * F.sqrt(units_col)
    return joined.withColumns({
        names["perplexity"]: F.pow(F.lit(2.0), mean),
        names["excess"]: excess,
        names["threshold"]: F.coalesce(limit, F.lit(limit_all)),
        names["accepted"]: (F.col(bytes_col) > 0) & F.coalesce(excess <= F.coalesce(limit, F.lit(limit_all)), F.lit(True)),
    }).drop(center, limit, lang, bits_col, units_col), names | {"bytes": bytes_col}


def _means(trusted: DataFrame, scores: DataFrame) -> DataFrame:
    """(lang, mean bits per word, words) of the trusted texts that have a score, written."""
    named = trusted.select("lang", *(c.alias(n) for c, n in zip(words.text_key("text"), "ab")))
    scored = named.join(bounded_broadcast(scores.filter("bits IS NOT NULL"), 250_000), ["a", "b"])
    return written(scored.select("lang", (F.col("bits") / F.col("units")).alias("mean"), "units"), "kn-trusted-scores")


def _thresholds(scores: DataFrame, keep: float) -> DataFrame:
    """Per language the median of the means, and the ``keep`` quantile of the excess over it.

    Below ``SUPPORT / (1 - keep)`` texts the quantile is that of all languages' excesses over their own medians,
    wider by the error of a median of so few texts.
    """
    centers = scores.groupBy(F.col("lang").alias("of")).agg(F.percentile_approx("mean", 0.5, 10_000).alias("center"))
    excess = scores.join(centers, F.col("lang").eqNullSafe(F.col("of"))).select(
        "lang", "center", ((F.col("mean") - F.col("center")) * F.sqrt("units")).alias("excess"))
    excess = written(excess, "kn-trusted-excess")
    limit = F.percentile_approx("excess", keep, 100_000)
    pooled = excess.agg(limit.alias("limit")).first()["limit"]
    wider = F.lit(pooled).cast("double") * F.sqrt(1 + F.lit(np.pi / 2) / F.col("texts"))
    found = excess.groupBy("lang", "center").agg(limit.alias("limit"), F.count(F.lit(1)).alias("texts"))
    enough = F.col("texts") * F.lit(1 - keep) >= SUPPORT
    return found.select("lang", "center", F.when(enough, F.col("limit")).otherwise(wider).alias("limit"))


def accepted_only(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with their own columns."""
    found, names = judge(docs, labels, **options)
    return found.filter(F.col(names["accepted"])).select(*docs.columns)
