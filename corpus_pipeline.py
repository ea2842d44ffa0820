"""The corpus pipeline: quality filter, exact and near deduplication, decontamination, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the stages before the last return the
columns of documents. Rows that a stage drops are gone for the ones after it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugework.llm import bpe, decontaminate, exact_dedup, near_dedup, quality
from gaugework.llm.common import documents, find_package, shrink, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the perplexity classifier accepts.

    Null and empty texts go. Equal texts of a language get equal verdicts, repeated rows stay or go together. A null language
    takes the figures of all. Without labels every text with content stays. An empty table stays empty; all columns stay, whatever
    their names; texts are judged whole.
    """
    find_package(spark)
    return quality.accepted_only(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the smallest id, one row of it.

    A null text counts as empty; null ids count as larger than all others. Texts are equal up to white space, compared whole.
    An empty table stays empty; all columns stay, whatever their names.
    """
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: 80 % or more of the five-word shingles shared.

    The smallest id stays, null ids only in components without others, one row of repeated ones. Null texts and texts without words
    are near nothing and stay. An empty table stays empty; all columns stay, whatever their names; shingles are those of whole texts.
    """
    find_package(spark)
    return near_dedup.drop_near_copies(docs, percent=80)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item.

    Null and empty texts have no window and stay, as all documents do with an empty benchmark. Rows of one id and text go or stay
    together. An empty table stays empty; all columns stay, whatever their names; texts are searched whole.
    """
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the digest of the text decoded from them: doc_id, n_tokens, ids, decoded_sha256.

    A null text is empty and has no tokens. Null ids and repeated rows are rows. An empty table gives an empty result; other columns
    are not kept; texts are encoded whole.
    """
    find_package(spark)
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    shrink(spark)
    return bpe.round_trip(docs, ranks, public_tokenizers.PATTERN).select(
        F.col("id").alias("doc_id"), (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("decontaminate", decontaminate_stage),
    ("encode", encode_stage),
]

#: Perplexities and band sketches have no SQL form; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written before the next reads it."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
