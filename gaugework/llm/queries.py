"""The registered queries of the text operators with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from gaugework.llm import (
    bpe, decontaminate, exact_dedup, infill, language, mixing, near_dedup, quality, sharding, substring_dedup, token_files, url_filter, whitening)
from gaugework.llm.common import documents, find_package
from gaugework.session import new_table_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            find_package(spark)
            return fn(spark, sf_dir)

        QUERIES[fn.__name__] = run
        if sql:
            ORACLES[fn.__name__] = sql
        return run
    return add


DECONTAMINATE_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT doc_id, s, n, item FROM dw JOIN bw USING (n, win)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM m) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
"""


@query(DECONTAMINATE_SQL)
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of ten words found in the documents."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contamination(documents(spark, sf_dir), benchmark).select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query()
def op6_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near-equal bytes; groups of equal texts stay together."""
    return sharding.assign(documents(spark, sf_dir), 24).select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


EXACT_SQL = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
"""


@query(EXACT_SQL)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts after white-space normalisation, the smallest doc_id kept."""
    return exact_dedup.refine(documents(spark, sf_dir), digest_all=True).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256"),
    )


@query()
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of all texts, and the texts decoded from them."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)
    return bpe.decode(encoded, ranks).select(
        F.col("id").alias("doc_id"), (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token-id files of all documents, and what a reader finds in them."""
    folder = new_table_path(spark, "token-files")
    token_files.write(documents(spark, sf_dir), folder, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_files.read_documents(spark, folder)


@query()
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Perplexity of every document under the model of trusted text, and whether it is accepted."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    found, names = quality.judge(docs, labels)
    return found.select(
        "doc_id", "lang", F.col(names["bytes"]).alias("n_bytes"), names["perplexity"], names["excess"],
        names["threshold"], names["accepted"],
    )


@query()
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from two thirds of the labelled ones."""
    docs = documents(spark, sf_dir)
    model = language.fit(docs.filter(~language.held_out(F.col("doc_id"))).select("lang", "text"))
    return language.predict(docs, model).select(
        F.col("id").alias("doc_id"), language.held_out(F.col("id")).alias("held_out"),
        F.col("nearest").alias("lang_pred"), "score", (F.col("lang") == language.UNDETERMINED).alias("rejected"),
    )


@query()
def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents linked by 85 % of their shingles, the smallest doc_id kept."""
    return near_dedup.near_duplicates(documents(spark, sf_dir), percent=85).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id", (F.col("id") == F.col("component_id")).alias("kept"),
    )


SUBSTRING_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, s, array_to_string(w[s:s + 34], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS s FROM d WHERE len(w) >= 35)),
r AS (SELECT win FROM s GROUP BY win HAVING count(*) > 1),
c AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS p FROM s JOIN r USING (win)),
k AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n_kept
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) ANTI JOIN c USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""


@query(SUBSTRING_SQL)
def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without runs of 35 words that start elsewhere too."""
    docs = documents(spark, sf_dir)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, x: acc + x["stop"] - x["start"])
    of_text = substring_dedup.clean_texts(docs).select(
        "a", "b", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"),
    )
    return substring_dedup.text_names(docs).join(of_text, ["a", "b"]).select(
        F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256",
    )


@query()
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for every page's URL: the stated rule's, else that of rules mined from the URLs that stated rules decide."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    index = url_filter.mine(url_filter.labelled_pages(pages))
    return url_filter.judge(pages, index).withColumnRenamed("id", "page_id")


MIXING_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
n AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS total, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source),
w AS (SELECT *, CAST([5, 2, 1][place % 3 + 1] AS DOUBLE) AS weight, 3 * total AS most FROM n),
l AS (
  SELECT *, (sum(total) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY most / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (
  SELECT source, total, CASE WHEN most <= weight * up THEN most ELSE weight * up END AS target
  FROM (SELECT *, (SELECT max(level) FROM l) AS up FROM l)),
p AS (
  SELECT doc_id, size, total, target,
    sum(size) OVER (PARTITION BY t.source ORDER BY md5('1:' || CAST(doc_id AS VARCHAR)) ROWS UNBOUNDED PRECEDING) - size AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, total AS source_size, CAST(target AS DOUBLE) AS target, CAST(size * (
    CAST(2 * start + size < 2 * target AS INT) + CAST(2 * (start + total) + size < 2 * target AS INT)
    + CAST(2 * (start + 2 * total) + size < 2 * target AS INT)) AS BIGINT) AS taken
FROM p
"""


@query(MIXING_SQL)
def op11_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix of all sources takes."""
    return mixing.mix(documents(spark, sf_dir)).rows.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.size("shards")).cast("long").alias("taken"))


INFILL_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || CAST(doc_id AS VARCHAR)) AS s FROM documents),
h AS (
  SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, CAST('0x' || s[1:8] AS BIGINT) AS h1, CAST('0x' || s[9:16] AS BIGINT) AS h2,
    CAST('0x' || s[17:24] AS BIGINT) AS h3, CAST('0x' || s[25:32] AS BIGINT) AS h4 FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS low, greatest(h1 % (n + 1), h2 % (n + 1)) AS high,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
         WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substring(t, 1, low) AS prefix, substring(t, low + 1, high - low) AS middle, substring(t, high + 1) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN low END AS prefix_chars, CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
         ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""


@query(INFILL_SQL)
def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-the-middle form of every document, and the text rebuilt from it."""
    return infill.restore(infill.transform(documents(spark, sf_dir))).select(
        F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


@query()
def op13_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first four whitened components of every embedding."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return whitening.fit_and_whiten(rows).withColumnRenamed("id", "vec_id")
