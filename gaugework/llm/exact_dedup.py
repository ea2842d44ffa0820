"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash.

Texts are equal when identical after each run of ``[\\x20\\x09-\\x0D]`` is replaced by one space.
A row first joins the group of its normalised length. Only groups of two or more go on to the
hash of a prefix, and only groups of two or more of those to SHA-256 of the whole normalised
text. All groups are counted by hash aggregation, which combines before the shuffle, so a group
of copies with a third of all rows is one row per task; finding the groups shuffles no texts.

Edge cases: a null text counts as empty. Of equal texts the smallest id stays; ids that are null
count as larger than all others. Of repeated rows with the same id exactly one stays. An empty
table gives an empty result. Extra columns do not matter; clashing names cannot occur because
the working columns live in tables of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from gaugework.llm.common import bounded_broadcast, fresh, written

PREFIX_CHARS = 64
#: Surviving (length, prefix hash) pairs, 16 bytes each, that may be broadcast.
MAX_BROADCAST_ROWS = 500_000


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def survivors(keys: DataFrame) -> DataFrame:
    """(n, prefix) pairs held by two or more rows, looking only at lengths held by two or more."""
    by_prefix = keys.groupBy("n", "prefix").agg(F.count(F.lit(1)).alias("rows"))
    by_length = by_prefix.groupBy("n").agg(F.sum("rows").alias("of_length")).filter("of_length > 1").select("n")
    return by_prefix.filter("rows > 1").join(by_length, "n", "left_semi").select("n", "prefix")


def refine(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_all: bool = False) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, sha256 (hex), n and prefix (length and prefix hash).

    ``sha256`` is null for rows that no longer had company after the prefix hash, unless
    ``digest_all`` asks for it: then the single scan that takes the prefix takes it too.
    """
    text = normalised(F.col(text_col))
    keys = docs.select(F.col(id_col).alias("id"), text.alias("t")).select(
        "id",
        F.length("t").cast("long").alias("n"),
        F.xxhash64(F.substring("t", 1, PREFIX_CHARS)).alias("prefix"),
        F.sha2("t", 256).alias("sha256") if digest_all else F.lit(None).cast("string").alias("sha256"),
    ).withColumn("row", F.monotonically_increasing_id())
    if digest_all:
        rows = written(keys, "dedup-rows")
        in_company = written(survivors(rows), "dedup-survivors").withColumn("alive", F.lit(True))
        rows = rows.join(bounded_broadcast(in_company, MAX_BROADCAST_ROWS), ["n", "prefix"], "left")
    else:
        in_company = written(survivors(keys.select("n", "prefix")), "dedup-survivors").withColumn("alive", F.lit(True))
        if in_company.limit(MAX_BROADCAST_ROWS + 1).count() <= MAX_BROADCAST_ROWS:
            # the flag meets the row before its text is hashed: others are never hashed in full
            full = docs.select(F.col(id_col).alias("id"), text.alias("t")).select(
                "id", "t", F.length("t").cast("long").alias("n"),
                F.xxhash64(F.substring("t", 1, PREFIX_CHARS)).alias("prefix"),
                F.monotonically_increasing_id().alias("row"),
            ).join(F.broadcast(in_company), ["n", "prefix"], "left")
            rows = written(full.select("id", "n", "prefix", "row", "alive", F.when(F.col("alive"), F.sha2("t", 256)).alias("sha256")), "dedup-rows")
        else:
            # too many survivors to send around: hash in the scan, so that no text is shuffled
            full = docs.select(F.col(id_col).alias("id"), text.alias("t")).select(
                "id", F.length("t").cast("long").alias("n"),
                F.xxhash64(F.substring("t", 1, PREFIX_CHARS)).alias("prefix"),
                F.monotonically_increasing_id().alias("row"), F.sha2("t", 256).alias("sha256"),
            )
            rows = written(full, "dedup-rows").join(in_company, ["n", "prefix"], "left")
    alone = rows.filter(F.col("alive").isNull()).select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "sha256", "n", "prefix",
    )
    alive = rows.filter("alive").select("id", "row", "sha256", "n", "prefix")
    # ids first, then the row that stands for a repeated id: longs only, so both are hash aggregates
    by_id = alive.groupBy("sha256", "id").agg(F.count(F.lit(1)).alias("rows"), F.min("row").alias("first_row"))
    groups = by_id.groupBy("sha256").agg(F.min("id").alias("keep_id"), F.sum("rows").alias("group_size"))
    firsts = by_id.join(groups, "sha256").filter(F.col("id").eqNullSafe(F.col("keep_id"))).select(
        "sha256", "keep_id", "group_size", "first_row",
    )
    grouped = alive.join(firsts, "sha256").select(
        "id", "keep_id", "group_size", (F.col("row") == F.col("first_row")).alias("kept"), "sha256", "n", "prefix",
    )
    return alone.unionByName(grouped)


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one row of each group of equal texts.

    Rows are marked by id, length and prefix hash first; only texts of marked rows are hashed again. Up to
    ``MAX_BROADCAST_ROWS / 4`` rows to drop are sent to the texts; beyond that Spark shuffles both, texts included.
    """
    decided = written(refine(docs, id_col, text_col).filter("group_size > 1"), "dedup-decided")
    gone = decided.filter(~F.col("id").eqNullSafe(F.col("keep_id"))).select("id", "n", "prefix", "sha256", F.lit(True).alias("out"))
    once = decided.filter(F.col("id").eqNullSafe(F.col("keep_id")) & ~F.col("kept")).select("id", "n", "prefix", "sha256", F.lit(False).alias("out"))
    marks = written(gone.unionByName(once).distinct(), "dedup-marks")
    names = {c: fresh(docs, f"dedup_{c}") for c in ("id", "n", "prefix", "sha256", "out", "marked")}
    marks = marks.toDF(*(names[c] for c in ("id", "n", "prefix", "sha256", "out")))
    text = normalised(F.col(text_col))
    near = bounded_broadcast(marks.select(names["id"], names["n"], names["prefix"]).distinct(), MAX_BROADCAST_ROWS // 4).withColumn(names["marked"], F.lit(True))
    same = F.col(id_col).eqNullSafe(F.col(names["id"])) & (F.length(text) == F.col(names["n"])) & (
        F.xxhash64(F.substring(text, 1, PREFIX_CHARS)) == F.col(names["prefix"]))
    marked = docs.join(near, same, "left").drop(names["id"], names["n"], names["prefix"])
    digest = fresh(marked, "dedup_digest")
    hashed = marked.withColumn(digest, F.when(F.col(names["marked"]), F.sha2(text, 256))).drop(names["marked"])
    exact = bounded_broadcast(marks.select(names["id"], names["sha256"], names["out"]).distinct(), MAX_BROADCAST_ROWS // 4)
    found = hashed.join(exact, F.col(id_col).eqNullSafe(F.col(names["id"])) & (F.col(digest) == F.col(names["sha256"])), "left")
    stay = found.filter(F.col(names["out"]).isNull()).select(*docs.columns)
    if once.isEmpty():
        return stay
    # several rows of one id and text: one of them stays
    single = found.filter(~F.col(names["out"])).dropDuplicates([names["id"], digest]).select(*docs.columns)
    return stay.unionByName(single)
