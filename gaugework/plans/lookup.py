"""Ways to find metric rows without reading them all: tag postings, typed JSON paths, and tables dealt by pipeline."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ROW, BLOCK, BUCKET = "row_id", "row_block", "tag_bucket"
#: Rows of a block, and buckets of tags.
BLOCK_ROWS, BUCKETS = 1 << 16, 64


# --- tags ----------------------------------------------------------------------------------

def write_postings(rows: DataFrame, folder: str, tags: str = "tags", buckets: int = BUCKETS, block_rows: int = BLOCK_ROWS) -> None:
    """Write ``rows`` with row ids, and an inverted table: for every tag and block the sorted ids of the rows that carry it.

    Blocks bound the list of one posting, so a tag that all rows carry is as many short lists as there are blocks. Postings are
    partitioned by a hash of the tag and sorted by tag inside. Null and empty lists of tags have no postings.
    """
    spark = rows.sparkSession
    numbered = rows.withColumn(ROW, F.monotonically_increasing_id())
    # the partition number is in the upper bits of an id, so a block lies in one partition
    numbered.withColumn(BLOCK, F.floor(F.col(ROW) / block_rows).cast("long")).write.parquet(f"{folder}/rows")
    stored = spark.read.parquet(f"{folder}/rows")
    each = stored.select(ROW, BLOCK, F.explode(F.array_distinct(tags)).alias("tag")).filter(F.col("tag").isNotNull())
    lists = each.groupBy("tag", BLOCK).agg(F.sort_array(F.collect_list(ROW)).alias("row_ids"), F.count(F.lit(1)).alias("n"))
    dealt = lists.withColumn(BUCKET, _bucket(F.col("tag"), buckets))
    dealt.repartitionByRange(BUCKET, "tag", BLOCK).sortWithinPartitions(BUCKET, "tag", BLOCK).write.partitionBy(BUCKET).parquet(f"{folder}/postings")


def _bucket(tag: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(tag), F.lit(buckets)).cast("int")


def postings(spark: SparkSession, folder: str, wanted: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Postings of the wanted tags: their buckets are pruned, and the tags are pushed into the scan."""
    names = sorted(set(wanted))
    found = spark.range(1).select(F.array_distinct(F.array(*[_bucket(F.lit(t), buckets) for t in names])).alias("b")).first()["b"] if names else []
    return spark.read.parquet(f"{folder}/postings").filter(F.col(BUCKET).isin(found) & F.col("tag").isin(names))


def rows_with_tags(spark: SparkSession, folder: str, wanted: Sequence[str], every: bool, buckets: int = BUCKETS) -> DataFrame:
    """Rows that carry any of the wanted tags, or ``every`` one: postings are united or intersected block by block."""
    names = sorted(set(wanted))
    by_block = postings(spark, folder, names, buckets).groupBy(BLOCK).agg(F.collect_list("row_ids").alias("lists"))  # a list per tag
    if every:
        both = F.aggregate(F.slice("lists", 2, len(names)), F.get("lists", F.lit(0)), lambda a, x: F.array_intersect(a, x))
        ids = by_block.filter(F.size("lists") == len(names)).select(BLOCK, F.explode(both).alias(ROW))
    else:
        ids = by_block.select(BLOCK, F.explode(F.array_distinct(F.flatten("lists"))).alias(ROW))
    return spark.read.parquet(f"{folder}/rows").join(ids, [BLOCK, ROW], "left_semi").drop(BLOCK, ROW)


# --- JSON ----------------------------------------------------------------------------------

def frequent_paths(rows: DataFrame, column: str = "metadata_json", share: float = 0.5, most: int = 32) -> dict[str, str]:
    """Top-level keys that at least ``share`` of the rows have, with the type all their values fit: double, else string."""
    keys = rows.select(F.try_parse_json(column).alias("v"), F.explode(F.json_object_keys(column)).alias("name"))
    total = rows.count()
    counted = keys.groupBy("name").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= share * total).orderBy(F.desc("n"), "name").limit(most)
    names = [r["name"] for r in counted.collect() if r["name"].isidentifier()]
    if not names:
        return {}
    number = lambda n: F.try_variant_get("v", f"$.{n}", "double")
    text = lambda n: F.try_variant_get("v", f"$.{n}", "string")
    parsed = rows.select(F.try_parse_json(column).alias("v"))
    odd = parsed.agg(*[F.count_if(number(n).isNull() & text(n).isNotNull()).alias(n) for n in names]).first()
    return {n: "string" if odd[n] else "double" for n in names}


def typed_name(path: str, column: str = "metadata_json") -> str:
    return f"{column}__{path}"


def with_typed_json(rows: DataFrame, paths: Mapping[str, str], column: str = "metadata_json") -> DataFrame:
    """``rows`` with the JSON text parsed once into a VARIANT, and a typed column per path, whose statistics a scan can use.

    Text that is not JSON is null there; the text stays.
    """
    parsed = rows.withColumn(f"{column}__variant", F.try_parse_json(column))
    return parsed.withColumns({typed_name(p, column): F.try_variant_get(f"{column}__variant", f"$.{p}", t) for p, t in paths.items()})


def write_typed_json(rows: DataFrame, path: str, paths: Mapping[str, str], column: str = "metadata_json") -> None:
    """Write ``rows`` clustered by the typed paths, so that their ranges per file are narrow."""
    typed = with_typed_json(rows, paths, column)
    names = [typed_name(p, column) for p in paths]
    (typed.repartitionByRange(*names).sortWithinPartitions(*names) if names else typed).write.parquet(path)


def json_path(table: DataFrame, path: str, kind: str = "double", column: str = "metadata_json") -> Column:
    """The value at a path: the typed column if the table has one, else from the VARIANT."""
    name = typed_name(path, column)
    return F.col(name) if name in table.columns else F.try_variant_get(f"{column}__variant", f"$.{path}", kind)


# --- distribution ----------------------------------------------------------------------------

SALT = "pipeline_salt"


def dominant(rows: DataFrame, salts: int, key: str = "pipeline_id") -> list[str]:
    """Keys with more than 1 / ``salts`` of the rows: fewer than ``salts`` of them."""
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = rows.count()
    return sorted(r[key] for r in counted.filter((F.col("n") * salts > total) & F.col(key).isNotNull()).collect())


def save_distributed(rows: DataFrame, table: str, path: str, heavy: Sequence[str], buckets: int, salts: int, row_key: Sequence[str],
                     key: str = "pipeline_id", copies: bool = False) -> DataFrame:
    """Save ``rows`` as a catalog table bucketed and sorted by (key, salt).

    The rows of a ``heavy`` key get one of ``salts`` salts by ``row_key``; all others have salt 0. ``copies`` is for the
    small side of joins: it has a row per salt of a heavy key instead. Tables with equal buckets join and aggregate on
    (key, salt) where they lie.
    """
    is_heavy = F.coalesce(F.col(key).isin(list(heavy)), F.lit(False)) if heavy else F.lit(False)
    own = F.explode(F.when(is_heavy, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))) if copies else F.when(
        is_heavy, F.pmod(F.xxhash64(*row_key), F.lit(salts))).otherwise(0).cast("int")
    salted = rows.withColumn(SALT, own).repartition(buckets, key, SALT)
    salted.write.bucketBy(buckets, key, SALT).sortBy(key, SALT).option("path", path).saveAsTable(table)
    return rows.sparkSession.table(table)


def totals_by_key(table: DataFrame, values: Mapping[str, Column], key: str = "pipeline_id") -> DataFrame:
    """Sums per key: rows are added up per (key, salt) in place, and only those sums travel."""
    partial = table.groupBy(key, SALT).agg(*[v.alias(n) for n, v in values.items()])
    return partial.groupBy(key).agg(*[F.sum(n).alias(n) for n in values])

