"""Inputs derived from the test tables, each with the same derivation in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugework.operators.catalog import CATALOG, model_name
from gaugework.operators.folds import assign_folds
from gaugework.queries.base import table
from gaugework.sources.tables import load_table

K = 5
SEED = 42
FEATURES = ["f1", "f2", "f3", "f4"]
BY = ["run_id", "model_name", "fold_id"]
BY_SQL = "run_id, model_name, fold_id"
AS_OF_SQL = "TIMESTAMP '2024-02-01 00:00:00'"


def as_of() -> Column:
    """The fixed "now" of the queries, so that their results do not depend on the clock."""
    return instant("2024-02-01 00:00:00")


def instant(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def embedding_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole vector and the label of every embedding."""
    return load_table(spark, f"{sf_dir}/embeddings.parquet", {
        "id": ("vec_id", "bigint"), "features": ("embedding", "array<double>"), "label": ("label", "string"),
    })


def customer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four features and the market segment of every customer."""
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("top"),
    )
    return table(spark, sf_dir, "customer").join(orders, "c_custkey", "left").select(
        F.col("c_custkey").alias("id"),
        F.col("c_acctbal").cast("double").alias("f1"),
        F.coalesce("n", F.lit(0)).cast("double").alias("f2"),
        (F.coalesce("top", F.lit(0)) / 100).cast("double").alias("f3"),
        F.col("c_nationkey").cast("double").alias("f4"),
        F.col("c_mktsegment").alias("label"),
    )


def customer_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_folds(customer_rows(spark, sf_dir), K, seed=SEED)


CUSTOMERS_SQL = """cu AS (
  SELECT c_custkey AS id, CAST(c_acctbal AS DOUBLE) AS f1, CAST(coalesce(n, 0) AS DOUBLE) AS f2,
         CAST(coalesce(top, 0) / 100 AS DOUBLE) AS f3, CAST(c_nationkey AS DOUBLE) AS f4, c_mktsegment AS label,
         ntile(5) OVER (ORDER BY md5('42:' || CAST(c_custkey AS VARCHAR)), c_custkey) AS fold_id
  FROM customer LEFT JOIN (SELECT o_custkey AS c_custkey, count(*) AS n, max(o_totalprice) AS top
                           FROM orders GROUP BY o_custkey) USING (c_custkey))"""


def separable_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customers' features with a label that follows from one of them."""
    return customer_rows(spark, sf_dir).withColumn("label", F.when(F.col("f1") < 4500, "low").otherwise("high"))


def event_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four numeric features and the type of every event."""
    ev = table(spark, sf_dir, "events")
    rows = ev.select(
        F.col("event_id").alias("id"),
        F.col("value").alias("f1"),
        F.col("user_id").cast("double").alias("f2"),
        F.get_json_object("props", "$.k").cast("double").alias("f3"),
        (F.hour("ts") * 60 + F.minute("ts")).cast("double").alias("f4"),
        F.col("event_type").alias("label"),
    )
    return assign_folds(rows, K, seed=SEED)


EVENT_FOLDS_SQL = """ef AS (
  SELECT event_id AS id, value AS f1, CAST(user_id AS DOUBLE) AS f2,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS f3,
         CAST(hour(ts) * 60 + minute(ts) AS DOUBLE) AS f4, event_type AS label,
         ntile(5) OVER (ORDER BY md5('42:' || CAST(event_id AS VARCHAR)), event_id) AS fold_id
  FROM events)"""


def order_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_folds(
        table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "id"), K, seed=SEED
    )


ORDER_FOLDS_SQL = """o5 AS (
  SELECT *, ntile(5) OVER (ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR)), o_orderkey) AS fold_id
  FROM orders)"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scored table over all orders: thirty models a year, class weights from the keys."""
    key, cust = F.col("id"), F.col("o_custkey")
    sets = F.array(*[
        F.struct(F.lit(a).alias("algorithm"), F.lit(v).alias("version_tag")) for a, v, _ in CATALOG
    ])
    weights = {"F": 1 + key % 7, "O": 1 + cust % 5, "P": 1 + (key + cust) % 3}
    total = sum((w.cast("double") for w in weights.values()), F.lit(0.0))
    rows = order_folds(spark, sf_dir).select(
        F.concat(F.lit("run-"), F.year("o_orderdate").cast("string")).alias("run_id"),
        F.year("o_orderdate").alias("run_year"),
        "fold_id",
        (1 + cust % 6).alias("parameter_set_id"),
        "id",
        F.col("o_totalprice").alias("price"),
        F.col("o_orderdate").alias("scored_at"),
        F.col("o_orderstatus").alias("actual"),
        *[(w.cast("double") / total).alias(f"p_{c}") for c, w in weights.items()],
        F.element_at(sets, (1 + cust % 6).cast("int")).alias("s"),
    ).select("*", "s.*").drop("s")
    f, o, p = F.col("p_F"), F.col("p_O"), F.col("p_P")
    return rows.select(
        "run_id", model_name("ORDERS").alias("model_name"), "fold_id", "parameter_set_id",
        "algorithm", "version_tag", "id", "price", "scored_at", "actual",
        F.when((f >= o) & (f >= p), "F").when(o >= p, "O").otherwise("P").alias("predicted"),
        F.create_map(F.lit("F"), f, F.lit("O"), o, F.lit("P"), p).alias("probs"),
        (F.col("run_year") * 100 + (F.col("fold_id") - 1) * len(CATALOG) + F.col("parameter_set_id"))
        .cast("bigint").alias("model_id"),
    )


SC_SQL = ORDER_FOLDS_SQL + """, w AS (
  SELECT *, 1 + o_custkey % 6 AS ps, CAST(1 + o_orderkey % 7 AS DOUBLE) AS wf,
         CAST(1 + o_custkey % 5 AS DOUBLE) AS wo, CAST(1 + (o_orderkey + o_custkey) % 3 AS DOUBLE) AS wp
  FROM o5),
sc AS (
  SELECT 'run-' || CAST(year(o_orderdate) AS VARCHAR) AS run_id,
         'ORDERS_' || a || '_F' || CAST(fold_id AS VARCHAR) || '_' || v AS model_name,
         fold_id, ps AS parameter_set_id, a AS algorithm, v AS version_tag, o_orderkey AS id,
         o_totalprice AS price, o_orderdate AS scored_at, o_orderstatus AS actual,
         CASE WHEN pf >= po AND pf >= pp THEN 'F' WHEN po >= pp THEN 'O' ELSE 'P' END AS predicted,
         pf, po, pp, year(o_orderdate) * 100 + (fold_id - 1) * 6 + ps AS model_id
  FROM (SELECT *, wf / (0e0 + wf + wo + wp) AS pf, wo / (0e0 + wf + wo + wp) AS po,
               wp / (0e0 + wf + wo + wp) AS pp,
               CASE WHEN ps <= 2 THEN 'DECISION_TREE' WHEN ps <= 4 THEN 'RANDOM_FOREST' ELSE 'SVM' END AS a,
               'v' || CAST(1 + (ps - 1) % 2 AS VARCHAR) AS v
        FROM w))"""

P_PREDICTED_SQL = "CASE predicted WHEN 'F' THEN pf WHEN 'O' THEN po ELSE pp END"
P_TRUE_SQL = "CASE actual WHEN 'F' THEN pf WHEN 'O' THEN po WHEN 'P' THEN pp ELSE 0e0 END"


def metric_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows shaped for the unified metrics table, one per event; keys repeat."""
    ev = table(spark, sf_dir, "events")
    env = F.element_at(
        F.array(F.lit("production"), F.lit("staging"), F.lit("lab")),
        (F.col("event_id") % 3 + 1).cast("int"),
    )
    return ev.select(
        F.col("event_type").alias("pipeline_id"),
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("run_id"),
        F.lit("value").alias("metric_name"),
        F.col("value").alias("metric_value"),
        F.when(F.col("event_id") % 4 != 0, "gauge").alias("metric_type"),
        F.col("ts").alias("recorded_at"),
        F.concat(F.lit("v"), (F.col("event_id") % 3).cast("string")).alias("model_version"),
        env.alias("environment_label"),
        F.array("event_type", env).alias("tags"),
        F.col("props").alias("metadata_json"),
    )


MM_SQL = """mm AS (
  SELECT event_type AS pipeline_id, 'u' || CAST(user_id AS VARCHAR) AS run_id, 'value' AS metric_name,
         value AS metric_value, CASE WHEN event_id % 4 <> 0 THEN 'gauge' END AS metric_type,
         ts AS recorded_at, 'v' || CAST(event_id % 3 AS VARCHAR) AS model_version,
         ['production', 'staging', 'lab'][CAST(event_id % 3 + 1 AS INTEGER)] AS environment_label,
         props AS metadata_json
  FROM events)"""


def tuning_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One parameter set per part: algorithm and version follow from its key and size."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("parameter_set_id"),
        F.element_at(
            F.array(F.lit("DECISION_TREE"), F.lit("RANDOM_FOREST"), F.lit("SVM")),
            (F.col("p_partkey") % 3 + 1).cast("int"),
        ).alias("algorithm"),
        F.concat(F.lit("v"), (1 + F.col("p_size") % 2).cast("string")).alias("version_tag"),
    )


_CATALOG_VALUES = ", ".join(
    f"('{a}', '{v}', '{n}', '{t}')" for a, v, settings in CATALOG for n, t in settings
)
GRID_SQL = f"""catalog(algorithm, version_tag, parameter_name, parameter_value) AS (
  VALUES {_CATALOG_VALUES}),
sets AS (
  SELECT p_partkey AS parameter_set_id,
         ['DECISION_TREE', 'RANDOM_FOREST', 'SVM'][CAST(p_partkey % 3 + 1 AS INTEGER)] AS algorithm,
         'v' || CAST(1 + p_size % 2 AS VARCHAR) AS version_tag
  FROM part),
grid AS (
  SELECT parameter_set_id, parameter_name, parameter_value
  FROM sets JOIN catalog USING (algorithm, version_tag))"""
