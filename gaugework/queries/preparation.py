"""Loading, validation, keys, folds and the hyper-parameter catalog."""

from pyspark.sql import functions as F

from gaugework.functions.exprs import normalise_label
from gaugework.operators import checks, folds
from gaugework.operators.catalog import grid_text, model_specs as specs_of, parameter_grid
from gaugework.operators.reshape import parameters_json
from gaugework.plans import mlmetrics, records
from gaugework.queries.base import query, table, tidy
from gaugework.queries.inputs import (
    BY, BY_SQL, CATALOG, GRID_SQL, K, ORDER_FOLDS_SQL, SC_SQL, SEED,
    embedding_rows, order_folds, scored, tuning_sets,
)
from gaugework.session import new_table_path
from gaugework.sources.tables import load_csv, load_rows, replace_table

LINE_RANGES = {
    "l_quantity": (1.0, 45.0),
    "l_extendedprice": (0.0, 100000.0),
    "l_discount": (0.0, 0.08),
    "l_tax": (0.0, 0.06),
}
_OUTSIDE_SQL = " OR ".join(f"{c} < {lo!r}e0 OR {c} > {hi!r}e0" for c, (lo, hi) in LINE_RANGES.items())


@query("""SELECT vec_id AS id, CAST(label AS VARCHAR) AS label, place, round(CAST(embedding[place] AS DOUBLE), 6) AS value
FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS place FROM embeddings)""")
def raw_load(spark, sf_dir):
    """The typed raw table, all components of every vector, one line each."""
    rows = embedding_rows(spark, sf_dir)
    return tidy(rows.select("id", "label", F.posexplode("features").alias("place", "value")).withColumn("place", F.col("place") + 1))


@query("""SELECT o_orderkey AS id,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high'
                            WHEN '3-MEDIUM' THEN 'medium' ELSE 'low' END AS label
FROM orders""")
def label_normalise(spark, sf_dir):
    mapping = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium"}
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        normalise_label(F.col("o_orderpriority"), mapping, else_label="low").alias("label"),
    )


@query(f"""WITH t AS (
  SELECT count(*) AS n, count(DISTINCT l_returnflag) AS d,
         max(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS a,
         max(CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END) AS b,
         max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS c,
         max(CASE WHEN l_returnflag = 'X' THEN 1 ELSE 0 END) AS x,
         count(*) FILTER (WHERE {_OUTSIDE_SQL}) AS o,
         count(*) FILTER (WHERE l_returnflag IS NULL OR l_quantity IS NULL OR l_extendedprice IS NULL
                             OR l_discount IS NULL OR l_tax IS NULL) AS u
  FROM lineitem),
r AS (
  SELECT 'row_count' AS "check", 60000 AS expected, n AS actual FROM t
  UNION ALL SELECT 'distinct_labels', 4, d FROM t
  UNION ALL SELECT 'label_present:A', 1, a FROM t
  UNION ALL SELECT 'label_present:N', 1, b FROM t
  UNION ALL SELECT 'label_present:R', 1, c FROM t
  UNION ALL SELECT 'label_present:X', 1, x FROM t
  UNION ALL SELECT 'rows_out_of_range', 0, o FROM t
  UNION ALL SELECT 'rows_with_null', 0, u FROM t)
SELECT "check", CAST(expected AS BIGINT) AS expected, CAST(actual AS BIGINT) AS actual,
       expected = actual AS passed FROM r""")
def validate_report(spark, sf_dir):
    return checks.validate(
        table(spark, sf_dir, "lineitem"), "l_returnflag", 60000, ["A", "N", "R", "X"], LINE_RANGES
    )


@query(f"""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, round(l_quantity, 6) AS l_quantity,
       round(l_extendedprice, 6) AS l_extendedprice, round(l_discount, 6) AS l_discount,
       round(l_tax, 6) AS l_tax
FROM lineitem WHERE {_OUTSIDE_SQL}""")
def range_violations(spark, sf_dir):
    bad = checks.range_violations(table(spark, sf_dir, "lineitem"), LINE_RANGES)
    return tidy(bad.select("l_orderkey", "l_linenumber", *LINE_RANGES))


@query("""SELECT o_custkey, count(*) AS n_rows FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
GROUP BY o_custkey""")
def fk_orphans(spark, sf_dir):
    in_credit = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") >= 0)
    return checks.orphans(table(spark, sf_dir, "orders"), "o_custkey", in_credit, "c_custkey")


@query("""SELECT event_id, ntile(5) OVER (ORDER BY md5('42:' || CAST(event_id AS VARCHAR)), event_id) AS fold_id
FROM events""")
def fold_global(spark, sf_dir):
    ids = table(spark, sf_dir, "events").select("event_id")
    return tidy(folds.assign_folds(ids, K, "event_id", SEED))


@query("""SELECT event_id, event_type,
       ntile(5) OVER (PARTITION BY event_type ORDER BY md5('42:' || CAST(event_id AS VARCHAR)), event_id) AS fold_id
FROM events""")
def fold_stratified(spark, sf_dir):
    ids = table(spark, sf_dir, "events").select("event_id", "event_type")
    return tidy(folds.assign_folds(ids, K, "event_id", SEED, stratify=["event_type"]))


@query(f"WITH {ORDER_FOLDS_SQL} SELECT DISTINCT fold_id FROM o5")
def fold_list(spark, sf_dir):
    return tidy(folds.fold_list(order_folds(spark, sf_dir)))


@query(f"""WITH {ORDER_FOLDS_SQL}, f AS (SELECT DISTINCT fold_id FROM o5)
SELECT f.fold_id, s.side, count(*) AS n_rows, min(o_orderkey) AS min_key, max(o_orderkey) AS max_key
FROM f, (VALUES ('train'), ('test')) s(side), o5
WHERE (s.side = 'test') = (o5.fold_id = f.fold_id)
GROUP BY f.fold_id, s.side""")
def holdout_split(spark, sf_dir):
    return tidy(folds.holdout_sizes(order_folds(spark, sf_dir), K))


@query(f"""WITH {SC_SQL}
SELECT {BY_SQL}, CAST(max(CASE WHEN actual = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS has_positive,
       CAST(max(CASE WHEN actual <> 'P' THEN 1 ELSE 0 END) AS BIGINT) AS has_negative
FROM sc GROUP BY {BY_SQL}""")
def class_presence(spark, sf_dir):
    return tidy(folds.class_presence(scored(spark, sf_dir), "actual", "P", BY))


@query(f"WITH {GRID_SQL} SELECT * FROM grid")
def param_grid(spark, sf_dir):
    return parameter_grid(tuning_sets(spark, sf_dir))


@query(f"""WITH {GRID_SQL}
SELECT parameter_set_id,
       string_agg(parameter_name || '=' || parameter_value, '; ' ORDER BY parameter_name) AS hyperparameters
FROM grid GROUP BY parameter_set_id""")
def hyperparam_string(spark, sf_dir):
    return grid_text(parameter_grid(tuning_sets(spark, sf_dir)))


@query(f"""WITH {GRID_SQL}
SELECT parameter_set_id,
       '{{' || string_agg('"' || parameter_name || '":"' || parameter_value || '"', ',' ORDER BY parameter_name)
       || '}}' AS hyperparameters
FROM grid GROUP BY parameter_set_id""")
def hyperparam_json(spark, sf_dir):
    return parameters_json(parameter_grid(tuning_sets(spark, sf_dir)), ["parameter_set_id"])


_SPEC_VALUES = ", ".join(
    f"({i}, '{a}', '{v}', '{'; '.join(f'{n}={t}' for n, t in sorted(s))}')"
    for i, (a, v, s) in enumerate(CATALOG, start=1)
)


@query(f"""WITH {ORDER_FOLDS_SQL}, f AS (SELECT DISTINCT fold_id FROM o5),
p(parameter_set_id, algorithm, version_tag, hyperparameters) AS (VALUES {_SPEC_VALUES})
SELECT row_number() OVER (ORDER BY fold_id, algorithm, version_tag) AS spec_no,
       'ORDERS_' || algorithm || '_F' || CAST(fold_id AS VARCHAR) || '_' || version_tag AS model_name,
       fold_id, CAST(parameter_set_id AS BIGINT) AS parameter_set_id, algorithm, version_tag, hyperparameters
FROM f, p""")
def model_specs(spark, sf_dir):
    present = folds.fold_list(order_folds(spark, sf_dir))
    return tidy(specs_of(present, "ORDERS"))


@query("""WITH k AS (SELECT CASE WHEN o_orderkey % 3 <> 0 THEN o_orderkey END AS id FROM orders),
r AS (SELECT id, row_number() OVER (ORDER BY coalesce(md5('42:' || CAST(id AS VARCHAR)), ''), id) AS place,
             count(*) OVER () AS n FROM k)
SELECT fold_id, count(*) AS n_rows, count(id) AS n_keys, CAST(coalesce(sum(id), 0) AS BIGINT) AS key_sum
FROM (SELECT id, ntile(4) OVER (ORDER BY place) AS fold_id FROM r) GROUP BY fold_id""")
def fold_null_key(spark, sf_dir):
    """Folds of a table in which a third of the keys is NULL: every row is in one."""
    rows = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey")).alias("id"))
    return tidy(folds.assign_folds(rows, 4, seed=SEED).groupBy("fold_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("id").alias("n_keys"), F.coalesce(F.sum("id"), F.lit(0)).alias("key_sum")))


_CUSTOMER = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


@query("SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 6) AS c_acctbal, c_mktsegment FROM customer")
def csv_round_trip(spark, sf_dir):
    """Customers written as delimited files and loaded with a declared schema."""
    path = new_table_path(spark, "customer-csv")
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    rows.write.option("header", True).option("sep", "|").csv(path)
    return tidy(load_csv(spark, path, _CUSTOMER, delimiter="|"))


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal >= 0")
def replaced_table(spark, sf_dir):
    """A table that was created from all customers and then replaced by those with a positive balance."""
    path = new_table_path(spark, "replaced")
    rows = table(spark, sf_dir, "customer")
    replace_table(rows.select("c_custkey", "c_mktsegment", "c_name"), path)
    return tidy(replace_table(rows.filter("c_acctbal >= 0").select("c_custkey", "c_mktsegment"), path))


@query("""SELECT n_name, CASE n_regionkey WHEN 0 THEN 'south' WHEN 1 THEN 'west' WHEN 2 THEN 'east' ELSE 'unlisted' END AS side, count(c_custkey) AS n_customers
FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL""")
def literal_rows(spark, sf_dir):
    """A literal table of three lines beside the nations and their customers."""
    sides = load_rows(spark, [(0, "south"), (1, "west"), (2, "east")], "n_regionkey int, side string")
    named = table(spark, sf_dir, "nation").join(F.broadcast(sides), "n_regionkey", "left")
    counted = table(spark, sf_dir, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("n"))
    return tidy(named.join(counted, "n_nationkey", "left").select(
        "n_name", F.coalesce("side", F.lit("unlisted")).alias("side"), F.coalesce("n", F.lit(0)).alias("n_customers")))


@query("""SELECT event_id, strftime(ts, '%Y%m%d%H%M%S') || lpad(CAST(user_id % 1000 AS VARCHAR), 3, '0') AS run_id,
       'PROB_' || upper(replace(event_type, '-', '_')) AS prob_column FROM events""")
def run_id_texts(spark, sf_dir):
    """Run ids and probability column names as text, of every event."""
    return tidy(table(spark, sf_dir, "events").select(
        "event_id", records.run_id_text(F.col("ts"), F.col("user_id")).alias("run_id"),
        records.probability_column(F.col("event_type")).alias("prob_column")))


@query("SELECT count(*) AS n_rows, true AS all_recent FROM events")
def default_time(spark, sf_dir):
    """Rows without a time take the current one."""
    rows = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("pipeline_id"), F.col("event_id").cast("string").alias("run_id"), F.lit("v").alias("metric_name"), F.col("value").alias("metric_value"))
    seconds = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("recorded_at")
    return mlmetrics.with_defaults(rows).agg(F.count(F.lit(1)).alias("n_rows"), F.every(seconds.between(0, 3600)).alias("all_recent"))
