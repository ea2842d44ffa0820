"""k-NN and the classification metrics."""

from pyspark.sql import functions as F

from gaugework.functions.exprs import prob_in_array, prob_of
from gaugework.operators import knn, metrics, pivots
from gaugework.operators.folds import assign_folds
from gaugework.plans.sweep import run_knn
from gaugework.queries.base import query, table, tidy
from gaugework.queries.inputs import (
    BY, BY_SQL, CUSTOMERS_SQL, EVENT_FOLDS_SQL, FEATURES, K, P_PREDICTED_SQL, P_TRUE_SQL, SC_SQL, SEED,
    customer_folds, embedding_rows, event_folds, scored,
)

NEIGHBOURS = 5


def _near_sql(source: str) -> str:
    gap = " + ".join(f"(q.{f} - t.{f}) * (q.{f} - t.{f})" for f in FEATURES)
    return f"""near AS (
  SELECT id, fold_id, unnest(best) AS b, unnest(range(1, len(best) + 1)) AS rank
  FROM (SELECT q.id, q.fold_id,
               min({{'distance': sqrt({gap}), 'id': t.id, 'label': t.label}}, {NEIGHBOURS}) AS best
        FROM {source} q JOIN {source} t ON q.fold_id <> t.fold_id
        GROUP BY q.id, q.fold_id))"""


_VOTES_SQL = """votes AS (SELECT id, b.label AS label, count(*) AS v FROM near GROUP BY id, b.label),
best AS (
  SELECT id, label AS predicted, v / 5e0 AS confidence FROM votes
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY v DESC, label) = 1)"""


def _predict_sql(source: str, source_sql: str) -> str:
    return f"""WITH {source_sql}, {_near_sql(source)}, {_VOTES_SQL}
SELECT s.id, s.fold_id, s.label AS actual, b.predicted, round(b.confidence, 6) AS confidence
FROM {source} s LEFT JOIN best b ON s.id = b.id"""


@query(f"""WITH {CUSTOMERS_SQL}, {_near_sql('cu')}
SELECT id, fold_id, rank, b.id AS neighbour_id, b.label AS neighbour_label,
       round(b.distance, 6) AS distance
FROM near""")
def knn_neighbours(spark, sf_dir):
    return tidy(knn.neighbours(customer_folds(spark, sf_dir), FEATURES, NEIGHBOURS))


@query(_predict_sql("cu", CUSTOMERS_SQL))
def knn_predict(spark, sf_dir):
    return tidy(knn.predict(customer_folds(spark, sf_dir), FEATURES, NEIGHBOURS))


@query(_predict_sql("ef", EVENT_FOLDS_SQL))
def knn_predict_events(spark, sf_dir):
    return tidy(knn.predict(event_folds(spark, sf_dir), FEATURES, NEIGHBOURS))


_VECTORS_SQL = f"""vs AS (
  SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x, CAST(label AS VARCHAR) AS label,
         ntile({K}) OVER (ORDER BY md5('{SEED}:' || CAST(vec_id AS VARCHAR)), vec_id) AS fold_id FROM embeddings)"""


@query(f"""WITH {_VECTORS_SQL},
near AS (
  SELECT id, fold_id, unnest(best) AS b, unnest(range(1, len(best) + 1)) AS rank
  FROM (SELECT q.id, q.fold_id, min({{'distance': list_distance(q.x, t.x), 'id': t.id, 'label': t.label}}, {NEIGHBOURS}) AS best
        FROM vs q JOIN vs t ON q.fold_id <> t.fold_id GROUP BY q.id, q.fold_id))
SELECT id, fold_id, rank, b.id AS neighbour_id, b.label AS neighbour_label, round(b.distance, 6) AS distance FROM near""")
def knn_embeddings(spark, sf_dir):
    """The nearest embeddings by all 64 components."""
    split = assign_folds(embedding_rows(spark, sf_dir), K, seed=SEED)
    return tidy(pivots.search(split, "features", NEIGHBOURS).near)


@query(f"""WITH {CUSTOMERS_SQL}, {_near_sql('cu')}, {_VOTES_SQL},
f AS (
  SELECT fold_id, count(*) AS total, count(*) FILTER (WHERE predicted = label) AS correct
  FROM cu LEFT JOIN (SELECT id, predicted FROM best) USING (id) GROUP BY fold_id),
a AS (SELECT fold_id, total, correct / CAST(total AS DOUBLE) AS accuracy FROM f)
SELECT 'knn_model_fold_' || CAST(fold_id AS VARCHAR) AS model_name, fold_id AS fold_number,
       'accuracy' AS metric_name, round(accuracy, 6) AS metric_value FROM a
UNION ALL
SELECT 'knn_model_fold_' || CAST(fold_id AS VARCHAR), fold_id, 'total_predictions',
       CAST(total AS DOUBLE) FROM a
UNION ALL
SELECT 'knn_model_cv', CAST(0 AS BIGINT), 'cv_mean_accuracy', round(avg(accuracy), 6) FROM a""")
def knn_cv(spark, sf_dir):
    predicted = run_knn(customer_folds(spark, sf_dir), FEATURES, NEIGHBOURS, "run-1")
    return tidy(metrics.cross_validation_rows(predicted, "knn_model").drop("run_id"))


# --- scored-table access ---------------------------------------------------------------


@query(f"WITH {SC_SQL} SELECT id, actual, predicted, round({P_PREDICTED_SQL}, 6) AS prob FROM sc")
def score_truth_join(spark, sf_dir):
    scores = scored(spark, sf_dir).select("id", "predicted", "probs")
    truth = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("actual")
    )
    joined = metrics.join_truth(scores, truth)
    return tidy(joined.select(
        "id", "actual", "predicted", prob_of(F.col("probs"), F.col("predicted")).alias("prob")
    ))


@query(f"WITH {SC_SQL} SELECT id, predicted, round({P_PREDICTED_SQL}, 6) AS predicted_prob FROM sc")
def prob_of_predicted(spark, sf_dir):
    pairs = F.transform(
        F.map_entries("probs"), lambda e: F.struct(e["key"].alias("label"), e["value"].alias("prob"))
    )
    return tidy(scored(spark, sf_dir).withColumn("pairs", pairs).select(
        "id", "predicted", prob_in_array(F.col("pairs"), F.col("predicted")).alias("predicted_prob")
    ))


@query(f"""WITH {SC_SQL}
SELECT id, predicted AS predicted_label, round({P_PREDICTED_SQL}, 6) AS predicted_prob FROM sc""")
def struct_extract(spark, sf_dir):
    held = scored(spark, sf_dir).select("id", F.struct(
        F.col("predicted").alias("predicted_value"),
        prob_of(F.col("probs"), F.col("predicted")).alias("probability"),
    ).alias("prediction"))
    return tidy(metrics.unpack_prediction(held))


# --- confusion matrix and what follows from it ------------------------------------------


def _classes_sql(labels: str, only_true: bool) -> str:
    """Per group and label: rows of it, rows called it, rows of it called it, straight from the scores."""
    having = "HAVING count(*) FILTER (actual = l) > 0" if only_true else ""
    return f"""SELECT {BY_SQL}, l AS class_label, count(*) FILTER (actual = l AND predicted = l) AS tp,
         count(*) FILTER (actual = l) AS actual_total, count(*) FILTER (predicted = l) AS predicted_total
  FROM sc, (SELECT unnest({labels}) AS l) GROUP BY {BY_SQL}, l {having}"""


def _scores_sql(classes: str) -> str:
    """Macro scores: means of tp / called, tp / true and 2 tp / (called + true), 0 where undefined."""
    return f"""WITH k AS ({classes}),
  s AS (SELECT {BY_SQL}, CAST(tp AS DOUBLE) AS tp, actual_total AS t, predicted_total AS c FROM k),
  a AS (SELECT {BY_SQL}, avg(coalesce(tp / nullif(c, 0), 0)) AS precision_macro,
               avg(coalesce(tp / nullif(t, 0), 0)) AS recall_macro,
               avg(coalesce(2 * tp / nullif(c + t, 0), 0)) AS f1_macro_mean FROM s GROUP BY {BY_SQL})
  SELECT *, coalesce(2 / nullif(1 / nullif(precision_macro, 0) + 1 / nullif(recall_macro, 0), 0), 0) AS f1_of_macro FROM a"""


_TRUE_CLASSES = _classes_sql("['F', 'O', 'P']", True)
MACRO_SQL = f"ma AS ({_scores_sql(_TRUE_CLASSES)})"
ACC_SQL = f"""ac AS (
  SELECT {BY_SQL}, count(*) FILTER (WHERE predicted = actual) AS correct, count(*) AS total,
         count(*) FILTER (WHERE predicted = actual) / CAST(count(*) AS DOUBLE) AS accuracy
  FROM sc GROUP BY {BY_SQL})"""


@query(f"WITH {SC_SQL} SELECT {BY_SQL}, actual, predicted, count(*) AS cnt FROM sc GROUP BY ALL")
def confusion_matrix(spark, sf_dir):
    return tidy(metrics.confusion_matrix(scored(spark, sf_dir), BY))


@query(f"WITH {SC_SQL} {_TRUE_CLASSES}")
def per_class_counts(spark, sf_dir):
    return tidy(metrics.per_class_counts(metrics.confusion_matrix(scored(spark, sf_dir), BY), BY))


@query(f"WITH {SC_SQL}, {ACC_SQL} SELECT {BY_SQL}, correct, total, round(accuracy, 6) AS accuracy FROM ac")
def fold_accuracy(spark, sf_dir):
    return tidy(metrics.fold_accuracy(scored(spark, sf_dir), BY))


def _macro(spark, sf_dir, *columns, macro_over=None):
    matrix = metrics.confusion_matrix(scored(spark, sf_dir), BY)
    return tidy(metrics.macro_scores(matrix, BY, macro_over).select(*BY, *columns))


@query(f"""WITH {SC_SQL}, {MACRO_SQL}
SELECT {BY_SQL}, round(precision_macro, 6) AS precision_macro, round(recall_macro, 6) AS recall_macro FROM ma""")
def macro_pr(spark, sf_dir):
    return _macro(spark, sf_dir, "precision_macro", "recall_macro")


@query(f"""WITH {SC_SQL}, {MACRO_SQL}
SELECT {BY_SQL}, round(f1_of_macro, 6) AS f1_of_macro FROM ma""")
def f1_of_macro(spark, sf_dir):
    return _macro(spark, sf_dir, "f1_of_macro")


@query(f"""WITH {SC_SQL}, {MACRO_SQL}
SELECT {BY_SQL}, round(f1_macro_mean, 6) AS f1_macro_mean FROM ma""")
def f1_macro_mean(spark, sf_dir):
    return _macro(spark, sf_dir, "f1_macro_mean")


_FIXED_SQL = _scores_sql(_classes_sql("['F', 'O', 'P', 'X']", False))


@query(f"""WITH {SC_SQL}, m AS ({_FIXED_SQL})
SELECT {BY_SQL}, round(precision_macro, 6) AS precision_macro, round(recall_macro, 6) AS recall_macro,
       round(f1_macro_mean, 6) AS f1_macro_mean FROM m""")
def macro_fixed_labels(spark, sf_dir):
    return _macro(
        spark, sf_dir, "precision_macro", "recall_macro", "f1_macro_mean",
        macro_over=["F", "O", "P", "X"],
    )


@query(f"""WITH {SC_SQL},
a AS (
  SELECT run_id, algorithm, version_tag, fold_id,
         count(*) FILTER (WHERE predicted = actual) / CAST(count(*) AS DOUBLE) AS accuracy
  FROM sc GROUP BY ALL)
SELECT run_id, algorithm, version_tag, round(avg(accuracy), 6) AS cv_mean_accuracy FROM a
GROUP BY run_id, algorithm, version_tag""")
def cv_mean(spark, sf_dir):
    family = ["run_id", "algorithm", "version_tag"]
    per_fold = metrics.fold_accuracy(scored(spark, sf_dir), [*family, "fold_id"])
    return tidy(metrics.cv_mean(per_fold, family))


# --- ranking metrics ---------------------------------------------------------------------

AUC_SQL = f"""au_s AS (
  SELECT {BY_SQL}, pp AS score, count(*) FILTER (WHERE actual = 'P') AS p, count(*) FILTER (WHERE actual <> 'P') AS n
  FROM sc GROUP BY {BY_SQL}, pp),
au_c AS (
  SELECT *, coalesce(sum(n) OVER (PARTITION BY {BY_SQL} ORDER BY score
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM au_s),
au AS (
  SELECT {BY_SQL}, CAST(sum(p) AS BIGINT) AS positives, CAST(sum(n) AS BIGINT) AS negatives,
         CASE WHEN sum(p) > 0 AND sum(n) > 0
              THEN sum(p * (below + n / 2e0)) / (CAST(sum(p) AS DOUBLE) * CAST(sum(n) AS DOUBLE)) END AS roc_auc
  FROM au_c GROUP BY {BY_SQL})"""
LIFT_SQL = f"""li_r AS (
  SELECT {BY_SQL}, CASE WHEN actual = 'P' THEN 1 ELSE 0 END AS hit,
         ntile(10) OVER (PARTITION BY {BY_SQL} ORDER BY pp DESC, id) AS bucket
  FROM sc),
li_b AS (
  SELECT {BY_SQL}, bucket, count(*) AS n_rows, CAST(sum(hit) AS BIGINT) AS hits
  FROM li_r GROUP BY {BY_SQL}, bucket),
li_t AS (
  SELECT *, CAST(sum(n_rows) OVER g AS DOUBLE) AS all_rows, CAST(sum(hits) OVER g AS DOUBLE) AS all_hits,
         CAST(sum(n_rows) OVER r AS DOUBLE) AS cum_rows, CAST(sum(hits) OVER r AS DOUBLE) AS cum_hits
  FROM li_b
  WINDOW g AS (PARTITION BY {BY_SQL}),
         r AS (PARTITION BY {BY_SQL} ORDER BY bucket ROWS UNBOUNDED PRECEDING)),
li AS (
  SELECT {BY_SQL}, bucket, n_rows, hits,
         CASE WHEN all_hits > 0 AND all_hits < all_rows
              THEN (hits / CAST(n_rows AS DOUBLE)) / (all_hits / all_rows) END AS lift,
         CASE WHEN all_hits > 0 AND all_hits < all_rows
              THEN (cum_hits / cum_rows) / (all_hits / all_rows) END AS cumulative_lift
  FROM li_t)"""
TOP_SQL = f"""tl AS (SELECT {BY_SQL}, lift AS lift_value FROM li WHERE bucket = 1)"""
LL_SQL = f"""ll AS (
  SELECT {BY_SQL}, avg(-ln(greatest(least({P_TRUE_SQL}, 1e0 - 1e-15), 1e-15))) AS log_loss
  FROM sc GROUP BY {BY_SQL})"""


def _ranked(spark, sf_dir):
    return metrics.rank_scores(scored(spark, sf_dir), "P", BY)


@query(f"WITH {SC_SQL}, {AUC_SQL} SELECT {BY_SQL}, positives, negatives, round(roc_auc, 6) AS roc_auc FROM au")
def roc_auc(spark, sf_dir):
    return tidy(metrics.roc_auc(_ranked(spark, sf_dir), BY))


@query("""WITH d AS (SELECT lang, n_chars AS score, quality AS y FROM labels JOIN documents USING (doc_id)),
s AS (SELECT lang, score, count(*) FILTER (WHERE y = 1) AS p, count(*) FILTER (WHERE y <> 1) AS n
      FROM d GROUP BY lang, score),
c AS (SELECT *, coalesce(sum(n) OVER (PARTITION BY lang ORDER BY score
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM s)
SELECT lang, CAST(sum(p) AS BIGINT) AS positives, CAST(sum(n) AS BIGINT) AS negatives,
       round(CASE WHEN sum(p) > 0 AND sum(n) > 0
             THEN sum(p * (below + n / 2e0)) / (CAST(sum(p) AS DOUBLE) * CAST(sum(n) AS DOUBLE)) END, 6) AS roc_auc
FROM c GROUP BY lang""")
def roc_auc_documents(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    rows = table(spark, sf_dir, "labels").join(docs, "doc_id").select(
        "lang", "doc_id",
        F.col("quality").cast("string").alias("actual"),
        F.create_map(F.lit("1"), F.col("n_chars").cast("double")).alias("probs"),
    )
    return tidy(metrics.roc_auc(metrics.rank_scores(rows, "1", ["lang"], "doc_id"), ["lang"]))


@query(f"""WITH {SC_SQL}, {LIFT_SQL}
SELECT {BY_SQL}, bucket, n_rows, hits, round(lift, 6) AS lift, round(cumulative_lift, 6) AS cumulative_lift
FROM li""")
def lift_table(spark, sf_dir):
    return tidy(metrics.lift_table(_ranked(spark, sf_dir), BY))


@query(f"WITH {SC_SQL}, {LIFT_SQL}, {TOP_SQL} SELECT {BY_SQL}, round(lift_value, 6) AS lift_value FROM tl")
def lift_top_bucket(spark, sf_dir):
    return tidy(metrics.top_bucket_lift(metrics.lift_table(_ranked(spark, sf_dir), BY), BY))


@query(f"WITH {SC_SQL}, {LL_SQL} SELECT {BY_SQL}, round(log_loss, 6) AS log_loss FROM ll")
def log_loss(spark, sf_dir):
    return tidy(metrics.log_loss(scored(spark, sf_dir), BY))


# --- copies, and groups and keys that are NULL ----------------------------------------------


def _line_rows(spark, sf_dir):
    """Suppliers' feature vectors, many of them equal: rounded balance and nation."""
    rows = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.floor(F.col("s_acctbal") / 4000).cast("double").alias("f1"),
        (F.col("s_nationkey") % 3).cast("double").alias("f2"), F.lit(0.0).alias("f3"), F.lit(0.0).alias("f4"),
        (F.col("s_nationkey") % 2).cast("string").alias("label"),
    )
    return assign_folds(rows, K, seed=SEED)


_COPIES_SQL = """cp AS (
  SELECT s_suppkey AS id, CAST(floor(s_acctbal / 4000) AS DOUBLE) AS f1, CAST(s_nationkey % 3 AS DOUBLE) AS f2,
         0e0 AS f3, 0e0 AS f4, CAST(s_nationkey % 2 AS VARCHAR) AS label,
         ntile(5) OVER (ORDER BY md5('42:' || CAST(s_suppkey AS VARCHAR)), s_suppkey) AS fold_id
  FROM supplier)"""


@query(f"""WITH {_COPIES_SQL}, {_near_sql('cp')}, {_VOTES_SQL},
one AS (SELECT id, b.label AS predicted FROM near WHERE rank = 1)
SELECT 5 AS k, s.id, s.fold_id, b.predicted, round(b.confidence, 6) AS confidence FROM cp s LEFT JOIN best b USING (id)
UNION ALL SELECT 1, s.id, s.fold_id, o.predicted, 1e0 FROM cp s LEFT JOIN one o USING (id)""")
def knn_predict_copies(spark, sf_dir):
    rows = _line_rows(spark, sf_dir)
    parts = [knn.predict(rows, FEATURES, k).withColumn("k", F.lit(k)) for k in (5, 1)]
    return tidy(parts[0].unionByName(parts[1]).select("k", "id", "fold_id", "predicted", "confidence"))


@query(f"""WITH {SC_SQL},
n AS (SELECT CASE WHEN fold_id < 3 THEN CAST(fold_id AS VARCHAR) END AS fold_id, actual, predicted, pf, po, pp FROM sc)
SELECT fold_id, count(*) AS total_predictions,
       round(count(*) FILTER (actual = predicted) / CAST(count(*) AS DOUBLE), 6) AS accuracy,
       round(avg(-ln(greatest(least({P_TRUE_SQL}, 1e0 - 1e-15), 1e-15))), 6) AS log_loss
FROM n GROUP BY fold_id""")
def evaluate_null_group(spark, sf_dir):
    """All metrics where the grouping column is NULL for three folds out of five."""
    rows = scored(spark, sf_dir).withColumn("fold_id", F.when(F.col("fold_id") < 3, F.col("fold_id").cast("string")))
    return tidy(metrics.evaluate(rows, "P", ["fold_id"])).select("fold_id", "total_predictions", "accuracy", "log_loss")


@query(f"""WITH {CUSTOMERS_SQL}, p AS (SELECT * FROM cu WHERE id IN (SELECT n_nationkey + 1 FROM nation)),
near AS (
  SELECT id, unnest(best) AS b
  FROM (SELECT q.id, min({{'distance': sqrt({" + ".join(f"(q.{f} - t.{f}) * (q.{f} - t.{f})" for f in FEATURES)}), 'id': t.id, 'label': t.label}}, {NEIGHBOURS}) AS best
        FROM p q JOIN cu t ON q.fold_id <> t.fold_id GROUP BY q.id)),
votes AS (SELECT id, b.label AS label, count(*) AS v FROM near GROUP BY id, b.label)
SELECT id, label AS predicted, v / 5e0 AS confidence FROM votes QUALIFY row_number() OVER (PARTITION BY id ORDER BY v DESC, label) = 1""")
def knn_sql_function(spark, sf_dir):
    """The SQL table function called for a stated list of points, one per nation, over all customers."""
    customer_folds(spark, sf_dir).createOrReplaceTempView("knn_customers")
    points = table(spark, sf_dir, "nation").select((F.col("n_nationkey") + 1).cast("long").alias("id"))
    customer_folds(spark, sf_dir).join(points, "id").createOrReplaceTempView("knn_points")
    knn.sql_function(spark, "knn_customers", FEATURES)
    arguments = ", ".join(f"p.{f}" for f in FEATURES)
    return tidy(spark.sql(
        f"SELECT p.id, n.label AS predicted, n.confidence FROM knn_points p, LATERAL knn_predict({arguments}, {NEIGHBOURS}, CAST(p.fold_id AS BIGINT)) n"))
