"""Fitted models. Predictions depend on the trainer, so these queries return what must hold for any."""

from pyspark.sql import Window, functions as F

from gaugework.operators import metrics
from gaugework.operators.catalog import (
    CATALOG, FOREST_200, LOGISTIC_50, LOGISTIC_100, LOGISTIC_200, parameter_sets,
)
from gaugework.operators.folds import assign_folds
from gaugework.plans.kfold import CV_METRIC, read_metrics, run_kfold
from gaugework.plans.sweep import run_sweep
from gaugework.queries.base import query, tidy
from gaugework.queries.inputs import CUSTOMERS_SQL, FEATURES, K, SEED, as_of, customer_folds, customer_rows, separable_rows
from gaugework.session import new_table_path

LEAST_ACCURACY = 0.85


def _audit(spark, sf_dir, catalog):
    """Per model and fold: rows, distinct ids, and rows that break a rule every scored table must keep."""
    folds = customer_folds(spark, sf_dir)
    scored = run_sweep(folds, FEATURES, parameter_sets(catalog), "run-1", "CUSTOMERS")
    labels = F.array(*[F.lit(x) for x in sorted(r[0] for r in folds.select("label").distinct().collect())])
    of_row = folds.select(F.col("id"), F.col("fold_id").alias("own_fold"), F.col("label").alias("own_label"))
    total = F.aggregate(F.map_values("probs"), F.lit(0.0), lambda s, v: s + v)
    most = F.array_max(F.map_values("probs"))
    return tidy(scored.join(of_row, "id").groupBy("model_name", "fold_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("id").alias("n_ids"),
        F.count_if(F.col("own_fold") != F.col("fold_id")).alias("in_other_fold"),
        F.count_if(~F.col("own_label").eqNullSafe(F.col("actual"))).alias("other_truth"),
        F.count_if(~F.coalesce(F.array_contains(labels, F.col("predicted")), F.lit(False))).alias("unknown_label"),
        F.count_if(~F.coalesce(F.abs(total - 1) < 1e-6, F.lit(False))).alias("no_distribution"),
        F.count_if(~F.coalesce(F.col("probs")[F.col("predicted")] >= most - 1e-9, F.lit(False))).alias("not_most_probable"),
    ))


def _audit_sql(catalog):
    names = ", ".join(f"('{a}', '{v}')" for a, v, _ in catalog)
    return f"""WITH {CUSTOMERS_SQL}
SELECT 'CUSTOMERS_' || a || '_F' || CAST(fold_id AS VARCHAR) || '_' || v AS model_name, fold_id, count(*) AS n_rows,
       count(DISTINCT id) AS n_ids, 0 AS in_other_fold, 0 AS other_truth, 0 AS unknown_label, 0 AS no_distribution,
       0 AS not_most_probable
FROM cu, (VALUES {names}) t(a, v) GROUP BY ALL"""


@query(_audit_sql(CATALOG[0:2]))
def model_decision_tree(spark, sf_dir):
    return _audit(spark, sf_dir, CATALOG[0:2])


@query(_audit_sql(CATALOG[2:4]))
def model_random_forest(spark, sf_dir):
    return _audit(spark, sf_dir, CATALOG[2:4])


@query(_audit_sql(CATALOG[4:5]))
def model_svm_linear(spark, sf_dir):
    return _audit(spark, sf_dir, CATALOG[4:5])


@query(_audit_sql(CATALOG[5:6]))
def model_svm_rbf(spark, sf_dir):
    return _audit(spark, sf_dir, CATALOG[5:6])


@query(_audit_sql([LOGISTIC_50]))
def model_logistic(spark, sf_dir):
    return _audit(spark, sf_dir, [LOGISTIC_50])


@query(_audit_sql([LOGISTIC_100, LOGISTIC_200]))
def model_logistic_long(spark, sf_dir):
    return _audit(spark, sf_dir, [LOGISTIC_100, LOGISTIC_200])


@query(_audit_sql([FOREST_200]))
def model_large_forest(spark, sf_dir):
    return _audit(spark, sf_dir, [FOREST_200])


@query(_audit_sql(CATALOG))
def sweep_scored(spark, sf_dir):
    return _audit(spark, sf_dir, CATALOG)


def _loss_of_shares(folds):
    """Log loss of predicting, for every row, the class shares of the other folds."""
    own = folds.groupBy("fold_id", "label").agg(F.count(F.lit(1)).alias("n"))
    of_fold, of_label = Window.partitionBy("fold_id"), Window.partitionBy("label")
    share = (F.sum("n").over(of_label) - F.col("n")) / (F.sum("n").over(Window.partitionBy()) - F.sum("n").over(of_fold))
    return own.withColumn("loss", -F.log(share) * F.col("n")).agg((F.sum("loss") / F.sum("n")).alias("loss")).first()["loss"]


@query("""SELECT v AS version_tag, (SELECT count(*) FROM customer) AS n_rows, true AS no_worse_than_shares, true AS no_worse_than_in_sample
FROM (SELECT unnest(['v1', 'v2']) AS v)""")
def svm_calibration(spark, sf_dir):
    """Held-out log loss of machines calibrated on margins of unseen rows, beside that of the class shares and of the calibration on training rows.

    Weights fitted to noise cost half their number over the rows, in expectation; twice that is allowed.
    """
    folds = customer_folds(spark, sf_dir).cache()
    classes = folds.select("label").distinct().count()
    allowed = classes * (classes + 1) / (folds.count() * (K - 1) / K)
    shares = _loss_of_shares(folds)
    found = {}
    for cross in (True, False):
        scored = run_sweep(folds, FEATURES, parameter_sets(CATALOG[4:6]), "run-1", cross_fitted=cross)
        found[cross] = metrics.evaluate(scored, "BUILDING", ["version_tag"]).select(
            "version_tag", F.col("total_predictions").alias("n_rows"), F.col("log_loss").alias(f"loss_{int(cross)}"))
    return tidy(found[True].join(found[False].drop("n_rows"), "version_tag").select(
        "version_tag", "n_rows", (F.col("loss_1") <= shares + allowed).alias("no_worse_than_shares"),
        (F.col("loss_1") <= F.col("loss_0") + allowed).alias("no_worse_than_in_sample")))


_LEARNERS = [CATALOG[0], CATALOG[2], CATALOG[4], CATALOG[5], LOGISTIC_200]


@query("SELECT algorithm, version_tag, count(*) AS n_rows, true AS learned FROM customer, (VALUES "
       + ", ".join(f"('{a}', '{v}')" for a, v, _ in _LEARNERS) + ") t(algorithm, version_tag) GROUP BY ALL")
def models_learn(spark, sf_dir):
    """Every algorithm finds a label that follows from one feature."""
    folds = assign_folds(separable_rows(spark, sf_dir), K, seed=SEED)
    scored = run_sweep(folds, FEATURES, parameter_sets(_LEARNERS), "run-1")
    accuracy = metrics.fold_accuracy(scored, ["algorithm", "version_tag"])
    return accuracy.select("algorithm", "version_tag", F.col("total").alias("n_rows"), (F.col("accuracy") >= LEAST_ACCURACY).alias("learned"))


_RUN_SETS = [CATALOG[0], LOGISTIC_100]


def _run(spark, sf_dir):
    folder = new_table_path(spark, "kfold-run")
    run = run_kfold(customer_rows(spark, sf_dir), FEATURES, parameter_sets(_RUN_SETS), K, "BUILDING", "run-1", as_of(),
                    prefix="CUSTOMERS", model_folder=f"{folder}/models-saved")
    run.append(folder)
    return folder


@query(f"""WITH {CUSTOMERS_SQL}
SELECT id, parameter_set_id, f1, f2, round(f3, 6) AS f3, f4, label AS actual_label, true AS probable,
       (SELECT count(DISTINCT c_mktsegment) FROM customer) AS n_probs
FROM cu, (VALUES (1), (8)) t(parameter_set_id)""")
def kfold_predictions(spark, sf_dir):
    """The prediction log of one run: every row once per set, with a probability for each class."""
    log = spark.read.parquet(f"{_run(spark, sf_dir)}/predictions")
    of_name = F.when(F.col("model_name").contains("DECISION_TREE"), 1).otherwise(8)
    return tidy(log.select(
        "id", of_name.alias("parameter_set_id"), *FEATURES, "actual_label",
        (F.col("predicted_prob") >= F.array_max(F.map_values("probs")) - 1e-9).alias("probable"),
        F.size("probs").alias("n_probs"),
    ))


@query("""WITH f AS (SELECT unnest([1, 2, 3, 4, 5]) AS fold_number),
m AS (SELECT unnest(['accuracy', 'precision_macro', 'recall_macro', 'f1_of_macro', 'roc_auc', 'lift_value', 'log_loss']) AS metric_name)
SELECT fold_number, metric_name, 2 AS n_models, true AS plausible FROM f, m
UNION ALL SELECT 0, 'cv_mean_accuracy', 2, true""")
def kfold_metric_log(spark, sf_dir):
    """The metric log of one run, read back: seven metrics per model and fold, and the mean as fold 0."""
    folder = _run(spark, sf_dir)
    log = read_metrics(spark, folder, "run-1")
    means = read_metrics(spark, folder, "run-1", "accuracy").groupBy("hyperparameters").agg(F.avg("metric_value").alias("mean"))
    value = F.col("metric_value")
    sound = F.when(F.col("metric_name") == CV_METRIC, F.abs(value - F.col("mean")) < 1e-9).when(
        F.col("metric_name").isin("lift_value", "log_loss"), value >= 0).otherwise(value.between(0, 1))
    return tidy(log.join(means, "hyperparameters").groupBy("fold_number", "metric_name").agg(
        F.countDistinct("model_name").alias("n_models"), F.every(F.coalesce(sound, F.lit(False))).alias("plausible")))


@query("""SELECT 'run-1' AS run_id, f AS fold_number, 'CUSTOMERS_' || a || '_F' || CAST(f AS VARCHAR) || '_' || v AS model_name,
       true AS saved, '5 folds' AS notes, '2024-03-02' AS next_run
FROM (SELECT unnest([1, 2, 3, 4, 5]) AS f), (VALUES ('DECISION_TREE', 'v1'), ('LOGISTIC_REGRESSION', 'v2')) t(a, v)""")
def kfold_registry(spark, sf_dir):
    """Run, model and retraining records of one run, joined; a model counts as saved if its files can be read."""
    folder = _run(spark, sf_dir)
    read = {n: spark.read.parquet(f"{folder}/{n}") for n in ("registry", "models", "lifecycle", "schedule")}
    saved = spark.read.text(f"{folder}/models-saved/*/*/metadata").select(
        F.regexp_extract("_metadata.file_path", "models-saved/[^/]+/([^/]+)/", 1).alias("model_name"), F.lit(True).alias("found")).distinct()
    due = read["schedule"].join(read["lifecycle"].select("model_id", "model_name"), "model_id").select(
        "model_name", F.to_date("next_run_on").cast("string").alias("next_run"))
    return tidy(read["models"].join(read["registry"].select("run_id", "notes"), "run_id").join(due, "model_name").join(
        saved, "model_name", "left").select(
        "run_id", "fold_number", "model_name", (F.coalesce("found", F.lit(False)) & F.col("artefact").endswith(F.col("model_name"))).alias("saved"),
        "notes", "next_run"))
