import math

import pytest
from pyspark.sql import functions as F

from gaugework.operators import metrics
from gaugework.operators.reshape import to_long, to_wide

G = ["g"]


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


@pytest.fixture(scope="module")
def matrix(spark):
    return spark.createDataFrame(
        [("m", "A", "A", 3), ("m", "A", "B", 1), ("m", "B", "B", 2), ("m", "C", "A", 1)],
        "g string, actual string, predicted string, cnt long",
    )


def test_macro_over_actual_classes(matrix):
    row = one(metrics.macro_scores(matrix, G))
    assert row["precision_macro"] == pytest.approx(0.472222, abs=1e-6)
    assert row["recall_macro"] == pytest.approx(0.583333, abs=1e-6)
    assert row["f1_of_macro"] == pytest.approx(0.521930, abs=1e-6)
    assert row["f1_macro_mean"] == pytest.approx(0.516667, abs=1e-6)


def test_macro_over_fixed_labels(matrix):
    row = one(metrics.macro_scores(matrix, G, macro_over=["A", "B", "C", "D"]))
    assert row["precision_macro"] == pytest.approx(3 * 0.4722222 / 4, abs=1e-6)
    assert row["recall_macro"] == pytest.approx(3 * 0.5833333 / 4, abs=1e-6)


def test_accuracy_is_trace_over_total_and_null_when_empty(spark, matrix):
    scored = matrix.select("g", "actual", "predicted", F.explode(F.sequence(F.lit(1), F.col("cnt").cast("int"))))
    assert one(metrics.fold_accuracy(scored, G))["accuracy"] == pytest.approx(5 / 7)
    assert one(metrics.fold_accuracy(scored.filter("false"), []))["accuracy"] is None
    counts = {(r["actual"], r["predicted"]): r["cnt"] for r in metrics.confusion_matrix(scored, G).collect()}
    assert counts == {("A", "A"): 3, ("A", "B"): 1, ("B", "B"): 2, ("C", "A"): 1}


def scored_rows(spark, pairs):
    return spark.createDataFrame(
        [("m", i, "P" if hit else "N", {"P": float(p)}) for i, (p, hit) in enumerate(pairs)],
        "g string, id long, actual string, probs map<string,double>",
    )


def auc(spark, pairs):
    return one(metrics.roc_auc(metrics.rank_scores(scored_rows(spark, pairs), "P", G), G))["roc_auc"]


def test_auc(spark):
    pairs = [(0.9, True), (0.8, True), (0.8, False), (0.1, False)]
    assert auc(spark, pairs) == pytest.approx(0.875)
    assert auc(spark, [(1 - p, h) for p, h in pairs]) == pytest.approx(0.125)
    assert auc(spark, [(0.9, True), (0.2, True)]) is None


def test_lift(spark):
    pairs = [(1 - i / 10, i in (0, 7)) for i in range(10)]
    lifts = metrics.lift_table(metrics.rank_scores(scored_rows(spark, pairs), "P", G), G)
    assert one(metrics.top_bucket_lift(lifts, G))["lift_value"] == pytest.approx(5.0)
    by_bucket = {r["bucket"]: r for r in lifts.collect()}
    assert by_bucket[10]["cumulative_lift"] == pytest.approx(1.0)
    only = metrics.lift_table(metrics.rank_scores(scored_rows(spark, [(0.5, True)] * 3), "P", G), G)
    assert all(r["lift"] is None for r in only.collect())


def test_log_loss(spark):
    df = spark.createDataFrame(
        [("m", "A", {"A": 0.5, "B": 0.5}), ("m", "B", {"A": 0.75, "B": 0.25})],
        "g string, actual string, probs map<string,double>",
    )
    assert one(metrics.log_loss(df, G))["log_loss"] == pytest.approx(1.039721, abs=1e-6)
    unknown = df.withColumn("actual", F.lit("Z"))
    assert one(metrics.log_loss(unknown, G))["log_loss"] == pytest.approx(-math.log(1e-15))


def test_cv_mean_ignores_summary_rows(spark):
    df = spark.createDataFrame([("r", 1, 0.5), ("r", 2, 1.0), ("r", 0, 0.0)], "run_id string, fold_id int, accuracy double")
    assert one(metrics.cv_mean(df, ["run_id"]))["cv_mean_accuracy"] == 0.75


def test_join_on_id_does_not_fan_out_on_equal_features(spark):
    scores = spark.createDataFrame([(1, 5.0, "a"), (2, 5.0, "a")], "id long, f double, predicted string")
    truth = spark.createDataFrame([(1, 5.0, "a"), (2, 5.0, "b")], "id long, f double, actual string")
    assert scores.join(truth, "f").count() == 4
    assert metrics.join_truth(scores, truth.drop("f")).count() == 2


def test_long_wide_round_trip_and_evaluate(spark):
    scored = spark.createDataFrame(
        [("m", i, "A" if i % 3 else "B", "A" if i % 4 else "B", {"A": i / 40, "B": 1 - i / 40}) for i in range(40)],
        "g string, id long, actual string, predicted string, probs map<string,double>",
    )
    names = ["accuracy", "precision_macro", "recall_macro", "f1_of_macro", "roc_auc", "lift_value", "log_loss"]
    wide = metrics.evaluate(scored, "A", G).select("g", *names)
    again = to_wide(to_long(wide, G, names), G, names)
    assert one(wide) == one(again)
    assert None not in one(wide)


def test_group_with_a_null_key_is_a_group(spark):
    rows = [(None, "m", 1, i, "ab"[i % 2], "ab"[i % 2 if i < 8 else 0], {"a": 0.4 + 0.2 * (i % 2 == 0), "b": 0.6 - 0.2 * (i % 2 == 0)}) for i in range(10)]
    df = spark.createDataFrame(rows, "run_id string, model_name string, fold_id int, id long, actual string, predicted string, probs map<string,double>")
    named = df.withColumn("run_id", F.lit("r"))
    got, want = (metrics.evaluate(x, "a").drop("run_id").collect() for x in (df, named))
    assert len(got) == 1 and got == want and 0 < got[0]["f1_macro_mean"] <= 1
