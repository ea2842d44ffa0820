from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from gaugework.plans import mlmetrics, records
from gaugework.schemas import METRICS_LOG, METRICS_WIDE, ML_METRICS, ML_METRICS_KEY, RUN_REGISTRY
from gaugework.sources import tables

NOW = datetime(2024, 5, 1, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def rows(spark):
    """Five metric rows, tags given as comma text."""
    return spark.createDataFrame([
        ("churn", "r1", "roc_auc", 0.9, "v45", "production", "accuracy,model-a", '{"fold": 1}'),
        ("reco", "r1", "hit_rate", 0.7, "v12", "staging", "rank-10", '{"top_k": 10}'),
        ("fraud", "r1", "precision", 0.8, "v9", "production", "financial", '{"threshold": 0.75}'),
        ("nlp", "r1", "f1_score", 0.6, "v3", "uat", "text, bert", '{"lang": "en"}'),
        ("vision", "r1", "top_1", 0.95, "v2", "lab", "vision,baseline", '{"dataset": "big"}'),
    ], "pipeline_id string, run_id string, metric_name string, metric_value double, "
       "model_version string, environment_label string, tags string, metadata_json string")


def test_defaults_and_tags(spark, rows):
    full = mlmetrics.with_defaults(rows, F.lit(NOW))
    assert full.columns == ML_METRICS.names
    got = {r["pipeline_id"]: r for r in full.collect()}
    assert all(r["metric_type"] == "scalar" and r["recorded_at"] is not None for r in got.values())
    assert got["nlp"]["tags"] == ["text", "bert"]
    assert mlmetrics.with_any_tag(full, ["bert", "rank-10"]).count() == 2
    assert mlmetrics.with_all_tags(full, ["vision", "baseline"]).count() == 1
    assert full.filter(mlmetrics.json_number("$.threshold") > 0.5).count() == 1


def test_ingest_enforces_the_key(spark, rows):
    full = mlmetrics.with_defaults(rows, F.lit(NOW))
    empty = spark.createDataFrame([], ML_METRICS)
    once = mlmetrics.ingest(empty, full.unionByName(full))
    assert once.count() == 5 and mlmetrics.violations(once).isEmpty()
    newer = full.withColumn("metric_value", F.lit(0.1)).limit(1)
    assert mlmetrics.ingest(once, newer).filter("metric_value = 0.1").count() == 1
    assert mlmetrics.ingest(once, full).count() == 5
    with pytest.raises(Exception, match="must not be NULL"):
        mlmetrics.ingest(empty, full.withColumn("run_id", F.lit(None).cast("string"))).collect()
    with pytest.raises(Exception, match="longer than 64"):
        mlmetrics.ingest(empty, full.withColumn("environment_label", F.repeat(F.lit("x"), 65))).collect()


def test_layout_prunes_years_and_pushes_time(spark, tmp_path):
    rows = spark.range(400).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 7)).alias("pipeline_id"),
        F.concat(F.lit("r"), F.col("id")).alias("run_id"), F.lit("m").alias("metric_name"),
        F.col("id").cast("double").alias("metric_value"),
        F.expr("timestamp '2022-06-01' + make_dt_interval(cast(id as int) * 2)").alias("recorded_at"),
    )
    path = str(tmp_path / "metrics")
    mlmetrics.write_layout(mlmetrics.with_defaults(rows), path)
    start, end = datetime(2023, 3, 1), datetime(2023, 4, 1)
    part = mlmetrics.read_range(spark, path, start, end)
    assert part.count() == rows.filter("recorded_at >= '2023-03-01' AND recorded_at < '2023-04-01'").count() > 0
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "GreaterThanOrEqual(recorded_at" in plan


def test_compare(spark):
    df = spark.createDataFrame(
        [("p", "r2", 0.9), ("p", "r1", 0.9), ("p", "r3", 0.1), ("p", "r4", None)],
        "pipeline_id string, run_id string, metric_value double",
    )
    row = mlmetrics.compare(df, ["pipeline_id"]).first()
    assert (row["n_values"], row["best_run"], row["worst_value"]) == (3, "r1", 0.1)


def test_csv_is_typed_and_fails_fast(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text("a|label\n1.5|x\n2.5|y\n")
    df = tables.load_csv(spark, str(path), "a double, label string", delimiter="|")
    assert [tuple(r) for r in df.collect()] == [(1.5, "x"), (2.5, "y")]
    path.write_text("a|label\nnot a number|x\n")
    with pytest.raises(Exception):
        tables.load_csv(spark, str(path), "a double, label string", delimiter="|").collect()


def test_replace_and_append(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.replace_table(spark.range(5), path)
    assert tables.replace_table(spark.range(3), path).count() == 3
    log = str(tmp_path / "log")
    for value in (1.0, 2.0):
        df = spark.createDataFrame([("spark", "r", value)], "platform string, run_id string, metric_value double")
        out = tables.append_log(df, log, METRICS_LOG, {"created_at": F.lit(NOW)})
    assert sorted(r["metric_value"] for r in out.collect()) == [1.0, 2.0]
    assert out.schema.names == METRICS_LOG.names and out.filter("created_at IS NULL").isEmpty()
    with pytest.raises(ValueError, match="not in the table"):
        tables.append_log(spark.range(1), log, METRICS_LOG)


def test_literal_rows(spark):
    df = tables.load_rows(spark, [("r", NOW, "knn", None)], RUN_REGISTRY)
    assert df.first()["model_family"] == "knn"


def test_records(spark):
    assert records.new_run_id(NOW).startswith("20240501000000-")
    assert records.new_run_id(NOW) != records.new_run_id(NOW)
    assert records.run_row(spark, "r", "knn", "note", NOW).first()["notes"] == "note"
    models = spark.createDataFrame(
        [(1, "M_F1", "SVM", 1, 5, "v1")],
        "model_id long, model_name string, algorithm string, fold_id int, parameter_set_id long, version_tag string",
    )
    lifecycle = records.model_lifecycle(models, F.lit(NOW))
    row = lifecycle.first()
    assert row["status"] == "ACTIVE" and (row["next_retrain_on"] - row["created_on"]).days == 30
    overview = records.retraining_overview(records.retraining_schedule(lifecycle), lifecycle)
    due = [records.retraining_due(overview, F.lit(datetime(2024, m, 31))).count() for m in (5, 7)]
    assert due == [1, 1]
    assert records.retraining_due(overview, F.lit(datetime(2024, 5, 30))).count() == 0
    records.register_views(retraining=overview)
    assert spark.sql("SELECT model_name FROM retraining").first()[0] == "M_F1"


def test_wide_log(spark):
    models = spark.createDataFrame(
        [(7, 5, 1, "SVM")], "model_id long, parameter_set_id long, fold_id int, algorithm string"
    )
    wide = spark.createDataFrame(
        [(7, 0.9, 0.8, 0.7, 0.6, None, 2.0)],
        "model_id long, accuracy double, precision_macro double, recall_macro double, "
        "f1_of_macro double, roc_auc double, lift_value double",
    )
    log = records.metrics_wide_log(wide, models, F.lit("a=1"), F.lit(NOW))
    assert log.columns == METRICS_WIDE.names
    row = log.first()
    assert (row["metric_id"], row["f1_macro"], row["roc_auc"], row["hyperparameters"]) == (7, 0.6, None, "a=1")


def test_key_columns_are_not_null():
    assert [f.name for f in ML_METRICS.fields if not f.nullable] == list(ML_METRICS_KEY)
