"""One k-fold run from validated rows to all its records."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gaugework.operators import metrics
from gaugework.operators.catalog import ParameterSet
from gaugework.operators.folds import assign_folds, check_folds
from gaugework.plans import records
from gaugework.plans.sweep import run_sweep

METRICS = ("accuracy", "precision_macro", "recall_macro", "f1_of_macro", "roc_auc", "lift_value", "log_loss")
CV_METRIC = "cv_mean_accuracy"


@dataclass(frozen=True)
class KFoldRun:
    """The records of a run; each is a table that :meth:`append` adds to a log folder."""

    registry: DataFrame
    predictions: DataFrame
    metrics: DataFrame
    models: DataFrame
    lifecycle: DataFrame
    schedule: DataFrame

    def append(self, folder: str) -> None:
        """Add the records to the logs below ``folder``, the registry last: a run listed there is complete."""
        for name in [f.name for f in fields(self) if f.name != "registry"] + ["registry"]:
            getattr(self, name).write.mode("append").parquet(f"{folder}/{name}")


def run_kfold(
    rows: DataFrame, features: Sequence[str], sets: Sequence[ParameterSet], k: int, positive: str, run_id: str, at: Column,
    family: str = "sweep", platform: str = "spark", prefix: str = "MODEL", key: str = "id", label: str = "label",
    seed: int = 42, model_folder: str | None = None,
) -> KFoldRun:
    """Split, train and score every set on every fold, evaluate, and make all records of the run.

    Metrics come per model and fold, plus the mean accuracy of each parameter set as fold 0. With
    ``model_folder`` the fitted pipelines are saved and the model records hold their paths.
    """
    check_folds(k)
    spark = rows.sparkSession
    folds = assign_folds(rows, k, key, seed, stratify=[label])
    scored = run_sweep(folds, features, sets, run_id, prefix, key, label, seed=seed, model_folder=model_folder)
    text = F.create_map(*[x for p in sets for x in (F.lit(p.parameter_set_id).cast("bigint"), F.lit(p.text()))])
    models = scored.select("run_id", "model_name", "algorithm", "fold_id", "parameter_set_id", "version_tag").distinct()
    number = F.col("fold_id").cast("bigint") * 1000 + F.col("parameter_set_id")
    lifecycle = records.model_lifecycle(models.withColumn("model_id", number), at)
    wide = metrics.evaluate(scored, positive, metrics.BY, key=key).join(
        models.select("model_name", "parameter_set_id"), "model_name").withColumn("hyperparameters", text[F.col("parameter_set_id")])
    log = records.metrics_log(wide, METRICS, platform, F.col("hyperparameters"), at)
    means = wide.groupBy("run_id", "parameter_set_id", "hyperparameters").agg(F.avg("accuracy").alias(CV_METRIC)).select(
        "run_id", F.concat(F.lit(f"{prefix}_CV_"), F.col("parameter_set_id").cast("string")).alias("model_name"),
        F.lit(0).alias("fold_id"), "hyperparameters", CV_METRIC)
    log = log.unionByName(records.metrics_log(means, [CV_METRIC], platform, F.col("hyperparameters"), at))
    path = F.concat_ws("/", F.lit(model_folder), "run_id", "model_name") if model_folder else F.lit(None).cast("string")
    return KFoldRun(
        registry=spark.range(1).select(
            F.lit(run_id).alias("run_id"), at.alias("created_at"), F.lit(family).alias("model_family"), F.lit(f"{k} folds").alias("notes")),
        predictions=records.prediction_log(scored, at, key, features),
        metrics=log,
        models=models.select(
            "run_id", F.col("fold_id").cast("int").alias("fold_number"), "model_name", path.alias("artefact"),
            text[F.col("parameter_set_id")].alias("hyperparameters"), at.alias("created_at")),
        lifecycle=lifecycle,
        schedule=records.retraining_schedule(lifecycle),
    )


def read_metrics(
    spark: SparkSession, folder: str, run_id: str, metric: str | None = None, fold: int | None = None,
) -> DataFrame:
    """The metric log of one run, of one metric or fold if given; the conditions reach the scan."""
    log = spark.read.parquet(f"{folder}/metrics").filter(F.col("run_id") == run_id)
    if metric is not None:
        log = log.filter(F.col("metric_name") == metric)
    return log if fold is None else log.filter(F.col("fold_number") == fold)


