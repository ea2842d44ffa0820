"""Cross-validated runs: every fold with every parameter set, and k-NN over all folds."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, functions as F

from gaugework.operators import classifiers, knn, logistic, trees
from gaugework.operators.catalog import ParameterSet, model_name
from gaugework.operators.folds import check_folds, holdout
from gaugework.session import materialise


def run_sweep(
    folds: DataFrame,
    features: Sequence[str],
    sets: Sequence[ParameterSet],
    run_id: str,
    prefix: str = "MODEL",
    key: str = "id",
    label: str = "label",
    parallelism: int = 4,
    seed: int = 42,
    model_folder: str | None = None,
    cross_fitted: bool = True,
) -> DataFrame:
    """Fit every (fold, parameter set) on the other folds and score the held-out fold.

    Returns one scored table: (run_id, model_name, fold_id, parameter_set_id, algorithm,
    version_tag, key, features, actual, predicted, probs). The prepared table is cached once
    for all fits. Decision trees and forests of all folds and sets are grown together, logistic regressions are fitted
    together, and so are the support vector machines of one parameter set with their calibration (``cross_fitted``: on margins
    of machines that have not seen the row). Only regressions too wide for that are Spark ML jobs, ``parallelism`` at a time.
    Rows without a label
    or with a missing feature are not trained on and get no prediction. With
    ``model_folder`` each fitted pipeline is saved under ``<folder>/<run>/<model name>``.
    """
    spark = folds.sparkSession
    in_folds = folds.filter(F.col("fold_id").isNotNull())
    labels = classifiers.labels_of(in_folds, label)
    complete = classifiers.usable(features, label)
    ready = classifiers.prepare(in_folds.filter(complete), features, labels, key, label).persist()
    rows = {r["fold_id"]: r["count"] for r in ready.groupBy("fold_id").count().collect()}
    fold_ids = sorted(rows)
    check_folds(len(fold_ids))

    def chosen(*algorithms: str) -> list[tuple[ParameterSet, int]]:
        return [(p, fold) for p in sets if p.algorithm in algorithms for fold in fold_ids]

    together = logistic.fits(len(labels), len(features))
    wooden = chosen(*classifiers.TREES)
    machines = [[m for m in chosen("SVM") if m[0] == p] for p in sets if p.algorithm == "SVM"]
    regressions = chosen("LOGISTIC_REGRESSION") if together else []
    single = [] if together else chosen("LOGISTIC_REGRESSION")
    laid = classifiers.numbered(ready, features, key) if len(labels) and (wooden or machines or regressions) else None

    def name_of(p: ParameterSet, fold: int) -> str:
        return f"{prefix}_{p.algorithm}_F{fold}_{p.version_tag}"

    def scored(scores: DataFrame, models: list[tuple[ParameterSet, int]]) -> DataFrame:
        """Scores (row, forest: place of the model, probs) as lines of the scored table."""
        about = F.array(*[F.struct(
            F.lit(run_id).alias("run_id"), F.lit(name_of(p, f)).alias("model_name"), F.lit(p.parameter_set_id).cast("bigint").alias("parameter_set_id"),
            F.lit(p.algorithm).alias("algorithm"), F.lit(p.version_tag).alias("version_tag")) for p, f in models])
        names = F.array(*[F.lit(x) for x in labels])
        named = laid.join(scores.withColumnRenamed("probs", "shares"), "row").withColumn("about", about[F.col("forest").cast("int")])
        return named.select(
            "about.run_id", "about.model_name", "fold_id", "about.parameter_set_id", "about.algorithm", "about.version_tag",
            key, *features, F.col(label).alias("actual"),
            F.element_at(names, F.array_position("shares", F.array_max("shares")).cast("int")).alias("predicted"),
            F.map_from_arrays(names, "shares").alias("probs"))

    def grow() -> list[DataFrame]:
        if not wooden:
            return []
        fitted = classifiers.grow_trees(laid, features, len(labels), [(p.typed(), p.algorithm, f) for p, f in wooden], model_folder is not None)
        if model_folder:
            for i, (p, fold) in enumerate(wooden):
                trees.save(fitted, i, fold, f"{model_folder}/{run_id}/{name_of(p, fold)}", features, labels)
        return [scored(fitted.scores, wooden)]

    def separate(models: list[tuple[ParameterSet, int]]) -> list[DataFrame]:
        if not models:
            return []
        if models[0][0].algorithm == "SVM":
            fitted = classifiers.train_machines(laid, models[0][0].typed(), features, len(labels), [f for _, f in models], seed, cross_fitted)
        else:
            fitted = classifiers.train_regressions(laid, [(p.typed(), f) for p, f in models], features, len(labels))
        if model_folder:
            for i, m in enumerate(models):
                fitted.saved(i).write().overwrite().save(f"{model_folder}/{run_id}/{name_of(*m)}")
        return [scored(logistic.score(laid, features, fitted.designs, fitted.weights, len(labels)), models)]

    def fit_alone(job: tuple[ParameterSet, int]) -> DataFrame:
        p, fold = job
        train_rows, test_rows = holdout(ready, fold)
        model = classifiers.build(p.algorithm, p.typed(), sum(rows.values()) - rows[fold], seed).fit(train_rows)
        if model_folder:
            model.write().overwrite().save(f"{model_folder}/{run_id}/{name_of(p, fold)}")
        return classifiers.score(model, test_rows, labels, features, key, label).select(
            F.lit(run_id).alias("run_id"), F.lit(name_of(p, fold)).alias("model_name"), "fold_id",
            F.lit(p.parameter_set_id).cast("bigint").alias("parameter_set_id"),
            F.lit(p.algorithm).alias("algorithm"), F.lit(p.version_tag).alias("version_tag"),
            key, *features, "actual", "predicted", "probs",
        )

    # rows that cannot be scored get a line without a prediction for every set
    none = F.array(*[
        F.struct(F.lit(p.parameter_set_id).cast("bigint").alias("parameter_set_id"),
                 F.lit(p.algorithm).alias("algorithm"), F.lit(p.version_tag).alias("version_tag"))
        for p in sets
    ])
    unscored = in_folds.filter(~complete).select("*", F.inline(none)).select(
        F.lit(run_id).alias("run_id"), model_name(prefix).alias("model_name"), "fold_id",
        "parameter_set_id", "algorithm", "version_tag", key,
        *[F.col(c).cast("double").alias(c) for c in features], F.col(label).alias("actual"),
        F.lit(None).cast("string").alias("predicted"),
        F.lit(None).cast("map<string,double>").alias("probs"),
    )
    on_thread = inheritable_thread_target(spark)
    try:
        with ThreadPoolExecutor(parallelism) as pool:
            grown = pool.submit(on_thread(grow))
            joint = list(pool.map(on_thread(separate), [*machines, regressions]))
            parts = [part for group in [grown.result(), *joint] for part in group]
            parts += pool.map(on_thread(fit_alone), single)
        return materialise(reduce(DataFrame.unionByName, [*parts, unscored]))
    finally:
        ready.unpersist()


def run_knn(
    folds: DataFrame,
    features: Sequence[str],
    k_neighbors: int,
    run_id: str,
    prefix: str = "knn_model",
    key: str = "id",
    label: str = "label",
) -> DataFrame:
    """k-NN predictions of all folds in one plan, as a scored table without ``probs``.

    (run_id, model_name, fold_id, key, actual, predicted, confidence).
    """
    return knn.predict(folds, features, k_neighbors, key, label).select(
        F.lit(run_id).alias("run_id"),
        F.concat(F.lit(f"{prefix}_fold_"), F.col("fold_id").cast("string")).alias("model_name"),
        "fold_id", key, "actual", "predicted", "confidence",
    )
