"""Spark ML classifiers behind one interface: prepare, fit, score.

Every fit is a distributed Spark ML job. Training and scoring use an explicit feature list,
so the fold number and the id never become features.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from gaugework.operators import logistic, svm, trees
from gaugework.session import materialise

FEATURES = "features"
TARGET = "target"
#: Algorithms that are grown together for all folds and sets.
TREES = ("DECISION_TREE", "RANDOM_FOREST")


def labels_of(df: DataFrame, label: str = "label") -> list[str]:
    """The distinct labels in alphabetical order: part of the model, and as large as the model's classes."""
    found = df.select(label).filter(F.col(label).isNotNull()).distinct()
    return sorted(r[0] for r in found.collect())


def usable(features: Sequence[str], label: str = "label") -> Column:
    """True where a row can be trained on: every feature is a finite number and the label is known."""
    return trainable_features(features) & F.col(label).isNotNull()


def trainable_features(features: Sequence[str]) -> Column:
    finite = [F.coalesce(F.abs(F.col(c).cast("double")) < float("inf"), F.lit(False)) for c in features]
    return reduce(lambda a, b: a & b, finite)


def prepare(
    folds: DataFrame, features: Sequence[str], labels: Sequence[str],
    key: str = "id", label: str = "label",
) -> DataFrame:
    """Add the feature vector and the numeric target; rows in a fixed order per partition.

    Hashing on the key and sorting makes fits repeatable for a given partition count.
    """
    indexer = StringIndexerModel.from_labels(
        list(labels), inputCol=label, outputCol=TARGET, handleInvalid="error"
    )
    assembler = VectorAssembler(inputCols=list(features), outputCol=FEATURES, handleInvalid="error")
    ready = assembler.transform(indexer.transform(
        folds.select(key, "fold_id", label, *[F.col(c).cast("double").alias(c) for c in features])
    ))
    return ready.repartition(key).sortWithinPartitions(key)


def build(algorithm: str, settings: dict, rows: int, seed: int = 42) -> Pipeline:
    """The unfitted pipeline for typed ``settings`` (see ``catalog.typed_settings``) and ``rows`` training rows."""
    if algorithm == "DECISION_TREE":
        stages = [DecisionTreeClassifier(
            featuresCol=FEATURES, labelCol=TARGET, seed=seed,
            maxDepth=settings["max_depth"], impurity=settings["impurity"],
        )]
    elif algorithm == "RANDOM_FOREST":
        stages = [RandomForestClassifier(
            featuresCol=FEATURES, labelCol=TARGET, seed=seed,
            numTrees=settings["num_trees"], maxDepth=settings["max_depth"],
            subsamplingRate=settings.get("subsampling_rate", 1.0),
        )]
    elif algorithm == "LOGISTIC_REGRESSION":
        # Spark's penalty is regParam on the mean loss. The catalog's plain "0.1" is taken as it. With a
        # named solver the penalty is that library's default, C = 1 on the summed loss and unscaled
        # features. Spark minimises smooth penalties with L-BFGS, the only solver the catalog knows.
        named = settings.get("solver") == "lbfgs"
        stages = [LogisticRegression(
            featuresCol=FEATURES, labelCol=TARGET, family="multinomial", maxIter=settings["max_iter"],
            regParam=1.0 / max(rows, 1) if named else settings.get("l2_reg", 0.0),
            standardization=not named, elasticNetParam=0.0,
        )]
    else:
        raise ValueError(f"unknown algorithm {algorithm}")
    return Pipeline(stages=stages)


def numbered(ready: DataFrame, features: Sequence[str], key: str = "id") -> DataFrame:
    """``ready`` written once with a row number, the hash of its key and the features as an array, for joint fits."""
    return materialise(ready.drop(FEATURES).withColumns({
        "row": F.monotonically_increasing_id(), "hash": F.xxhash64(key), "x": F.array(*[F.col(c).cast("double") for c in features])}))


def grow_trees(
    laid: DataFrame, features: Sequence[str], classes: int, models: Sequence[tuple[dict, str, int]], keep_nodes: bool = False,
) -> trees.Fitted:
    """All trees and forests of ``models`` (typed settings, algorithm, held-out fold) on ``numbered`` rows, in joint passes."""
    def forest(settings: dict, algorithm: str, held: int) -> trees.Forest:
        if algorithm == "DECISION_TREE":
            return trees.Forest(held, settings["impurity"], settings["max_depth"])
        return trees.Forest(held, "gini", settings["max_depth"], settings["num_trees"], settings.get("subsampling_rate", 1.0))

    return trees.fit(laid, [forest(*m) for m in models], len(features), classes, keep_nodes)


@dataclass
class Linear:
    """Logistic models fitted together; ``saved`` makes the transformers of one."""

    designs: list[logistic.Design]
    weights: list[np.ndarray]
    saved: Callable[[int], PipelineModel]


def train_machines(
    ready: DataFrame, settings: dict, features: Sequence[str], classes: int, fold_ids: Sequence[int], seed: int = 42,
    cross_fitted: bool = True,
) -> Linear:
    """Support vector machines for all held-out folds with their calibration.

    All machines are trained together, and so are the calibrations: a multi-class form of Platt (1999), on margins of machines
    that have not seen the row (``cross_fitted``), or on those of the training rows themselves.
    """
    kernels = svm.fold_kernels(ready, features, settings["kernel"] == "gaussian", seed,
                               settings.get("fourier_features", svm.FOURIER_FEATURES), pairs=cross_fitted)
    machines = svm.fit(ready, features, classes, settings["complexity"], kernels)
    margins = [svm.Margins(f, kernels, machines) for f in fold_ids]
    designs = [m.design() for m in margins]
    weights = logistic.fit(ready, features, classes, designs)

    def saved(i: int) -> PipelineModel:
        own = (margins[i].held,)
        return logistic.pipeline(svm.margin_stages(features, kernels[own], machines[own]), "machine_margins", weights[i])

    return Linear(designs, weights, saved)


def train_regressions(
    ready: DataFrame, models: Sequence[tuple[dict, int]], features: Sequence[str], classes: int,
) -> Linear:
    """Logistic regressions of all (typed settings, held-out fold), together.

    The catalog's plain "0.1" is the ridge on the mean loss and standardised features. A set that names the ``lbfgs`` solver gets
    that library's default: C = 1 on the summed loss, and raw features. Newton steps reach the same optimum as any solver.
    """
    known = logistic.moments(ready, features)
    designs = []
    for settings, held in models:
        rows, mean, var = known[held]
        named = settings.get("solver") == "lbfgs"
        penalty = 1.0 / max(rows, 1) if named else settings.get("l2_reg", 0.0)
        designs.append(logistic.regression(held, rows, mean, var, penalty, not named))
    weights = logistic.fit(ready, features, classes, designs)
    return Linear(designs, weights, lambda i: logistic.pipeline(
        [logistic.standardising(features, designs[i].score)], "regression_x", weights[i]))


def score(
    model: PipelineModel, test: DataFrame, labels: Sequence[str], features: Sequence[str],
    key: str = "id", label: str = "label",
) -> DataFrame:
    """(key, fold_id, features, actual, predicted, probs) for prepared rows.

    ``probs`` maps every label to its probability; the prediction is the most probable label.
    """
    names = F.array(*[F.lit(x) for x in labels])
    return model.transform(test).select(
        key, "fold_id", *features,
        F.col(label).alias("actual"),
        F.element_at(names, F.col("prediction").cast("int") + 1).alias("predicted"),
        F.map_from_arrays(names, vector_to_array("probability")).alias("probs"),
    )
