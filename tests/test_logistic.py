import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from gaugework.operators import catalog, classifiers, folds, logistic, metrics, svm
from gaugework.plans.sweep import run_sweep

NAMES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def ready(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(360):
        x = rng.normal(0, 1, 3) * [1, 5, 0.2] + [0, 3, -1]
        y = int(np.argmax([x[0], x[1] / 4, rng.normal(0.5, 1)]))
        rows.append((i, i % 3, y, *map(float, x)))
    return spark.createDataFrame(rows, "row long, fold_id int, target int, a double, b double, c double").cache()


@pytest.mark.parametrize("penalty,standardised", [(0.1, True), (1 / 240, False), (0.01, True)])
def test_equals_spark_ml(ready, penalty, standardised):
    """Coefficients of every fold within 1e-3 of a fit of its own."""
    known = logistic.moments(ready, NAMES)
    designs = [logistic.regression(h, *known[h], penalty, standardised) for h in range(3)]
    found = logistic.fit(ready, NAMES, 3, designs)
    assembled = VectorAssembler(inputCols=NAMES, outputCol="features").transform(ready)
    for held, (d, w) in enumerate(zip(designs, found)):
        model = LogisticRegression(featuresCol="features", labelCol="target", family="multinomial", maxIter=300, tol=1e-12, regParam=penalty,
                                   standardization=standardised).fit(assembled.filter(F.col("fold_id") != held))
        raw = w[:, :-1] / d.score.scale
        constant = w[:, -1] - raw @ d.score.mean
        assert np.allclose(raw, model.coefficientMatrix.toArray(), atol=1e-3)
        want = model.interceptVector.toArray()
        assert np.allclose(constant - constant.mean(), want - want.mean(), atol=1e-3)


def test_many_models_take_no_more_passes(spark, ready):
    known, n = logistic.moments(ready, NAMES), {}
    for name, models in (("one", [(0, 0.1)]), ("many", [(h, p) for h in range(3) for p in (0.1, 0.03, 0.3, 0.05)])):
        spark.sparkContext.setJobGroup(f"logistic-{name}", name)
        logistic.fit(ready, NAMES, 3, [logistic.regression(h, *known[h], p, True) for h, p in models])
        n[name] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"logistic-{name}"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert n["many"] <= n["one"] + 8


def test_calibration_rows_have_margins_of_machines_that_left_them_out(spark):
    rng = np.random.default_rng(0)
    rows = [(i, f"c{i % 3}", *map(float, rng.normal(0, 1, 6))) for i in range(150)]
    names = [f"x{j}" for j in range(6)]
    df = folds.assign_folds(spark.createDataFrame(rows, ", ".join(["id long, label string", *[f"{n} double" for n in names]])), 3)
    ready = classifiers.prepare(df, names, ["c0", "c1", "c2"])
    kernels = svm.fold_kernels(ready, names, False, 1, pairs=True)
    assert sorted(kernels) == [(1,), (1, 2), (1, 3), (2,), (2, 3), (3,)]
    machines = svm.fit(ready, names, 3, 1.0, kernels)
    x, fold = rng.normal(0, 1, (9, 6)), np.array([2, 3] * 4 + [2])
    got = svm.Margins(1, kernels, machines).train(x, fold)
    for f in (2, 3):
        assert np.allclose(got[fold == f], kernels[1, f].inputs(x[fold == f]) @ machines[1, f].T)


def test_noise_is_calibrated_to_the_shares_of_the_classes(spark):
    """Labels that do not follow from the features: cross-fitted probabilities are no worse than the classes' shares, others are."""
    rng = np.random.default_rng(2)
    names = [f"x{j}" for j in range(30)]
    rows = [(i, f"c{rng.integers(0, 3)}", *map(float, rng.normal(0, 1, 30))) for i in range(300)]
    df = folds.assign_folds(spark.createDataFrame(rows, ", ".join(["id long, label string", *[f"{n} double" for n in names]])), 3)
    loss = {}
    for cross in (True, False):
        scored = run_sweep(df, names, catalog.parameter_sets(catalog.CATALOG[4:5]), "r", cross_fitted=cross)
        loss[cross] = metrics.evaluate(scored, "c0", ["run_id"]).first()["log_loss"]
    assert loss[True] < np.log(3) * 1.03 < loss[False]


def test_too_large_features_are_refused(spark):
    rows = [(i, "ab"[i % 2], 1e200 * (i % 7)) for i in range(40)]
    df = folds.assign_folds(spark.createDataFrame(rows, "id long, label string, a double"), 2)
    with pytest.raises(ValueError, match="too large"):
        run_sweep(df, ["a"], catalog.parameter_sets(catalog.CATALOG[4:5]), "r")
    with pytest.raises(ValueError, match="at most"):
        ready = classifiers.prepare(df.withColumn("a", F.col("a") / 1e200), ["a"], ["a", "b"])
        svm.fit(ready, ["a"], 2, 1.0, {(1,): svm.Kernel(np.zeros(1), np.ones(1), np.zeros((5000, 1)), np.zeros(5000))})


def test_saved_regression_scores_the_same(spark, ready, tmp_path):
    from pyspark.ml import PipelineModel

    df = ready.select(F.col("row").alias("id"), "fold_id", F.concat(F.lit("c"), F.col("target")).alias("label"), *NAMES)
    scored = run_sweep(df, NAMES, catalog.parameter_sets([catalog.LOGISTIC_100]), "r", model_folder=str(tmp_path))
    model = PipelineModel.load(f"{tmp_path}/r/MODEL_LOGISTIC_REGRESSION_F1_v2")
    prepared = classifiers.prepare(df.filter("fold_id = 1"), NAMES, ["c0", "c1", "c2"])
    again = {r["id"]: r for r in classifiers.score(model, prepared, ["c0", "c1", "c2"], NAMES).collect()}
    want = scored.filter("fold_id = 1").collect()
    assert len(want) == len(again) == 120
    for r in want:
        assert again[r["id"]]["predicted"] == r["predicted"] and again[r["id"]]["probs"] == pytest.approx(r["probs"])
