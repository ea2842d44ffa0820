import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from gaugework.operators import catalog, folds, metrics
from gaugework.plans.sweep import run_knn, run_sweep

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def split(spark):
    """Three classes: one apart, two that overlap a little."""
    rng = np.random.default_rng(7)
    centres = {"x": (0, 0, 0, 0), "y": (4, 4, 0, 0), "z": (5.5, 4, 2, 0)}
    rows = [
        (i * 3 + j, *[float(v) for v in rng.normal(c, 0.8)], name)
        for i in range(40) for j, (name, c) in enumerate(centres.items())
    ]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, label string")
    return folds.assign_folds(df, 3, stratify=["label"])


@pytest.fixture(scope="module")
def scored(split, tmp_path_factory):
    sets = catalog.parameter_sets([*catalog.CATALOG, catalog.LOGISTIC_100])
    folder = str(tmp_path_factory.mktemp("models"))
    return run_sweep(split, FEATURES, sets, "r", model_folder=folder), folder


def test_sweep_scores_every_row_once_per_set(scored, split):
    df = scored[0]
    assert df.count() == 7 * 120
    per_row = df.groupBy("parameter_set_id", "id").count()
    assert per_row.filter("count <> 1").isEmpty()
    assert df.join(split.select("id", F.col("fold_id").alias("f")), "id").filter("f <> fold_id").isEmpty()
    total = F.aggregate(F.map_values("probs"), F.lit(0.0), lambda s, v: s + v)
    assert df.filter((F.abs(total - 1) > 1e-9) | (F.size("probs") != 3)).isEmpty()


def test_models_learn(scored):
    accuracy = metrics.fold_accuracy(scored[0], ["algorithm", "version_tag"]).collect()
    assert len(accuracy) == 7
    for row in accuracy:
        assert row["accuracy"] > 0.85, row


def test_saved_model_scores_the_same(scored, split):
    from gaugework.operators import classifiers

    df, folder = scored
    name = "MODEL_SVM_F1_v2"
    model = PipelineModel.load(f"{folder}/r/{name}")
    ready = classifiers.prepare(split, FEATURES, ["x", "y", "z"])
    again = classifiers.score(model, ready.filter("fold_id = 1"), ["x", "y", "z"], FEATURES)
    both = again.select("id", F.col("predicted").alias("p2")).join(df.filter(F.col("model_name") == name), "id")
    assert both.count() == 42 and both.filter("p2 <> predicted").isEmpty()


def test_same_seed_same_predictions(split):
    sets = catalog.parameter_sets(catalog.CATALOG[2:3])
    runs = [
        sorted((r["id"], r["predicted"]) for r in run_sweep(split, FEATURES, sets, "r").collect())
        for _ in range(2)
    ]
    assert runs[0] == runs[1]


def test_knn_run_learns(split):
    rows = metrics.cross_validation_rows(run_knn(split, FEATURES, 5, "r"), "knn_model").collect()
    value = {(r["model_name"], r["metric_name"]): r["metric_value"] for r in rows}
    assert value["knn_model_cv", "cv_mean_accuracy"] > 0.9
    assert value["knn_model_fold_1", "total_predictions"] == 42  # 14 of each class
    assert len(rows) == 7


def test_settings_are_typed_and_checked():
    p = catalog.parameter_sets()[1]
    assert p.typed() == {"algo_name": "DECISION_TREE", "max_depth": 12, "impurity": "entropy"}
    assert catalog.typed_settings(dict(catalog.FOREST_200[2]))["subsampling_rate"] == 1.0
    for bad in ({"NO_SUCH": "1"}, {"TREE_IMPURITY_METRIC": "other"}, {"RF_NUM_TREES": "many"}):
        with pytest.raises(ValueError):
            catalog.typed_settings(bad)


def test_grid_and_specs(spark):
    grid = catalog.parameter_grid(catalog.sets_frame(spark))
    assert grid.count() == 18
    text = {r[0]: r[1] for r in catalog.grid_text(grid).collect()}
    assert text[1] == "ALGO_NAME=ALGO_DECISION_TREE; TREE_IMPURITY_METRIC=TREE_IMPURITY_GINI; TREE_TERM_MAX_DEPTH=6"
    assert text == {p.parameter_set_id: p.text() for p in catalog.parameter_sets()}
    specs = catalog.model_specs(spark.createDataFrame([(1,), (2,)], "fold_id int")).orderBy("spec_no").collect()
    assert [r["spec_no"] for r in specs] == list(range(1, 13))
    assert specs[11]["model_name"] == "MODEL_SVM_F2_v2"


def test_ids_do_not_depend_on_the_part_of_the_catalog():
    assert [p.parameter_set_id for p in catalog.parameter_sets(catalog.CATALOG[2:3])] == [3]
    assert [p.parameter_set_id for p in catalog.parameter_sets([catalog.LOGISTIC_100, ("OWN", "v1", ())])] == [8, 11]


def test_specs_number_folds_with_gaps(spark):
    specs = catalog.model_specs(spark.createDataFrame([(1,), (4,)], "fold_id int")).collect()
    assert sorted(r["spec_no"] for r in specs) == list(range(1, 13))


def test_incomplete_rows_and_many_labels(spark):
    from gaugework.operators import classifiers

    many = spark.createDataFrame([(f"l{i}",) for i in range(1001)], "label string")
    assert len(classifiers.labels_of(many)) == 1001
    rows = [(i, float(i % 2), "ab"[i % 2]) for i in range(40)] + [(100, None, "a"), (101, 0.0, None), (102, float("nan"), "b")]
    df = folds.assign_folds(spark.createDataFrame(rows, "id long, a double, label string"), 2)
    got = {r["id"]: r["predicted"] for r in run_sweep(df, ["a"], catalog.parameter_sets(catalog.CATALOG[:1]), "r").collect()}
    assert len(got) == 43 and [got[i] for i in (100, 101, 102)] == [None] * 3 and got[1] == "b"


def test_wide_svm_without_driver_sums(spark, monkeypatch):
    """Many inputs and classes, machines in several turns: every one converges and separates its class."""
    from gaugework.operators import classifiers, svm

    monkeypatch.setattr(svm, "PARTIAL_SIZE", 100_000)
    rng = np.random.default_rng(0)
    centres = rng.normal(0, 3, (6, 40))
    names = [f"x{i}" for i in range(40)]
    rows = [(i, *map(float, centres[i % 6] + rng.normal(0, 0.5, 40)), f"c{i % 6}") for i in range(120)]
    df = folds.assign_folds(spark.createDataFrame(rows, ", ".join(["id long", *[f"{n} double" for n in names], "label string"])), 2)
    ready = classifiers.prepare(df, names, [f"c{i}" for i in range(6)])
    weights = svm.fit(ready, names, 6, 1.0, svm.fold_kernels(ready, names, False, 1))
    assert {f: w.shape for f, w in weights.items()} == {(1,): (6, 41), (2,): (6, 41)}
    scored = run_sweep(df, names, catalog.parameter_sets(catalog.CATALOG[4:5]), "r")
    assert metrics.fold_accuracy(scored, ["run_id"]).first()["accuracy"] > 0.95


def test_machines_without_two_folds_start_close(spark, split, monkeypatch):
    """They start from those without one fold, so a few passes end them; the weights are those of a start at zero."""
    from gaugework.operators import classifiers, svm

    laid = classifiers.numbered(classifiers.prepare(split, FEATURES, ["x", "y", "z"]), FEATURES)
    kernels = svm.fold_kernels(laid, FEATURES, True, 1, 16, pairs=True)
    passes, one = [], svm._pass

    def counted(ready, features, machines, *rest):
        passes.append([len(f) for f, _ in machines])
        return one(ready, features, machines, *rest)

    monkeypatch.setattr(svm, "_pass", counted)
    warm = svm.fit(laid, FEATURES, 3, 1.0, kernels)
    pairs = sum(f == 2 for some in passes for f in some)
    passes.clear()
    cold = svm.fit(laid, FEATURES, 3, 1.0, {(*f, 99): k for f, k in kernels.items() if len(f) == 1})
    assert pairs < sum(map(len, passes))  # as many machines
    for f in (f for f in kernels if len(f) == 1):
        assert np.allclose(warm[f], cold[*f, 99], rtol=0.05, atol=0.05)
