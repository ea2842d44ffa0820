import pytest
from pyspark.sql import functions as F

from gaugework.functions.exprs import normalise_label, prob_in_array, prob_of
from gaugework.operators import checks

RANGES = {"a": (0.0, 10.0), "b": (0.0, 10.0)}


def flowers(spark, rows):
    return spark.createDataFrame(rows, "a double, b double, label string")


def failed(report):
    return {r["check"] for r in report.filter("NOT passed").collect()}


def test_validation(spark):
    good = flowers(spark, [(1.0, 2.0, "x"), (3.0, 4.0, "y")])
    report = checks.validate(good, "label", 2, ["x", "y"], RANGES)
    assert failed(report) == set()
    checks.require_valid(report)
    bad = flowers(spark, [(10.5, 2.0, "x"), (3.0, 4.0, None), (1.0, 1.0, "x")])
    report = checks.validate(bad, "label", 2, ["x", "y"], RANGES)
    assert failed(report) == {
        "row_count", "distinct_labels", "label_present:y", "rows_out_of_range", "rows_with_null"
    }
    with pytest.raises(checks.ValidationError, match="row_count: expected 2, found 3"):
        checks.require_valid(report)
    assert checks.range_violations(bad, RANGES).count() == 1


def test_key_violations(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 1)], "k string, v int")
    got = {(r["k"], r["problem"]): r["cnt"] for r in checks.key_violations(df, ["k"]).collect()}
    assert got == {("a", "duplicate_key"): 2, (None, "null_key"): 1}


def test_orphans(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "fk long")
    parent = spark.createDataFrame([(2,)], "pk long")
    assert [tuple(r) for r in checks.orphans(child, "fk", parent, "pk").collect()] == [(1, 2)]


def test_upsert_updates_inserts_and_is_idempotent(spark):
    existing = spark.createDataFrame([("a", 1, 10), ("b", 2, 10)], "k string, v int, t int")
    updates = spark.createDataFrame([("b", 3, 11), ("b", 4, 12), ("c", 5, 11)], "k string, v int, t int")
    once = checks.upsert(existing, updates, ["k"], [F.col("t")])
    twice = checks.upsert(once, updates, ["k"], [F.col("t")])
    want = [("a", 1, 10), ("b", 4, 12), ("c", 5, 11)]
    assert sorted(tuple(r) for r in once.collect()) == want
    assert sorted(tuple(r) for r in twice.collect()) == want


def test_labels(spark):
    df = spark.createDataFrame([("Iris-setosa",), ("setosa",), ("other",), (None,)], "raw string")
    mapping = {"Iris-setosa": "setosa", "Iris-versicolor": "versicolor"}
    parity = df.select(normalise_label(F.col("raw"), mapping, else_label="virginica"))
    assert [r[0] for r in parity.collect()] == ["setosa", "virginica", "virginica", "virginica"]
    strict = df.limit(2).select(normalise_label(F.col("raw"), mapping))
    assert [r[0] for r in strict.collect()] == ["setosa", "setosa"]
    for bad in ("raw = 'other'", "raw IS NULL"):
        with pytest.raises(Exception, match="unknown label"):
            df.filter(bad).select(normalise_label(F.col("raw"), mapping)).collect()


def test_probability_lookup(spark):
    df = spark.sql("SELECT map('a', 0.25D) AS m, array(named_struct('label', 'a', 'prob', 0.25D)) AS p")
    row = df.select(
        prob_of(F.col("m"), F.lit("a")), prob_of(F.col("m"), F.lit("z")),
        prob_in_array(F.col("p"), F.lit("a")), prob_in_array(F.col("p"), F.lit("z")),
    ).first()
    assert list(row) == [0.25, None, 0.25, None]
