import math

import pytest

from gaugework.operators import knn

FEATURES = ["a", "b"]
SCHEMA = "id long, fold_id int, label string, a double, b double"


def brute(rows, k):
    answer = {}
    for i, fold, _, a, b in rows:
        near = sorted(
            (math.sqrt((a - y[3]) ** 2 + (b - y[4]) ** 2), y[0], y[2]) for y in rows if y[1] != fold
        )[:k]
        answer[i] = [n[1] for n in near]
    return answer


def found(df):
    answer = {}
    for r in sorted(df.collect(), key=lambda r: (r["id"], r["rank"])):
        answer.setdefault(r["id"], []).append(r["neighbour_id"])
    return answer


def spread_rows(n):
    return [(i, i % 5 + 1, "xyz"[i % 3], float(i * 7919 % 1009), float(i * 104729 % 997)) for i in range(n)]


def copied_rows(n):
    """A third of the rows are copies of one vector, most others lie on a line, one is far away."""
    rows = []
    for i in range(n):
        a, b = (1.0, 1.0) if i % 3 == 0 else (float(i % 40), 0.0)
        rows.append((i, i % 4 + 1, "xy"[i % 2], a, b))
    rows.append((n, 1, "x", 1e6, -1e6))
    return rows


@pytest.mark.parametrize("rows,cell_rows,fanout", [
    (spread_rows(400), 16, 8),
    (copied_rows(400), 16, 4),
    (spread_rows(60), 256, 32),
], ids=["spread", "copies", "one-cell"])
def test_equals_brute_force(spark, rows, cell_rows, fanout):
    df = spark.createDataFrame(rows, SCHEMA)
    got = knn.neighbours(df, FEATURES, 4, cell_rows=cell_rows, fanout=fanout, hot_rows=20)
    assert found(got) == brute(rows, 4)


def test_does_not_depend_on_partitions(spark):
    rows = copied_rows(200)
    results = []
    for partitions in ("2", "9"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        got = knn.predict(spark.createDataFrame(rows, SCHEMA), FEATURES, 3, cell_rows=16)
        results.append(sorted(tuple(r) for r in got.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] and len(results[0]) == len(rows)


def test_confidence_divides_by_k(spark):
    rows = [(1, 1, "a", 0.0, 0.0), (2, 2, "b", 1.0, 0.0), (3, 2, "b", 2.0, 0.0), (4, 2, "b", 3.0, 0.0)]
    got = {r["id"]: r for r in knn.predict(spark.createDataFrame(rows, SCHEMA), FEATURES, 5).collect()}
    assert (got[1]["predicted"], got[1]["confidence"]) == ("b", 0.6)
    assert (got[2]["predicted"], got[2]["confidence"]) == ("a", 0.2)


def test_vote_ties_go_to_the_smaller_label(spark):
    rows = [(1, 1, "z", 0.0, 0.0), (2, 2, "b", 1.0, 0.0), (3, 2, "a", 1.0, 0.0)]
    got = {r["id"]: r["predicted"] for r in knn.predict(spark.createDataFrame(rows, SCHEMA), FEATURES, 2).collect()}
    assert got[1] == "a"


def test_rows_without_features_or_neighbours(spark):
    rows = [(1, 1, "a", 0.0, 0.0), (2, 1, "a", float("nan"), 0.0), (3, 1, "a", None, 0.0), (4, None, "a", 0.0, 0.0)]
    got = {r["id"]: r["predicted"] for r in knn.predict(spark.createDataFrame(rows, SCHEMA), FEATURES, 2).collect()}
    assert got == {1: None, 2: None, 3: None}


def test_candidate_search_has_no_product_and_no_python(spark):
    df = spark.createDataFrame(spread_rows(100), SCHEMA)
    plan = knn.neighbours(df, FEATURES, 3, cell_rows=16)._jdf.queryExecution().executedPlan().toString()
    for name in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ArrowEval"):
        assert name not in plan


@pytest.mark.parametrize("k", [1, 2, 5])
def test_copies_are_all_answered(spark, k):
    rows = [(i, float(i // 3), 0.0, "ab"[i % 2], 1 + i % 2) for i in range(30)]
    df = spark.createDataFrame(rows, "id long, a double, b double, label string, fold_id int")
    found = {r["id"]: r["confidence"] for r in knn.predict(df, ["a", "b"], k).collect()}
    assert len(found) == 30 and all(c for c in found.values())
    assert knn.neighbours(df, ["a", "b"], k).count() == 30 * k
