from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from gaugework.functions.exprs import tile_of
from gaugework.operators import folds
from gaugework.operators.ordering import hashed_rank, sorted_rank


def sizes(df):
    return [n for _, n in sorted(Counter(r["fold_id"] for r in df.collect()).items())]


def test_tile_sizes(spark):
    assert sizes(folds.assign_folds(spark.range(7), 5)) == [2, 2, 1, 1, 1]
    assert sizes(folds.assign_folds(spark.range(3), 5)) == [1, 1, 1]


def test_k_below_two_is_rejected(spark):
    for call in (folds.assign_folds, folds.holdout_sizes):
        with pytest.raises(ValueError):
            call(spark.range(3), 1)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(n=st.integers(1, 60), k=st.integers(2, 9))
def test_tile_of_matches_ntile(spark, n, k):
    rows = spark.range(1, n + 1).withColumn(
        "tile", tile_of(F.col("id"), F.lit(n), k)
    ).selectExpr("id", "tile", f"ntile({k}) OVER (ORDER BY id) AS want")
    assert rows.filter("tile <> want").isEmpty()


def test_folds_partition_rows_and_do_not_depend_on_partitioning(spark):
    df = spark.range(1000).withColumn("label", F.when(F.col("id") % 10 < 7, "hot").otherwise("cold"))
    results = []
    for partitions in ("3", "11"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        split = folds.assign_folds(df.repartition(int(partitions)), 4, stratify=["label"])
        results.append(sorted((r["id"], r["fold_id"]) for r in split.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1]
    assert [i for i, _ in results[0]] == list(range(1000))
    per = Counter((r["label"], r["fold_id"]) for r in folds.assign_folds(df, 4, stratify=["label"]).collect())
    for label in ("hot", "cold"):
        counts = [per[label, f] for f in range(1, 5)]
        assert max(counts) - min(counts) <= 1


def test_null_stratum_is_a_stratum(spark):
    df = spark.range(20).withColumn("label", F.when(F.col("id") < 10, "a"))
    assert folds.assign_folds(df, 2, stratify=["label"]).count() == 20


def test_hashed_rank_orders_rows_per_bucket_not_in_one_task(spark):
    plan = hashed_rank(spark.range(100), "id", 1)._jdf.queryExecution().optimizedPlan().toString()
    row_windows = [line for line in plan.splitlines() if "row_number()" in line and "Window" in line]
    assert row_windows and all("_bucket" in line for line in row_windows)


def test_sorted_rank_with_one_hot_score(spark):
    df = spark.createDataFrame(
        [(i, "g" if i % 5 else None, 0.5 if i % 3 == 0 else (i * 37 % 101) / 101) for i in range(500)],
        "id long, g string, score double",
    )
    got = sorted_rank(df, ["g"], [F.desc("score"), F.col("id")])
    want = df.selectExpr(
        "id", "row_number() OVER (PARTITION BY g ORDER BY score DESC, id) AS want",
        "count(*) OVER (PARTITION BY g) AS n",
    )
    joined = got.join(want, "id")
    assert joined.count() == 500
    assert joined.filter("rank <> want OR rows <> n").isEmpty()


def test_holdout(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, None)], "id long, fold_id int")
    train, test = folds.holdout(df, 1)
    assert [r["id"] for r in train.collect()] == [2]
    assert [r["id"] for r in test.collect()] == [1]
    lines = {(r["fold_id"], r["side"]): r["n_rows"] for r in folds.holdout_sizes(df, 2).collect()}
    assert lines == {(1, "train"): 1, (1, "test"): 1, (2, "train"): 1, (2, "test"): 1}


def test_class_presence(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (2, "b")], "fold_id int, label string")
    got = {r["fold_id"]: (r["has_positive"], r["has_negative"]) for r in folds.class_presence(df, "label", "a").collect()}
    assert got == {1: (1, 0), 2: (1, 1)}


def test_rows_without_a_key_stay(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "a"), (None, None)], "id long, label string")
    assert folds.assign_folds(df, 2).count() == 4
    assert folds.assign_folds(df, 2, stratify=["label"]).count() == 4
