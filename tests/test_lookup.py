import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gaugework.operators import knn
from gaugework.operators.folds import assign_folds
from gaugework.plans import keyed, lookup

KEYS = ["pipeline_id", "run_id"]


def files(path):
    return {str(p.relative_to(path)) for p in Path(path).rglob("part-*") if p.suffix == ".parquet"}


@pytest.fixture
def table(spark, tmp_path):
    rows = [(f"p{i % 7}", f"r{i}", float(i), i) for i in range(300)]
    df = spark.createDataFrame(rows, "pipeline_id string, run_id string, v double, at int")
    keyed.create(df, f"{tmp_path}/t", KEYS, [F.col("at")], 16)
    return f"{tmp_path}/t", {r[:2]: r[2] for r in rows}


def content(spark, path):
    return {(r["pipeline_id"], r["run_id"]): r["v"] for r in keyed.read(spark, path).collect()}


def test_merge_leaves_other_files_alone(spark, table):
    path, want = table
    before = files(path)
    updates = [("p0", "r0", -1.0, 900), ("p0", "r0", -2.0, 899), ("new", "n", 5.0, 1), ("p1", "r1", 7.0, -5)]
    n = keyed.merge(path, spark.createDataFrame(updates, "pipeline_id string, run_id string, v double, at int"), KEYS, [F.col("at")], 16)
    want |= {("p0", "r0"): -1.0, ("new", "n"): 5.0, ("p1", "r1"): 7.0}
    assert content(spark, path) == want and keyed.read(spark, path).count() == len(want)
    touched = {f.split("/")[0] for f in before ^ files(path)}
    assert 1 <= len(touched) <= n <= 3
    assert {f for f in before if f.split("/")[0] not in touched} <= files(path)


def test_merging_twice_or_nothing_changes_nothing(spark, table):
    path, want = table
    updates = spark.createDataFrame([("p0", "r0", -1.0, 900), (None, "x", 1.0, 1)], "pipeline_id string, run_id string, v double, at int")
    none = updates.limit(0)
    assert keyed.merge(path, none, KEYS, [F.col("at")], 16) == 0
    for _ in range(2):
        keyed.merge(path, updates.filter("pipeline_id IS NOT NULL"), KEYS, [F.col("at")], 16)
    assert content(spark, path) == want | {("p0", "r0"): -1.0}


def test_merge_into_nothing(spark, tmp_path):
    rows = spark.createDataFrame([("a", "b", 1.0, 1)], "pipeline_id string, run_id string, v double, at int")
    assert keyed.merge(f"{tmp_path}/none", rows, KEYS, [F.col("at")]) == 1 and content(spark, f"{tmp_path}/none") == {("a", "b"): 1.0}


@pytest.fixture(scope="module")
def tagged(spark, tmp_path_factory):
    rng = random.Random(2)
    rows = [(i, rng.sample(["all", "a", "b", "c", "d", f"only{i}"], rng.randint(1, 4))) for i in range(500)]
    rows += [(1000, None), (1001, []), (1002, ["a", None, "a"]), (1003, ["a", "b"]), (1003, ["a", "b"])]
    folder = str(tmp_path_factory.mktemp("tags"))
    lookup.write_postings(spark.createDataFrame(rows, "id long, tags array<string>").repartition(3), folder, block_rows=50)
    return folder, rows


@pytest.mark.parametrize("wanted", [["a"], ["a", "b"], ["all", "c", "d"], ["nowhere"], ["a", "nowhere"], ["only3", "only4"], ["a", "a"]])
def test_postings_equal_a_scan(spark, tagged, wanted):
    folder, rows = tagged
    for every in (True, False):
        meets = (lambda t: set(wanted) <= set(t)) if every else (lambda t: set(wanted) & set(t))
        got = sorted(r["id"] for r in lookup.rows_with_tags(spark, folder, wanted, every).collect())
        assert got == sorted(i for i, t in rows if t and meets(t))


def test_postings_read_the_wanted_tags_only(spark, tagged):
    folder, _ = tagged
    found = lookup.postings(spark, folder, ["a", "only3"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [tag_bucket" in plan and "PushedFilters: [In(tag, [a,only3])]" in plan
    read = found.select("_metadata.file_path").distinct().count()
    assert read <= 2 < len(files(f"{folder}/postings"))


def test_typed_json(spark, tmp_path):
    rows = [(i, f'{{"k": {i}, "name": "n{i % 3}", "mixed": {i if i % 2 else chr(34) + "x" + chr(34)}}}') for i in range(400)]
    rows += [(1000, None), (1001, "no json"), (1002, '{"rare": 1}'), (1003, '{"k": "text"}'), (1004, "[1]")]
    df = spark.createDataFrame(rows, "id long, metadata_json string")
    assert lookup.frequent_paths(df.filter("id <> 1003")) == {"k": "double", "name": "string", "mixed": "string"}
    paths = {"k": "double", "name": "string"}
    lookup.write_typed_json(df.repartition(4), f"{tmp_path}/j", paths)
    table = spark.read.parquet(f"{tmp_path}/j")
    some = table.filter(lookup.json_path(table, "k") >= 390)
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(metadata_json__k,390.0)" in plan.split("PushedFilters")[1].split("ReadSchema")[0]
    assert sorted(r["id"] for r in some.collect()) == list(range(390, 400))
    assert [r["id"] for r in table.filter(lookup.json_path(table, "rare") == 1).collect()] == [1002]
    assert table.count() == 405 and table.filter("id = 1001").first()["metadata_json"] == "no json"
    assert lookup.frequent_paths(df.limit(0)) == {}


def test_distributed_tables_join_and_add_up_in_place(spark, tmp_path):
    rows = [("big" if i % 10 else f"s{i}", i, float(i)) for i in range(400)] + [(None, 1, 1.0)]
    df = spark.createDataFrame(rows, "pipeline_id string, run int, v double")
    heavy = lookup.dominant(df, 4)
    assert heavy == ["big"]
    side = df.groupBy("pipeline_id").agg(F.max("v").alias("top"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = lookup.save_distributed(df, "dist_a", f"{tmp_path}/a", heavy, 4, 4, ["run"])
        b = lookup.save_distributed(side, "dist_b", f"{tmp_path}/b", heavy, 4, 4, [], copies=True)
        joined = a.join(b, ["pipeline_id", lookup.SALT])
        in_place = joined.groupBy("pipeline_id", lookup.SALT).agg(F.sum("v").alias("v"))
        assert "Exchange" not in in_place._jdf.queryExecution().executedPlan().toString()
        totals = lookup.totals_by_key(joined, {"v": F.sum("v"), "n": F.count(F.lit(1))})
        assert totals._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1  # of one row per key and salt
        got = {r["pipeline_id"]: (r["v"], r["n"]) for r in totals.collect()}
        assert len(got) == 41 and got["big"] == (sum(v for p, _, v in rows if p == "big"), 360)
        assert a.filter("pipeline_id = 'big'").select(lookup.SALT).distinct().count() == 4
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for t in ("dist_a", "dist_b"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_sql_function_equals_predict(spark):
    rng = random.Random(5)
    rows = [(i, "xyz"[i % 3], float(rng.randint(0, 4)), float(rng.randint(0, 4))) for i in range(90)]  # many ties
    split = assign_folds(spark.createDataFrame(rows, "id long, label string, a double, b double"), 3)
    split.createOrReplaceTempView("few_rows")
    knn.sql_function(spark, "few_rows", ["a", "b"], "near_label")
    found = spark.sql("SELECT p.id, n.* FROM (SELECT * FROM few_rows WHERE id < 30) p, LATERAL near_label(p.a, p.b, 4, CAST(p.fold_id AS BIGINT)) n")
    want = {r["id"]: (r["predicted"], r["confidence"]) for r in knn.predict(split, ["a", "b"], 4).collect()}
    got = {r["id"]: (r["label"], r["confidence"]) for r in found.collect()}
    assert len(got) == 30 and all(got[i] == pytest.approx(want[i]) for i in got)
