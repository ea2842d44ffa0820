from pyspark.sql import functions as F

from gaugework.schemas import ML_METRICS
from gaugework.streaming import keyed_state
from gaugework.streaming.ingest import _BATCHES, _last_marks, _read, _since, compact, current, ingest_stream


def feed(spark, source, values, pipeline="p"):
    rows = [(pipeline, f"r{i}", "m", float(v)) for i, v in values]
    spark.createDataFrame(
        rows, "pipeline_id string, run_id string, metric_name string, metric_value double"
    ).coalesce(1).write.mode("append").json(source)


def run(spark, source, root, checkpoint, name="a"):
    ingest_stream(spark.readStream.schema(ML_METRICS).json(source), root, checkpoint, name).awaitTermination()


def values(df):
    return {(r["pipeline_id"], r["run_id"]): r["metric_value"] for r in df.collect()}


def test_stream_keeps_one_row_per_key(spark, tmp_path):
    source, root, checkpoint, table = (str(tmp_path / n) for n in ("in", "out", "ckpt", "table"))
    assert current(spark, root).count() == 0
    feed(spark, source, [(1, 0.1), (2, 0.2), (2, 0.2)])
    run(spark, source, root, checkpoint)
    feed(spark, source, [(2, 0.05), (3, 0.3)])
    run(spark, source, root, checkpoint)
    run(spark, source, root, checkpoint)  # nothing new: no batch
    want = {("p", "r1"): 0.1, ("p", "r2"): 0.05, ("p", "r3"): 0.3}
    now = current(spark, root)
    assert values(now) == want and now.filter(F.col("metric_type") != "scalar").isEmpty()
    compact(spark, root, table)
    assert values(spark.read.parquet(table)) == want


def test_streams_do_not_overwrite_each_other(spark, tmp_path):
    one, two, root = (str(tmp_path / n) for n in ("one", "two", "out"))
    feed(spark, one, [(1, 0.1)])
    feed(spark, two, [(1, 0.9)], "q")
    run(spark, one, root, str(tmp_path / "c1"), "a")
    run(spark, two, root, str(tmp_path / "c2"), "b")
    assert values(current(spark, root)) == {("p", "r1"): 0.1, ("q", "r1"): 0.9}


def test_replayed_batch_changes_nothing(spark, tmp_path):
    source, root = str(tmp_path / "in"), str(tmp_path / "out")
    feed(spark, source, [(1, 0.1)])
    run(spark, source, root, str(tmp_path / "c1"))
    before = current(spark, root).collect()
    run(spark, source, root, str(tmp_path / "c2"))  # batch 0 of the same stream once more
    assert current(spark, root).collect() == before


def test_current_after_compaction_reads_only_later_batches(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    feed(spark, source, [(1, 0.1), (2, 0.2)])
    run(spark, source, root, checkpoint)
    compact(spark, root)
    assert values(current(spark, root)) == {("p", "r1"): 0.1, ("p", "r2"): 0.2}
    feed(spark, source, [(2, 0.5)])
    run(spark, source, root, checkpoint)
    assert values(current(spark, root)) == {("p", "r1"): 0.1, ("p", "r2"): 0.5}
    last, marks = _last_marks(spark, root)
    assert (last, marks) == (1, {"a": 0})
    assert {r[0] for r in _since(_read(spark, _BATCHES, f"{root}/batches"), marks).select("batch").distinct().collect()} == {1}
    compact(spark, root)
    assert values(current(spark, root)) == {("p", "r1"): 0.1, ("p", "r2"): 0.5}
    assert _since(_read(spark, _BATCHES, f"{root}/batches"), _last_marks(spark, root)[1]).isEmpty()


def keyed(spark, source, root, checkpoint):
    stream = spark.readStream.schema(ML_METRICS).option("maxFilesPerTrigger", 1).json(source)
    keyed_state.start(stream, root, checkpoint).awaitTermination()


def timed(spark, source, rows):
    full = [("p", r, "m", v, f"2024-01-01T00:00:{s:02d}.000Z", ["a", None], None) for r, v, s in rows]
    spark.createDataFrame(full, "pipeline_id string, run_id string, metric_name string, metric_value double, recorded_at string, tags array<string>, "
                          "model_version string").coalesce(1).write.mode("append").json(source)


def test_keyed_state_keeps_the_newest_row(spark, tmp_path):
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    timed(spark, source, [("r1", 1.0, 5), ("r1", 2.0, 9), ("r2", 1.0, 1), ("r3", None, 3)])
    timed(spark, source, [("r1", 3.0, 7), ("r2", 5.0, 2), ("r4", 1.0, 1)])  # r1: older than what stands
    keyed(spark, source, root, checkpoint)
    assert values(keyed_state.current(spark, root)) == {("p", "r1"): 2.0, ("p", "r2"): 5.0, ("p", "r3"): None, ("p", "r4"): 1.0}
    timed(spark, source, [("r1", 9.0, 9), ("r1", 1.0, 9), ("r3", 7.0, 3), ("r2", 0.0, 2)])  # equal times: the larger value
    keyed(spark, source, root, checkpoint)
    now = keyed_state.current(spark, root)
    assert values(now) == {("p", "r1"): 9.0, ("p", "r2"): 5.0, ("p", "r3"): 7.0, ("p", "r4"): 1.0}
    row = now.filter("run_id = 'r1'").first()
    assert row["tags"] == ["a", None] and row["model_version"] is None and row["metric_type"] == "scalar"
    changes = spark.read.parquet(f"{root}/changes")
    assert changes.filter("run_id = 'r1'").agg(F.max("change")).first()[0] <= 3


def test_keyed_state_is_safe_to_replay(spark, tmp_path):
    """A restart writes nothing again; the same rows once more, in other batches, change nothing."""
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    timed(spark, source, [(f"r{i % 5}", float(i), i % 7) for i in range(30)])
    keyed(spark, source, root, checkpoint)
    want, written = values(keyed_state.current(spark, root)), spark.read.parquet(f"{root}/changes").count()
    keyed(spark, source, root, checkpoint)
    timed(spark, source, [(f"r{i % 5}", float(i), i % 7) for i in reversed(range(30))])
    keyed(spark, source, root, checkpoint)
    assert values(keyed_state.current(spark, root)) == want and spark.read.parquet(f"{root}/changes").count() == written
    other = str(tmp_path / "other")
    keyed(spark, source, other, str(tmp_path / "ckpt2"))
    assert values(keyed_state.current(spark, other)) == want


def test_keyed_state_runs_no_python_per_key(spark, tmp_path):
    """The state is updated in the JVM, after rows of a key were combined, and a batch writes only what it brought."""
    source, root, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ckpt"))
    timed(spark, source, [("r1", 1.0, 5), ("r1", 2.0, 9), ("r2", 1.0, 1)])
    plan = keyed_state.changes(spark.readStream.schema(ML_METRICS).json(source))._jdf.queryExecution().toString()
    assert "Aggregate" in plan and "TransformWithState" not in plan
    keyed(spark, source, root, checkpoint)
    timed(spark, source, [("r1", 2.0, 9), ("r2", 3.0, 1), ("r1", 5.0, 2)])
    keyed(spark, source, root, checkpoint)
    written = spark.read.parquet(f"{root}/changes")
    assert sorted((r["run_id"], r["metric_value"], r["change"]) for r in written.collect()) == [("r1", 2.0, 1), ("r2", 1.0, 1), ("r2", 3.0, 2)]
