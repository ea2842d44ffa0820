"""Metric logs, run and model records, and the unified metrics table."""

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from gaugework.operators import checks, metrics, reshape
from gaugework.plans import keyed, lookup, mlmetrics, records
from gaugework.queries.base import query, tidy
from gaugework.queries.inputs import (
    AS_OF_SQL, BY, BY_SQL, MM_SQL, P_PREDICTED_SQL, SC_SQL, as_of, instant, metric_rows, scored,
)
from gaugework.queries.scoring import ACC_SQL, AUC_SQL, LIFT_SQL, LL_SQL, MACRO_SQL, TOP_SQL
from gaugework.schemas import METRICS_LOG, ML_METRICS_KEY
from gaugework.session import new_table_path
from gaugework.sources.tables import append_log, conform
from gaugework.streaming import keyed_state

METRICS = ["accuracy", "precision_macro", "recall_macro", "f1_of_macro", "roc_auc", "lift_value", "log_loss"]
# Column names of the record tables, here and in the SQL below.
MODEL = ["model_id", "model_name", "algorithm", "fold_id", "parameter_set_id", "version_tag"]


# --- metric logs ---------------------------------------------------------------------------

WIDE_SQL = f"""{SC_SQL}, {MACRO_SQL}, {ACC_SQL}, {AUC_SQL}, {LIFT_SQL}, {TOP_SQL}, {LL_SQL},
wide AS (
  SELECT {BY_SQL}, round(accuracy, 6) AS accuracy, round(precision_macro, 6) AS precision_macro,
         round(recall_macro, 6) AS recall_macro, round(f1_of_macro, 6) AS f1_of_macro,
         round(roc_auc, 6) AS roc_auc, round(lift_value, 6) AS lift_value, round(log_loss, 6) AS log_loss
  FROM ac JOIN ma USING ({BY_SQL}) JOIN au USING ({BY_SQL}) JOIN tl USING ({BY_SQL}) JOIN ll USING ({BY_SQL}))"""


def _long_sql(source: str = "wide", names=tuple(METRICS)) -> str:
    return " UNION ALL ".join(
        f"SELECT {BY_SQL}, '{m}' AS metric_name, {m} AS metric_value FROM {source}" for m in names
    )


def _wide(spark, sf_dir):
    return tidy(metrics.evaluate(scored(spark, sf_dir), "P", BY)).select(*BY, *METRICS)


_LABEL_SQL = f"""{SC_SQL}, {MACRO_SQL}, {ACC_SQL},
aw AS (
  SELECT {BY_SQL}, round(accuracy, 6) AS accuracy, round(precision_macro, 6) AS precision_macro,
         round(recall_macro, 6) AS recall_macro, round(f1_of_macro, 6) AS f1_of_macro
  FROM ac JOIN ma USING ({BY_SQL}))"""
LABEL_METRICS = ["accuracy", "precision_macro", "recall_macro", "f1_of_macro"]


def _label_metrics(spark, sf_dir):
    rows = scored(spark, sf_dir)
    macro = metrics.macro_scores(metrics.confusion_matrix(rows, BY), BY)
    return tidy(metrics.fold_accuracy(rows, BY).join(macro, BY)).select(*BY, *LABEL_METRICS)


@query(f"WITH {_LABEL_SQL} {_long_sql('aw', LABEL_METRICS)}")
def metrics_unpivot(spark, sf_dir):
    return reshape.unpivot_structs(_label_metrics(spark, sf_dir), BY, [(m, m) for m in LABEL_METRICS])


@query(f"""WITH {WIDE_SQL}, l AS ({_long_sql()})
SELECT 'spark' AS platform, run_id, model_name, fold_id AS fold_number, metric_name, metric_value,
       '{{"k":5}}' AS hyperparameters, {AS_OF_SQL} AS created_at
FROM l""")
def metrics_long(spark, sf_dir):
    return tidy(records.metrics_log(
        _wide(spark, sf_dir), METRICS, "spark", F.lit('{"k":5}'), as_of()
    ))


@query(f"WITH {WIDE_SQL} SELECT * FROM wide")
def metrics_wide(spark, sf_dir):
    long = reshape.to_long(_wide(spark, sf_dir), BY, METRICS)
    return reshape.to_wide(long, BY, METRICS)


@query(f"""WITH {_LABEL_SQL}, {LL_SQL}
SELECT 'labels' AS platform, * FROM ({_long_sql('aw', LABEL_METRICS)})
UNION ALL SELECT 'probabilities', {BY_SQL}, 'log_loss', round(log_loss, 6) FROM ll""")
def metrics_union(spark, sf_dir):
    labels = reshape.to_long(_label_metrics(spark, sf_dir), BY, LABEL_METRICS)
    losses = reshape.to_long(metrics.log_loss(scored(spark, sf_dir), BY), BY, ["log_loss"])
    return tidy(
        labels.withColumn("platform", F.lit("labels"))
        .unionByName(losses.withColumn("platform", F.lit("probabilities")))
    ).select("platform", *BY, "metric_name", "metric_value")


@query(f"""WITH {SC_SQL}, {ACC_SQL}
SELECT 'spark' AS platform, run_id, model_name, fold_id AS fold_number, 'accuracy' AS metric_name,
       round(accuracy, 6) AS metric_value, CAST(NULL AS VARCHAR) AS hyperparameters, {AS_OF_SQL} AS created_at FROM ac
UNION ALL
SELECT 'spark', run_id, model_name, fold_id, 'total_predictions', CAST(total AS DOUBLE), NULL, {AS_OF_SQL}
FROM ac""")
def metrics_append(spark, sf_dir):
    per_fold = metrics.fold_accuracy(scored(spark, sf_dir), BY).withColumnRenamed("total", "total_predictions")
    path = new_table_path(spark, "metrics_log")
    log = None
    for name in ("accuracy", "total_predictions"):
        rows = records.metrics_log(per_fold, [name], "spark", F.lit(None).cast("string"), as_of())
        log = append_log(rows.drop("created_at"), path, METRICS_LOG, {"created_at": as_of()})
    return tidy(log)


@query(f"""WITH {MM_SQL}
SELECT pipeline_id, run_id, metric_name, round(metric_value, 6) AS metric_value, recorded_at FROM mm
ORDER BY recorded_at DESC, pipeline_id, run_id LIMIT 20""")
def latest_metrics(spark, sf_dir):
    rows = metric_rows(spark, sf_dir).select(
        "pipeline_id", "run_id", "metric_name", "metric_value", "recorded_at"
    )
    return tidy(mlmetrics.latest(rows, 20, [F.desc("recorded_at"), "pipeline_id", "run_id"]))


@query(f"""WITH {SC_SQL}
SELECT run_id, model_name, fold_id AS fold_number, id, round(price, 6) AS price,
       predicted AS predicted_label, round({P_PREDICTED_SQL}, 6) AS predicted_prob,
       actual AS actual_label, {AS_OF_SQL} AS created_at
FROM sc""")
def prediction_log(spark, sf_dir):
    log = records.prediction_log(scored(spark, sf_dir), as_of(), features=["price"])
    return tidy(log.drop("probs"))


# --- run and model records -----------------------------------------------------------------

_MODELS_SQL = f"""{SC_SQL}, m AS (
  SELECT model_id, model_name, algorithm, fold_id, parameter_set_id, version_tag, max(scored_at) AS created_on
  FROM sc GROUP BY ALL),
lc AS (
  SELECT model_id, model_name, algorithm, fold_id, parameter_set_id, version_tag, 'ACTIVE' AS status,
         created_on, created_on + INTERVAL 30 DAY AS next_retrain_on
  FROM m),
rs AS (
  SELECT model_id AS schedule_id, model_id, parameter_set_id, fold_id, CAST(30 AS BIGINT) AS frequency_days,
         created_on + INTERVAL 30 DAY AS next_run_on, created_on AS last_trained_on,
         'Scheduled when the model was trained' AS notes
  FROM lc)"""
_OVERVIEW_SQL = """SELECT model_id, model_name, frequency_days, next_run_on, last_trained_on, notes
FROM rs JOIN (SELECT model_id, model_name FROM lc) USING (model_id)"""


def _lifecycle(spark, sf_dir):
    models = scored(spark, sf_dir).groupBy(*MODEL).agg(F.max("scored_at").alias("created_on"))
    return records.model_lifecycle(models, F.col("created_on"))


@query(f"""WITH {MM_SQL}
SELECT run_id, min(recorded_at) AS created_at, min(pipeline_id) AS model_family,
       'run found in the metric rows' AS notes
FROM mm GROUP BY run_id""")
def run_registry(spark, sf_dir):
    return tidy(records.run_registry(
        metric_rows(spark, sf_dir), F.col("pipeline_id"), "run found in the metric rows", "recorded_at"
    ))


@query(f"WITH {_MODELS_SQL} SELECT * FROM lc")
def model_lifecycle(spark, sf_dir):
    return tidy(_lifecycle(spark, sf_dir))


@query(f"WITH {_MODELS_SQL} SELECT * FROM rs")
def retraining_schedule(spark, sf_dir):
    return tidy(records.retraining_schedule(_lifecycle(spark, sf_dir)))


@query(f"WITH {_MODELS_SQL} {_OVERVIEW_SQL}")
def retraining_overview(spark, sf_dir):
    lifecycle = _lifecycle(spark, sf_dir)
    return tidy(records.retraining_overview(records.retraining_schedule(lifecycle), lifecycle))


@query(f"""WITH {_MODELS_SQL} SELECT * FROM ({_OVERVIEW_SQL})
WHERE next_run_on <= TIMESTAMP '1999-01-01 00:00:00'""")
def retraining_due(spark, sf_dir):
    return tidy(records.retraining_due(
        retraining_overview(spark, sf_dir), instant("1999-01-01 00:00:00")
    ))


@query(f"""WITH {WIDE_SQL}, {_MODELS_SQL.removeprefix(SC_SQL + ', ')},
mk AS (SELECT DISTINCT run_id, model_name, fold_id, model_id FROM sc)
SELECT lc.model_id, lc.model_name, algorithm, lc.fold_id, version_tag, status, created_on, next_retrain_on,
       accuracy, precision_macro, recall_macro, f1_of_macro AS f1_macro, roc_auc, lift_value
FROM lc JOIN (SELECT * FROM wide JOIN mk USING ({BY_SQL})) w ON lc.model_id = w.model_id""")
def model_summary(spark, sf_dir):
    rows = scored(spark, sf_dir)
    wide = metrics.evaluate(rows, "P", ["model_id"]).withColumnRenamed("f1_of_macro", "f1_macro")
    return tidy(records.model_summary(_lifecycle(spark, sf_dir), wide))


_REGISTRY_SQL = f"""{SC_SQL},
t AS (
  SELECT run_id, fold_id AS fold_number, model_name, 'models/' || run_id || '/' || model_name AS artefact,
         algorithm AS hyperparameters, max(scored_at) AS created_at, month(scored_at) > 6 AS second
  FROM sc GROUP BY ALL),
r AS (
  SELECT *, row_number() OVER (PARTITION BY run_id, fold_number, second
                               ORDER BY created_at DESC, model_name DESC) AS place FROM t),
n AS (SELECT * FROM r WHERE place = 1),
best AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY run_id, fold_number ORDER BY second DESC) = 1)"""


@query(f"""WITH {_REGISTRY_SQL}
SELECT run_id, fold_number, model_name, artefact, hyperparameters, created_at FROM best""")
def model_registry(spark, sf_dir):
    trained = scored(spark, sf_dir).groupBy(
        "run_id", F.col("fold_id").alias("fold_number"), "model_name",
        F.concat_ws("/", F.lit("models"), "run_id", "model_name").alias("artefact"),
        F.col("algorithm").alias("hyperparameters"), (F.month("scored_at") > 6).alias("second"),
    ).agg(F.max("scored_at").alias("created_at"))
    order = [F.col("created_at"), F.col("model_name")]
    earlier = checks.latest_per_key(
        trained.filter(~F.col("second")).drop("second"), ["run_id", "fold_number"], order
    )
    later = trained.filter("second").drop("second")
    return tidy(records.register_models(earlier, later))


# --- unified metrics table -----------------------------------------------------------------

_HALF = "2024-01-16 00:00:00"


@query(f"""WITH {MM_SQL}
SELECT pipeline_id, run_id, metric_name, round(metric_value, 6) AS metric_value,
       coalesce(metric_type, 'scalar') AS metric_type,
       CASE WHEN metric_value < 1 THEN {AS_OF_SQL} ELSE recorded_at END AS recorded_at,
       model_version, environment_label, pipeline_id || ',' || environment_label AS tags, metadata_json
FROM mm""")
def ml_metrics_defaults(spark, sf_dir):
    rows = metric_rows(spark, sf_dir).withColumn(
        "recorded_at", F.when(F.col("metric_value") >= 1, F.col("recorded_at"))
    ).withColumn("tags", F.concat_ws(", ", "tags"))
    return tidy(mlmetrics.with_defaults(rows, as_of()).withColumn("tags", F.concat_ws(",", "tags")))


@query(f"""WITH {MM_SQL}
SELECT pipeline_id, run_id, metric_name, count(*) AS cnt, 'duplicate_key' AS problem
FROM mm GROUP BY ALL HAVING count(*) > 1""")
def pk_violations(spark, sf_dir):
    return mlmetrics.violations(metric_rows(spark, sf_dir))


@query(f"""WITH {MM_SQL}
SELECT pipeline_id, run_id, metric_name, round(metric_value, 6) AS metric_value, recorded_at, metadata_json
FROM mm QUALIFY row_number() OVER (
  PARTITION BY pipeline_id, run_id, metric_name
  ORDER BY recorded_at >= TIMESTAMP '{_HALF}' DESC, recorded_at DESC, metric_value DESC) = 1""")
def upsert_metrics(spark, sf_dir):
    rows = metric_rows(spark, sf_dir).select(
        *ML_METRICS_KEY, "metric_value", "recorded_at", "metadata_json"
    )
    half = instant(_HALF)
    order = [F.col("recorded_at"), F.col("metric_value")]
    existing = checks.latest_per_key(rows.filter(F.col("recorded_at") < half), ML_METRICS_KEY, order)
    updates = rows.filter(F.col("recorded_at") >= half)
    return tidy(checks.upsert(existing, updates, ML_METRICS_KEY, order))


_INGEST_SQL = f"""{_LABEL_SQL}, l AS ({_long_sql('aw', LABEL_METRICS)}),
old AS (SELECT {BY_SQL}, 'total_predictions' AS metric_name, CAST(total AS DOUBLE) AS metric_value,
               TIMESTAMP '2024-01-01 00:00:00' AS logged FROM ac),
new AS (SELECT *, {AS_OF_SQL} AS logged FROM l)"""


@query(f"""WITH {_INGEST_SQL}
SELECT 'orders' AS pipeline_id, run_id,
       model_name || '/fold' || CAST(fold_id AS VARCHAR) || '/' || metric_name AS metric_name,
       metric_value, 'scalar' AS metric_type, logged AS recorded_at, 'v1' AS model_version,
       'lab' AS environment_label, 'spark,' || metric_name AS tags,
       '{{"fold":' || CAST(fold_id AS VARCHAR) || ',"model":"' || model_name
       || '","hyperparameters":"k=5"}}' AS metadata_json
FROM (SELECT * FROM old UNION ALL SELECT * FROM new)""")
def ml_metrics_ingest(spark, sf_dir):
    def unified(wide, names, at):
        log = records.metrics_log(wide, names, "spark", F.lit("k=5"), at)
        return mlmetrics.from_log(log, "orders", F.lit("v1"), "lab")

    per_fold = metrics.fold_accuracy(scored(spark, sf_dir), BY).withColumnRenamed("total", "total_predictions")
    first = unified(
        per_fold, ["accuracy", "total_predictions"], instant("2024-01-01 00:00:00")
    )
    then = unified(_label_metrics(spark, sf_dir), LABEL_METRICS, as_of())
    table = mlmetrics.ingest(first, then)
    return tidy(table.withColumn("tags", F.concat_ws(",", "tags")))


@query(f"""WITH {MM_SQL}
SELECT pipeline_id, run_id, round(metric_value, 6) AS metric_value, recorded_at FROM mm
WHERE recorded_at >= TIMESTAMP '2024-01-10 00:00:00' AND recorded_at < TIMESTAMP '2024-01-20 00:00:00'""")
def metrics_time_range(spark, sf_dir):
    rows = metric_rows(spark, sf_dir).select("pipeline_id", "run_id", "metric_value", "recorded_at")
    return tidy(mlmetrics.time_range(
        rows, instant("2024-01-10 00:00:00"), instant("2024-01-20 00:00:00")
    ))


@query(f"""WITH {MM_SQL}
SELECT pipeline_id, run_id, round(metric_value, 6) AS metric_value,
       CAST(json_extract_string(metadata_json, '$.k') AS DOUBLE) AS k
FROM mm WHERE CAST(json_extract_string(metadata_json, '$.k') AS DOUBLE) >= 50""")
def metrics_json_filter(spark, sf_dir):
    k = mlmetrics.json_number("$.k")
    return tidy(
        metric_rows(spark, sf_dir).filter(k >= 50)
        .select("pipeline_id", "run_id", "metric_value", k.alias("k"))
    )


@query(f"""WITH {MM_SQL}
SELECT pipeline_id, run_id, round(metric_value, 6) AS metric_value, environment_label FROM mm
WHERE pipeline_id = 'error' OR environment_label = 'production'""")
def metrics_tag_filter(spark, sf_dir):
    tagged = mlmetrics.with_any_tag(metric_rows(spark, sf_dir), ["error", "production"])
    return tidy(tagged.select("pipeline_id", "run_id", "metric_value", "environment_label"))


@query(f"""WITH {MM_SQL}
SELECT pipeline_id, model_version, environment_label, metric_name, count(*) AS n_values,
       round(avg(metric_value), 6) AS mean_value, round(max(metric_value), 6) AS best_value,
       round(min(metric_value), 6) AS worst_value,
       min({{'v': -metric_value, 'r': run_id}}).r AS best_run
FROM mm GROUP BY pipeline_id, model_version, environment_label, metric_name""")
def metrics_compare(spark, sf_dir):
    return tidy(mlmetrics.compare(metric_rows(spark, sf_dir)))


@query(f"""WITH {MM_SQL}
SELECT pipeline_id, run_id, round(metric_value, 6) AS metric_value, environment_label FROM mm
WHERE pipeline_id = 'error' AND environment_label = 'production'""")
def metrics_all_tags(spark, sf_dir):
    tagged = mlmetrics.with_all_tags(metric_rows(spark, sf_dir), ["error", "production"])
    return tidy(tagged.select("pipeline_id", "run_id", "metric_value", "environment_label"))


@query(f"""WITH {MM_SQL}
SELECT pipeline_id, run_id, round(metric_value, 6) AS metric_value, recorded_at FROM mm
WHERE recorded_at >= TIMESTAMP '2024-01-10 00:00:00' AND recorded_at < TIMESTAMP '2024-01-20 00:00:00'""")
def metrics_layout_read(spark, sf_dir):
    """The same time range read from the written layout: partitions by year, sorted by pipeline and time."""
    path = new_table_path(spark, "metrics-layout")
    mlmetrics.write_layout(metric_rows(spark, sf_dir), path)
    found = mlmetrics.read_range(spark, path, datetime(2024, 1, 10), datetime(2024, 1, 20))
    return tidy(found.select("pipeline_id", "run_id", "metric_value", "recorded_at"))


@query(f"""WITH {WIDE_SQL}, mk AS (SELECT DISTINCT {BY_SQL}, model_id, parameter_set_id, algorithm FROM sc)
SELECT model_id AS metric_id, model_id, parameter_set_id, fold_id, algorithm, 'catalog' AS hyperparameters, accuracy,
       precision_macro, recall_macro, f1_of_macro AS f1_macro, roc_auc, lift_value, {AS_OF_SQL} AS evaluated_on
FROM wide JOIN mk USING ({BY_SQL})""")
def metrics_wide_log(spark, sf_dir):
    rows = scored(spark, sf_dir)
    wide = metrics.evaluate(rows, "P", ["model_id"])
    return tidy(records.metrics_wide_log(wide, rows.select(*MODEL).distinct(), F.lit("catalog"), as_of()))


@query(f"""WITH {MM_SQL}
SELECT pipeline_id, run_id, metric_name, round(metric_value, 6) AS metric_value, recorded_at, metadata_json
FROM mm QUALIFY row_number() OVER (
  PARTITION BY pipeline_id, run_id, metric_name
  ORDER BY recorded_at >= TIMESTAMP '{_HALF}' DESC, recorded_at DESC, metric_value DESC) = 1""")
def merge_partitions(spark, sf_dir):
    """A keyed table made of the first half of the rows, after a merge of the second half."""
    path = new_table_path(spark, "keyed-metrics")
    rows = metric_rows(spark, sf_dir).select(*ML_METRICS_KEY, "metric_value", "recorded_at", "metadata_json")
    order = [F.col("recorded_at"), F.col("metric_value")]
    keyed.create(rows.filter(F.col("recorded_at") < instant(_HALF)), path, ML_METRICS_KEY, order)
    keyed.merge(path, rows.filter(F.col("recorded_at") >= instant(_HALF)), ML_METRICS_KEY, order)
    return tidy(keyed.read(spark, path))


def _by_tags(spark, sf_dir, every):
    folder = new_table_path(spark, "metric-tags")
    lookup.write_postings(metric_rows(spark, sf_dir), folder)
    found = lookup.rows_with_tags(spark, folder, ["error", "production"], every)
    return tidy(found.select("pipeline_id", "run_id", "metric_value", "environment_label"))


@query(f"""WITH {MM_SQL}
SELECT pipeline_id, run_id, round(metric_value, 6) AS metric_value, environment_label FROM mm
WHERE pipeline_id = 'error' OR environment_label = 'production'""")
def metrics_tag_postings(spark, sf_dir):
    """Rows with any of two tags, found by the inverted table."""
    return _by_tags(spark, sf_dir, False)


@query(f"""WITH {MM_SQL}
SELECT pipeline_id, run_id, round(metric_value, 6) AS metric_value, environment_label FROM mm
WHERE pipeline_id = 'error' AND environment_label = 'production'""")
def metrics_tag_postings_all(spark, sf_dir):
    """Rows with both of two tags, found by the inverted table."""
    return _by_tags(spark, sf_dir, True)


@query(f"""WITH {MM_SQL}
SELECT pipeline_id, run_id, round(metric_value, 6) AS metric_value,
       CAST(json_extract_string(metadata_json, '$.k') AS DOUBLE) AS k
FROM mm WHERE CAST(json_extract_string(metadata_json, '$.k') AS DOUBLE) >= 50""")
def metrics_json_typed(spark, sf_dir):
    """The JSON filter on a layout that holds frequent paths as typed columns."""
    path = new_table_path(spark, "metric-json")
    rows = metric_rows(spark, sf_dir)
    lookup.write_typed_json(rows, path, lookup.frequent_paths(rows))
    table = spark.read.parquet(path)
    k = lookup.json_path(table, "k")
    return tidy(table.filter(k >= 50).select("pipeline_id", "run_id", "metric_value", k.alias("k")))


@query(f"""WITH {MM_SQL},
v AS (SELECT pipeline_id, min(recorded_at) AS since FROM mm GROUP BY pipeline_id)
SELECT pipeline_id, count(*) AS n_values, round(sum(metric_value), 4) AS total_value,
       count(*) FILTER (WHERE recorded_at >= since + INTERVAL 7 DAY) AS n_later
FROM mm JOIN v USING (pipeline_id) GROUP BY pipeline_id""")
def metrics_by_pipeline(spark, sf_dir):
    """Rows and a table of pipelines, both dealt by pipeline, joined and added up where they lie."""
    rows = metric_rows(spark, sf_dir).select("pipeline_id", "run_id", "metric_value", "recorded_at")
    heavy, names = lookup.dominant(rows, 4), [f"pipelines_{uuid.uuid4().hex}" for _ in range(2)]
    since = rows.groupBy("pipeline_id").agg(F.min("recorded_at").alias("since"))
    left = lookup.save_distributed(rows, names[0], new_table_path(spark, names[0]), heavy, 8, 4, ["run_id", "recorded_at"])
    right = lookup.save_distributed(since, names[1], new_table_path(spark, names[1]), heavy, 8, 4, [], copies=True)
    for name in names:
        spark.sql(f"DROP TABLE {name}")  # the entries alone; files and frames stay
    joined = left.join(right, ["pipeline_id", lookup.SALT])
    later = F.col("recorded_at") >= F.col("since") + F.expr("INTERVAL 7 DAY")
    totals = lookup.totals_by_key(joined, {
        "n_values": F.count(F.lit(1)), "total_value": F.sum("metric_value"), "n_later": F.count_if(later)})
    return totals.select("pipeline_id", "n_values", F.round("total_value", 4).alias("total_value"), "n_later")


@query(f"""WITH {MM_SQL}
SELECT pipeline_id, run_id, metric_name, round(metric_value, 6) AS metric_value, coalesce(metric_type, 'scalar') AS metric_type, recorded_at,
       model_version, environment_label, pipeline_id || ',' || environment_label AS tags, metadata_json
FROM mm QUALIFY row_number() OVER (PARTITION BY pipeline_id, run_id, metric_name ORDER BY recorded_at DESC, metric_value DESC) = 1""")
def metrics_stream_state(spark, sf_dir):
    """The unified table that a stream of files keeps with state per key."""
    folder = new_table_path(spark, "metric-stream")
    rows = metric_rows(spark, sf_dir).withColumn("recorded_at", F.col("recorded_at").cast("timestamp"))
    rows.repartition(4).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(f"{folder}/in")
    keyed_state.start(stream, folder, f"{folder}/checkpoint").awaitTermination()
    return tidy(keyed_state.current(spark, folder).withColumn("tags", F.concat_ws(",", "tags")))
