"""Schemas of the log and record tables. Their names, columns and types."""

from pyspark.sql.types import (
    ArrayType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TEXT, REAL, INT, BIG, INSTANT = StringType(), DoubleType(), IntegerType(), LongType(), TimestampType()


def _table(key: tuple[str, ...] = (), **columns: DataType) -> StructType:
    """A schema whose ``key`` columns are NOT NULL."""
    return StructType([StructField(n, t, n not in key) for n, t in columns.items()])


RUN_REGISTRY = _table(
    ("run_id",), run_id=TEXT, created_at=INSTANT, model_family=TEXT, notes=TEXT
)

PARAMETER_SETS = _table(
    ("parameter_set_id",), parameter_set_id=BIG, algorithm=TEXT, version_tag=TEXT, created_on=INSTANT
)

PARAMETERS = _table(
    ("parameter_set_id", "parameter_name"),
    parameter_set_id=BIG, parameter_name=TEXT, parameter_value=TEXT,
)

METRICS_LOG = _table(
    platform=TEXT, run_id=TEXT, model_name=TEXT, fold_number=INT, metric_name=TEXT,
    metric_value=REAL, hyperparameters=TEXT, created_at=INSTANT,
)

METRICS_WIDE = _table(
    ("metric_id",), metric_id=BIG, model_id=BIG, parameter_set_id=BIG, fold_id=BIG, algorithm=TEXT,
    hyperparameters=TEXT, accuracy=REAL, precision_macro=REAL, recall_macro=REAL, f1_macro=REAL,
    roc_auc=REAL, lift_value=REAL, evaluated_on=INSTANT,
)

PREDICTIONS = _table(
    run_id=TEXT, model_name=TEXT, fold_number=INT, id=BIG, predicted_label=TEXT,
    predicted_prob=REAL, probs=MapType(TEXT, REAL), actual_label=TEXT, created_at=INSTANT,
)

MODEL_LIFECYCLE = _table(
    ("model_id",), model_id=BIG, model_name=TEXT, algorithm=TEXT, fold_id=BIG, parameter_set_id=BIG,
    version_tag=TEXT, status=TEXT, created_on=INSTANT, next_retrain_on=INSTANT,
)

RETRAINING_SCHEDULE = _table(
    ("schedule_id",), schedule_id=BIG, model_id=BIG, parameter_set_id=BIG, fold_id=BIG,
    frequency_days=BIG, next_run_on=INSTANT, last_trained_on=INSTANT, notes=TEXT,
)

MODELS = _table(
    ("run_id", "fold_number"), run_id=TEXT, fold_number=INT, model_name=TEXT, artefact=TEXT,
    hyperparameters=TEXT, created_at=INSTANT,
)

ML_METRICS_KEY = ("pipeline_id", "run_id", "metric_name")

ML_METRICS = _table(
    ML_METRICS_KEY, pipeline_id=TEXT, run_id=TEXT, metric_name=TEXT, metric_value=REAL,
    metric_type=TEXT, recorded_at=INSTANT, model_version=TEXT, environment_label=TEXT,
    tags=ArrayType(TEXT), metadata_json=TEXT,
)

# Longest text allowed per column.
ML_METRICS_LENGTHS = {
    "pipeline_id": 128,
    "run_id": 128,
    "metric_name": 255,
    "metric_type": 64,
    "model_version": 128,
    "environment_label": 64,
}
