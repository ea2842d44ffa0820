"""Session building, the shared folder, and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def build_session(app: str = "gaugework", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time and adaptive execution; ``conf`` adds or overrides settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    A local session without that setting gets a temporary folder; a cluster session
    without it is an error, because a machine-local folder would not survive.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if configured:
        if current is None:
            sc.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="gaugework-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


def new_table_path(spark: SparkSession, name: str) -> str:
    """An unused path for a written table inside the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: computes ``df`` once, cuts its lineage, survives lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, max_rows: int = 100_000, max_bytes: int = 32 << 20) -> DataFrame:
    """Hint a broadcast only after measuring ``df`` (already materialised by the caller).

    Bounds the rows, and the bytes of their text form. Beyond either bound the frame is returned as
    it is and Spark shuffles the join.
    """
    text = F.length(F.to_json(F.struct(*df.columns)))
    seen = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(text), F.lit(0)).alias("size")).first()
    if seen["n"] <= max_rows and seen["size"] <= max_bytes:
        return F.broadcast(df)
    return df
