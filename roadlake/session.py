"""Session settings the operators rely on, and where scratch tables go."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

_CHECKPOINT_DIR = "spark.checkpoint.dir"


def prepare(spark: SparkSession) -> SparkSession:
    """Set what the session decides for every table written through it.

    UTC, so that parsed and printed times never depend on where a job runs; and timestamps in
    Parquet that carry statistics, which the default encoding lacks, so that a filter on
    ``event_time`` can skip parts of a file. Python workers look for this package where the driver found it,
    which serves local sessions and shared installations; elsewhere submit it with ``--py-files``.
    """
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[1]))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    # Without it a day that holds much of the data, or a key that does, would be one task's.
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local session that names none (as in tests) falls back to a temporary folder.
    """
    configured = spark.conf.get(_CHECKPOINT_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_DIR} to a folder all executors share")
    return _local_dir()


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="roadlake-")


def checkpointed(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and go on from there, so that a lost executor repeats nothing before it.

    Spark removes the files once the frame is gone where ``spark.cleaner.referenceTracking.cleanCheckpoints`` says so.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has used before."""
    return f"{shared_dir(spark)}/roadlake/{label}-{uuid.uuid4().hex}"


def no_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    """Empty frame of a schema, made without a Python worker."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
