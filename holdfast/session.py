"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings the jobs are written for. The number of shuffle partitions is left to
# the cluster: AQE coalesces from whatever it is set to.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Of equal keys in a generated answer the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def session(app_name: str = "holdfast", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or get) a session with the settings above; ``conf`` wins."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the folder checkpoints go to, setting it only where none is set.

    A cluster names a shared folder in ``spark.checkpoint.dir``. Only a local
    master, which has no other machines, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="holdfast-checkpoint-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and return a frame over it.

    Used where one result is read several times, or where row positions must stay
    the same when an executor is lost.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
