"""Session helpers: building a local session for tests/bench, and lineage cuts.

On a cluster the session comes from the caller (``spark-submit`` or a notebook);
nothing here overrides settings the cluster already made.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Broadcast a join side only when its measured runtime size is under the bound: no
# broadcast from planner estimates (file sizes are not a bound on decoded rows); AQE
# converts a join after the small side's shuffle stage has been measured.
BROADCAST_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
}

# Settings for a local run. On a cluster size ``spark.sql.shuffle.partitions``
# and ``spark.sql.files.maxPartitionBytes`` to the data; AQE coalesces small
# shuffle partitions and splits skewed ones at runtime.
LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    **BROADCAST_CONF,
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Delete a query's checkpoint files once its frames are garbage-collected.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
}


def local_session(cores: int | str = "*", app: str = "texloom", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in {**LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the session's checkpoint folder.

    The cluster names a shared folder in ``spark.checkpoint.dir``; it is used as
    is. Only a local-mode session without one (tests, bench) gets a fresh
    scratch folder; a cluster session without one gets ``None``.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master == "local" or sc.master.startswith("local["):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="texloom-ckpt-"))
        return sc.getCheckpointDir()
    return None


def require_shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder; an error where a cluster session names none (there is nowhere to put intermediate rows
    that all executors can read)."""
    folder = ensure_checkpoint_dir(spark)
    if folder is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint into the shared checkpoint folder.

    Used after the expensive Python step (archive expansion) and wherever a
    frame is read twice and must give the same rows both times.
    """
    require_shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
