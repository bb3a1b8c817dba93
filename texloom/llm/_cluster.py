"""Where intermediate data lives: the folder that the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The shared folder of the session. Only a local session without one gets a folder of its own (tests)."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not folder:
        if not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="texloom-llm-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, what: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """A reliable checkpoint of the rows: lineage ends there, and later reads see the same rows."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
