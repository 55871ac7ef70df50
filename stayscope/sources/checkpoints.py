"""Named parquet checkpoints and lineage cuts, kept where every executor can read them."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder. A local session without one gets its own, removed when Python ends."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(folder)
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="stayscope-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Compute `df` once into a new table in the shared folder and read it from there.

    Later steps cannot change or redo it when an executor is lost, and read only the columns
    they need. The tables stay until the folder is emptied, like other checkpoints.
    """
    path = f"{shared_folder(df.sparkSession)}/stayscope-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def save_checkpoint(df: DataFrame, root: str, name: str) -> DataFrame:
    """Write `df` as parquet under a name, replacing an older one, and return what was written."""
    df.write.mode("overwrite").parquet(f"{root}/checkpoint-{name}")
    return load_checkpoint(df.sparkSession, root, name)


def load_checkpoint(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Read back a named checkpoint."""
    return spark.read.parquet(f"{root}/checkpoint-{name}")
