"""Shared-folder tables: the way this package cuts long plans.

Work tables go to the folder the cluster names in ``spark.checkpoint.dir``, as
Parquet, so a lost executor costs a re-read and never a re-computation of the
whole chain. A machine-local folder is only ever used with a local master.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from the session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder all executors share"
            )
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tableloom-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other call gets."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def store(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table."""
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
