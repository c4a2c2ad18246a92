"""Cutting lineage and passing files on in the shared folder of ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one serves only a local session that names none, as in tests."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="tessera-shared-"))
    return sc.getCheckpointDir()


def kept(df: DataFrame) -> DataFrame:
    """An eager reliable checkpoint."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def scratch(spark: SparkSession) -> str:
    """The path of a new folder in the shared one."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"
