"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def staging_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``. Only a
    local session may fall back to a folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="quorate-")


def new_folder(spark: SparkSession, label: str) -> str:
    return f"{staging_root(spark)}/quorate/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, folder: str, name: str) -> DataFrame:
    """Write a table that several later jobs read, and read it back: lineage
    is cut and a lost executor costs no recomputation."""
    path = f"{folder}/{name}"
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
