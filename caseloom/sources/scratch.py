"""Tables in the folder that all executors share, to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession) -> str:
    """Below spark.checkpoint.dir; without it, on one machine only (as in tests), a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = f"file://{tempfile.gettempdir()}/caseloom-scratch"
    return f"{root.rstrip('/')}/caseloom/{spark.sparkContext.applicationId}"


def written(df: DataFrame) -> DataFrame:
    """df written to the shared folder as Parquet and read again. Survives lost executors; an application's tables are in one folder."""
    path = f"{scratch_dir(df.sparkSession)}/{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)
