"""Tables that cut a lineage: written to the folder that the cluster names in spark.checkpoint.dir, and read back."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, or else below the folder that was set for checkpoints.

    Where neither is set, below the local temp folder in a local session; a cluster, whose
    executors don't share such a folder, is an error.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {context.master} share; intermediate tables are written there")
        base = f"file://{tempfile.gettempdir()}/corpusmill-{context.applicationId}"
    return f"{base.rstrip('/')}/corpusmill/{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Its shuffle files go as soon as it is written."""
    spark = df.sparkSession
    path, before = f"{shared_dir(spark)}/{name}", spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
