"""Shared scratch space: tables written under spark.checkpoint.dir cut lineage.

A written table survives the loss of any executor, which a local checkpoint does not.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def base_dir(spark: SparkSession) -> str:
    """The folder that the cluster names; a temporary one only where none is set (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = f"file://{tempfile.mkdtemp(prefix='tidemark-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{base_dir(spark)}/tidemark-{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The same rows, read from a Parquet table in the shared folder."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that nothing will read again."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
