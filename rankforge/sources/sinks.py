"""Table sinks (S3, S4): overwrite into a fresh version directory, replay-safe
appends by batch partition.  Without a transactional table format, readers
see a version only once it is complete: the ``_CURRENT`` pointer is written
last.  Pointers are only ever added, never replaced: a reader takes the newest
one, so there is a version at every moment and a crash leaves the one before."""

from __future__ import annotations

import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_POINTER = "seq long, version string"


def write_version(df: DataFrame, table_root: str, version: str | None = None) -> str:
    """S3: write ``df`` as a new version and add a pointer to it below ``_CURRENT``."""
    version = version or time.strftime("v%Y%m%d%H%M%S")
    path = os.path.join(table_root, version)
    df.write.mode("overwrite").parquet(path)
    spark = df.sparkSession
    spark.createDataFrame([(time.time_ns(), version)], _POINTER).coalesce(1) \
        .write.mode("append").csv(os.path.join(table_root, "_CURRENT"))
    return path


def read_current(spark: SparkSession, table_root: str) -> DataFrame:
    version = spark.read.schema(_POINTER).csv(os.path.join(table_root, "_CURRENT")).agg(
        F.max_by("version", "seq")).first()[0]
    return spark.read.parquet(os.path.join(table_root, version))


def append_batch(df: DataFrame, path: str, batch_id: int, merge_schema: bool = True) -> None:
    """Append one batch; rewriting the same ``batch_id`` replaces it."""
    (df.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """Read all batches, unioning evolving schemas by name."""
    return spark.read.option("mergeSchema", True).parquet(path)
