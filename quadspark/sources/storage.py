"""Paths on any file system Spark can reach."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadspark.session import scratch_path

# An input below this size per core has too few splits to use all cores.
SMALL_BYTES_PER_CORE = 16 * 1024 * 1024


def _located(spark: SparkSession, path: str):
    location = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def path_exists(spark: SparkSession, path: str) -> bool:
    system, location = _located(spark, path)
    return system.exists(location)


def path_size(spark: SparkSession, path: str) -> int:
    system, location = _located(spark, path)
    return system.getContentSummary(location).getLength()


def spread_small(df: DataFrame, path: str, *keys: str) -> DataFrame:
    """Spread the rows of a small input over all cores before they are multiplied.

    The size of the input decides; a large one has splits enough and is left
    alone.  Rows are hashed by key, which a retried task repeats exactly.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    if path_size(spark, path) >= cores * SMALL_BYTES_PER_CORE:
        return df
    return df.repartition(cores, *keys)


# Stored bytes of an input that one task multiplies where memory per task matters.
PART_BYTES = 2 * 1024 * 1024


def parts_of(spark: SparkSession, path: str) -> int:
    """Tasks for the rows of an input: all cores, and so many that each task's share is bounded."""
    return max(spark.sparkContext.defaultParallelism, -(-path_size(spark, path) // PART_BYTES))


# Stored bytes of a lookup table that is sent to every executor; some ten times as many in memory at most.
MAX_BROADCAST_BYTES = 16 * 1024 * 1024


def stored_table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write a derived table to the shared folder once; returns it as read back, and its path."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stored_lookup(df: DataFrame, name: str) -> DataFrame:
    """Write a small derived table once, and broadcast it if its size allows.

    Beyond the bound it takes part in an ordinary shuffle join.
    """
    stored, path = stored_table(df, name)
    return F.broadcast(stored) if path_size(df.sparkSession, path) <= MAX_BROADCAST_BYTES else stored
