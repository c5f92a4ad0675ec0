"""Prefix tables: expanding and compacting IRIs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadspark.sources.storage import stored_lookup


def read_prefixes(spark: SparkSession, path: str) -> DataFrame:
    """``@prefix`` / ``PREFIX`` lines of a file as ``(prefix, iri)``."""
    line = r"^\s*@?(?:prefix|PREFIX)\s+([^:\s]*):\s*<([^>]*)>"
    rows = spark.read.text(path).filter(F.col("value").rlike(line))
    return rows.select(
        F.regexp_extract("value", line, 1).alias("prefix"), F.regexp_extract("value", line, 2).alias("iri"))


def prefix_table(spark: SparkSession, prefixes: Mapping[str, str]) -> DataFrame:
    return spark.createDataFrame(list(prefixes.items()), "prefix string, iri string")


def expand_curies(df: DataFrame, prefixes: DataFrame, column: str) -> DataFrame:
    """Replace ``prefix:local`` by the full IRI; an unknown prefix leaves the value."""
    table = stored_lookup(prefixes.select(F.col("prefix").alias("__pfx"), F.col("iri").alias("__iri")), "prefixes")
    key = F.substring_index(F.col(column), ":", 1)
    local = F.substr(F.col(column), F.length(key) + 2, F.length(column))
    has_prefix = F.contains(F.col(column), F.lit(":"))
    joined = df.join(table, has_prefix & (key == F.col("__pfx")), "left")
    return _replaced(joined, df, column, F.concat("__iri", local))


def compact_iris(df: DataFrame, prefixes: DataFrame, column: str) -> DataFrame:
    """Replace a namespace that ends in ``#`` or ``/`` by its prefix."""
    table = stored_lookup(prefixes.select(F.col("prefix").alias("__pfx"), F.col("iri").alias("__iri")), "prefixes")
    namespace = F.regexp_extract(F.col(column), r"^(.*[#/])", 1)
    local = F.substr(F.col(column), F.length(namespace) + 1, F.length(column))
    joined = df.join(table, namespace == F.col("__iri"), "left")
    return _replaced(joined, df, column, F.concat("__pfx", F.lit(":"), local))


def _replaced(joined: DataFrame, df: DataFrame, column: str, value: Column) -> DataFrame:
    return joined.select(*(
        F.coalesce(value, F.col(c)).alias(c) if c == column else F.col(c) for c in df.columns))
