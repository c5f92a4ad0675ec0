"""Manifests of files to load: which files, into which graph."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The type suffixes loaded by default.
DEFAULT_TYPES = (
    "nt,ttl,nq,trig,owl,nt.gz,ttl.gz,nq.gz,trig.gz,owl.gz,nt.bz2,ttl.bz2,nq.bz2,trig.bz2,owl.bz2"
)
MANIFEST_COLUMNS = ["source", "type", "g", "length", "modified", "explicit"]


def accepts_type(file_type: Column, include_types: str | Iterable[str] = DEFAULT_TYPES) -> Column:
    """Whether a type is one of the suffixes, or ends with one after a dot (case-sensitive)."""
    suffixes = include_types.split(",") if isinstance(include_types, str) else list(include_types)
    suffixes = [x.strip() for x in suffixes if x.strip()]
    accepted = F.lit(False)
    for suffix in suffixes:
        accepted = accepted | (file_type == suffix) | F.endswith(file_type, F.lit("." + suffix))
    return accepted


def graph_name(group: Column, artifact: Column, version: Column, file_type: Column, classifier: Column) -> Column:
    """``urn:mvn:group:artifact:version[:type][:classifier]``; empty parts are dropped."""
    return F.concat_ws(
        ":", F.lit("urn:mvn"), group, artifact, version,
        F.nullif(file_type, F.lit("")), F.nullif(classifier, F.lit("")),
    )


def file_type(path: Column) -> Column:
    """The part of the file name after its first dot."""
    return F.regexp_extract(path, r"/[^/.]+\.([^/]+)$", 1)


def list_sources(
    spark: SparkSession, root: str, include_types: str | Iterable[str] = DEFAULT_TYPES, graph: Column | None = None
) -> DataFrame:
    """Files below a folder, kept by type suffix.

    File contents are never read: the listing uses the metadata columns only.
    ``graph`` is computed from ``path`` and ``type``; the default graph otherwise.
    """
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        .select("path", "length", F.col("modificationTime").alias("modified"))
        .withColumn("type", file_type(F.col("path")))
    )
    g = F.lit(None).cast("string") if graph is None else F.nullif(F.trim(graph), F.lit(""))
    return files.filter(accepts_type(F.col("type"), include_types)).select(
        F.col("path").alias("source"), "type", g.alias("g"), "length", "modified", F.lit(False).alias("explicit"))


def file_graph_mapping(spark: SparkSession, mapping: Sequence[tuple[str, str | None]]) -> DataFrame:
    """Extra files with explicit graphs; a blank graph is the default one.

    They are not filtered by type.
    """
    df = spark.createDataFrame(
        [(_uri(path), g) for path, g in mapping], "source string, g string")
    return df.select(
        "source", file_type(F.col("source")).alias("type"), F.nullif(F.trim("g"), F.lit("")).alias("g"),
        F.lit(None).cast("bigint").alias("length"), F.lit(None).cast("timestamp").alias("modified"),
        F.lit(True).alias("explicit"))


def _uri(path: str) -> str:
    """The form in which Spark reports a local path: one slash after the scheme."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return f"file:{path}" if path.startswith("/") else path
