"""Incremental file load: the stream checkpoint is the load state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quadspark.functions.terms import QUAD_COLUMNS
from quadspark.sinks.rdf import read_quad_table, save, write_quad_table
from quadspark.sources.rdf import accepted, dataset_scope, parse_rdf_lines
from quadspark.sources.storage import path_exists


def load_stream(
    spark: SparkSession, directory: str, table: str, checkpoint: str, graph: Column | None = None,
    dedupe: bool = False, on_reject: str = "fail", files_per_batch: int = 10_000,
) -> StreamingQuery:
    """Load the files of a folder that no earlier run has loaded, then stop.

    ``graph`` is computed from ``source`` (the file); without it the quads keep
    their graphs.  Each batch writes its own part of the table under its number,
    so a batch that is repeated after a failure replaces itself.  ``dedupe``
    drops quads that earlier batches hold, at the price of reading them.  A
    malformed line ends the stream, or, with ``on_reject="keep"``, leaves out its
    whole file: the line goes to the table ``<table>_rejects``, and the file is
    among ``left_out``, for ``run_load`` to take when it is mended.  A backlog is
    read ``files_per_batch`` at a time.
    """
    if on_reject not in ("fail", "keep"):
        raise ValueError("on_reject is 'fail' or 'keep'")
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(directory).select(
        "value", F.col("_metadata.file_path").alias("source"), dataset_scope().alias("__scope"))
    parsed = parse_rdf_lines(lines, scope=F.col("__scope"))
    if on_reject == "fail":
        parsed = accepted(parsed)
    target = F.col("g") if graph is None else F.coalesce(F.nullif(F.trim(graph), F.lit("")), F.col("g"))
    quads = parsed.withColumn("g", target).select(*QUAD_COLUMNS, "source", "reject")

    def store(batch: DataFrame, number: int) -> None:
        if on_reject == "keep":
            # A batch holds whole files.  It is parsed once: rejects decide on all lines of their file.
            staged = f"{table}_staged"
            save(batch, staged, "OVERWRITE")
            batch = batch.sparkSession.read.schema(batch.schema).parquet(staged)
            rejects = batch.filter(F.col("reject").isNotNull()).select("source", "reject")
            save(rejects, f"{table}_rejects/batch={number}", "OVERWRITE")
            batch = batch.join(rejects.select("source").distinct(), "source", "left_anti")
        fresh = batch.select(*QUAD_COLUMNS)
        if dedupe and path_exists(batch.sparkSession, table):
            earlier = read_quad_table(batch.sparkSession, table, batches=True)
            fresh = _missing(fresh, earlier.filter(F.col("batch") != number))
        write_quad_table(fresh, f"{table}/batch={number}", "OVERWRITE")

    return (
        quads.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def left_out(spark: SparkSession, table: str) -> DataFrame:
    """Files (source) that a stream with ``on_reject="keep"`` has not loaded, because they have malformed lines."""
    if not path_exists(spark, f"{table}_rejects"):
        return spark.createDataFrame([], "source string")
    return spark.read.schema("source string, reject string").parquet(f"{table}_rejects").select("source").distinct()


def _missing(new: DataFrame, old: DataFrame) -> DataFrame:
    right = old.select(*(F.col(c).alias(f"__{c}") for c in QUAD_COLUMNS))
    on = F.col("s") == F.col("__s")
    for c in QUAD_COLUMNS[1:]:
        on = on & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return new.join(right, on, "left_anti")
