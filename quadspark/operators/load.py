"""Load many files into named graphs, once each.

The load state is a table ``(source, graphs, length, modified, loaded_at, targets,
load)``.  Data is written before the state, so a failed load is repeated and
never lost.  A file is loaded as a whole or not at all: one with a malformed line
ends the load, or is left pending and its malformed lines are kept in a table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadspark.functions.terms import BNODE, IRI, LITERAL, QUAD_COLUMNS, XSD_STRING, null
from quadspark.sinks.rdf import publish_if_changed, save, write_quad_table
from quadspark.sources.rdf import accepted, scan_rdf_lines, scan_trig_blocks
from quadspark.sources.storage import path_exists

STATE_SCHEMA = ("source string, graphs array<string>, length bigint, modified timestamp, loaded_at timestamp, "
                "targets array<string>, load bigint")

# Types in the block layout, and types that nothing here parses (codec suffixes aside).
BLOCK_TYPES, UNPARSED_TYPES = ("trig",), ("owl", "rdf", "jsonld")

# Vocabulary and subject of the load state as triples.
STATE_NS = "http://www.example.org/"
STATE_IRI = "urn:load-state"
LOAD, FILE, GRAPH = STATE_NS + "load", STATE_NS + "file", STATE_NS + "graph"


def read_load_state(spark: SparkSession, path: str) -> DataFrame:
    if not path_exists(spark, path):
        return spark.createDataFrame([], STATE_SCHEMA)
    return spark.read.schema(STATE_SCHEMA).parquet(path)


def first_per_source(manifest: DataFrame, order: str = "explicit") -> DataFrame:
    """One row per source: listed files before explicit ones, then by graph name.

    A source is loaded once, into the first graph it is mapped to.
    """
    row = F.struct(F.col(order), F.col("g"), *(F.col(c) for c in manifest.columns if c not in (order, "g", "source")))
    best = manifest.groupBy("source").agg(F.min(row).alias("__row"))
    return best.select("source", "__row.*").select(*manifest.columns)


def pending(
    manifest: DataFrame, load_state: DataFrame, key: str = "source", fingerprint: bool = False
) -> DataFrame:
    """Manifest rows that are not loaded yet.

    ``key="source"`` skips a source loaded anywhere; ``key="source,graph"`` loads
    it once per graph.  ``fingerprint`` also loads a file again whose length or
    modification time changed.
    """
    if key == "source":
        todo = first_per_source(manifest)
        done = load_state.select(
            F.col("source").alias("__source"), F.col("length").alias("__length"), F.col("modified").alias("__modified"))
        on = F.col("source") == F.col("__source")
    elif key == "source,graph":
        todo = manifest.dropDuplicates(["source", "g"])
        # The default graph is an empty list in the state.
        done = load_state.select(
            F.col("source").alias("__source"), F.explode_outer("graphs").alias("__g"),
            F.col("length").alias("__length"), F.col("modified").alias("__modified"))
        on = (F.col("source") == F.col("__source")) & F.col("g").eqNullSafe(F.col("__g"))
    else:
        raise ValueError("key is 'source' or 'source,graph'")
    if fingerprint:
        on = on & F.col("length").eqNullSafe(F.col("__length")) & F.col("modified").eqNullSafe(F.col("__modified"))
    return todo.join(done, on, "left_anti")


def _base_type() -> Column:
    return F.element_at(F.split(F.regexp_replace("type", r"\.(?:gz|bz2)$", ""), r"\."), -1)


def scan_all(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Quads and malformed lines of all files of a manifest, with ``source`` and the graph ``target``.

    The paths go through the driver, as in every file scan; ``run_load`` scans
    a bounded number at a time.
    """
    kinds = manifest.select("source", _base_type().alias("kind")).distinct()
    paths: dict[bool, list[str]] = {True: [], False: []}
    for row in kinds.toLocalIterator():
        if row.kind in UNPARSED_TYPES:
            raise ValueError(f"no parser for type {row.kind}: {row.source}")
        paths[row.kind in BLOCK_TYPES].append(row.source)
    columns = ["source", *QUAD_COLUMNS, "reject"]
    parts = []
    if paths[False]:
        parts.append(scan_rdf_lines(spark, paths[False]).select(*columns))
    if paths[True]:
        parts.append(scan_trig_blocks(spark, paths[True]).select(*columns))
    if not parts:
        return spark.createDataFrame([], ", ".join(f"{c} string" for c in [*columns, "target"]))
    graphs = manifest.select(F.col("source").alias("__source"), F.col("g").alias("target"))
    placed = reduce(DataFrame.unionByName, parts).join(graphs, F.col("source") == F.col("__source"))
    return placed.withColumn("g", F.coalesce("target", "g")).select(*columns, "target")


def load_all(spark: SparkSession, manifest: DataFrame, on_reject: str = "fail") -> DataFrame:
    """Quads of all files of a manifest, each in its graph, as one scan.

    A file whose manifest row names no graph keeps the graph names of its quads.
    """
    return accepted(scan_all(spark, manifest), on_reject).select(*QUAD_COLUMNS, "source")


def state_rows(loaded: DataFrame, number: int = 0) -> DataFrame:
    """State of loaded manifest rows; the default graph leaves ``graphs`` empty and is an empty target."""
    return loaded.groupBy("source").agg(
        F.sort_array(F.collect_set("g")).alias("graphs"), F.max("length").alias("length"),
        F.max("modified").alias("modified"), F.current_timestamp().alias("loaded_at"),
        F.collect_set(F.coalesce("g", F.lit(""))).alias("targets"), F.lit(number).cast("bigint").alias("load"))


def record_load(loaded: DataFrame, path: str, number: int = 0) -> None:
    """Append the loaded manifest rows to the state table."""
    state_rows(loaded, number).write.mode("append").parquet(path)


def load_state_triples(load_state: DataFrame) -> DataFrame:
    """The state as triples: the state has a load, a load has a file and graphs."""
    node = F.concat(F.lit("load-"), F.substring(F.sha2("source", 256), 1, 16))
    node = F.concat(node, F.lit("-"), F.substring(F.sha2(F.array_join("graphs", "\u0001"), 256), 1, 8))

    def triple(s, s_kind, p, o, o_kind, dt=None):
        return F.struct(
            s.alias("s"), F.lit(s_kind).alias("s_kind"), F.lit(p).alias("p"), o.alias("o"),
            F.lit(o_kind).alias("o_kind"), (F.lit(dt) if dt else null()).alias("o_dt"), null().alias("o_lang"),
            null().alias("g"))

    fixed = F.array(
        triple(F.lit(STATE_IRI), IRI, LOAD, node, BNODE),
        triple(node, BNODE, FILE, F.col("source"), LITERAL, XSD_STRING),
    )
    graphs = F.transform("graphs", lambda g: triple(node, BNODE, GRAPH, g, IRI))
    return load_state.select(F.inline(F.concat(fixed, graphs))).dropDuplicates()


def read_loaded(spark: SparkSession, table: str, state: str) -> DataFrame:
    """The loaded dataset as a set: of each file and graph, what the latest load has brought."""
    columns = [*QUAD_COLUMNS, "p_key", "source", "target"]
    schema = ", ".join(f"{c} string" for c in columns) + ", load bigint"
    if not path_exists(spark, table):
        return spark.createDataFrame([], schema).select(*columns[:-2])
    latest = read_load_state(spark, state).select(
        F.col("source").alias("__source"), F.explode("targets").alias("__target"), "load").groupBy(
        "__source", "__target").agg(F.max("load").alias("__load"))
    rows = spark.read.schema(schema).parquet(table)
    current = (F.col("source") == F.col("__source")) & (F.coalesce("target", F.lit("")) == F.col("__target")) & (
        F.col("load") == F.col("__load"))
    return rows.join(latest, current, "left_semi").select(*columns[:-2]).dropDuplicates()


def read_kept_rejects(spark: SparkSession, table: str) -> DataFrame:
    """Malformed lines (load, source, reject) of files that ``on_reject="keep"`` has left pending."""
    return spark.read.schema("source string, reject string, load bigint").parquet(f"{table}_rejects")


def _load_part(spark: SparkSession, todo: DataFrame, table: str, state: str, on_reject: str) -> int:
    """Load the files of some manifest rows as the next part; returns how many rows were loaded."""
    number = (read_load_state(spark, state).agg(F.max("load")).first()[0] or 0) + 1
    part, extra = f"{table}/load={number}", ("source", "target")
    scanned = scan_all(spark, todo)
    if on_reject == "fail":
        write_quad_table(accepted(scanned), part, "OVERWRITE", extra=extra)
    else:
        staged = f"{table}_staged"
        save(scanned, staged, "OVERWRITE")
        scanned = spark.read.schema(scanned.schema).parquet(staged)
        rejects = scanned.filter(F.col("reject").isNotNull()).select("source", "reject")
        save(rejects, f"{table}_rejects/load={number}", "OVERWRITE")
        bad = rejects.select("source").distinct()
        write_quad_table(scanned.join(bad, "source", "left_anti"), part, "OVERWRITE", extra=extra)
        todo = todo.join(bad, "source", "left_anti")
    record_load(todo, state, number)
    return todo.count()


def run_load(
    spark: SparkSession, manifest: DataFrame, table: str, state: str, published: str | None = None,
    key: str = "source", fingerprint: bool = False, on_reject: str = "fail", files_per_load: int = 100_000,
) -> int:
    """Load the pending files into a quad table; returns how many were loaded.

    Files are loaded in the order of their names, so many at a time, each time
    as a numbered part of the table: a repeated run after a failure goes on with
    the same number and overwrites that part.  With ``on_reject="keep"``, files
    with malformed lines stay pending.
    """
    if on_reject not in ("fail", "keep"):
        raise ValueError("on_reject is 'fail' or 'keep'")
    todo = pending(manifest, read_load_state(spark, state), key, fingerprint)
    part_state = f"{state}_pending"
    save(todo, part_state, "OVERWRITE")
    todo = spark.read.schema(todo.schema).parquet(part_state)
    count, last = 0, ""
    while True:
        # The paths of one part go through the driver, and no more.
        names = todo.select("source").filter(F.col("source") > last).distinct().orderBy("source").limit(files_per_load)
        until = names.agg(F.max("source")).first()[0]
        if until is None:
            break
        some = todo.filter((F.col("source") > last) & (F.col("source") <= until))
        count += _load_part(spark, some, table, state, on_reject)
        last = until
    if published is not None:
        publish_if_changed(spark, read_loaded(spark, table, state).select(*QUAD_COLUMNS), published, count > 0)
    return count
