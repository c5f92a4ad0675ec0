"""Benchmark run plans and their metadata."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadspark.functions.terms import (
    IRI,
    LITERAL,
    QUAD_COLUMNS,
    RDF_TYPE,
    XSD_DATETIME,
    XSD_INTEGER,
    XSD_STRING,
    null,
)
from quadspark.operators.graphs import content_hash, dataset_label, skolem_iri

# Our vocabulary for experiments.
EXP = "http://example.org/experiment#"


def run_plan(queries: DataFrame, warmup_runs: int = 1, runs: int = 1) -> DataFrame:
    """Every query in every run; warm-up runs have negative ids, run 0 is the first measured one."""
    first = -max(warmup_runs, 0)
    if runs <= first:
        return queries.withColumn("run_id", F.lit(0)).limit(0)
    ids = F.sequence(F.lit(first), F.lit(runs - 1))
    return queries.select("*", F.explode(ids).alias("run_id"))


def limit_warmup(plan: DataFrame, limit: int | None, position: str = "seq") -> DataFrame:
    """Only the first ``limit`` queries in warm-up runs; null or negative means all.

    ``position`` orders the queries and is dense from 0, as ``read_query_log``
    numbers them; use ``with_position`` for a log without one.
    """
    if limit is None or limit < 0:
        return plan
    return plan.filter((F.col("run_id") >= 0) | (F.col(position) < limit))


def with_position(queries: DataFrame, limit: int | None, *order: str) -> DataFrame:
    """Mark the first ``limit`` queries by a position below ``limit``, all others by ``limit``.

    ``order`` names columns that identify a query; equal queries share the
    position of the first.  Only the first rows are ranked, found by a
    distributed top-k.  A null or negative limit means all, as in
    ``limit_warmup``: every position is 0.
    """
    if limit is None or limit < 0:
        return queries.withColumn("seq", F.lit(0).cast("bigint"))
    keys = list(order)
    first = queries.select(*(F.col(k).alias(f"__{k}") for k in keys)).orderBy(*(f"__{k}" for k in keys)).limit(limit)
    # The window has no partition: it ranks the first rows only.
    rank = F.row_number().over(Window.orderBy(*first.columns)).cast("bigint") - 1
    ranked = first.withColumn("seq", rank).groupBy(*first.columns).agg(F.min("seq").alias("seq"))
    on = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys))
    return queries.join(ranked, on, "left").select(
        *queries.columns, F.coalesce("seq", F.lit(limit).cast("bigint")).alias("seq"))


def gate_warmup(records: DataFrame, warmup_log: bool = True) -> DataFrame:
    """Drop warm-up records unless they are logged."""
    return records if warmup_log else records.filter(F.col("run_id") >= 0)


def run_metadata(plan: DataFrame, base_iri: str, timestamp: Column) -> DataFrame:
    """Config, execution and run resources of every experiment, one named graph each.

    ``plan`` has ``dataset_id``, ``service_url`` and ``run_id`` (other columns are
    ignored).  Identifiers are hashes of the content and link the levels.
    """
    stamp = timestamp.cast("string")
    config_keys = [F.col("dataset_id"), F.col("service_url"), F.lit(base_iri)]
    runs = plan.select("dataset_id", "service_url", "run_id").dropDuplicates()
    config = skolem_iri(base_iri, "config", content_hash(config_keys))
    runs = runs.withColumns({"config": config, "stamp": stamp})
    runs = runs.withColumn("exec", skolem_iri(base_iri, "exec", content_hash([F.col("config"), F.col("stamp")])))
    runs = runs.withColumn("run", skolem_iri(
        base_iri, "run", content_hash([F.col("exec"), F.col("run_id").cast("string")])))
    configs = runs.dropDuplicates(["config"])
    configs = _resource(configs, "config", "Config", [
        ("identifier", F.col("dataset_id"), LITERAL, XSD_STRING),
        ("label", dataset_label(F.col("dataset_id")), LITERAL, XSD_STRING),
        ("service", F.col("service_url"), IRI, None),
        ("baseIri", F.lit(base_iri), IRI, None),
    ])
    execs = _resource(runs.dropDuplicates(["exec"]), "exec", "Execution", [
        ("config", F.col("config"), IRI, None),
        ("timestamp", F.col("stamp"), LITERAL, XSD_DATETIME),
    ])
    run_rows = _resource(runs, "run", "Run", [
        ("exec", F.col("exec"), IRI, None),
        ("runId", F.col("run_id").cast("string"), LITERAL, XSD_INTEGER),
        ("timestamp", F.col("stamp"), LITERAL, XSD_DATETIME),
    ])
    return configs.unionByName(execs).unionByName(run_rows)


def _resource(df: DataFrame, node: str, cls: str, properties: list[tuple]) -> DataFrame:
    rows = [(RDF_TYPE, F.lit(EXP + cls), IRI, None), *((EXP + p, *rest) for p, *rest in properties)]
    structs = [
        F.struct(F.lit(p).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"),
                 (F.lit(dt) if dt else null()).alias("o_dt"))
        for p, o, kind, dt in rows
    ]
    quads = df.select(F.col(node).alias("s"), F.inline(F.array(*structs))).filter(F.col("o").isNotNull())
    return quads.select(
        "s", F.lit(IRI).alias("s_kind"), "p", "o", "o_kind", "o_dt", null().alias("o_lang"),
        F.col("s").alias("g")).select(*QUAD_COLUMNS)
