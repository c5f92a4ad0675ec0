"""Ordered steps over one dataset whose results form one graph."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from quadspark.functions.terms import QUAD_SCHEMA, as_quads
from quadspark.operators.graphs import graph_union
from quadspark.sources.rdf import read_rdf_lines
from quadspark.sources.storage import stored_table

QueryStep = Callable[[DataFrame], DataFrame]


def run_script(
    spark: SparkSession, steps: Sequence[str | QueryStep], quads: DataFrame | None = None,
    distinct: bool = True, share: bool = True,
) -> DataFrame:
    """Run steps in order and join their results into one graph.

    A path step adds a file to the dataset that later steps see; a function step
    maps the dataset to quads.  ``share`` writes the dataset to the shared folder
    once for all query steps; without it every step scans the source, with only
    the columns it needs.
    """
    dataset = quads
    shared: DataFrame | None = None
    results: list[DataFrame] = []
    for step in steps:
        if isinstance(step, str):
            loaded = read_rdf_lines(spark, step)
            dataset = loaded if dataset is None else graph_union(dataset, loaded)
            shared = None
            continue
        if dataset is None:
            dataset = spark.createDataFrame([], QUAD_SCHEMA)
        if shared is None:
            shared = stored_table(dataset, "script")[0] if share else dataset
        results.append(as_quads(step(shared)))
    if not results:
        return spark.createDataFrame([], QUAD_SCHEMA)
    merged = reduce(lambda a, b: a.unionByName(b), results)
    return merged.dropDuplicates() if distinct else merged
