"""Whole-graph operators: set union, natural graphs, skolem IRIs, updates.

A graph is a set, so results that may repeat a quad are made distinct; repeats
collapse map-side before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadspark.functions.terms import BNODE, IRI, QUAD_COLUMNS, QUAD_SCHEMA, as_quads
from quadspark.operators.patterns import bgp, construct


def as_set(quads: DataFrame) -> DataFrame:
    return as_quads(quads).dropDuplicates()


# --- G1, G2, L2, G4 -------------------------------------------------------------

def graph_union(*graphs: DataFrame | None, spark: SparkSession | None = None) -> DataFrame:
    """Set union; ``None`` and repeated arguments are ignored, no graph is the empty graph."""
    unique: list[DataFrame] = []
    for g in graphs:
        if g is not None and not any(g is u for u in unique):
            unique.append(g)
    if not unique:
        return (spark or SparkSession.active()).createDataFrame([], QUAD_SCHEMA)
    return reduce(lambda a, b: a.unionByName(b), map(as_quads, unique)).dropDuplicates()


def into_graph(triples: DataFrame, g: str | Column | None) -> DataFrame:
    """Put triples into a graph; null or blank is the default graph."""
    name = F.lit(g).cast("string") if g is None or isinstance(g, str) else g
    return as_quads(triples.withColumn("g", F.nullif(F.trim(name), F.lit(""))))


def natural_graph(quads: DataFrame, resource: str = "s") -> DataFrame:
    """Triples in the graph named by their resource (a column)."""
    return as_quads(quads.withColumn("g", F.col(resource)))


def dataset_label(identifier: Column) -> Column:
    """Path-like label of a dataset id: scheme dropped, slashes become dashes."""
    path = F.regexp_replace(identifier, r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "")
    return F.translate(path, "/", "-")


# --- G3: skolem IRIs --------------------------------------------------------------

def content_hash(keys: Sequence[Column]) -> Column:
    """Hash of ordered key columns."""
    return F.sha2(F.concat_ws("\u0001", *keys), 256)


def skolem_iri(base: str, cls: str, digest: Column) -> Column:
    return F.concat(F.lit(f"{base}{cls}-"), digest)


def set_digest(row: Column) -> list[Column]:
    """Aggregates that identify a set of distinct rows whatever their order.

    Four 60-bit pieces of each row's SHA-256 are summed.  Sums combine
    map-side, so a node with many values never meets in one task as a list.
    """
    digest = F.sha2(row, 256)
    pieces = [F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10).cast("decimal(20,0)") for i in range(4)]
    return [F.sum(p).cast("string").alias(f"__d{i}") for i, p in enumerate(pieces)]


def skolemize(quads: DataFrame, base_iri: str, cls: str, keys: Sequence[str]) -> DataFrame:
    """Replace blank nodes by IRIs made from the values of their key predicates.

    Blank nodes without a key predicate stay as they are.  A key whose value is
    itself a blank node must have been replaced by an earlier call; for graphs
    whose blank nodes refer to each other see ``canonical.skolemize_graph``.
    """
    quads = as_quads(quads)
    content = quads.filter((F.col("s_kind") == BNODE) & F.col("p").isin(list(keys)))
    row = F.concat_ws("\u0001", "p", "o", "o_kind", F.coalesce("o_dt", F.lit("")), F.coalesce("o_lang", F.lit("")))
    sums = (
        content.select(F.col("s").alias("__b"), row.alias("__row")).dropDuplicates()
        .groupBy("__b").agg(*set_digest(F.col("__row")))
    )
    digest = content_hash([F.col(f"__d{i}") for i in range(4)])
    names = sums.select("__b", skolem_iri(base_iri, cls, digest).alias("__iri"))
    has_blank = (F.col("s_kind") == BNODE) | (F.col("o_kind") == BNODE)
    replaced = quads.filter(has_blank)
    for place in ("s", "o"):
        replaced = renamed_blanks(replaced, names, place)
    return quads.filter(~has_blank).unionByName(replaced).dropDuplicates()


def renamed_blanks(quads: DataFrame, names: DataFrame, place: str) -> DataFrame:
    # Terms that are no blank nodes get keys that match nothing and differ by
    # row: as nulls, or by a frequent value, they would meet in one task.
    other = F.concat(F.lit("-"), F.xxhash64(*QUAD_COLUMNS).cast("string"))
    label = F.when(F.col(f"{place}_kind") == BNODE, F.concat(F.lit("b"), F.col(place))).otherwise(other)
    keyed = names.select(F.concat(F.lit("b"), F.col("__b")).alias("__key"), "__iri")
    joined = quads.withColumn("__label", label).join(keyed, F.col("__label") == F.col("__key"), "left")
    return joined.select(*(
        F.coalesce("__iri", place).alias(c) if c == place
        else F.when(F.col("__iri").isNotNull(), IRI).otherwise(F.col(c)).alias(c) if c == f"{place}_kind"
        else F.col(c)
        for c in QUAD_COLUMNS
    ))


# --- X20: set operations ------------------------------------------------------------

def graph_intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    return as_quads(a).intersect(as_quads(b))


def graph_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return as_quads(a).subtract(as_quads(b))


# --- X18: updates as new snapshots ----------------------------------------------------

def insert_data(quads: DataFrame, new: DataFrame) -> DataFrame:
    return graph_union(quads, new)


def delete_data(quads: DataFrame, old: DataFrame) -> DataFrame:
    """Quads without those of ``old``; nulls (default graph, no language) compare equal."""
    left = as_quads(quads)
    right = as_quads(old).dropDuplicates()
    right = right.select(*(F.col(c).alias(f"__d_{c}") for c in QUAD_COLUMNS))
    on = (F.col("s") == F.col("__d_s")) & (F.col("p") == F.col("__d_p")) & (F.col("o") == F.col("__d_o"))
    for c in ("s_kind", "o_kind", "o_dt", "o_lang", "g"):
        on = on & F.col(c).eqNullSafe(F.col(f"__d_{c}"))
    return left.join(right, on, "left_anti")


def modify(
    quads: DataFrame, where: DataFrame, delete: Sequence[tuple] = (), insert: Sequence[tuple] = ()
) -> DataFrame:
    """``DELETE``/``INSERT ... WHERE``: both templates are filled from the same solutions."""
    result = as_quads(quads)
    if delete:
        result = delete_data(result, construct(where, delete))
    if insert:
        result = insert_data(result, construct(where, insert))
    return result


def delete_where(quads: DataFrame, patterns: Sequence[tuple]) -> DataFrame:
    return modify(quads, bgp(quads, patterns), delete=patterns)


# --- Q18, X19: graph-level updates -----------------------------------------------------

def move_to_graph(quads: DataFrame, pred: Column, g: str) -> DataFrame:
    """Move the quads that satisfy a condition to a named graph."""
    moved = F.when(pred, F.lit(g)).otherwise(F.col("g"))
    return as_quads(quads).withColumn("g", moved).dropDuplicates()


def _in_graph(g: str | None) -> Column:
    return F.col("g").eqNullSafe(F.lit(g).cast("string"))


def clear_graph(quads: DataFrame, g: str | None) -> DataFrame:
    return as_quads(quads).filter(~_in_graph(g))


def add_graph(quads: DataFrame, source: str | None, target: str | None) -> DataFrame:
    """Copy the quads of one graph into another that keeps its own; one pass over the input."""
    quads = as_quads(quads)
    if source == target:
        return quads
    graphs = F.when(_in_graph(source), F.array(F.col("g"), F.lit(target).cast("string")))
    graphs = graphs.otherwise(F.array(F.col("g")))
    return quads.select(*QUAD_COLUMNS[:-1], F.explode(graphs).alias("g")).dropDuplicates()


def copy_graph(quads: DataFrame, source: str | None, target: str | None) -> DataFrame:
    if source == target:
        return as_quads(quads)
    return add_graph(clear_graph(quads, target), source, target)


def move_graph(quads: DataFrame, source: str | None, target: str | None) -> DataFrame:
    quads = as_quads(quads)
    if source == target:
        return quads
    kept = clear_graph(quads, target)
    # The target was emptied, so no quad can meet a copy of itself there.
    return kept.withColumn("g", F.when(_in_graph(source), F.lit(target).cast("string")).otherwise(F.col("g")))
