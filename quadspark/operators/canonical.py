"""Names for blank nodes that depend on the graph only, by colour refinement.

A blank node's colour is the hash of its earlier colour and of the set of its
triples, in which other blank nodes stand with their colours.  Rounds go on
until they tell no more nodes apart.  The sets are summed hashes, so they
combine before the shuffle and a hub is no group in one task.  At the end, each
colour takes in those of all nodes that hang together with it by blank nodes.

Nodes that stay alike:  parts of the graph that hang together by such nodes are
compared.  A part whose own nodes all differ is a copy of every part with the
same colours; copies say the same, and become one.  In a part that is alike in
itself, as a ring, one node of the smallest class is set apart and refinement
goes on.  Which one makes no difference where the nodes are images of each other
by symmetry; where they are alike to refinement and still differ (regular parts
without symmetry), labels decide.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadspark.functions.terms import BNODE, as_quads
from quadspark.operators.graphs import renamed_blanks, set_digest, skolem_iri
from quadspark.sources.storage import stored_table

_SUMS = [f"__d{i}" for i in range(4)]


def _kept(df: DataFrame, name: str) -> DataFrame:
    return stored_table(df, f"colour-{name}")[0]


def _hash(*parts: Column | str) -> Column:
    return F.sha2(F.concat_ws("\u0001", *parts), 256)


def _incidence(quads: DataFrame) -> DataFrame:
    """Every triple of a blank node as (node, key, other, value); other is the blank node at its other end."""
    graph = F.when(F.startswith("g", F.lit("_:")), F.lit("_:")).otherwise(F.coalesce("g", F.lit("")))
    ends = {"s": F.array(F.lit("s"), "s_kind", "s", F.lit(""), F.lit("")),
            "o": F.array(F.lit("o"), "o_kind", "o", F.coalesce("o_dt", F.lit("")), F.coalesce("o_lang", F.lit("")))}
    rows = []
    for place, far in (("s", "o"), ("o", "s")):
        is_far = F.col(f"{far}_kind") == BNODE
        itself = is_far & (F.col("s") == F.col("o")) & (F.col(f"{place}_kind") == BNODE)
        other = F.when(is_far & ~itself, F.col(far))
        value = F.when(itself, F.lit("itself")).when(~is_far, F.concat_ws("\u0001", ends[far]))
        rows.append(F.when(F.col(f"{place}_kind") == BNODE, F.struct(
            F.col(place).alias("node"), _hash(F.lit(place), "p", graph).alias("key"), other.alias("other"), value.alias("value"))))
    return quads.select(F.explode(F.array(*rows)).alias("r")).where("r IS NOT NULL").select("r.*").distinct()


def _refined(colours: DataFrame, links: DataFrame) -> DataFrame:
    """One round: every node learns the colours of the nodes it is linked to."""
    far = colours.select(F.col("node").alias("other"), F.col("colour").alias("far"))
    sums = links.join(far, "other").groupBy("node").agg(*set_digest(F.concat_ws("\u0001", "key", "far")))
    return colours.join(sums, "node", "left").select(
        "node", _hash("colour", *(F.coalesce(c, F.lit("")) for c in _SUMS)).alias("colour"))


def _settled(colours: DataFrame, links: DataFrame) -> DataFrame:
    """Rounds until the number of colours stays; the last one makes colours tell their neighbours' classes."""
    known = colours.select("colour").distinct().count()
    while True:
        finer = _kept(_refined(colours, links), "round")
        now = finer.select("colour").distinct().count()
        if now == known:
            return finer
        colours, known = finer, now


def _parts(links: DataFrame) -> DataFrame:
    """(node, part) of the nodes in links; part is the least node that hangs together with it."""
    labels = _kept(links.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("part")), "parts")
    while True:
        near = links.join(labels.select(F.col("node").alias("other"), "part"), "other").select("node", "part")
        least = labels.unionByName(near).groupBy("node").agg(F.min("part").alias("part"))
        # A shortcut: the part of the part.
        above = labels.select(F.col("node").alias("part"), F.col("part").alias("above"))
        following = _kept(least.join(above, "part", "left").select("node", F.coalesce("above", "part").alias("part")), "parts")
        changed = following.join(labels.select("node", F.col("part").alias("old")), "node").where("part <> old")
        if changed.isEmpty():
            return following
        labels = following


def _set_apart(colours: DataFrame, links: DataFrame) -> DataFrame | None:
    """One node of every part that is alike in itself gets a colour of its own; None if there is no such part."""
    tied = _kept(colours.join(colours.groupBy("colour").count().where("count > 1").select("colour"), "colour"), "tied")
    inner = links.join(tied.select("node"), "node", "left_semi").join(
        tied.select(F.col("node").alias("other")), "other", "left_semi").select("node", "other").distinct()
    parts = _parts(_kept(inner, "ties"))
    classes = parts.join(tied, "node").groupBy("part", "colour").agg(F.count("*").alias("n"), F.min("node").alias("node"))
    first = classes.where("n > 1").groupBy("part").agg(F.min(F.struct("n", "colour", "node")).alias("least"))
    chosen = _kept(first.select(F.col("least.node").alias("node"), F.lit(True).alias("chosen")), "chosen")
    if chosen.isEmpty():
        return None
    return _kept(colours.join(chosen, "node", "left").select(
        "node", F.when(F.col("chosen"), _hash("colour", F.lit("first"))).otherwise(F.col("colour")).alias("colour")), "apart")


def blank_colours(quads: DataFrame) -> DataFrame:
    """(node, colour) of every blank node; equal colours mean that they say the same."""
    incidence = _kept(_incidence(as_quads(quads)), "incidence")
    links = incidence.where("other IS NOT NULL").select("node", "key", "other")
    ground = incidence.groupBy("node").agg(*set_digest(F.concat_ws("\u0001", "key", F.coalesce("value", F.lit("blank")))))
    colours = _settled(_kept(ground.select("node", _hash(*_SUMS).alias("colour")), "ground"), links)
    while (apart := _set_apart(colours, links)) is not None:
        colours = _settled(apart, links)
    # Rounds may end before news of a far node comes: the colours of all that hangs together tell the rest.
    whole = colours.join(_parts(_kept(links.select("node", "other").distinct(), "whole")), "node", "left").select(
        "node", "colour", F.coalesce("part", "node").alias("part"))
    digests = whole.groupBy("part").agg(*set_digest(F.col("colour")))
    return whole.join(digests, "part").select("node", _hash("colour", *_SUMS).alias("colour"))


def skolemize_graph(quads: DataFrame, base_iri: str, cls: str = "node") -> DataFrame:
    """Replace every blank node by an IRI made from what the graph says about it.

    Graphs that differ in labels and order of rows only give the same quads.
    Blank names of graphs stay.
    """
    quads = as_quads(quads).distinct()
    names = blank_colours(quads).select(F.col("node").alias("__b"), skolem_iri(base_iri, cls, F.col("colour")).alias("__iri"))
    has_blank = (F.col("s_kind") == BNODE) | (F.col("o_kind") == BNODE)
    replaced = quads.filter(has_blank)
    for place in ("s", "o"):
        replaced = renamed_blanks(replaced, names, place)
    return quads.filter(~has_blank).unionByName(replaced).dropDuplicates()
