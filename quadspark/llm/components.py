"""Connected components by label propagation with hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadspark.llm.tables import stored


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in the links (a, b); component is the least id reachable.

    Every round, a vertex and the root it points to take the least label of the
    vertex's neighbours, and then the label of their label.  Minima combine
    before the shuffle, and labels are a table, so joins split hot vertices.
    """
    both = links.select("a", "b").where("a <> b").distinct()
    both = stored(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))), "llm-links")
    labels = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("label"))
    labels = stored(labels.select("id", F.least("id", "label").alias("label")), "llm-labels")
    while True:
        seen = both.join(labels, both.a == labels.id).select(
            F.col("b").alias("id"), "label", F.lit(None).cast("long").alias("old"))
        best = labels.select("id", "label", F.col("label").alias("old")).unionByName(seen)
        best = stored(best.groupBy("id").agg(F.min("label").alias("label"), F.max("old").alias("old")), "llm-best")
        moved = best.where("label < old")
        if moved.isEmpty():
            return best.select("id", F.col("label").alias("component"))
        hooks = moved.select(F.col("old").alias("id"), "label")
        hooked = stored(best.select("id", "label").unionByName(hooks).groupBy("id").agg(
            F.min("label").alias("label")), "llm-hooked")
        roots = hooked.select(F.col("id").alias("label"), F.col("label").alias("root"))
        labels = stored(hooked.join(roots, "label", "left").select(
            "id", F.coalesce("root", "label").alias("label")), "llm-labels")
