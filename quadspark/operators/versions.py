"""A stored graph whose updates write only what they change.

Below its folder a graph has numbered *bases* (whole graphs as quad tables),
numbered *parts* (the rows that one update inserts or deletes, or the graphs
that it clears) and a *log* of what is complete.  The state after number n is
the latest base up to n, changed by the parts behind it; of each quad its latest
row counts.  An update that fails before its log row is written has not
happened, and the next one writes over its part.  Older numbers stay readable,
after a compaction too.  One writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadspark.functions.terms import QUAD_COLUMNS, as_quads
from quadspark.operators.patterns import bgp, construct, predicate_key
from quadspark.sinks.rdf import read_quad_table, write_quad_table

LOG_SCHEMA = "number bigint, kind string"
PART_SCHEMA = ", ".join(f"{c} string" for c in [*QUAD_COLUMNS, "p_key", "change"]) + ", number bigint"
INSERT, DELETE, CLEAR = "insert", "delete", "clear"


def create(df: DataFrame, path: str) -> int:
    """Store a graph as number 0; a folder that holds one already is refused."""
    spark = df.sparkSession
    write_quad_table(df, f"{path}/bases/base=0")
    _done(spark, path, 0, "base")
    return 0


def latest(spark: SparkSession, path: str) -> int:
    """Number of the last complete update."""
    return spark.read.schema(LOG_SCHEMA).parquet(f"{path}/log").agg(F.max("number")).first()[0]


def read_version(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The graph after an update, by default the last one, as a quad table with ``p_key``.

    The base is not shuffled while the parts behind it are small: its rows are
    looked up in theirs.  Conditions on predicates reach all scans.
    """
    log = spark.read.schema(LOG_SCHEMA).parquet(f"{path}/log")
    known = log if number is None else log.filter(F.col("number") <= number)
    found = known.agg(F.max("number").alias("last"), F.max(F.when(F.col("kind") == "base", F.col("number"))).alias("base")).first()
    if found["base"] is None or (number is not None and found["last"] != number):
        raise ValueError(f"{path} has no number {number}")
    base = read_quad_table(spark, f"{path}/bases/base={found['base']}")
    if found["last"] == found["base"]:
        return base
    parts = spark.read.schema(PART_SCHEMA).parquet(f"{path}/parts").filter(
        (F.col("number") > found["base"]) & (F.col("number") <= found["last"]))
    changed = parts.filter(F.col("change") != CLEAR).groupBy(*QUAD_COLUMNS, "p_key").agg(
        F.max_by("change", "number").alias("change"), F.max("number").alias("number"))
    cleared = parts.filter(F.col("change") == CLEAR).groupBy(F.col("g").alias("__g")).agg(F.max("number").alias("__number"))
    in_cleared = F.col("g").eqNullSafe(F.col("__g"))
    names = {c: f"__c_{c}" for c in [*QUAD_COLUMNS, "p_key"]}
    touched = changed.select(*(F.col(c).alias(n) for c, n in names.items()))
    kept = base.join(touched, _same(names), "left_anti").join(cleared, in_cleared, "left_anti")
    # A part clears before it inserts.
    added = changed.filter(F.col("change") == INSERT).join(
        cleared, in_cleared & (F.col("number") < F.col("__number")), "left_anti")
    return kept.unionByName(added.select(*kept.columns))


def _same(names: dict[str, str]) -> Column:
    on = F.lit(True)
    for c, n in names.items():
        plain = c in ("s", "p", "o", "p_key")
        on = on & (F.col(c) == F.col(n) if plain else F.col(c).eqNullSafe(F.col(n)))
    return on


def update(
    spark: SparkSession, path: str, delete: DataFrame | None = None, insert: DataFrame | None = None,
    clear: Sequence[str | None] = (),
) -> int:
    """Clear graphs, delete quads, then insert quads, as one update; returns its number.

    A quad that is deleted and inserted is there afterwards.  None among the
    graphs to clear is the default graph.  Writes a row per quad and graph given.
    """
    number = latest(spark, path) + 1
    rows = spark.createDataFrame([(g,) for g in clear], "g string").dropDuplicates().select(
        *(F.col(c) if c == "g" else F.lit(None).cast("string").alias(c) for c in QUAD_COLUMNS), F.lit(CLEAR).alias("change"))
    given = [as_quads(df).withColumn("change", F.lit(kind)) for df, kind in ((delete, DELETE), (insert, INSERT)) if df is not None]
    if given:
        quads = given[0] if len(given) == 1 else given[0].unionByName(given[1])
        # The greater of the two words is the insertion.
        rows = rows.unionByName(quads.groupBy(*QUAD_COLUMNS).agg(F.max("change").alias("change")))
    rows = rows.withColumn("p_key", predicate_key(F.col("p")))
    rows.sortWithinPartitions("p", "s", "o").write.mode("overwrite").parquet(f"{path}/parts/number={number}")
    _done(spark, path, number, "part")
    return number


def modify_version(
    spark: SparkSession, path: str, where: Sequence[tuple], delete: Sequence[tuple] = (), insert: Sequence[tuple] = ()
) -> int:
    """``DELETE``/``INSERT ... WHERE``: the last state answers the patterns, and fills both templates."""
    solutions = bgp(read_version(spark, path), where)
    return update(
        spark, path, construct(solutions, delete) if delete else None, construct(solutions, insert) if insert else None)


def copy_version(spark: SparkSession, path: str, source: str | None, target: str | None, move: bool = False) -> int:
    """The target graph becomes a copy of the source; ``move`` also clears the source."""
    if source == target:
        return latest(spark, path)
    quads = read_version(spark, path).filter(F.col("g").eqNullSafe(F.lit(source).cast("string")))
    quads = quads.withColumn("g", F.lit(target).cast("string"))
    return update(spark, path, insert=quads, clear=[target, source] if move else [target])


def compact(spark: SparkSession, path: str) -> int:
    """Write the last state as a base of its own, sorted by predicate, so that reading it needs no parts."""
    number = latest(spark, path)
    write_quad_table(read_version(spark, path, number), f"{path}/bases/base={number}", "OVERWRITE")
    _done(spark, path, number, "base")
    return number


def _done(spark: SparkSession, path: str, number: int, kind: str) -> None:
    spark.createDataFrame([(number, kind)], LOG_SCHEMA).coalesce(1).write.mode("append").parquet(f"{path}/log")
