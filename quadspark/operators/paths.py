"""Property paths.

A path is a solution DataFrame with two variables; ``hop`` makes one from a
predicate, the other functions compose them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadspark.functions.terms import BNODE, IRI, SUFFIXES, columns_of
from quadspark.operators.patterns import DEFAULT_GRAPH, join, match, project
from quadspark.session import scratch_path

DISTANCE = "__distance"
#: Work that doubling the distance may take, as a multiple of what the single steps it saves take now.
WORTH = 4


def hop(graph, predicate: str, start: str = "x", end: str = "y", g=DEFAULT_GRAPH) -> DataFrame:
    return match(graph, f"?{start}", predicate, f"?{end}", g=g)


def _rename(path: DataFrame, mapping: dict[str, str]) -> DataFrame:
    names = {}
    for old, new in mapping.items():
        for c in columns_of(path, old):
            names[c] = new + c[len(old):]
    return path.select(*(F.col(c).alias(names.get(c, c)) for c in path.columns))


def sequence(first: DataFrame, second: DataFrame, start: str = "x", end: str = "y") -> DataFrame:
    """``a / b``: end of the first path is the start of the second (a bag, as the language has it)."""
    left = _rename(first, {end: "__mid"})
    right = _rename(second, {start: "__mid"})
    return project(join(left, right), start, end)


def alternative(*paths: DataFrame, start: str = "x", end: str = "y") -> DataFrame:
    """``a | b``: bag union."""
    result = project(paths[0], start, end)
    for p in paths[1:]:
        result = result.unionByName(project(p, start, end), allowMissingColumns=True)
    return result


def inverse(path: DataFrame, start: str = "x", end: str = "y") -> DataFrame:
    """``^a``: ends exchanged; literals cannot be subjects of a further hop but stay values."""
    return _rename(path, {start: end, end: start})


def negated(graph, predicates: Sequence[str] = (), inverse_of: Sequence[str] = (), g=DEFAULT_GRAPH) -> DataFrame:
    """``!(a | ^b)``: pairs joined by any predicate but those named (a bag).

    Without ``inverse_of`` only forward triples count, and without
    ``predicates`` only backward ones, as the language has it.
    """
    if not predicates and not inverse_of:
        raise ValueError("a negated property set names at least one predicate")

    def others(start: str, end: str, names: Sequence[str]) -> DataFrame:
        triples = match(graph, f"?{start}", "?__p", f"?{end}", g=g)
        return project(triples.filter(~F.col("__p").isin(list(names))), "x", "y")

    parts = [others("x", "y", predicates)] if predicates else []
    parts += [others("y", "x", inverse_of)] if inverse_of else []
    return alternative(*parts)


def _pair_columns(df: DataFrame) -> DataFrame:
    """Pairs with all term columns on both sides, so that unions align."""
    columns = []
    for v in ("x", "y"):
        for suffix in ("", *SUFFIXES):
            c = v + suffix
            columns.append(F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c))
    return df.select(*columns)


def nodes(graph, g=DEFAULT_GRAPH) -> DataFrame:
    """Every subject and object of a graph with itself: the zero-length path."""
    triples = match(graph, "?s", "?p", "?o", g=g)
    ends = F.array(
        F.struct(F.col("s").alias("x"), F.col("s_kind").alias("x_kind"),
                 F.lit(None).cast("string").alias("x_dt"), F.lit(None).cast("string").alias("x_lang")),
        F.struct(F.col("o").alias("x"), F.col("o_kind").alias("x_kind"),
                 F.col("o_dt").alias("x_dt"), F.col("o_lang").alias("x_lang")),
    )
    unique = triples.select(F.inline(ends)).dropDuplicates()
    return unique.select("*", *(F.col("x" + suffix).alias("y" + suffix) for suffix in ("", *SUFFIXES)))


def zero_or_one(graph, path: DataFrame, g=DEFAULT_GRAPH) -> DataFrame:
    """``a?``: the path or the node itself, as a set."""
    return _pair_columns(path).unionByName(nodes(graph, g)).dropDuplicates()


def one_or_more(path: DataFrame, sources: DataFrame | None = None, max_steps: int | None = None) -> DataFrame:
    """``a+``: distinct reachable pairs.  Safe on cycles.

    Every pair is found with its distance.  When all pairs up to a distance are
    known, those at that very distance are continued: by one step, or by all
    known pairs, which doubles the distance.  The second is taken while it does
    not cost much more than the steps it saves, so long chains take a number of
    rounds that grows with the logarithm of their length, and dense graphs are
    walked step by step.  Rounds are written as tables below the shared
    checkpoint folder, which cuts the lineage and survives the loss of executors.

    ``sources`` (a DataFrame with variable ``x``) restricts the starting nodes;
    then only single steps are taken, as the pairs of other nodes are not known.
    ``max_steps`` guards a loop that should have ended; a longer path is an error.
    """
    spark = path.sparkSession
    root = scratch_path(spark, "reach")
    pairs = _pair_columns(path).dropDuplicates()
    columns = pairs.columns
    pairs = pairs.withColumn(DISTANCE, F.lit(1).cast("long"))
    schema = pairs.schema

    def table(*names: str) -> DataFrame:
        return spark.read.schema(schema).parquet(*(f"{root}/{n}" for n in names))

    rounds = ["round-0"]
    if sources is None:
        pairs.write.parquet(f"{root}/round-0")
    else:
        pairs.write.parquet(f"{root}/edges")
        edges = table("edges")
        wanted = sources.select(F.col("x").alias("__w"), F.col("x_kind").alias("__w_kind")).dropDuplicates()
        edges.join(wanted, (F.col("x") == F.col("__w")) & (F.col("x_kind") == F.col("__w_kind")), "left_semi").write.parquet(
            f"{root}/round-0")
    length = 1
    while True:
        known = table(*rounds)
        # Only resources have outgoing edges; literals end a path.
        ends = known.filter((F.col(DISTANCE) == length) & F.col("y_kind").isin(IRI, BNODE)).select(
            *(c for c in columns if c.startswith("x")),
            F.col("y").alias("__mid"), F.col("y_kind").alias("__mid_kind"))
        # Read once more, so that its columns are its own in the join.
        steps = (table(*rounds) if sources is None else edges).select(
            F.col("x").alias("__from"), F.col("x_kind").alias("__from_kind"),
            *(c for c in columns if c.startswith("y")), F.col(DISTANCE).alias("__by"))
        single, doubled = _work(ends, steps) if length > 1 else (1, 1)
        if not single:
            return known.select(*columns)
        by = length if sources is None and doubled <= WORTH * length * single else 1
        meet = (F.col("__mid") == F.col("__from")) & (F.col("__mid_kind") == F.col("__from_kind"))
        grown = ends.join(steps.filter(F.col("__by") <= by), meet).groupBy(*columns).agg(
            F.min(F.col("__by") + length).alias(DISTANCE))
        seen = table(*rounds)
        fresh = grown.join(seen, _all_equal(grown, seen, columns), "left_anti")
        rounds.append(f"round-{len(rounds)}")
        fresh.write.parquet(f"{root}/{rounds[-1]}")
        length += by
        if max_steps is not None and length > max_steps and table(rounds[-1]).filter(F.col(DISTANCE) > max_steps).take(1):
            raise RuntimeError(f"paths are longer than {max_steps} steps")


def _work(ends: DataFrame, steps: DataFrame) -> tuple[int, int]:
    """Rows that the ends give with single steps, and with all known pairs."""
    coming = ends.groupBy("__mid", "__mid_kind").count()
    going = steps.groupBy("__from", "__from_kind").agg(
        F.count_if(F.col("__by") == 1).alias("single"), F.count("*").alias("all"))
    # Sums in double: products of counts may leave the range of a long.
    count = F.col("count").cast("double")
    found = coming.join(going, (F.col("__mid") == F.col("__from")) & (F.col("__mid_kind") == F.col("__from_kind"))).agg(
        F.sum(count * F.col("single")).alias("single"), F.sum(count * F.col("all")).alias("all")).first()
    return found["single"] or 0, found["all"] or 0


def _all_equal(left: DataFrame, right: DataFrame, columns: Sequence[str]):
    on = (left["x"] == right["x"]) & (left["y"] == right["y"])
    for c in columns:
        if c not in ("x", "y"):
            on = on & left[c].eqNullSafe(right[c])
    return on


def zero_or_more(graph, path: DataFrame, g=DEFAULT_GRAPH) -> DataFrame:
    """``a*``: reachable pairs and every node with itself."""
    return one_or_more(path).unionByName(nodes(graph, g)).dropDuplicates()
