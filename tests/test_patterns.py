"""Solution algebra on small inputs, checked against brute force."""

import itertools
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quadspark.functions.terms import IRI, QUAD_SCHEMA, XSD_INTEGER, Literal, mark_unbound, maybe_unbound, term
from quadspark.operators import paths
from quadspark.operators.patterns import (
    ANY_GRAPH,
    bgp,
    bind,
    exists,
    filter_,
    join,
    match,
    minus,
    not_exists,
    optional,
    order_by,
    project,
    star,
    union,
    values,
)


def quads(spark, *rows):
    """Rows ``(s, p, o)`` or ``(s, p, o, g)``; an object is an IRI, a Literal or ``_:label``."""
    out = []
    for s, p, o, *g in rows:
        s_kind = "bnode" if s.startswith("_:") else "iri"
        if isinstance(o, Literal):
            obj = (o.value, "literal", o.datatype, o.lang)
        else:
            obj = (o, "bnode" if o.startswith("_:") else "iri", None, None)
        out.append((s, s_kind, p, *obj, g[0] if g else None))
    return spark.createDataFrame(out, QUAD_SCHEMA)


def solutions(spark, names, rows):
    flat = [tuple(x for v in row for x in (v, None if v is None else "iri")) for row in rows]
    schema = ", ".join(f"{n} string, {n}_kind string" for n in names)
    df = spark.createDataFrame(flat, schema)
    return mark_unbound(df, [n for i, n in enumerate(names) if any(r[i] is None for r in rows)])


def compatible(a, b):
    return all(a[v] == b[v] or a[v] is None or b[v] is None for v in a.keys() & b.keys())


def common(a, b):
    return any(a[v] is not None and b[v] is not None for v in a.keys() & b.keys())


def bag(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


cell = st.sampled_from([None, "a", "b"])
left_rows = st.lists(st.tuples(st.sampled_from(["k", "m"]), cell, cell), min_size=1, max_size=6)
right_rows = st.lists(st.tuples(st.sampled_from(["k", "m"]), cell, cell), min_size=1, max_size=6)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(left_rows, right_rows)
def test_unbound_variables_match_brute_force(spark, lrows, rrows):
    left = solutions(spark, ["k", "x", "y"], lrows)
    right = solutions(spark, ["k", "x", "z"], rrows)
    ls = [dict(zip("kxy", r, strict=True)) for r in lrows]
    rs = [dict(zip("kxz", r, strict=True)) for r in rrows]

    def merged(a, b):
        return tuple(a.get(v) if a.get(v) is not None else b.get(v) for v in "kxyz")

    pairs = [merged(a, b) for a, b in itertools.product(ls, rs) if compatible(a, b)]
    assert bag(join(left, right), *"kxyz") == sorted(pairs, key=str)
    kept = [a for a in ls if not any(compatible(a, b) for b in rs)]
    rest = [(a["k"], a["x"], a["y"], None) for a in kept]
    assert bag(optional(left, right), *"kxyz") == sorted(pairs + rest, key=str)
    assert bag(not_exists(left, right), *"kxy") == sorted((tuple(a.values()) for a in kept), key=str)
    assert bag(exists(left, right), *"kxy") == sorted(
        (tuple(a.values()) for a in ls if any(compatible(a, b) for b in rs)), key=str)
    left2, right2 = project(left, "x", "y"), project(right, "x", "z")
    ls2, rs2 = [{v: a[v] for v in "xy"} for a in ls], [{v: b[v] for v in "xz"} for b in rs]
    assert bag(minus(left2, right2), *"xy") == sorted(
        (tuple(a.values()) for a in ls2 if not any(compatible(a, b) and common(a, b) for b in rs2)), key=str)


@pytest.mark.parametrize("n", [3, 8])
def test_many_unbound_variables(spark, n):
    """Masks as data: any number of loose variables, in one plan."""
    rng, names = random.Random(n), [f"v{i}" for i in range(n)]

    def side(last, size):
        forms = [[rng.random() < 0.6 for _ in names] for _ in range(4)]
        rows = []
        for _ in range(size):
            form = rng.choice(forms)
            rows.append(("k" if rng.random() < 0.7 else "m", *(rng.choice("ab") if f else None for f in form), rng.choice("xy")))
        return rows, ["k", *names, last], solutions(spark, ["k", *names, last], rows)

    lrows, lnames, left = side("p", 14)
    rrows, rnames, right = side("q", 14)
    ls, rs = ([dict(zip(ns, r, strict=True)) for r in rows] for rows, ns in ((lrows, lnames), (rrows, rnames)))
    everything = [*lnames, "q"]

    def merged(a, b):
        return tuple(a.get(v) if a.get(v) is not None else b.get(v) for v in everything)

    pairs = [merged(a, b) for a, b in itertools.product(ls, rs) if compatible(a, b)]
    kept = [a for a in ls if not any(compatible(a, b) for b in rs)]
    joined = join(left, right)
    assert bag(joined, *everything) == sorted(pairs, key=str) and pairs
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
    assert bag(optional(left, right), *everything) == sorted(pairs + [merged(a, {}) for a in kept], key=str)
    assert bag(not_exists(left, right), *lnames) == sorted((tuple(a.values()) for a in kept), key=str)
    assert bag(exists(left, right), *lnames) == sorted(
        (tuple(a.values()) for a in ls if any(compatible(a, b) for b in rs)), key=str)
    chosen = [a for a in ls if any(compatible(a, b) and b["q"] == "x" for b in rs)]
    assert bag(exists(left, right, F.col("q") == "x"), *lnames) == sorted((tuple(a.values()) for a in chosen), key=str)
    left2, right2 = project(left, *names), project(right, *names)
    ls2, rs2 = [{v: a[v] for v in names} for a in ls], [{v: b[v] for v in names} for b in rs]
    assert bag(minus(left2, right2), *names) == sorted(
        (tuple(a.values()) for a in ls2 if not any(compatible(a, b) and common(a, b) for b in rs2)), key=str)
    assert bag(not_exists(left2, right2), *names) == sorted(
        (tuple(a.values()) for a in ls2 if not any(compatible(a, b) for b in rs2)), key=str)
    assert all(maybe_unbound(joined, v) for v in names if any(r[v] is None for r in ls) and any(r[v] is None for r in rs))
    assert bag(join(left.limit(0), right), *everything) == []


def test_rows_written_for_each_mask_are_not_broadcast(spark):
    names, rows = ["k", "a", "b", "c"], [("k", "x", None, "z"), ("k", None, "y", "z"), ("k", None, None, None)]
    left, right = (solutions(spark, [*names, last], [(*r, "v") for r in rows]) for last in "pq")
    for found in (join(left, right), exists(left, right), not_exists(left, right)):
        plan = found._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_many_unbound_variables_with_nothing_in_common(spark):
    names = ["a", "b", "c"]
    left = solutions(spark, names, [("x", None, None), (None, "y", "z")])
    right = solutions(spark, names, [(None, "y", None), ("x", None, None)])
    with pytest.raises(ValueError, match="no bound variable"):
        join(left, right)
    assert join(left, right, allow_product=True).count() == 4


def test_terms_of_different_type_do_not_join(spark):
    g = quads(spark, ("s", "p", Literal("1", XSD_INTEGER)), ("t", "q", Literal("1")), ("u", "q", Literal("1", XSD_INTEGER)),
              ("v", "q", Literal("1", lang="en")), ("w", "q", "1"))
    sol = bgp(g, [("?a", "p", "?x"), ("?b", "q", "?x")])
    assert bag(sol, "a", "b") == [("s", "u")]


def test_object_joins_subject_only_as_a_resource(spark):
    g = quads(spark, ("a", "p", "b"), ("c", "p", Literal("b")), ("b", "q", "d"))
    assert bag(bgp(g, [("?x", "p", "?y"), ("?y", "q", "?z")]), "x", "z") == [("a", "d")]


def test_default_named_and_any_graph(spark):
    g = quads(spark, ("a", "p", "b"), ("a", "p", "b", "g1"), ("c", "p", "d", "g2"))
    assert bag(match(g, "?s", "p", "?o"), "s", "o") == [("a", "b")]
    assert bag(match(g, "?s", "p", "?o", g="g2"), "s", "o") == [("c", "d")]
    assert bag(match(g, "?s", "p", "?o", g="?g"), "s", "g") == [("a", "g1"), ("c", "g2")]
    assert bag(match(g, "?s", "p", "?o", g=ANY_GRAPH), "s", "o") == [("a", "b"), ("c", "d")]


def test_disconnected_patterns_are_refused(spark):
    g = quads(spark, ("a", "p", "b"))
    with pytest.raises(ValueError, match="cross product"):
        bgp(g, [("?a", "p", "?b"), ("?c", "p", "?d")])
    with pytest.raises(ValueError, match="no variable"):
        join(match(g, "?a", "p", "?b"), match(g, "?c", "p", "?d"))


def test_joins_are_equi_joins(spark):
    g = quads(spark, ("a", "p", "b"), ("b", "q", "c"))
    base = match(g, "?x", "p", "?y")
    loose = optional(base, match(g, "?y", "q", "?z"))
    other = union(match(g, "?y", "q", "?z"), match(g, "?y", "q", "?w"))
    plan = join(loose, other)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_star_is_one_aggregation_and_rejects_second_values(spark):
    g = quads(spark, ("a", "p", "x"), ("a", "q", Literal("1")), ("b", "p", "y"))
    sol = star(g, "s", {"p": "x", "q": "n"}, optional=["n"])
    assert bag(sol, "s", "x", "n") == [("a", "x", "1"), ("b", "y", None)]
    assert maybe_unbound(sol, "n") and not maybe_unbound(sol, "x")
    assert bag(star(g, "s", {"p": "x", "q": "n"}), "s") == [("a",)]
    with pytest.raises(Exception, match="more than one value"):
        star(quads(spark, ("a", "p", "x"), ("a", "p", "y")), "s", {"p": "x"}).collect()


def test_optional_condition_belongs_to_the_join(spark):
    g = quads(spark, ("a", "p", "b"), ("c", "p", "d"), ("b", "q", Literal("5", XSD_INTEGER)), ("d", "q", Literal("x", XSD_INTEGER)))
    values_ = match(g, "?y", "q", "?n")
    sol = optional(match(g, "?x", "p", "?y"), values_, F.col("n").try_cast("int") > 3)
    assert bag(sol, "x", "n") == [("a", "5"), ("c", None)]


def test_order_of_kinds_and_numbers(spark):
    rows = [("s", "p", Literal("10", XSD_INTEGER)), ("s", "p", Literal("9", XSD_INTEGER)), ("s", "p", Literal("b")),
            ("s", "p", "iri"), ("s", "p", "_:n")]
    sol = match(quads(spark, *rows), "?s", "p", "?o")
    ordered = [r.o for r in order_by(union(sol, match(quads(spark, ("t", "p", "z")), "?s", "p", "?q")), "o").collect()]
    assert ordered[:3] == [None, "_:n", "iri"]
    assert ordered.index("9") < ordered.index("10")


def test_values_with_an_unbound_cell(spark):
    table = values(spark, ["y", "c"], [("b", Literal("one")), (None, Literal("any"))])
    g = quads(spark, ("a", "p", "b"), ("c", "p", "d"))
    with pytest.raises(ValueError, match="no bound variable"):
        join(match(g, "?x", "p", "?y"), table)
    sol = join(match(g, "?x", "p", "?y"), table, allow_product=True)
    assert bag(sol, "x", "y", "c") == [("a", "b", "any"), ("a", "b", "one"), ("c", "d", "any")]


def test_bind_errors_are_unbound(spark):
    from quadspark.functions import scalars as fn

    sol = match(quads(spark, ("a", "p", Literal("no number", XSD_INTEGER))), "?s", "p", "?o")
    sol = bind(sol, "n", fn.abs_(term(sol, "o")))
    assert [r.n for r in sol.collect()] == [None]
    assert filter_(sol, fn.integer(term(sol, "o")) > 0).count() == 0


def test_reachability_on_a_cycle(spark):
    g = quads(spark, ("a", "n", "b"), ("b", "n", "c"), ("c", "n", "a"), ("c", "n", Literal("end")), ("d", "n", "a"))
    path = paths.hop(g, "n")
    reached = bag(paths.one_or_more(path), "x", "y")
    cycle = [(x, y) for x in "abcd" for y in ("a", "b", "c", "end")]
    assert reached == sorted(cycle, key=str)
    only_a = match(quads(spark, ("a", "t", "t")), "?x", "t", "t")
    assert bag(paths.one_or_more(path, sources=only_a), "x", "y") == sorted(
        [p for p in cycle if p[0] == "a"], key=str)
    with pytest.raises(RuntimeError):
        paths.one_or_more(path, max_steps=1)


def _closure(edges):
    """Brute force: pairs with a path of at least one edge."""
    following = {}
    for x, y in edges:
        following.setdefault(x, set()).add(y)
    pairs = set()
    for x in following:
        todo = list(following[x])
        while todo:
            y = todo.pop()
            if (x, y) not in pairs:
                pairs.add((x, y))
                todo += following.get(y, ())
    return pairs


def _edges(spark, edges):
    return spark.createDataFrame(
        [(str(x), IRI, str(y), IRI) for x, y in edges], "x string, x_kind string, y string, y_kind string")


def test_reachability_of_any_shape(spark):
    rng = random.Random(5)
    dense = [(rng.randrange(30), rng.randrange(30)) for _ in range(120)]
    ring = [(i, (i + 1) % 17) for i in range(17)] + [(40 + i, 41 + i) for i in range(7)] + [(47, 3), (5, 5)]
    ring += [(200 + i, 99) for i in range(50)] + [(99, 100 + i) for i in range(50)] + [(120, 3)]
    for edges in (dense, ring):
        want = sorted((str(x), str(y)) for x, y in _closure(edges))
        assert bag(paths.one_or_more(_edges(spark, edges * 2)), "x", "y") == sorted(want, key=str)
    some = _edges(spark, [(41, 0), (77, 0)]).select("x", "x_kind")
    assert bag(paths.one_or_more(_edges(spark, ring), sources=some), "x", "y") == sorted(
        [(str(x), str(y)) for x, y in _closure(ring) if x in (41, 77)], key=str)


def test_long_chains_take_few_rounds(spark, monkeypatch):
    measured = []
    work = paths._work
    monkeypatch.setattr(paths, "_work", lambda *a: measured.append(1) or work(*a))
    chain = spark.range(700).select(
        F.col("id").cast("string").alias("x"), F.lit(IRI).alias("x_kind"),
        (F.col("id") + 1).cast("string").alias("y"), F.lit(IRI).alias("y_kind"))
    reached = paths.one_or_more(chain)
    assert reached.count() == 700 * 701 // 2 == reached.where("cast(x as int) < cast(y as int)").distinct().count()
    assert len(measured) <= 11
    assert paths.one_or_more(chain.where("cast(x as int) < 8"), max_steps=8).count() == 36
    with pytest.raises(RuntimeError):
        paths.one_or_more(chain.where("cast(x as int) < 9"), max_steps=8)


def test_zero_length_paths_include_every_node(spark):
    g = quads(spark, ("a", "n", "b"), ("a", "m", Literal("x")))
    assert bag(paths.zero_or_more(g, paths.hop(g, "n")), "x", "y") == [
        ("a", "a"), ("a", "b"), ("b", "b"), ("x", "x")]
