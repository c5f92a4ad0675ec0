"""Templates read backwards and patterns over mapped tables, against the mapped triples."""

import itertools
import random

import pytest

from quadspark.functions.terms import LANG_STRING, RDF_TYPE, XSD_INTEGER, Literal
from quadspark.operators.inversion import equals, same
from quadspark.operators.mapping import (
    MappedGraph,
    TriplesMap,
    apply_mapping,
    apply_mappings,
    constant,
    expression,
    parent_ref,
    pom,
    reference,
    template,
)
from quadspark.operators.patterns import bgp, describe, match

E = "http://e/"
TEXTS = ["a", "a b", "é/ü", "1", "01", "a-b", "-", "", "%41", "x+y", "~*", "1-1", None, "it's \\", "𝄞"]


@pytest.fixture(scope="module")
def graph(spark):
    rng = random.Random(7)
    people = [(i, rng.choice(TEXTS), rng.choice([*range(5), None]), rng.choice(["en", "DE", None])) for i in range(40)]
    places = [(k, i % 3, rng.choice(TEXTS), float(i)) for i, k in enumerate(TEXTS)]
    towns = [(str(i), i - 2, rng.choice([*range(40), None])) for i in range(8)]
    sources = {
        "people": spark.createDataFrame(people, "id long, name string, boss int, tag string"),
        "places": spark.createDataFrame(places, "k string, n int, other string, x double"),
        "towns": spark.createDataFrame(towns, "code string, num int, mayor long"),
    }
    place = TriplesMap("places", template(E + "place/{k}"), [
        pom(E + "n", "n", XSD_INTEGER), pom(E + "near", template(E + "place/{other}")),
        pom(E + "mixed", template(E + "pair/{k}-{n}")), pom(E + "x", template(E + "x/{x}"))], [E + "Place"])
    person = TriplesMap("people", template(E + "person/{id}"), [
        pom(E + "name", "name"), pom(E + "boss", template(E + "person/{boss}")),
        pom(E + "says", "name", language=reference("tag")), pom(E + "label", "name", language="en"),
        pom(E + "lives", template(E + "place/{name}")), pom(E + "double", expression("id * 2"), XSD_INTEGER),
        pom(E + "pair", template(E + "pair/{id}-{boss}")), pom(E + "kind", constant(E + "Human")),
        pom(E + "same", "id", XSD_INTEGER)], [E + "Person"], unique=True)
    town = TriplesMap("towns", template(E + "place/{code}"), [
        pom(E + "n", "num", XSD_INTEGER), pom(E + "mayor", parent_ref(person, "mayor", "id")),
        pom(E + "twin", parent_ref(place, ["code", "num"], ["k", "n"])),
        pom(template(E + "dyn/{num}"), "code"), pom(E + "self", parent_ref(TriplesMap("towns", template(E + "t/{num}"))))],
        [E + "Place"])
    return MappedGraph(sources, [place, person, town])


def rows(df):
    columns = sorted(df.columns)
    return columns, sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def values(df, names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


IRIS = [E + "place/a%20b", E + "place/%C3%A9%2F%C3%BC", E + "place/a b", E + "place/", E + "place/%41", E + "place/%2541",
        E + "place/1", E + "place/01", E + "person/3", E + "person/03", E + "person/+3", E + "person/99999999999999999999",
        E + "pair/1-1", E + "pair/-1-1", E + "pair/a-b-2", E + "pair/1-1-1", E + "place/%c3%a9", E + "place/%FF", E + "x/1.0",
        E + "Human", E + "Place", "http://other/1", E + "place/a%20", E + "place/~%2A", E + "place/it%27s%20%5C"]


def test_constants_equal_the_full_scan(graph):
    quads = apply_mappings(graph.sources, graph.maps).collect()
    for iri in IRIS:
        about = sorted(((q.p, q.o) for q in quads if q.s == iri), key=str)
        assert values(describe(graph, iri), ["p", "o"]) == about, iri
        assert values(match(graph, "?s", "?p", iri), ["s", "p"]) == sorted(
            ((q.s, q.p) for q in quads if q.o == iri and q.o_kind == "iri"), key=str), iri
    literals = [Literal(t) for t in TEXTS if t is not None] + [
        Literal("1", XSD_INTEGER), Literal("01", XSD_INTEGER), Literal("99999999999", XSD_INTEGER),
        Literal("a", lang="en"), Literal("a b", lang="DE"), Literal("1", lang="fr")]
    for x in literals:
        assert values(match(graph, "?s", "?p", x), ["s", "p"]) == sorted((
            (q.s, q.p) for q in quads if (q.o, q.o_kind, q.o_dt, q.o_lang) == (x.value, "literal", x.datatype, x.lang and x.lang.lower())), key=str), x


def test_describe_many_goes_by_keys(spark, graph):
    quads = apply_mappings(graph.sources, graph.maps)
    iris = spark.createDataFrame([(i,) for i in IRIS * 2], "s string")
    assert rows(describe(graph, iris)) == rows(describe(quads, iris))


def random_pattern(rng, triples):
    """Triples that hang together, some of their terms made variables, so that there is a solution."""
    chosen, terms = [rng.choice(triples)], set()
    for _ in range(rng.choice([0, 1, 1, 2])):
        terms |= {chosen[-1][0], chosen[-1][2]}
        near = [t for t in triples if (t[0] in terms or t[2] in terms) and t not in chosen]
        chosen += [rng.choice(near)] if near else []
    names = {}
    for s, _, o in chosen:
        for term in (s, o):
            if rng.random() < 0.8 or not names:
                names.setdefault(term, f"?v{len(names)}")
    shared = [t for t in names if sum(t in (c[0], c[2]) for c in chosen) > 1]
    if len(chosen) > 1 and not shared:
        return [chosen[0]], []
    return [(names.get(s, s), p, names.get(o, o)) for s, p, o in chosen], [v[1:] for v in names.values()]


def test_patterns_equal_the_joins_of_triples(graph):
    quads = apply_mappings(graph.sources, graph.maps).cache()
    triples = sorted({(q.s, q.p, Literal(q.o, q.o_dt if q.o_lang is None else "", q.o_lang) if q.o_kind == "literal" else q.o)
                      for q in quads.collect()}, key=str)
    rng, answered = random.Random(11), 0
    while answered < 30:
        pattern, names = random_pattern(rng, triples)
        try:
            want = bgp(quads, pattern)
        except ValueError:  # not connected
            continue
        if not names:
            continue
        found = bgp(graph, pattern)
        columns = [c for n in names for c in (n, n + "_kind") if n in found.columns]
        assert values(found, columns) == values(want, columns), pattern
        typed = [n for n in names if n + "_dt" in found.columns and n + "_dt" in want.columns]
        extra = [n + x for n in typed for x in ("", "_dt", "_lang")]
        assert values(found, extra) == values(want, extra), pattern
        assert want.count() > 0
        answered += 1


def test_joins_on_keys_build_strings_for_the_result_only(graph):
    plan = bgp(graph, [("?a", E + "boss", "?b"), ("?b", E + "name", "?n")])._jdf.queryExecution().optimizedPlan().toString()
    on = [line for line in plan.splitlines() if "Join" in line]
    assert len(on) == 1 and "concat" not in on[0]
    plan = bgp(graph, [("?a", E + "name", "?n"), ("?a", E + "boss", "?b"), ("?a", E + "same", "?i")])
    assert "Join" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_constants_are_pushed_to_the_scan(spark, place):
    spark.range(100).selectExpr("id", "cast(id AS string) AS k", "id % 7 AS v").write.parquet(place + "/t")
    source = spark.read.parquet(place + "/t")
    maps = [TriplesMap("t", template(E + "a/{id}/{k}"), [pom(E + "v", "v")]), TriplesMap("t", template(E + "b/{id}"), [pom(E + "k", "k")])]
    graph = MappedGraph({"t": source}, maps)
    found = match(graph, E + "a/7/7", "?p", "?o")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(id,7), EqualTo(k,7)" in plan.replace("IsNotNull(id), IsNotNull(k), ", "")
    assert found.count() == 1
    never = match(graph, E + "c/7", "?p", "?o")._jdf.queryExecution().executedPlan().toString()
    assert "parquet" not in never


def test_slots_that_touch_are_compared_as_strings():
    from pyspark.sql import types as T

    types = {"a": T.StringType(), "b": T.StringType(), "i": T.IntegerType(), "j": T.LongType()}
    assert same(template("x{a}{b}"), types, template("x{b}{a}"), types)[0].startswith("concat(")
    assert same(template("x{a}-{b}"), types, template("x{b}-{a}"), types)[0].startswith("concat(")
    assert same(template("x{i}-{j}"), types, template("x{j}-{i}"), types) == ["`i` = `j`", "`j` = `i`"]
    assert same(template("x/{a}"), types, template("x/{i}"), types) == ["cast(`a` AS string) = cast(`i` AS string)"]
    assert same(template("x/{a}"), types, template("y/{a}"), types) is None
    assert equals(template("x{a}{b}"), types, "x12") == "(`a` = '' AND `b` = '12') OR (`a` = '1' AND `b` = '2') OR (`a` = '12' AND `b` = '')"
    assert equals(template("x{i}"), types, "x007") is None
    assert equals(template("x{a}{b}"), types, "x" + "1" * 40).startswith("concat(")


def test_predicate_maps(spark):
    df = spark.createDataFrame([("a b", "1", "p"), ("c", None, "q"), (None, "2", "p"), ("a b", "3", None)], "k string, v string, s string")
    m = TriplesMap("t", template(E + "{s}"), [pom(template(E + "has/{k}"), "v"), pom(E + "fixed", "k")])
    quads = {(q.s, q.p, q.o) for q in apply_mapping(df, m).collect()}
    assert quads == {(E + "p", E + "has/a%20b", "1"), (E + "p", E + "fixed", "a b"), (E + "q", E + "fixed", "c")}
    only = {(q.s, q.p, q.o) for q in apply_mapping(df, m, only=[E + "has/a%20b"]).collect()}
    assert only == {(E + "p", E + "has/a%20b", "1")}
    assert apply_mapping(df, m, only=[E + "has/a b", "http://none"]).count() == 0


def test_joins_on_several_columns_and_on_the_row(spark):
    child = spark.createDataFrame([(1, "a", 10), (1, "b", 11), (2, None, 12), (None, "a", 13)], "x int, y string, id int")
    parent = spark.createDataFrame([(1, "a", 100), (1, "c", 101), (2, None, 102), (1, "a", 103)], "x int, y string, id int")
    to = TriplesMap("parent", template(E + "p/{id}"))
    m = TriplesMap("child", template(E + "c/{id}"), [
        pom(E + "both", parent_ref(to, ["x", "y"], ["x", "y"])), pom(E + "row", parent_ref(TriplesMap("child", template(E + "r/{x}"))))])
    quads = {(q.s, q.p, q.o) for q in apply_mappings({"child": child, "parent": parent}, [m]).collect()}
    both = {(E + f"c/{a}", E + "both", E + f"p/{b}") for a, b in itertools.product([10], [100, 103])}
    assert quads == both | {(E + f"c/{a}", E + "row", E + f"r/{b}") for a, b in [(10, 1), (11, 1), (12, 2)]}
    with pytest.raises(ValueError):
        parent_ref(to, ["x", "y"], ["x"])
    with pytest.raises(ValueError, match="join condition"):
        apply_mappings({"child": child, "parent": parent}, [TriplesMap("child", template(E + "c/{id}"), [pom(E + "p", parent_ref(to))])])


def test_language_of_a_constant(spark, graph):
    tags = match(graph, "?s", E + "says", "?o").collect()
    assert {r.o_dt for r in tags if r.o_lang} == {LANG_STRING} and {r.o_lang for r in tags} == {"en", "de", None}
