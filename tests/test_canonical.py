"""Names of blank nodes do not depend on labels or order."""

import itertools
import random

import pytest

from quadspark.functions.terms import QUAD_COLUMNS, Literal
from quadspark.operators.canonical import blank_colours, skolemize_graph
from test_patterns import quads


def relabelled(triples, seed):
    rng = random.Random(seed)
    blanks = sorted({x for t in triples for x in (t[0], t[2]) if isinstance(x, str) and x.startswith("_:")})
    names = [f"_:n{i}" for i in range(len(blanks))]
    rng.shuffle(names)
    new = dict(zip(blanks, names, strict=True))
    out = [(new.get(t[0], t[0]), t[1], t[2] if isinstance(t[2], Literal) else new.get(t[2], t[2]), *t[3:]) for t in triples]
    rng.shuffle(out)
    return out


def result(spark, triples):
    found = skolemize_graph(quads(spark, *triples), "http://b/")
    return sorted((tuple(r[c] for c in QUAD_COLUMNS) for r in found.collect()), key=str)


def ring(n, name="r", p="next"):
    return [(f"_:{name}{i}", p, f"_:{name}{(i + 1) % n}") for i in range(n)]


GRAPHS = {
    "nested": [("s", "has", "_:a"), ("_:a", "street", "_:b"), ("_:b", "name", Literal("x")), ("_:b", "no", Literal("1")),
               ("s", "has", "_:c"), ("_:c", "street", "_:d"), ("_:d", "name", Literal("x")), ("_:d", "no", Literal("2"))],
    "list": [(f"_:l{i}", "rest", f"_:l{i + 1}" if i < 5 else "nil") for i in range(6)] + [
        (f"_:l{i}", "first", Literal("same")) for i in range(6)],
    "ring": ring(5) + [("s", "has", "_:r0"), ("_:z", "p", "_:z")],
    "plain ring": ring(6),
    "rings that refinement takes for one": ring(6) + ring(3, "a") + ring(3, "b"),
    "graphs": [("_:a", "p", "_:b", "g1"), ("_:a", "p", "_:b", "g2"), ("_:b", "p", "_:c", "g1"), ("_:c", "q", Literal("x", lang="en"))],
    "square with a diagonal": ring(4, p="e") + [("_:r0", "e", "_:r2"), ("_:r2", "e", "_:r0")],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_labels_and_order_make_no_difference(spark, name):
    first, second = (result(spark, relabelled(GRAPHS[name], seed)) for seed in (1, 2))
    assert first == second
    assert not any(r[1] == "bnode" or r[4] == "bnode" for r in first)


def test_structure_is_kept(spark):
    """Nodes that differ stay apart, also in rings; copies become one."""
    sizes = {name: len(result(spark, GRAPHS[name])) for name in ("nested", "list", "ring", "plain ring")}
    assert sizes == {name: len(GRAPHS[name]) for name in sizes}
    assert len(result(spark, GRAPHS["rings that refinement takes for one"])) == 9
    copies = [("s", "has", f"_:c{i}") for i in range(40)] + [(f"_:c{i}", "name", Literal("x")) for i in range(40)]
    assert len(result(spark, copies)) == 2


def test_different_graphs_get_different_names(spark):
    one = result(spark, [("_:a", "p", "_:b"), ("_:b", "q", Literal("1"))])
    two = result(spark, [("_:a", "p", "_:b"), ("_:b", "q", Literal("2"))])
    assert {r[0] for r in one}.isdisjoint({r[0] for r in two})


def isomorphic(a, b):
    """Brute force over all renamings."""
    nodes = [sorted({x for t in g for x in (t[0], t[2])}) for g in (a, b)]
    if len(nodes[0]) != len(nodes[1]) or len(a) != len(b):
        return False
    target = set(b)
    for image in itertools.permutations(nodes[1]):
        new = dict(zip(nodes[0], image, strict=True))
        if {(new[s], p, new[o]) for s, p, o in a} == target:
            return True
    return False


def test_random_graphs_against_brute_force(spark):
    """Connected graphs whose colours all differ have one result exactly if they are isomorphic."""
    rng, seen = random.Random(4), []
    for _ in range(6):
        n = rng.choice([3, 4])
        triples = sorted({(f"_:x{rng.randrange(n)}", rng.choice("pq"), f"_:x{rng.randrange(n)}") for _ in range(n + 1)})
        colours = blank_colours(quads(spark, *triples)).collect()
        if len({r.colour for r in colours}) == len(colours):
            seen.append((triples, result(spark, triples)))
    for (a, x), (b, y) in itertools.combinations(seen, 2):
        assert (x == y) == isomorphic(a, b)
    assert len(seen) > 2


def test_no_blank_nodes(spark):
    assert len(result(spark, [("s", "p", "o"), ("s", "p", Literal("o"))])) == 2
    assert blank_colours(quads(spark, ("s", "p", "o"))).count() == 0
