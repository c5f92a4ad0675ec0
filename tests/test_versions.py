"""Stored graphs with numbered updates, checked against sets."""

import random

import pytest
from pyspark.sql import functions as F

from quadspark.functions.terms import QUAD_COLUMNS, Literal
from quadspark.operators import versions
from quadspark.operators.patterns import match
from test_patterns import quads


def _rows(spark, some):
    return quads(spark, *[(s, p, Literal(o, lang="en") if o == "x" else o, *([g] if g else [])) for s, p, o, g in some])


def _state(spark, path, number=None):
    found = [(r.s, r.p, r.o, r.g) for r in versions.read_version(spark, path, number).collect()]
    assert len(found) == len(set(found))
    return set(found)


def test_any_order_of_updates(spark, tmp_path):
    rng = random.Random(11)
    every = [(s, p, o, g) for s in "ab" for p in "pq" for o in ("x", "y") for g in (None, "g", "h")]
    path = str(tmp_path / "graph")
    state = set(rng.sample(every, 9))
    versions.create(_rows(spark, state), path)
    states = [state]
    for step in range(6):
        old, new = rng.sample(every, 5), rng.sample(every, 4)
        cleared = [None, "g", "h"][step % 3: step % 3 + step % 2]
        number = versions.update(spark, path, _rows(spark, old), _rows(spark, new + new), cleared)
        state = ({q for q in state if q[3] not in cleared} - set(old)) | set(new)
        states.append(state)
        assert number == len(states) - 1
        if step == 3:
            assert versions.compact(spark, path) == number
    for number, want in enumerate(states):
        assert _state(spark, path, number) == want
    versions.copy_version(spark, path, "g", None)
    state = {q for q in state if q[3]} | {(*q[:3], None) for q in state if q[3] == "g"}
    assert _state(spark, path) == state
    versions.copy_version(spark, path, None, "h", move=True)
    state = {q for q in state if q[3] == "g"} | {(*q[:3], "h") for q in state if q[3] is None}
    assert _state(spark, path) == state
    with pytest.raises(ValueError, match="no number"):
        versions.read_version(spark, path, 99)


def test_updates_write_what_they_change(spark, tmp_path):
    path = str(tmp_path / "graph")
    versions.create(_rows(spark, [(f"s{i}", f"p{i % 5}", f"o{i}", None) for i in range(500)]), path)
    ten = versions.modify_version(spark, path, [("?s", "p1", "?o"), ("?s", "p1", "o1")], insert=[("?s", "seen", "?o")])
    assert spark.read.parquet(f"{path}/parts/number={ten}").count() == 1
    ten = versions.update(spark, path, delete=_rows(spark, [(f"s{i}", f"p{i % 5}", f"o{i}", None) for i in range(10)]))
    assert spark.read.parquet(f"{path}/parts/number={ten}").count() == 10
    assert versions.read_version(spark, path).count() == 491 and versions.read_version(spark, path, 0).count() == 500
    # A part without its log row has not happened, and is written over.
    spark.read.parquet(f"{path}/parts/number={ten}").withColumn("change", F.lit("insert")).write.parquet(f"{path}/parts/number={ten + 1}")
    assert versions.latest(spark, path) == ten and versions.read_version(spark, path).count() == 491
    assert versions.update(spark, path, clear=[None]) == ten + 1
    assert versions.read_version(spark, path).count() == 0
    with pytest.raises(Exception, match="exist"):
        versions.create(_rows(spark, [("s", "p", "o", None)]), path)


def test_predicates_reach_all_scans(spark, tmp_path, capsys):
    path = str(tmp_path / "graph")
    versions.create(_rows(spark, [("a", "p", "b", None), ("a", "q", "b", None)]), path)
    versions.update(spark, path, delete=_rows(spark, [("a", "q", "b", None)]))
    graph = versions.read_version(spark, path)
    found = match(graph, "?s", "p", "?o")
    capsys.readouterr()
    found.explain("formatted")
    pushed = [line for line in capsys.readouterr().out.splitlines() if "PushedFilters" in line]
    # The base, and the parts as what was touched and as what was added.
    assert sum("EqualTo(p,p)" in line for line in pushed) >= 3, pushed
    assert [(r.s, r.o) for r in found.collect()] == [("a", "b")]
    assert versions.read_version(spark, path, 0).select(*QUAD_COLUMNS).count() == 2
