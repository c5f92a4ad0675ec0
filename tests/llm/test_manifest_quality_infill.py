"""Manifest, quality classifier and fill-in-the-middle against brute force and held-out labels."""

import random
import re
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from quadspark.llm import manifest, quality
from quadspark.llm.infill import infill, restored, transform
from quadspark.llm.manifest import proofs, tampered

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, tree string, pos long, part string, h1 string"


def table(spark, rows):
    """Documents of (doc_id, text, source), with columns whose names the operators use inside."""
    full = [(d, t, None if d == 3 else "en", s, None if t is None else len(t), "t", 7, "p", "h") for d, t, s in rows]
    return spark.createDataFrame(full, COLUMNS).repartition(3)


# --- manifest -----------------------------------------------------------------------

def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, text):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i:i + 16]) for i in range(0, len(last), 16)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        run = level[i // 16 * 16:i // 16 * 16 + 16]
        out.append((run[:i % 16], run[i % 16 + 1:]))
        i //= 16
    return out


def manifest_of(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"]), r))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by_source[s], key=lambda x: x[:3])]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        for i, (_, _, leaf, r) in enumerate(sorted(by_source[s], key=lambda x: x[:3])):
            steps = path(trees[s], i) + path(top, k)
            value = leaf
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["text"] is not None:
                value = leaf_of(r, re.sub("[A-Z]", lambda m: m[0].lower(), r["text"]))
            for left, right in steps:
                value = h(*left, value, *right)
            proof = "".join("".join(a) + "|" + "".join(b) + ";" for a, b in steps)
            out.append((r["doc_id"], leaf, trees[s][-1][0], top[-1][0], proof, value))
    return sorted(out, key=str)


def check_manifest(spark, rows, levels):
    documents = table(spark, rows)
    found = proofs(documents, tampered(), levels=levels)
    names = ("doc_id", "leaf", "subroot", "root", "proof", "folded_root")
    assert sorted((tuple(r[n] for n in names) for r in found.collect()), key=str) == manifest_of(documents.collect())


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_manifest(spark, levels):
    """Sources of one to many rounds, lone leaves, runs of one, nulls, repeated ids and rows."""
    rng = random.Random(levels)
    sizes = {"a": 700, "b": 1, "é": 16, "z": 17, "": 257, None: 33, "+": 256}
    rows = [(i * 7 + k, rng.choice([f"Text {i}", "", None, "ÄB cD\n"]), s)
            for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    rows += [(None, "No id", "z"), (None, "No id", "z"), (4, "One", "a"), (4, "Two", "a"), (4, "Two", "a")]
    rows += [(10_000 + i, "x", f"source {i}") for i in range(300)]
    check_manifest(spark, rows, levels)


def test_manifest_of_few(spark):
    check_manifest(spark, [(1, "Only", "s")], 3)
    check_manifest(spark, [(1, "Same", "s")] * 40, 1)
    found = proofs(table(spark, [(1, "x", "s")]).where("doc_id = 2"))
    assert found.count() == 0 and found.columns[0] == "doc_id"


def test_sweeps():
    """Every leaf's path folds to the top, for all sizes around the borders of levels."""
    for n in (1, 2, 15, 16, 17, 255, 256, 257, 300):
        digests = [h(str(i)) for i in range(n)]
        levels = manifest.forward(digests, manifest.levels_above(n))
        assert levels == tree(digests)
        assert {manifest.fold(d, p) for d, p in zip(digests, manifest.backward(levels, ""), strict=True)} == {levels[-1][0]}


# --- fill in the middle ------------------------------------------------------------------

TEXTS = ["", None, "a", "Hello, world! <P> marked", "<S>", "ab<M>", "< P> <", "é€𝄞 \x00\x1c\n\t ß", "word " * 400, "x" * 5000, "é" * 3000,
         "Das ist ein Satz.\nUnd  noch einer <", "P>x<S"]


def infilled(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    draws = [int(h(f"1:{'' if doc_id is None else doc_id}")[8 * k:8 * k + 8], 16) for k in range(4)]
    low, high = sorted(d % (len(units) + 1) for d in draws[:2])
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or draws[2] % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text, text
    spm = draws[3] % 100 < 20
    output = f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, len(units), "spm" if spm else "psm", len(p), len(m), output, text


def test_infill(spark):
    rows = [(i, TEXTS[i % len(TEXTS)], "s") for i in range(20 * len(TEXTS))] + [(None, "no id", "s"), (1, "again", "s"), (1, "again", "s")]
    found = restored(infill(table(spark, rows)))
    want = [infilled(d, t) for d, t, _ in rows]
    assert {w[2] for w in want} == {"plain", "psm", "spm"}
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    assert restored(infill(table(spark, rows).where("doc_id = -1"))).count() == 0


def test_long_texts_go_through_in_pieces(spark):
    rng = random.Random(1)
    text = "".join(rng.choice(["a", "bc", " ", "é", "€", "𝄞", ".", "\n"]) for _ in range(5000)) + "q" * 500
    rows = [(i, text[i:], "s") for i in range(6)] + [(9, "", "s"), (10, "short one", "s")]
    names = ["doc_id", "text", "h1", "h2", "h3", "h4"]
    from quadspark.llm.infill import _draw

    drawn = table(spark, rows).select("doc_id", "text", *map(_draw, range(1, 5))).toArrow().to_batches()
    for batch in drawn:
        for size in (7, 100, 1 << 20):
            assert transform(batch.select(names), size).to_pylist() == transform(batch.select(names)).to_pylist()
            for r in transform(batch.select(names), size).to_pylist():
                assert tuple(r.values()) == infilled(r["doc_id"], dict((d, t) for d, t, _ in rows)[r["doc_id"]])[:6]


# --- quality ---------------------------------------------------------------------------------

def labelled(spark, prose, n=600):
    """Clean prose, and texts with signs, bars or one word again and again."""
    rows, marks = [], []
    for i in range(n):
        text, good = prose(i, 40 + i % 60, 3000), int(i % 5 > 1)
        if not good:
            words = text.split()
            text = (" | ".join(words) if i % 3 == 0 else " ".join(w + "###" for w in words) if i % 3 == 1
                    else " ".join(w for w in words[:8] for _ in range(9)))
        rows.append((i, text, "s"))
        marks.append((i, good, 0, "x"))
    return table(spark, rows), spark.createDataFrame(marks, "doc_id long, quality int, toxic int, text string")


def test_quality_on_held_out_labels(spark, prose):
    documents, labels = labelled(spark, prose)
    found = quality.scored(documents, labels).join(labels.select("doc_id", "quality"), "doc_id").where("held_out").collect()
    assert len(found) > 100
    assert {r.doc_id for r in found} == {r.doc_id for r in found if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert sum(r.predicted == r.quality for r in found) > 0.97 * len(found)
    assert all(r.predicted == int(r.score >= 0.7) and 0 <= r.score <= 1 for r in found)


def test_held_out_labels_are_not_learnt(spark, prose):
    documents, labels = labelled(spark, prose, 120)
    turned = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    first, second = ({r.doc_id: r.score for r in quality.scored(documents, x).collect()} for x in (labels, turned))
    assert first == second


def test_quality_of_odd_rows(spark, prose):
    documents, labels = labelled(spark, prose, 60)
    odd = table(spark, [(900, None, "s"), (901, "", "s"), (None, "no id", "s"), (902, " \n\t", "s"), (903, "same", "s"), (903, "same", "s"),
                        (904, "z " * 300_000, "s"), (0, "another text of an id", "s")])
    more = labels.unionByName(spark.createDataFrame(
        [(None, 1, 0, "x"), (900, None, 0, "x"), (901, 1, 0, "x"), (1, 1, 0, "y")], labels.schema))
    found = quality.scored(documents.unionByName(odd), more).collect()
    assert len(found) == 68 and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (900, 901, 902)}) == 1
    assert len({r.score for r in found if r.doc_id == 903}) == 1
    assert [r.held_out for r in found if r.doc_id is None] == [False]


def test_quality_without_labels_or_rows(spark, prose):
    documents, labels = labelled(spark, prose, 10)
    assert {r.score for r in quality.scored(documents, labels.where("quality = 7")).collect()} == {0.5}
    assert quality.scored(documents.where("doc_id = -1"), labels).count() == 0


def test_leader_follows_the_regularised_leader():
    """The closed form of the weights against the published per-coordinate rule."""
    state, z, n = quality.Leader.new(), {}, {}
    rng = random.Random(2)
    for _ in range(60):
        at = rng.sample(range(12), 4)
        x, label = [rng.random() for _ in at], rng.randrange(2)
        w = {}
        for i in [*at, quality.BUCKETS]:
            zi, ni = z.get(i, 0.0), n.get(i, 0.0)
            sign = 1 if zi > 0 else -1
            w[i] = 0.0 if abs(zi) <= quality.L1 else -(zi - sign * quality.L1) / ((quality.BETA + ni**0.5) / quality.ALPHA + quality.L2)
        import math

        p = 1 / (1 + math.exp(-sum(w[i] * v for i, v in zip([*at, quality.BUCKETS], [*x, 1.0], strict=True))))
        for i, v in zip([*at, quality.BUCKETS], [*x, 1.0], strict=True):
            g = (p - label) * v
            sigma = ((n.get(i, 0.0) + g * g)**0.5 - n.get(i, 0.0)**0.5) / quality.ALPHA
            z[i] = z.get(i, 0.0) + g - sigma * w[i]
            n[i] = n.get(i, 0.0) + g * g
        import numpy as np

        state.learn(np.array(at), np.array(x), label)
    for i in z:
        assert abs(state.z[i] - z[i]) < 1e-9 and abs(state.n[i] - n[i]) < 1e-9
