"""The pipeline's stages, and the registered queries against their SQL."""

import os
from collections import defaultdict

import pytest
from compare import connect, difference
from llm import brute
from llm.conftest import make_documents
from pyspark.sql import functions as F

import __spark_entry__ as spark_entry
import corpus_pipeline
from quadspark.llm import queries
from quadspark.llm.tables import stored

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_registered():
    names = spark_entry.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.SQL[name]) is None


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in docs.select("doc_id", "text", "source").collect()]
        docs = stored(stage(spark, docs, SF_DIR), "test-stage")
        rows = docs.collect()
        if name != "packing":
            assert docs.columns == COLUMNS
        if name == "near duplicates":
            want = {r[0] for r in brute.near([b[:2] for b in before], 5, 80) if r[3]}
            assert sorted(r.doc_id for r in rows) == sorted(want)
        elif name == "repeated passages":
            want = {r[0]: r[3].split() for r in brute.repeated([b[:2] for b in before], 50)}
            assert {r.doc_id: brute.words(r.text) for r in rows} == {
                d: w for d, w in want.items() if w or not brute.words(dict(b[:2] for b in before)[d])}
        elif name == "mixing":
            size, taken = defaultdict(int), defaultdict(int)
            for d, t, _ in before:
                size[d] = len(brute.words(t))
            for r in rows:
                taken[r.doc_id] += len(brute.words(r.text))
            assert all(taken[d] <= 2 * size[d] for d in taken)
            assert abs(sum(taken.values()) - 1.5 * sum(size.values())) <= 20
        elif name == "packing":
            ends = defaultdict(int)
            for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
                assert r.offset == ends[r.sequence_id]
                ends[r.sequence_id] += r.length
            assert max(ends.values()) <= 4096
            assert {r.doc_id for r in rows} == {b[0] for b in before}


def test_toxic_documents_go(spark):
    rows = [(i, ("plain words here. " * 3) + ("awful insult." if i % 5 == 0 else "nice day."), "s") for i in range(400)]
    docs = make_documents(spark, [(i, f"{t} n{i}", s) for i, t, s in rows])
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)], "doc_id long, toxic int")
    from quadspark.llm.toxicity import train, without_toxic

    left = without_toxic(docs, train(docs, labels))
    assert left.schema == docs.schema and {r.doc_id for r in left.collect()} == {i for i in range(400) if i % 5}


def test_odd_rows(spark, prose):
    rows = [(1, prose(1, 80)), (1, prose(1, 80)), (2, prose(1, 80)), (3, None), (3, None), (4, ""), (None, "x y"),
            (None, None), (5, prose(1, 60) + " tail")]
    docs = make_documents(spark, rows)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 0, 1, 3, 3, 4, 5]
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = stored(stage(spark, docs, SF_DIR), "test-odd")
    assert docs.count() > 0


def test_texts_of_one_id_are_not_lost(spark):
    docs = make_documents(spark, [(1, "a b c"), (1, "x y z q"), (2, "a b c"), (None, "a b c"), (None, "other words"), (3, "x y z q")])
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SF_DIR)
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, "other words"), (1, "a b c"), (1, "x y z q")]


def test_columns_of_any_name_and_type(spark, prose):
    """Names that the stages use inside, names with dots and quotes, maps, and copies of rows."""
    rows = [(1, prose(1, 80)), (2, prose(1, 80)), (3, f"{prose(2, 60)} {prose(3, 60)}"), (4, f"{prose(4, 60)} {prose(3, 60)}"),
            (4, f"{prose(4, 60)} {prose(3, 60)}"), (5, None), (None, "")]
    docs = make_documents(spark, rows)
    names = ["_found", "found", "row", "print", "number", "group", "a.b", "q't x", "value", "taken", "digest"]
    docs = docs.select("*", *(F.lit(n).alias(n) for n in names), F.create_map(F.lit("k"), "doc_id").alias("map"),
                       F.array("doc_id").alias("list"), F.struct("doc_id", "text").alias("pair"))
    schema = docs.schema
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF_DIR), "test-names")
        assert docs.columns == schema.names, name
        assert [f.dataType for f in docs.schema] == [f.dataType for f in schema], name
    assert docs.count() > 0 and {r["a.b"] for r in docs.collect()} == {"a.b"}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() >= docs.count()


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF_DIR), "test-empty")
    assert docs.count() == 0
