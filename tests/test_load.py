"""Manifests, load state and incremental loading."""

import pytest
from pyspark.sql import functions as F

from quadspark.operators import load
from quadspark.sources.manifest import accepts_type, file_graph_mapping, graph_name, list_sources
from quadspark.streaming.load import left_out, load_stream
from quadspark.sinks.rdf import read_quad_table


def write(folder, name, *subjects):
    with open(f"{folder}/{name}", "w") as f:
        f.writelines(f"<http://s/{s}> <http://p> <http://o> .\n" for s in subjects)


def test_type_suffixes(spark):
    df = spark.createDataFrame([("nt",), ("rml.ttl",), ("hint",), ("ttl",), ("NT",), ("xl",)], "t string")

    def kept(types):
        return {r.t for r in df.filter(accepts_type(F.col("t"), types)).collect()}

    assert kept("nt,ttl") == {"nt", "rml.ttl", "ttl"}
    assert kept(" ttl , l") == {"ttl", "rml.ttl"}
    assert kept(["l", "ttl"]) == {"ttl", "rml.ttl"}


def test_graph_names(spark):
    df = spark.createDataFrame(
        [("g", "a", "1", "nt.bz2", None), ("g", "a", "1", "ttl.bz2", "dcat"), ("g", "a", "1", "", "")],
        "g string, a string, v string, t string, c string")
    names = [r[0] for r in df.select(graph_name(*(F.col(c) for c in "gavtc"))).collect()]
    assert names == ["urn:mvn:g:a:1:nt.bz2", "urn:mvn:g:a:1:ttl.bz2:dcat", "urn:mvn:g:a:1"]


def test_listing_and_explicit_files(spark, place):
    import os

    os.mkdir(f"{place}/sub")
    write(place, "a.nt", 1)
    write(f"{place}/sub", "b-1.0.nq.gz", 1)
    write(place, "c.hint", 1)
    listed = list_sources(spark, place, graph=F.concat(F.lit("urn:"), F.col("type"))).collect()
    assert {(r.source.rsplit("/", 1)[1], r.g, r.length > 0) for r in listed} == {
        ("a.nt", "urn:nt", True), ("b-1.0.nq.gz", "urn:0.nq.gz", True)}
    extra = file_graph_mapping(spark, [(f"{place}/c.hint", " "), (f"{place}/a.nt", "urn:x")]).collect()
    assert [(r.source, r.g) for r in extra] == [(f"file:{place}/c.hint", None), (f"file:{place}/a.nt", "urn:x")]


def run(spark, place, manifest, **options):
    return load.run_load(spark, manifest, f"{place}/table", f"{place}/state", f"{place}/published", **options)


def loaded(spark, place):
    return {(r.s, r.g) for r in load.read_loaded(spark, f"{place}/table", f"{place}/state").collect()}


def test_load_twice_loads_once(spark, place, tmp_path_factory):
    src = str(tmp_path_factory.mktemp("src"))
    write(src, "a.nt", 1, 2)
    write(src, "b.nt", 3)
    manifest = list_sources(spark, src, graph=F.lit("urn:g"))
    assert run(spark, place, manifest) == 2
    assert run(spark, place, manifest) == 0
    write(src, "c.nt", 4, 1)
    assert run(spark, place, list_sources(spark, src, graph=F.lit("urn:g"))) == 1
    assert loaded(spark, place) == {(f"http://s/{i}", "urn:g") for i in (1, 2, 3, 4)}
    assert spark.read.parquet(f"{place}/published").count() == 4


def test_one_file_in_two_graphs(spark, place, tmp_path_factory):
    src = str(tmp_path_factory.mktemp("src"))
    write(src, "a.nt", 1)
    both = file_graph_mapping(spark, [(f"{src}/a.nt", "urn:a"), (f"{src}/a.nt", "urn:b")])
    assert run(spark, f"{place}/one", both) == 1
    assert loaded(spark, f"{place}/one") == {("http://s/1", "urn:a")}
    assert run(spark, f"{place}/two", both, key="source,graph") == 2
    assert loaded(spark, f"{place}/two") == {("http://s/1", "urn:a"), ("http://s/1", "urn:b")}
    assert run(spark, f"{place}/two", both, key="source,graph") == 0


def test_changed_file_is_loaded_again_only_on_request(spark, place, tmp_path_factory):
    src = str(tmp_path_factory.mktemp("src"))
    write(src, "a.nt", 1)
    assert run(spark, place, list_sources(spark, src)) == 1
    write(src, "a.nt", 1, 2)
    assert run(spark, place, list_sources(spark, src)) == 0
    assert run(spark, place, list_sources(spark, src), fingerprint=True) == 1
    assert run(spark, place, list_sources(spark, src), fingerprint=True) == 0
    assert loaded(spark, place) == {("http://s/1", None), ("http://s/2", None)}


def test_default_graph_has_no_graph_triple(spark, place, tmp_path_factory):
    src = str(tmp_path_factory.mktemp("src"))
    write(src, "a.nt", 1)
    run(spark, place, list_sources(spark, src))
    triples = load.load_state_triples(load.read_load_state(spark, f"{place}/state")).collect()
    assert sorted(t.p.rsplit("/", 1)[1] for t in triples) == ["file", "load"]


def test_key_is_checked(spark):
    empty = spark.createDataFrame([], load.STATE_SCHEMA)
    with pytest.raises(ValueError):
        load.pending(file_graph_mapping(spark, [("/a.nt", None)]), empty, key="graph")


def test_stream_loads_new_files_only(spark, place, tmp_path_factory):
    src = str(tmp_path_factory.mktemp("src"))
    for number, subjects in enumerate([(1, 2), (2, 3)]):
        write(src, f"{number}.nt", *subjects)
        load_stream(spark, src, f"{place}/table", f"{place}/checkpoint", dedupe=True).awaitTermination()
    rows = read_quad_table(spark, f"{place}/table", batches=True).collect()
    assert sorted((r.s, r.batch) for r in rows) == [("http://s/1", 0), ("http://s/2", 0), ("http://s/3", 1)]


def test_malformed_lines_end_a_load_or_are_kept(spark, place, tmp_path_factory):
    src = str(tmp_path_factory.mktemp("src"))
    write(src, "a.nt", 1)
    write(src, "b.nt", 2)
    with open(f"{src}/b.nt", "a") as f:
        f.write("@prefix ex: <http://ex/> .\n")
    manifest = list_sources(spark, src)
    with pytest.raises(Exception, match="malformed line"):
        run(spark, place, manifest)
    assert load.read_load_state(spark, f"{place}/state").count() == 0
    assert run(spark, place, manifest, on_reject="keep") == 1
    assert loaded(spark, place) == {("http://s/1", None)}
    assert [r.reject for r in load.read_kept_rejects(spark, f"{place}/table").collect()] == ["@prefix ex: <http://ex/> ."]
    write(src, "b.nt", 2)
    assert run(spark, place, list_sources(spark, src)) == 1
    assert loaded(spark, place) == {("http://s/1", None), ("http://s/2", None)}
    with pytest.raises(ValueError):
        run(spark, place, manifest, on_reject="drop")


def test_types_without_a_parser_are_refused(spark, place, tmp_path_factory):
    src = str(tmp_path_factory.mktemp("src"))
    write(src, "a.owl.gz", 1)
    with pytest.raises(ValueError, match="owl"):
        run(spark, place, list_sources(spark, src))


def test_blocks_and_lines_load_together(spark, place, tmp_path_factory):
    src = str(tmp_path_factory.mktemp("src"))
    write(src, "a.nt", 1)
    with open(f"{src}/b.trig", "w") as f:
        f.write("<http://g> {\n<http://s/2> <http://p> <http://o> .\n}\n")
    assert run(spark, place, list_sources(spark, src)) == 2
    assert loaded(spark, place) == {("http://s/1", None), ("http://s/2", "http://g")}


def test_reload_forgets_what_a_file_no_longer_has(spark, place, tmp_path_factory):
    src = str(tmp_path_factory.mktemp("src"))
    write(src, "a.nt", 1, 2)
    write(src, "b.nt", 2, 3)
    assert run(spark, place, list_sources(spark, src)) == 2
    write(src, "a.nt", 1)
    assert run(spark, place, list_sources(spark, src), fingerprint=True) == 1
    assert loaded(spark, place) == {("http://s/1", None), ("http://s/2", None), ("http://s/3", None)}
    with open(f"{src}/b.nt", "w") as f:
        f.write("# nothing left\n")
    assert run(spark, place, list_sources(spark, src), fingerprint=True) == 1
    assert loaded(spark, place) == {("http://s/1", None)}
    assert spark.read.parquet(f"{place}/published").count() == 1


def test_stream_keeps_malformed_lines(spark, place, tmp_path_factory):
    src = str(tmp_path_factory.mktemp("src"))
    write(src, "a.nt", 1)
    with open(f"{src}/a.nt", "a") as f:
        f.write("no triple\n")
    with pytest.raises(Exception, match="malformed line"):
        load_stream(spark, src, f"{place}/t1", f"{place}/c1").awaitTermination()
    write(src, "b.nt", 2)
    load_stream(spark, src, f"{place}/t2", f"{place}/c2", on_reject="keep").awaitTermination()
    # A file is loaded as a whole or not at all.
    assert [r.s for r in read_quad_table(spark, f"{place}/t2").collect()] == ["http://s/2"]
    assert [r.reject for r in spark.read.parquet(f"{place}/t2_rejects").collect()] == ["no triple"]
    assert [r.source.rsplit("/", 1)[-1] for r in left_out(spark, f"{place}/t2").collect()] == ["a.nt"]
    assert left_out(spark, f"{place}/t1").count() == 0


def test_many_files_are_loaded_some_at_a_time(spark, place, tmp_path_factory):
    src = str(tmp_path_factory.mktemp("src"))
    for i in range(5):
        write(src, f"{i}.nt", i)
    with open(f"{src}/3.nt", "a") as f:
        f.write("no triple\n")
    manifest = list_sources(spark, src)
    assert load.run_load(spark, manifest, f"{place}/t", f"{place}/s", on_reject="keep", files_per_load=2) == 4
    assert {r.load for r in load.read_load_state(spark, f"{place}/s").collect()} == {1, 2, 3}
    assert {r.s for r in load.read_loaded(spark, f"{place}/t", f"{place}/s").collect()} == {f"http://s/{i}" for i in (0, 1, 2, 4)}
    assert load.run_load(spark, manifest, f"{place}/t", f"{place}/s", on_reject="keep", files_per_load=2) == 0
    write(src, "3.nt", 3)
    assert load.run_load(spark, list_sources(spark, src), f"{place}/t", f"{place}/s", files_per_load=2) == 1
    assert load.read_loaded(spark, f"{place}/t", f"{place}/s").count() == 5
