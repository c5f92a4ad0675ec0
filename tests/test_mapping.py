"""Mapping a CSV source with typed literals, missing columns and empty fields."""

import pytest

from quadspark.functions.terms import RDF_TYPE, XSD_DOUBLE, XSD_STRING
from quadspark.operators.mapping import (
    MappedGraph,
    TriplesMap,
    apply_mapping,
    apply_mappings,
    expression,
    parent_ref,
    pom,
    template,
)
from quadspark.sources.tabular import read_csv_source, read_json_source, read_xml_docs

GEO = "http://example.org/geo#"


@pytest.fixture
def stops(spark, place):
    rows = "\n".join(f'st{i},"Platform {i}",{i}00,{i}50,,' for i in range(10))
    with open(f"{place}/stops.csv", "w") as f:
        f.write(f"stop_id,stop_desc,stop_lat,stop_lon,zone_id,parent\n{rows}\n\n")
    return read_csv_source(spark, "stops.csv", base_dir=place)


def stops_map(description, **options):
    return TriplesMap("stops", template("http://example.org/stops/{stop_id}"), [
        pom(GEO + "description", description), pom(GEO + "lat", "stop_lat", XSD_DOUBLE),
        pom(GEO + "long", "stop_lon", XSD_DOUBLE), pom(GEO + "zone", "zone_id")], **options)


def test_missing_column_is_an_error(stops):
    with pytest.raises(ValueError, match="folder/stop_desc"):
        apply_mapping(stops, stops_map("folder/stop_desc"))


def test_missing_column_can_be_skipped(stops):
    quads = apply_mapping(stops, stops_map("folder/stop_desc", missing_reference="skip"))
    assert quads.count() == 20
    assert quads.select("p").distinct().count() == 2


def test_corrected_mapping(stops):
    quads = apply_mapping(stops, stops_map("stop_desc")).collect()
    assert len(quads) == 30
    assert len({q.s for q in quads}) == 10
    assert {q.o_dt for q in quads if q.p == GEO + "lat"} == {XSD_DOUBLE}
    assert {q.o_dt for q in quads if q.p == GEO + "description"} == {XSD_STRING}
    assert {q.o for q in quads if q.p == GEO + "lat"} == {f"{i}00" for i in range(10)}


def test_only_prunes_the_scan(stops):
    graph = MappedGraph({"stops": stops}, [stops_map("stop_desc")])
    plan = graph.quads(only={GEO + "lat"})._jdf.queryExecution().executedPlan().toString()
    assert "stop_lat" in plan and "stop_desc" not in plan


def test_null_and_encoded_template_slots(spark):
    df = spark.createDataFrame([("a b/é", 1), (None, 2), ("x", None)], "k string, n int")
    m = TriplesMap("t", template("http://e/{k}"), [pom("http://e/n", "n")], ["http://e/C"])
    quads = apply_mapping(df, m).collect()
    assert {(q.s, q.p) for q in quads} == {
        ("http://e/a%20b%2F%C3%A9", "http://e/n"), ("http://e/a%20b%2F%C3%A9", RDF_TYPE), ("http://e/x", RDF_TYPE)}


def test_maps_on_one_source_with_different_subjects_and_graphs(spark):
    df = spark.createDataFrame([("1", "x"), ("2", None)], "k string, v string")
    one = TriplesMap("t", template("http://e/a/{k}"), [pom("http://e/v", "v")], graph=template("http://g/{k}"))
    two = TriplesMap("t", template("http://e/b/{v}"), [pom("http://e/k", "k")])
    quads = {(q.s, q.p, q.o, q.g) for q in apply_mappings({"t": df}, [one, two]).collect()}
    assert quads == {("http://e/a/1", "http://e/v", "x", "http://g/1"), ("http://e/b/x", "http://e/k", "1", None)}


def test_quotes_in_constants_and_names(spark):
    df = spark.createDataFrame([("it's \\ ok",)], "`a``b` string")
    m = TriplesMap("t", template("http://e/it's/{a`b}"), [pom("http://e/v'", "a`b"), pom("http://e/e", expression("1 + 1"))])
    quads = {(q.s, q.p, q.o) for q in apply_mapping(df, m).collect()}
    subject = "http://e/it's/it%27s%20%5C%20ok"
    assert quads == {(subject, "http://e/v'", "it's \\ ok"), (subject, "http://e/e", "2")}


def test_no_wanted_predicate_gives_an_empty_graph(stops):
    assert apply_mapping(stops, stops_map("stop_desc"), only=["http://none"]).count() == 0


def test_parent_in_the_same_source(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (3, 1)], "id int, up int")
    parent = TriplesMap("t", template("http://e/{id}"))
    child = TriplesMap("t", template("http://e/{id}"), [pom("http://e/up", parent_ref(parent, "up", "id"))])
    quads = {(q.s, q.o) for q in apply_mappings({"t": df}, [child]).collect()}
    assert quads == {("http://e/2", "http://e/1"), ("http://e/3", "http://e/1")}


def test_json_array_sequence_and_lines(spark, place):
    texts = {"array": '[{"k": 1},\n {"k": 2}]', "sequence": '\x1e{"k":\n1}\n\x1e{"k": 2}\n', "lines": '{"k": 1}\n{"k": 2}\n'}
    for mode, text in texts.items():
        with open(f"{place}/{mode}.json", "w") as f:
            f.write(text)
        rows = read_json_source(spark, f"{mode}.json", mode, "k int", base_dir=place).filter("k IS NOT NULL")
        assert sorted(r.k for r in rows.collect()) == [1, 2]
    with pytest.raises(ValueError):
        read_json_source(spark, place, "other")


def test_xml_documents_are_whole(spark, place):
    for i in range(3):
        with open(f"{place}/{i}.xml", "w") as f:
            f.write(f"<a>\n<b>{i}</b>\n</a>")
    docs = read_xml_docs(spark, place).collect()
    assert sorted(d.xml for d in docs) == [f"<a>\n<b>{i}</b>\n</a>" for i in range(3)]
