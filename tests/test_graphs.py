"""Statistics, set operations, skolem IRIs, logs, plans and scripts on fixtures."""

import pytest
from pyspark.sql import functions as F

from quadspark.functions.terms import QUAD_COLUMNS, QUAD_SCHEMA, RDF_TYPE, Literal
from quadspark.functions.xml import xml_parse
from quadspark.operators import benchplan, graphs, querylog, void
from quadspark.plans.metadata import xml_contacts
from quadspark.plans.script import run_script
from quadspark.sources.querylog import normalize_query, parse_query_log, query_id
from test_patterns import quads


def example(spark):
    return quads(spark, ("a", RDF_TYPE, "A"), ("b", RDF_TYPE, "A"), ("b", RDF_TYPE, "B"), ("a", "p", "b"),
                 ("a", "p", Literal("x")), ("b", "q", Literal("x")), ("c", "p", "a"))


def rows(df, *names):
    return {tuple(r[n] for n in names) for r in df.collect()}


def test_statistics_by_hand(spark):
    g = example(spark)
    one = void.void_dataset(g).first()
    assert (one.triples, one.distinct_subjects, one.properties, one.distinct_objects) == (7, 3, 3, 5)
    assert void.void_classes(g).first().classes == 2
    assert rows(void.class_partition(g), "class", "triples") == {("A", 6), ("B", 3)}
    assert rows(void.class_instances(g), "class", "instances") == {("A", 2), ("B", 1)}
    assert rows(void.property_partition(g), "p", "triples") == {(RDF_TYPE, 3), ("p", 3), ("q", 1)}
    assert rows(void.class_cooccurrence(g), "class", "classes") == {("A", 2), ("B", 2)}
    assert ("A", "p", 2, 1, 2) in rows(
        void.class_property_partition(g), "class", "p", "triples", "distinct_subjects", "distinct_objects")
    both = void.class_partitions(g)
    assert rows(both.filter("p IS NULL"), "class", "triples", "properties") == {("A", 6, 3), ("B", 3, 2)}


def test_literals_of_other_types_are_other_objects(spark):
    g = quads(spark, ("a", "p", Literal("1")), ("a", "p", Literal("1", "http://dt")), ("a", "p", Literal("1", lang="en")),
              ("a", "p", "1"))
    assert void.void_dataset(g).first().distinct_objects == 4


def test_blank_labels_do_not_change_counts(spark):
    g = quads(spark, ("_:x", "p", "_:y"), ("_:y", "p", Literal("v")))
    renamed = quads(spark, ("_:n1", "p", "_:n2"), ("_:n2", "p", Literal("v")))
    assert void.void_dataset(g).first() == void.void_dataset(renamed).first()
    assert rows(void.node_kind_profile(g), "measure", "key", "n") == rows(
        void.node_kind_profile(renamed), "measure", "key", "n")


def test_statistics_of_an_empty_graph(spark):
    empty = spark.createDataFrame([], QUAD_SCHEMA)
    assert void.void_dataset(empty).first().triples == 0
    for fn in (void.class_partition, void.property_partition, void.class_cooccurrence, void.node_kind_profile):
        assert fn(empty).count() == 0


def test_partitions_as_triples_are_linked(spark):
    triples = rows(void.void_to_rdf(void.class_property_partition(example(spark)), "http://ds"), "s", "p", "o")
    inner = {s for s, p, _ in triples if p == void.VOID + "property"}
    outer = {o for s, p, o in triples if p == void.VOID + "propertyPartition"}
    assert inner == outer
    assert {s for s, p, _ in triples if p == void.VOID + "class"} == {
        o for s, p, o in triples if s == "http://ds"}


def test_union_is_idempotent_and_commutative(spark):
    a, b = example(spark), quads(spark, ("a", "p", "b"), ("z", "p", "b", "g"))
    once, again = graphs.graph_union(a, b), graphs.graph_union(b, a, a, None)
    assert once.count() == again.count() == 8
    assert rows(once, *QUAD_COLUMNS) == rows(again, *QUAD_COLUMNS)
    assert graphs.graph_union(spark=spark).count() == 0


def test_skolem_iris_depend_on_content_only(spark):
    def build(label):
        return quads(spark, (label, "id", Literal("7")), (label, "tag", Literal("x")), (label, "tag", Literal("y")),
                     (label, "note", Literal("free")), ("s", "has", label), ("_:other", "note", Literal("kept")))

    first = rows(graphs.skolemize(build("_:a"), "http://b/", "Thing", ["id", "tag"]), "s", "p", "o")
    second = rows(graphs.skolemize(build("_:q"), "http://b/", "Thing", ["tag", "id"]), "s", "p", "o")
    assert first == second
    iri = next(o for s, p, o in first if p == "has")
    assert iri.startswith("http://b/Thing-") and (iri, "note", "free") in first
    assert ("_:other", "note", "kept") in first


def test_updates_on_snapshots(spark):
    g = quads(spark, ("a", "p", "b"), ("a", "p", "b", "g"), ("a", "p", Literal("b")))
    left = graphs.delete_data(g, quads(spark, ("a", "p", "b")))
    assert rows(left, "o_kind", "g") == {("iri", "g"), ("literal", None)}
    assert rows(graphs.move_graph(g, "g", "h"), "g") == {(None,), ("h",)}
    assert graphs.copy_graph(g, "g", "g").count() == 3
    assert graphs.move_to_graph(g, F.col("p") == "p", "all").count() == 2


def test_query_ids_ignore_spacing_outside_strings(spark):
    texts = ["SELECT  *\n{ ?s ?p 'a  b' }", " SELECT * { ?s\t?p 'a  b' } ", "SELECT * { ?s ?p 'a b' }",
             'ASK { ?s ?p """x\n  "y"  z""" }', "it's  odd"]
    df = spark.createDataFrame([(t,) for t in texts], "q string")
    out = [r.n for r in df.select(normalize_query(F.col("q")).alias("n")).collect()]
    assert out == ["SELECT * { ?s ?p 'a  b' }", "SELECT * { ?s ?p 'a  b' }", "SELECT * { ?s ?p 'a b' }",
                   'ASK { ?s ?p """x\n  "y"  z""" }', "it's odd"]
    ids = [r.i for r in df.select(query_id(F.col("q")).alias("i")).collect()]
    assert ids[0] == ids[1] != ids[2]


def test_positions_of_equal_queries(spark):
    queries = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "q string")
    found = sorted(map(tuple, benchplan.with_position(queries, 2, "q").collect()))
    assert found == [("a", 0), ("b", 1), ("b", 1), ("c", 2)]
    for limit in (None, -1):
        all_of_them = benchplan.with_position(queries, limit, "q")
        assert all_of_them.count() == 4 and benchplan.limit_warmup(benchplan.run_plan(all_of_them, 1, 1), limit).count() == 8


def test_log_lines_of_every_shape(spark):
    lines = [
        '1.2.3.4 - - [01/Jan/2024:10:00:00 +0200] "GET /sparql?query=ASK+%7B%7D&x=1 HTTP/1.1" 200 5',
        '1.2.3.4 - u [01/Jan/2024:10:00:00 +0000] "POST /sparql HTTP/1.1" 200 5 "-" "-"',
        '1.2.3.4 - - [bad time] "GET /s?default=&query=%ZZ HTTP/1.1" 200 5',
        "garbage",
    ]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i int, value string")
    out = {r.i: r for r in parse_query_log(df, "virtuoso").select(
        "i", "host", F.unix_seconds("ts").alias("t"), "query").collect()}
    assert (out[0].host, out[0].t, out[0].query) == ("1.2.3.4", 1704096000, "ASK {}")
    assert [out[i].query for i in (1, 2, 3)] == [None] * 3
    assert out[2].t is None and out[3].host is None
    with pytest.raises(ValueError):
        parse_query_log(df, "other")


def test_two_lists_of_queries_and_enrichers(spark):
    df = spark.createDataFrame([("SELECT * { ?s ?p ?o }",), ("SELECT * { ?x ?y ?z }",), ("",)], "value string")
    log = parse_query_log(df, "sparql").filter("query IS NOT NULL")
    assert log.select("query_hash").distinct().count() == 2
    assert querylog.enrich(log).columns == log.columns
    with pytest.raises(KeyError):
        querylog.enrich(log, ["unknown"])
    custom = querylog.enrich(log, ["size"], {"size": lambda d: d.withColumn("size", F.length("query"))})
    assert "size" in custom.columns


def test_run_plan(spark):
    queries = spark.createDataFrame([("q0", 0), ("q1", 1)], "q string, seq bigint")

    def planned(warmup, limit):
        return benchplan.limit_warmup(benchplan.run_plan(queries, warmup, 2), limit)

    plan = planned(2, 1)
    assert sorted((r.run_id, r.q) for r in plan.collect()) == [
        (-2, "q0"), (-1, "q0"), (0, "q0"), (0, "q1"), (1, "q0"), (1, "q1")]
    assert benchplan.gate_warmup(plan, False).count() == 4
    assert benchplan.gate_warmup(plan).count() == 6
    assert planned(2, None).count() == planned(2, -1).count() == 8
    assert {r.run_id for r in planned(-3, None).collect()} == {0, 1}
    assert benchplan.run_plan(queries, 0, 0).count() == 0


def test_run_metadata_is_linked(spark):
    plan = spark.createDataFrame([("http://d/x", "http://e", i) for i in (-1, 0)], "dataset_id string, service_url string, run_id int")
    out = benchplan.run_metadata(plan, "http://b/", F.current_timestamp()).collect()
    configs = {q.s for q in out if q.o == benchplan.EXP + "Config"}
    execs = {q.s for q in out if q.o == benchplan.EXP + "Execution"}
    runs = {q.s for q in out if q.o == benchplan.EXP + "Run"}
    assert (len(configs), len(execs), len(runs)) == (1, 1, 2)
    assert all(q.g == q.s for q in out)
    assert {q.o for q in out if q.p == benchplan.EXP + "exec"} == execs
    assert {q.o for q in out if q.p == benchplan.EXP + "config"} == configs


PROJECT = '<project xmlns="urn:p"><licenses>{}</licenses><developers>{}</developers></project>'
LICENCE = "<license><url>http://l</url></license>"


@pytest.mark.parametrize("licences, developers, expected", [
    (LICENCE, "<developer><name>N</name><url>http://u</url><organization>O</organization>"
              "<organizationUrl>http://o</organizationUrl></developer>", 6),
    (LICENCE, "<developer><name>N</name></developer>", 3),
    ("", "", 0),
    ("<license><url>not an iri</url></license>", "<developer><url/></developer>", 0),
])
def test_contacts_of_a_project(spark, licences, developers, expected):
    docs = spark.createDataFrame([(PROJECT.format(licences, developers),)], "xml string")
    assert xml_contacts(docs, F.lit("urn:b#"), F.lit("urn:b#dataset")).count() == expected


def test_contact_iri_is_encoded(spark):
    docs = spark.createDataFrame([(PROJECT.format("", "<developer><name>J \u00d6</name></developer>"),)], "xml string")
    out = xml_contacts(docs, F.lit("urn:b#"), F.lit("urn:b#dataset"))
    assert ("urn:b#dev/J%20%C3%96",) in rows(out, "o")


def test_malformed_xml_is_unbound(spark):
    df = spark.createDataFrame([("<a><b>1</b></a>",), ("<a><b>",)], "x string")
    out = [r.b for r in df.select(xml_parse(F.col("x"), "b string").getField("b").alias("b")).collect()]
    assert out == ["1", None]


def test_script_steps_see_earlier_files(spark, place):
    for name in ("one", "two"):
        with open(f"{place}/{name}.nt", "w") as f:
            f.write(f"<http://s/{name}> <http://p> <http://o> .\n")

    def copy(q):
        return q.select("s", "s_kind", F.lit("http://seen").alias("p"), "o", "o_kind", "o_dt", "o_lang")

    out = run_script(spark, [f"{place}/one.nt", copy, f"{place}/two.nt", copy])
    assert rows(out, "s") == {("http://s/one",), ("http://s/two",)} and out.count() == 2
    assert run_script(spark, [f"{place}/one.nt", copy, copy], distinct=False, share=False).count() == 2
    assert run_script(spark, []).count() == 0


def test_a_hub_subject_is_split(spark):
    """The join of triples with the classes of their subjects may be split where one subject has most triples."""
    from quadspark.operators.void import class_partition

    def quads(n, subject, p, o, kind):
        return spark.range(n).select(
            subject.alias("s"), F.lit("iri").alias("s_kind"), F.lit(p).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"),
            F.lit(None).cast("string").alias("o_dt"), F.lit(None).cast("string").alias("o_lang"), F.lit(None).cast("string").alias("g"))

    each = F.concat(F.lit("http://s/"), F.col("id"))
    graph = quads(2000, each, RDF_TYPE, F.lit("http://C"), "iri").unionByName(
        quads(60_000, F.lit("http://s/1"), "http://p", F.col("id").cast("string"), "literal")).unionByName(
        quads(2000, each, "http://p", F.lit("x"), "literal"))
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k", "spark.sql.shuffle.partitions": "16",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "0"}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = class_partition(graph)
        assert [r.triples for r in found.collect()] == [64_000]
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_digests(spark):
    import hashlib

    from quadspark.functions import scalars as fn
    from quadspark.functions.terms import literal_term

    texts = ["", "a", "\u00e9\U0001F600", "x" * 5000]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = literal_term(F.col("t"))
    names = ("md5", "sha1", "sha256", "sha384", "sha512")
    for r in df.select("t", *(getattr(fn, n)(t).value.alias(n) for n in names)).collect():
        assert [r[n] for n in names] == [hashlib.new(n, r.t.encode()).hexdigest() for n in names]


def test_zones_as_durations(spark):
    from quadspark.functions import scalars as fn
    from quadspark.functions.terms import XSD_DATETIME, literal_term

    zones = {"Z": "PT0S", "+01:00": "PT1H", "-05:30": "-PT5H30M", "+00:45": "PT45M", "-00:00": "PT0S", "": None}
    df = spark.createDataFrame([(z, "2024-01-01T00:00:00" + z) for z in zones], "z string, t string")
    found = df.select("z", fn.timezone(literal_term(F.col("t"), XSD_DATETIME)).value.alias("d")).collect()
    assert {r.z: r.d for r in found} == zones


def test_negated_property_sets(spark):
    from quadspark.operators import paths

    g = quads(spark, ("a", "p", "b"), ("a", "q", "c"), ("b", "r", Literal("x")))
    assert rows(paths.negated(g, ["p"]), "x", "y") == {("a", "c"), ("b", "x")}
    assert rows(paths.negated(g, inverse_of=["q", "r"]), "x", "y") == {("b", "a")}
    assert rows(paths.negated(g, ["p", "r"], ["p"]), "x", "y") == {("a", "c"), ("c", "a"), ("x", "b")}
    with pytest.raises(ValueError):
        paths.negated(g)


def test_catalogue_records_are_made_by_many_tasks(spark, place):
    """One small file of many rows: its triples are not all made distinct in the task that reads it."""
    from quadspark.plans.catalog.statistics import v10_dcat_records
    from quadspark.plans.registry import SCHEMAS

    rows = [(i % 40 if i else None, "n", "b", "Type" if i % 3 else None, i % 2, 1.0) for i in range(90)]
    spark.createDataFrame(rows, SCHEMAS["part"]).coalesce(1).write.parquet(f"{place}/part.parquet")
    found = v10_dcat_records(spark, place)
    assert "hashpartitioning(p_partkey" in found._jdf.queryExecution().executedPlan().toString()
    triples = [tuple(r) for r in found.collect()]
    # A dataset has a type, and links for each type of its rows; other triples are as many as files.
    assert triples and len(triples) == len(set(triples))


def _people(spark):
    from quadspark.operators.mapping import MappedGraph, TriplesMap, pom, template

    rows = [(i % 7 if i else None, "ab"[i % 2], i % 3 or None) for i in range(40)]
    other = [(i, f"n{i % 2}") for i in range(5)]
    sources = {"p": spark.createDataFrame(rows, "id int, name string, boss int"), "q": spark.createDataFrame(other, "id int, name string")}
    # Both sources describe some of the same subjects.
    return MappedGraph(sources, [
        TriplesMap("p", template("http://e/{id}"), [pom("http://e/name", "name"), pom("http://e/boss", template("http://e/{boss}"))], ["http://e/P"]),
        TriplesMap("q", template("http://e/{id}"), [pom("http://e/name", "name")], ["http://e/Q", "http://e/P"])])


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sets_and_property_counts_by_subject(spark):
    from quadspark.operators.graphs import as_set
    from quadspark.operators.void import property_partition, property_partition_by_subject

    graph = _people(spark)
    dealt = as_set(graph.quads_by_subject(3))
    plan = _plan(dealt)  # before it runs, so that only one plan is told
    assert "hashpartitioning(s#" not in plan and plan.count("Exchange") == 2  # one for a source
    assert sorted(map(tuple, dealt.collect()), key=str) == sorted(map(tuple, as_set(graph.quads()).collect()), key=str)
    want = property_partition(as_set(graph.quads()))
    found = property_partition_by_subject(dealt).select(*want.columns)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))


def test_class_partitions_by_subject(spark):
    from quadspark.operators import void
    from quadspark.operators.mapping import GraphBySubject

    graph = _people(spark)
    dealt = GraphBySubject(graph, 3)
    for name in ("class_partitions", "class_property_partition"):
        want = getattr(void, name)(graph)
        found = getattr(void, name + "_by_subject")(dealt).select(*want.columns)
        assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
        assert "hashpartitioning(s#" not in _plan(found) and "hashpartitioning(inst#" not in _plan(found)


def test_lines_of_a_large_graph_are_not_shuffled_for_its_blocks(spark):
    from quadspark.functions.terms import QUAD_SCHEMA
    from quadspark.sinks.rdf import trig_blocks

    rows = [(f"http://e/{i}", "iri", "http://e/p", "v" * 50, "literal", "http://www.w3.org/2001/XMLSchema#string", None,
             "http://e/g" if i % 9 == 0 else None) for i in range(60)]
    blocks = trig_blocks(spark.createDataFrame(rows, QUAD_SCHEMA), 1000)
    plan = _plan(blocks)
    assert "BroadcastHashJoin" in plan and plan.count("Exchange hashpartitioning") == 1
    texts = [r.value for r in blocks.collect()]
    assert sum(t.count('"') // 2 for t in texts) == 60 and len(texts) > 4


def test_quads_of_a_log_are_written_compressed(spark, place, monkeypatch):
    import datetime

    from quadspark.plans.catalog import logs
    from quadspark.plans.registry import SCHEMAS
    from quadspark.sinks.rdf import format_and_codec

    paths, write = [], logs.write_rdf
    monkeypatch.setattr(logs, "write_rdf", lambda df, path: (paths.append(path), write(df, path)))
    rows = [(i, datetime.datetime(2024, 1, 1, 0, 0, i), 1, "click" if i % 3 else "error", 60.0, '{"k": 5}') for i in range(9)]
    spark.createDataFrame(rows, SCHEMAS["events"]).write.parquet(f"{place}/events.parquet")
    assert logs.s5_rdf_log(spark, place).count() == 12
    assert [format_and_codec(p) for p in paths] == [("nq", "gzip")]


def test_quads_of_a_log_are_read_once(spark, place):
    from quadspark.functions.terms import QUAD_SCHEMA
    from quadspark.operators.querylog import LOG, log_of_quads, read_rdf_log
    from quadspark.sinks.rdf import write_rdf

    def quads(s, *values):
        return [(f"http://e/{s}", "iri", LOG + p, o, "literal", "http://www.w3.org/2001/XMLSchema#string", None, None) for p, o in values]

    entries = {1: "a", 2: "a", 3: None}
    rows = [row for i, host in entries.items() for row in quads(f"entry{i}", ("position", str(i)), *([("host", host)] if host else []))]
    rows += quads("entry1", ("host", "b"))  # of several values the least counts
    # Entry 2 has three queries; entry 9 and query 4 are only named; query 1 is said twice.
    links = [(1, 1), (1, 2), (2, 2), (3, 2), (4, 3), (1, 9), (1, 1)]
    rows += [(f"http://e/query{q}", "iri", LOG + "entry", f"http://e/entry{e}", "iri", None, None, None) for q, e in links]
    rows += 2 * quads("query1", ("text", "ASK {}"), ("hash", "h1"), ("uses_filter", "true"))
    rows += quads("query2", ("hash", "h2"), ("form", "ASK")) + quads("query3", ("text", "SELECT"))
    given = spark.createDataFrame(rows, QUAD_SCHEMA).repartition(3)
    write_rdf(given, f"{place}/log.nq.gz")
    about = {1: ("ASK {}", "h1", None, True), 2: (None, "h2", "ASK", None), 3: ("SELECT", None, None, None), 4: (None, None, None, None)}
    want = sorted(((e if e in entries else None, entries.get(e), *about[q]) for q, e in set(links)), key=str)
    columns = ["seq", "host", "query", "query_hash", "form", "uses_filter"]
    for found in (log_of_quads(given), read_rdf_log(spark, f"{place}/log.nq.gz")):
        assert sorted(map(tuple, found.select(*columns).collect()), key=str) == want
    # Entries with one query each: no line is parsed again by the plan that joins them.
    write_rdf(given.filter("not (p like '%entry' and o = 'http://e/entry2')"), f"{place}/once.nq.gz")
    once = read_rdf_log(spark, f"{place}/once.nq.gz")
    assert "Scan text" not in _plan(once) and once.count() == 3


def test_lines_are_decoded_once(spark, place):
    from quadspark.sources.rdf import read_rdf_lines

    with open(f"{place}/a.nq", "w") as f:
        f.write('<http://e/s> <http://e/p> "a\\"b" .\n_:x <http://e/p> <http://e/o\\u00e9> _:g .\n')
    quads = read_rdf_lines(spark, f"{place}/a.nq").filter("p = 'http://e/p'")
    assert _plan(quads.select("s", "p", "o")).count("from_json") == 1
    first, second = sorted(quads.collect(), key=lambda r: r.s_kind, reverse=True)
    assert (first.s, first.o, first.g) == ("http://e/s", 'a"b', None)
    assert second.s.endswith("-x") and second.o == "http://e/oé" and second.g == "_:" + second.s[:-1] + "g"


def test_words_of_a_query_are_found_where_no_name_holds_them(spark):
    from quadspark.operators.querylog import FEATURES, enrich

    cases = {
        "SELECT * { FILTER(?x)} limit 1": ("SELECT", {"filter", "limit"}), "ask{ ?filter :limit x:union }": ("ASK", set()),
        "select(count (?x) as ?n){}": ("SELECT", {"aggregate"}), "SELECT ?n { BIND(x:count(?y) AS ?n) } ": ("SELECT", set()),
        "?select x:ask describe <limit> ?count(": ("DESCRIBE", set()), "filters prefilter filter:x -union \U0001f600UNION": (None, {"union"}),
        "SELECT group_concat(?x) Distinct # optional": ("SELECT", {"aggregate", "distinct"}), "SELECT $sum(?x) optional": ("SELECT", {"optional"})}
    rows = enrich(spark.createDataFrame([(q,) for q in cases], "query string"), ["form", "features"]).collect()
    assert {r.query: (r.form, {f for f in FEATURES if r[f"uses_{f}"]}) for r in rows} == cases
