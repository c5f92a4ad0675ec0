"""Line files, graph blocks, tables and save modes."""

import random

import pytest
from pyspark.sql import functions as F

from quadspark.functions.terms import LANG_STRING, QUAD_COLUMNS, QUAD_SCHEMA, XSD_INTEGER, XSD_STRING
from quadspark.operators.patterns import match
from quadspark.sinks.rdf import (
    format_and_codec,
    publish_if_changed,
    read_quad_table,
    save,
    trig_blocks,
    write_quad_table,
    write_rdf,
    write_trig_blocks,
)
from quadspark.sources.prefixes import prefix_table, read_prefixes
from quadspark.sources.rdf import parse_rdf_lines, read_rdf_lines, read_rdf_rejects, read_trig_blocks

TEXTS = ["", "plain", 'a "quote"', "back\\slash", "\\n no break", "line\nbreak", "tab\t and \r return", "\u00e9\u4e2d",
         "\U0001F600", "\\u0041", "ends with \\", '\\"', "\u2028 sep", "}\n", "'single'", "\x01", " spaces "]


def sample(spark):
    rows = [("http://s/1", "iri", "http://p", t, "literal", XSD_STRING, None, None) for t in TEXTS]
    rows += [("http://s/1", "iri", "http://p", t, "literal", LANG_STRING, "en-gb", "http://g/1") for t in TEXTS]
    rows += [
        ("http://s/2", "iri", "http://p", "01", "literal", XSD_INTEGER, None, "http://g/2"),
        ("http://s/2", "iri", "http://p", "http://o/\u00e9", "iri", None, None, "http://g/2"),
        ("http://s/2", "iri", "http://q", "http://o", "iri", None, None, "_:graph"),
    ]
    return spark.createDataFrame(rows, QUAD_SCHEMA)


def as_set(df, *columns):
    return {tuple(r[c] for c in columns or QUAD_COLUMNS) for r in df.collect()}


@pytest.mark.parametrize("suffix", ["nq", "nq.gz", "nq.bz2"])
def test_quads_round_trip(spark, place, suffix):
    path = f"{place}/x.{suffix}"
    write_rdf(sample(spark).filter("g IS NULL OR g NOT LIKE '\\_:%'"), path)
    assert as_set(read_rdf_lines(spark, path)) == as_set(sample(spark).filter("g IS NULL OR g NOT LIKE '\\_:%'"))
    assert read_rdf_rejects(spark, path).count() == 0


def test_triples_drop_the_graph(spark, place):
    write_rdf(sample(spark), f"{place}/x", output_format="ttl")
    back = as_set(read_rdf_lines(spark, f"{place}/x"))
    assert back == {(*row[:-1], None) for row in as_set(sample(spark))}


def test_blank_nodes_keep_to_their_file(spark, place):
    for name in ("one", "two"):
        with open(f"{place}/{name}.nt", "w") as f:
            f.write('_:b <http://p> _:c .\n_:c <http://p> "x" .\n')
    rows = read_rdf_lines(spark, place).collect()
    assert len({r.s for r in rows}) == 4
    assert {r.o for r in rows if r.o_kind == "bnode"} <= {r.s for r in rows}


def test_escapes_and_malformed_lines(spark):
    s = "<http://s> <http://p> "
    cases = {
        s + r'"\u0041\U00000042\t\b\f\'\"\\u0043" .': "AB\t\b\f'\"\\u0043",
        s + r'"\\U0001F600\U0001F600" .': "\\U0001F600\U0001F600",
        s + '"a"@de-AT <http://g> . # "comment"': "a",
        s + '"x"^^<http://dt>.': "x",
        "<http://s><http://p>_:o.x.": "o.x", "<http://s>\t<http://p>\t_:o.x\t.": "o.x",
        s + '"a"b" .': None, s + '"unclosed .': None, s + r'"\U0011FFFF" .': None, "<http://s> <p q> <o> .": None,
        s + '"a"@ .': None, s + '"a"': None, "nothing": None, '"lit" <http://p> <http://o> .': None,
    }
    parsed = parse_rdf_lines(spark.createDataFrame([(k, k) for k in cases], "value string, line string")).collect()
    assert {r.line: r.o for r in parsed} == cases
    assert {r.reject for r in parsed if r.o is None} == {k for k, v in cases.items() if v is None}


def test_very_long_literals(spark):
    text = '\\n\\"a' * 200_000
    row = parse_rdf_lines(spark.createDataFrame([(f'<http://s> <http://p> "{text}" .',)], "value string")).first()
    assert len(row.o) == 600_000


def test_blocks_round_trip_and_are_bounded(spark, place):
    df = sample(spark)
    big = spark.range(5000).select(
        F.concat(F.lit("http://s/"), "id").alias("s"), F.lit("iri").alias("s_kind"), F.lit("http://p").alias("p"),
        F.col("id").cast("string").alias("o"), F.lit("literal").alias("o_kind"), F.lit(XSD_STRING).alias("o_dt"),
        F.lit(None).cast("string").alias("o_lang"), F.lit("http://g/big").alias("g"))
    everything = df.unionByName(big).unionByName(big)
    blocks = trig_blocks(everything, block_chars=5_000).select(F.size(F.split("value", "\n")).alias("n")).collect()
    assert len(blocks) > 50 and max(b.n for b in blocks) < 250
    write_trig_blocks(everything, place + "/x", block_chars=5_000)
    back = as_set(read_trig_blocks(spark, place + "/x"))
    # A blank graph name is local to its file: it comes back with the file's scope before its label.
    names = {row[-1] for row in back if (row[-1] or "").startswith("_:")}
    assert len(names) == 1 and names.pop().endswith("-graph")
    plain = {(*row[:-1], "_:graph" if (row[-1] or "").startswith("_:") else row[-1]) for row in back}
    assert plain == as_set(everything)


@pytest.mark.parametrize("suffix", ["nq", "trig"])
def test_blank_graph_names_keep_apart(spark, place, suffix):
    """One label in two files names two graphs; in one file it names one."""
    rows = [(f"http://s/{i}", "iri", "http://p", "x", "literal", XSD_STRING, None, f"_:g{i % 2}") for i in range(6)]
    for name in ("one", "two"):
        write_rdf(spark.createDataFrame(rows, QUAD_SCHEMA).repartition(2), f"{place}/{name}.{suffix}")
    read = read_rdf_lines if suffix == "nq" else read_trig_blocks
    both = as_set(read(spark, [f"{place}/one.{suffix}", f"{place}/two.{suffix}"]), "s", "g")
    assert len(both) == 12 and len({g for _, g in both}) == 4
    groups = {frozenset(s for s, g in both if g == name) for name in {g for _, g in both}}
    assert groups == {frozenset(f"http://s/{i}" for i in (0, 2, 4)), frozenset(f"http://s/{i}" for i in (1, 3, 5))}


def test_quad_table_is_a_set_and_prunes_by_predicate(spark, place):
    df = sample(spark)
    write_quad_table(df.unionByName(df), place + "/t", partition_predicates=True)
    table = read_quad_table(spark, place + "/t")
    assert table.count() == len(as_set(df))
    plan = match(table, "?s", "http://q", "?o", g="?g")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(p_key" in plan


def test_save_modes(spark, place):
    path = place + "/x"
    one, two = spark.range(1), spark.range(2)
    save(one, path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        save(two, path)
    save(two, path, "SKIP")
    assert spark.read.parquet(path).count() == 1
    save(two, path, "OVERWRITE")
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError):
        save(two, path, "APPEND")


def test_publish_only_changes(spark, place):
    path = place + "/p"
    assert publish_if_changed(spark, spark.range(1), path, changed=False)
    assert not publish_if_changed(spark, spark.range(2), path, changed=False)
    assert publish_if_changed(spark, spark.range(3), path, changed=True)
    assert spark.read.parquet(path).count() == 3


def test_format_precedence():
    assert format_and_codec("/a/x.nt", "nq", "ttl") == ("nq", None)
    assert format_and_codec("/a/x.nt.gz", None, "ttl") == ("ttl", "gzip")
    assert format_and_codec("/a/x", None, "ttl.bz2") == ("ttl", "bzip2")
    assert format_and_codec("/a/x.nq.bz2") == ("nq", "bzip2")
    assert format_and_codec("/a/x") == ("trig", None)
    with pytest.raises(ValueError):
        format_and_codec("/a/x", "docx")


def test_prefix_files(spark, place):
    with open(place + "/p.ttl", "w") as f:
        f.write("@prefix ex: <http://ex/> .\nPREFIX : <http://base#>\n# no prefix\n")
    assert as_set(read_prefixes(spark, place + "/p.ttl"), "prefix", "iri") == {("ex", "http://ex/"), ("", "http://base#")}
    assert prefix_table(spark, {"a": "b"}).count() == 1


def test_line_numbers_over_many_splits(spark, place):
    from quadspark.sources.querylog import read_query_log

    rng = random.Random(1)
    texts = [f"SELECT ?v{i} {{ ?s ?p {'x' * rng.randint(0, 200)} }}" for i in range(4000)]
    for name in ("one", "two"):
        with open(f"{place}/{name}.rq", "w") as f:
            f.write("\n".join(texts) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        rows = read_query_log(spark, place, "sparql").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 8000
    assert all(r.raw == texts[r.seq] for r in rows)


def test_entries_are_the_same_however_files_are_split(spark, place):
    from quadspark.operators.querylog import LOG, enrich, log_of_quads, query_only, rdfize_log, read_rdf_log
    from quadspark.sources.querylog import list_position, read_query_log

    rng = random.Random(2)
    line = '10.0.0.{} - - [01/Jan/2024:10:00:{:02d} +0000] "GET /sparql?query=ASK+%7B+%3Fs+%3Fp+{}+%7D HTTP/1.1" 200 5'
    lines = [line.format(rng.randrange(3), rng.randrange(2), rng.randrange(20)) for _ in range(600)]
    for name in ("one", "two"):
        with open(f"{place}/{name}.log", "w") as f:
            f.write("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = []
    for size in ("3000", "100000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            log = enrich(read_query_log(spark, place, "apache"), ["form", "features"])
            quads = rdfize_log(log, "http://b/")
            found.append(as_set(quads.filter(F.col("p") == LOG + "entry")))
            assert sorted(r.position for r in list_position(log).collect()) == list(range(1200))
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found[0] == found[1] and len(found[0]) == 1200
    # Quads are a log again, whose entries have the same names.
    columns = ["source", "seq", "host", "ts", "query", "query_hash", "form", "uses_filter"]
    for fmt in ("nq", "nt"):
        write_rdf(quads, f"{place}-back.{fmt}")
        back = read_rdf_log(spark, f"{place}-back.{fmt}")
        assert as_set(back, *columns) == as_set(log, *columns) and back.count() == 1200
        again = rdfize_log(back, "http://b/")
        assert as_set(again) == as_set(quads)
    bare = log_of_quads(rdfize_log(query_only(log).drop("form"), "http://b/").unionByName(quads.limit(0)))
    assert bare.count() == 1200 and as_set(bare, "host", "ts", "form") == {(None, None, None)}
