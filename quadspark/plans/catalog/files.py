"""S, K, L: sources, sinks and loading.

Files are written from the tables below the checkpoint folder and read back;
the oracles state the result on the tables.
"""

from pyspark.sql import functions as F

from quadspark.functions.terms import BNODE, XSD_INTEGER
from quadspark.operators import load
from quadspark.operators.graphs import into_graph
from quadspark.operators.mapping import TriplesMap, apply_mapping, apply_mappings, pom, reference, template
from quadspark.operators.patterns import match
from quadspark.plans.catalog.statistics import document_graph
from quadspark.plans.registry import query, spread_table, table
from quadspark.plans.testgraph import EX, graph, node
from quadspark.session import scratch_path
from quadspark.sinks.rdf import (
    publish_if_changed,
    read_quad_table,
    save,
    write_quad_table,
    write_rdf,
    write_trig_blocks,
)
from quadspark.sources.manifest import accepts_type, file_graph_mapping, graph_name, list_sources
from quadspark.sources.prefixes import compact_iris, expand_curies
from quadspark.sources.rdf import read_rdf_lines, read_rdf_rejects, read_trig_blocks
from quadspark.sources.tabular import read_csv_source, read_json_source, read_xml_rows
from quadspark.streaming.load import load_stream

CUST = "'http://example.org/customer/' || "
ORDER = "'http://example.org/order/' || "


# --- S1, K1: line files ---------------------------------------------------------

@query("s1_rdf_lines", f"""
SELECT {CUST} c_custkey AS s, c_name AS o, 'http://www.w3.org/2001/XMLSchema#string' AS o_dt,
  'http://example.org/segment/' || c_mktsegment AS g FROM customer
UNION ALL SELECT {CUST} c_custkey, c_nationkey::VARCHAR, 'http://www.w3.org/2001/XMLSchema#integer', NULL FROM customer
""")
def s1_rdf_lines(spark, sf):
    """Lines put together from columns, with comments and odd spacing, in bz2 files."""
    c = table(spark, sf, "customer")
    subject = F.concat(F.lit(f"<{EX}customer/"), F.col("c_custkey"), F.lit(">"))
    name = F.format_string(
        f'%s\t<{EX}name>  "%s" <{EX}segment/%s> . # a comment', subject, F.col("c_name"), F.col("c_mktsegment"))
    number = F.format_string(f'%s<{EX}nation>"%d"^^<{XSD_INTEGER}>.', subject, F.col("c_nationkey"))
    lines = c.select(F.explode(F.array(name, number, F.lit("# comment"), F.lit(" "))).alias("value"))
    path = scratch_path(spark, "lines")
    lines.write.option("compression", "bzip2").text(path)
    return read_rdf_lines(spark, path).select("s", "o", "o_dt", "g")


@query("s1_rejects", """
SELECT 'this is no triple ' || s_suppkey AS reject FROM supplier
UNION ALL SELECT '<http://example.org/s> <http://example.org/p> "a"' || s_suppkey || '" .' FROM supplier
""")
def s1_rejects(spark, sf):
    s = table(spark, sf, "supplier")
    key = F.col("s_suppkey").cast("string")
    lines = s.select(F.explode(F.array(
        F.concat(F.lit("this is no triple "), key),
        F.concat(F.lit(f'<{EX}s> <{EX}p> "a"'), key, F.lit('" .')),
        F.concat(F.lit(f'<{EX}s> <{EX}p> "'), key, F.lit('" .')))).alias("value"))
    path = scratch_path(spark, "rejects")
    lines.write.text(path)
    return read_rdf_rejects(spark, path).select("reject")


@query("k1_s1_round_trip", """
SELECT 'http://example.org/doc/' || doc_id AS s, md5(text) AS o_md5, lang AS o_lang, 'http://example.org/all' AS g
FROM documents
""")
def k1_s1_round_trip(spark, sf):
    """Whole texts with line breaks, quotes and non-ASCII letters as N-Quads."""
    m = TriplesMap("documents", node("doc", "doc_id"), [pom(EX + "text", "text", language=reference("lang"))])
    quads = into_graph(apply_mapping(spread_table(spark, sf, "documents", "doc_id"), m), EX + "all")
    path = scratch_path(spark, "quads")
    write_rdf(quads, path, output_format="nq")
    return read_rdf_lines(spark, path).select("s", F.md5("o").alias("o_md5"), "o_lang", "g")


@query("k1_ntriples_counts", """
SELECT 'http://example.org/status' AS p, count(*) AS n FROM orders
UNION ALL SELECT 'http://example.org/priority', count(*) FROM orders
UNION ALL SELECT 'http://example.org/total', count(*) FROM orders
UNION ALL SELECT 'http://example.org/customer', count(*) FROM orders
UNION ALL SELECT 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type', count(*) FROM orders
""")
def k1_ntriples_counts(spark, sf):
    path = scratch_path(spark, "orders")
    write_rdf(graph(spark, sf, "orders").quads(), path, output_type="nt")
    return read_rdf_lines(spark, path).groupBy("p").agg(F.count(F.lit(1)).alias("n"))


@query("k1_page_sources", """
SELECT 'http://example.org/page/' || page_id AS s, md5(html) AS html_md5 FROM pages
""")
def k1_page_sources(spark, sf):
    m = TriplesMap("pages", node("page", "page_id"), [pom(EX + "html", "html")])
    path = scratch_path(spark, "pages")
    write_rdf(apply_mapping(spread_table(spark, sf, "pages", "page_id"), m), path, output_format="ttl")
    return read_rdf_lines(spark, path).select("s", F.md5("o").alias("html_md5"))


# --- S2 - S4: tables and documents -----------------------------------------------

@query("s2_csv", "SELECT c_custkey::VARCHAR AS c_custkey, c_name, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS segment FROM customer")
def s2_csv(spark, sf):
    c = table(spark, sf, "customer").select(
        "c_custkey", "c_name", F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("segment"))
    path = scratch_path(spark, "csv")
    c.write.option("header", True).csv(f"{path}/customer")
    return read_csv_source(spark, "customer", base_dir=path)


@query("s2_csv_multiline", "SELECT doc_id::VARCHAR AS doc_id, md5(text) AS text_md5, lang FROM documents")
def s2_csv_multiline(spark, sf):
    path = scratch_path(spark, "csv")
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    docs.write.option("header", True).option("escape", '"').csv(
        path, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    rows = read_csv_source(
        spark, path, multiline=True, ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
    return rows.select("doc_id", F.md5("text").alias("text_md5"), "lang")


@query("s3_json_sequence", """
SELECT event_type, count(*) AS n, sum(CAST(regexp_extract(props, '\\d+') AS BIGINT))::BIGINT AS k FROM events GROUP BY 1
""")
def s3_json_sequence(spark, sf):
    """Records of the event properties as a JSON sequence."""
    events = table(spark, sf, "events")
    path = scratch_path(spark, "json")
    record = F.to_json(F.struct("event_type", F.from_json("props", "k bigint").alias("props")))
    events.select(record.alias("value")).write.option("lineSep", "\x1e").text(path)
    rows = read_json_source(spark, path, "sequence", "event_type string, props struct<k: bigint>")
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("props.k").alias("k"))


@query("s3_json_array", "SELECT s_name, s_nationkey::BIGINT AS s_nationkey FROM supplier")
def s3_json_array(spark, sf):
    """One array per file, of a block of keys: an array is bounded, however many there are."""
    path = scratch_path(spark, "json")
    rows = table(spark, sf, "supplier").select("s_name", "s_nationkey", F.floor(F.col("s_suppkey") / 10_000).alias("block"))
    arrays = rows.groupBy("block").agg(F.to_json(F.collect_list(F.struct("s_name", "s_nationkey"))).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    return read_json_source(spark, path, "array", "s_name string, s_nationkey bigint")


@query("s4_xml_rows", "SELECT c_custkey::BIGINT AS c_custkey, c_name FROM customer")
def s4_xml_rows(spark, sf):
    path = scratch_path(spark, "xml")
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    c.write.format("xml").option("rowTag", "customer").option("rootTag", "customers").save(path)
    return read_xml_rows(spark, path, "customer", "c_custkey bigint, c_name string")


# --- S6 - S9 ------------------------------------------------------------------------

_TYPES = """CASE WHEN p_size < 10 THEN 'nt' WHEN p_size < 20 THEN 'rml.ttl' WHEN p_size < 30 THEN 'hint'
  WHEN p_size < 40 THEN 'NQ' ELSE lower(p_type) || '.nq.bz2' END"""


@query("s6_list_sources", f"""
SELECT p_partkey::VARCHAR AS path, {_TYPES} AS type FROM part WHERE p_size < 20 OR p_size >= 40
""")
def s6_list_sources(spark, sf):
    """The type predicate of the file listing."""
    size = F.col("p_size")
    kind = F.when(size < 10, "nt").when(size < 20, "rml.ttl").when(size < 30, "hint").when(size < 40, "NQ").otherwise(
        F.concat(F.lower("p_type"), F.lit(".nq.bz2")))
    files = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("path"), kind.alias("type"))
    return files.filter(accepts_type(F.col("type"), "nt, ttl,nq.bz2"))


@query("s7_file_graph_mapping", """
SELECT 'file:/extra/one.nt' AS source, 'http://example.org/extra' AS g, 'nt' AS type
UNION ALL SELECT 'file:/extra/two.nq.gz', NULL, 'nq.gz'
UNION ALL SELECT url, 'http://example.org/pages', 'page' FROM pages
""")
def s7_file_graph_mapping(spark, sf):
    """Two explicit files next to a manifest of pages."""
    pages = table(spark, sf, "pages").select(
        F.col("url").alias("source"), F.lit("page").alias("type"), F.lit(EX + "pages").alias("g"))
    extra = file_graph_mapping(spark, [("file:/extra/one.nt", EX + "extra"), ("file:/extra/two.nq.gz", "  ")])
    return pages.unionByName(extra.select("source", "type", "g"))


def _nation_prefixes(spark, sf):
    return table(spark, sf, "nation").select(
        F.concat(F.lit("n"), F.col("n_nationkey")).alias("prefix"),
        F.concat(F.lit(EX + "nation/"), F.col("n_nationkey"), F.lit("/")).alias("iri"))


@query("s8_expand_curies", """
SELECT c_name AS name, 'http://example.org/nation/' || c_nationkey || '/' || c_custkey AS term FROM customer
UNION ALL SELECT c_name, 'zz:' || c_custkey FROM customer
""")
def s8_expand_curies(spark, sf):
    c = table(spark, sf, "customer")
    curies = F.array(F.concat(F.lit("n"), "c_nationkey", F.lit(":"), "c_custkey"), F.concat(F.lit("zz:"), "c_custkey"))
    rows = c.select(F.col("c_name").alias("name"), F.explode(curies).alias("term"))
    return expand_curies(rows, _nation_prefixes(spark, sf), "term")


@query("s8_compact_iris", """
SELECT c_name AS name, 'n' || c_nationkey || ':' || c_custkey AS term FROM customer
""")
def s8_compact_iris(spark, sf):
    c = table(spark, sf, "customer")
    rows = c.select(F.col("c_name").alias("name"), F.concat(
        F.lit(EX + "nation/"), "c_nationkey", F.lit("/"), "c_custkey").alias("term"))
    return compact_iris(rows, _nation_prefixes(spark, sf), "term")


@query("k2_s9_trig_blocks", f"""
SELECT {ORDER} o_orderkey AS s, o_orderstatus AS o, {CUST} o_custkey AS g FROM orders
UNION ALL SELECT 'http://example.org/doc/' || doc_id, md5(text), NULL FROM documents
""")
def k2_s9_trig_blocks(spark, sf):
    """Many small graphs, and the default graph with large literals."""
    orders = graph(spark, sf, "orders").quads([EX + "status", EX + "customer"])
    customer = orders.filter(F.col("p") == EX + "customer").select(F.col("s").alias("x"), F.col("o").alias("cust"))
    status = orders.filter(F.col("p") == EX + "status").join(customer, F.col("s") == F.col("x"))
    docs = apply_mapping(spread_table(spark, sf, "documents", "doc_id"), TriplesMap(
        "documents", node("doc", "doc_id"), [pom(EX + "text", "text")]))
    path = scratch_path(spark, "blocks")
    write_trig_blocks(into_graph(status, F.col("cust")).unionByName(docs), path, block_chars=20_000)
    back = read_trig_blocks(spark, path)
    text = F.when(F.col("p") == EX + "text", F.md5("o")).otherwise(F.col("o"))
    return back.select("s", text.alias("o"), "g")


def _accounts(spark, sf):
    """Customers with a blank account, which has the name; dealt at random over many files."""
    accounts = TriplesMap("customer", node("customer", "c_custkey"), [pom(EX + "account", template("account {c_custkey}%", BNODE))])
    names = TriplesMap("customer", template("account {c_custkey}%", BNODE), [pom(EX + "label", "c_name")])
    quads = apply_mappings({"customer": table(spark, sf, "customer")}, [accounts, names])
    return quads.repartition(8, "o")


def _followed(quads):
    """Customers and the names of their accounts."""
    account = quads.filter(F.col("p") == EX + "account").select("s", F.col("o").alias("account"))
    label = quads.filter(F.col("p") == EX + "label").select(F.col("s").alias("account"), F.col("o").alias("name"))
    return account.join(label, "account").select("s", "name")


_ACCOUNT_NAMES = "SELECT 'http://example.org/customer/' || c_custkey AS s, c_name AS name FROM customer"


@query("k1_blank_links", _ACCOUNT_NAMES)
def k1_blank_links(spark, sf):
    """Blank nodes link triples of different part files, and their labels need encoding."""
    path = scratch_path(spark, "blank")
    write_rdf(_accounts(spark, sf), path, output_format="nt")
    return _followed(read_rdf_lines(spark, path))


@query("k2_blank_links", _ACCOUNT_NAMES)
def k2_blank_links(spark, sf):
    path = scratch_path(spark, "blank")
    write_trig_blocks(into_graph(_accounts(spark, sf), EX + "accounts"), path, block_chars=20_000)
    return _followed(read_trig_blocks(spark, path))


@query("k1_iri_escapes", r"""
SELECT 'http://example.org/' || p_name || ' "' || p_type || '"\{' || p_partkey || '}' AS s, p_brand AS o FROM part
""")
def k1_iri_escapes(spark, sf):
    """Names that an IRI cannot hold as they are come back unchanged."""
    part = table(spark, sf, "part")
    name = F.concat(F.lit(EX), "p_name", F.lit(' "'), "p_type", F.lit('"\\{'), "p_partkey", F.lit("}"))
    quads = part.select(
        name.alias("s"), F.lit("iri").alias("s_kind"), F.lit(EX + "brand").alias("p"), F.col("p_brand").alias("o"),
        F.lit("literal").alias("o_kind"), F.lit("http://www.w3.org/2001/XMLSchema#string").alias("o_dt"),
        F.lit(None).cast("string").alias("o_lang"), F.lit(None).cast("string").alias("g"))
    path = scratch_path(spark, "escaped")
    write_rdf(quads, path, output_format="nt")
    return read_rdf_lines(spark, path).select("s", "o")


# --- K3 - K6 ---------------------------------------------------------------------------

@query("k3_save", "SELECT s_suppkey, s_name FROM supplier WHERE s_acctbal > 0")
def k3_save(spark, sf):
    """Written, overwritten, and left alone by SKIP."""
    s = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    path = scratch_path(spark, "saved")
    save(s, path)
    save(s.filter("s_acctbal > 0"), path, "OVERWRITE")
    save(s.filter("s_acctbal < 0"), path, "SKIP")
    return spark.read.parquet(path).select("s_suppkey", "s_name")


@query("k4_compression", """
SELECT codec, 'http://example.org/name' AS p, count(*) AS n FROM customer, (VALUES ('bz2'), ('gz')) AS c(codec) GROUP BY codec
""")
def k4_compression(spark, sf):
    names = graph(spark, sf, "customer").quads([EX + "name"])
    counts = []
    for codec in ("gz", "bz2"):
        path = scratch_path(spark, "packed") + f".nt.{codec}"
        write_rdf(names, path)
        counts.append(read_rdf_lines(spark, path).groupBy(F.lit(codec).alias("codec"), "p").agg(
            F.count(F.lit(1)).alias("n")))
    return counts[0].unionByName(counts[1])


@query("k5_quad_table", f"SELECT {ORDER} o_orderkey AS o, {CUST} o_custkey AS c FROM orders")
def k5_quad_table(spark, sf):
    """Stored twice over; a pattern on a stored graph reads the files of its predicate."""
    quads = graph(spark, sf, "orders").quads()
    path = scratch_path(spark, "table")
    write_quad_table(quads.unionByName(quads), path, partition_predicates=True)
    return match(read_quad_table(spark, path), "?o", EX + "customer", "?c").select("o", "c")


@query("k5_unpartitioned", "SELECT lang AS o_lang, count(DISTINCT (doc_id, text)) AS n FROM documents GROUP BY lang")
def k5_unpartitioned(spark, sf):
    path = scratch_path(spark, "table")
    write_quad_table(document_graph(spark, sf).quads([EX + "text"]), path)
    return read_quad_table(spark, path).groupBy("o_lang").agg(F.count(F.lit(1)).alias("n"))


@query("k6_publish", "SELECT c_custkey FROM customer WHERE c_acctbal > 0")
def k6_publish(spark, sf):
    """Missing copy written, unchanged one kept, changed one replaced."""
    c = table(spark, sf, "customer")
    path = scratch_path(spark, "published")
    publish_if_changed(spark, c.select("c_custkey"), path, changed=False)
    publish_if_changed(spark, c.filter("c_acctbal > 0").select("c_custkey"), path, changed=True)
    publish_if_changed(spark, c.select("c_custkey"), path, changed=False)
    return spark.read.parquet(path)


# --- L: loading --------------------------------------------------------------------------

@query("l1_graph_name", """
SELECT p_partkey, 'urn:mvn:org.example:' || p_name || ':' || p_size
  || CASE WHEN p_size > 20 THEN ':nt.bz2' ELSE '' END || CASE WHEN p_type = 'PROMO' THEN ':dcat' ELSE '' END AS g
FROM part
""")
def l1_graph_name(spark, sf):
    g = graph_name(
        F.lit("org.example"), F.col("p_name"), F.col("p_size").cast("string"),
        F.when(F.col("p_size") > 20, "nt.bz2").otherwise(""), F.when(F.col("p_type") == "PROMO", "dcat"))
    return table(spark, sf, "part").select("p_partkey", g.alias("g"))


def _write_names(spark, sf):
    """Name triples of customers and suppliers in two folders."""
    root = scratch_path(spark, "sources")
    for name in ("customer", "supplier"):
        write_rdf(graph(spark, sf, name).quads([EX + "name"]), f"{root}/{name}", output_format="nt")
    return root


def _folder_graph():
    """Graph of a listed file: its folder; suppliers go to the default graph."""
    folder = F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1)
    return F.when(folder == "customer", F.concat(F.lit(EX), folder))


@query("l3_load_all", """
SELECT 'http://example.org/customer' AS g, c_name AS o FROM customer UNION ALL SELECT NULL, s_name FROM supplier
""")
def l3_load_all(spark, sf):
    manifest = list_sources(spark, _write_names(spark, sf), "txt", _folder_graph())
    return load.load_all(spark, manifest).select("g", "o")


@query("l3_run_load", """
SELECT 'http://example.org/customer' AS g, c_name AS o FROM customer UNION ALL SELECT NULL, s_name FROM supplier
""")
def l3_run_load(spark, sf):
    """Two runs over a growing folder, the second one twice: each file is loaded once."""
    root = _write_names(spark, sf)
    place = scratch_path(spark, "store")
    for folder in (f"{root}/customer", root, root):
        manifest = list_sources(spark, folder, "txt", _folder_graph())
        load.run_load(spark, manifest, f"{place}/table", f"{place}/state", f"{place}/published")
    return spark.read.parquet(f"{place}/published").select("g", "o")


def _nation_files(spark, lines, root):
    """Write lines (nation, value) as one file per nation; there are 25 nations."""
    staged = scratch_path(spark, "nations")
    lines.repartition("nation").write.partitionBy("nation").text(staged)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    system = path(staged).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(path(root))
    for status in system.globStatus(path(f"{staged}/nation=*/part-*")):
        target = path(f"{root}/{status.getPath().getParent().getName().removeprefix('nation=')}.nt")
        system.delete(target, False)
        system.rename(status.getPath(), target)


def _nation_graph():
    return F.concat(F.lit(EX + "nation/"), F.regexp_extract("path", r"/(\d+)\.nt$", 1))


@query("l3_rejects", """
SELECT 'http://example.org/nation/' || s_nationkey AS g, count(*) FILTER (s_acctbal < 0) AS rejects,
  CASE WHEN count(*) FILTER (s_acctbal < 0) = 0 THEN count(*) ELSE 0 END AS loaded
FROM supplier GROUP BY s_nationkey
""")
def l3_rejects(spark, sf):
    """Suppliers in debt are malformed lines: their nations' files stay pending, and the lines are kept."""
    supplier = table(spark, sf, "supplier")
    good = F.concat(F.lit(f"<{EX}supplier/"), "s_suppkey", F.lit(f"> <{EX}name> \""), "s_name", F.lit('" .'))
    lines = supplier.select(
        F.col("s_nationkey").alias("nation"), F.when(F.col("s_acctbal") < 0, F.concat(F.lit("@prefix "), good)).otherwise(good).alias("value"))
    root, place = scratch_path(spark, "incoming"), scratch_path(spark, "store")
    _nation_files(spark, lines, root)
    manifest = list_sources(spark, root, graph=_nation_graph())
    load.run_load(spark, manifest, f"{place}/table", f"{place}/state", on_reject="keep")
    files = manifest.select("source", "g")
    rejects = load.read_kept_rejects(spark, f"{place}/table").groupBy("source").agg(F.count(F.lit(1)).alias("rejects"))
    quads = load.read_loaded(spark, f"{place}/table", f"{place}/state").groupBy("g").agg(F.count(F.lit(1)).alias("loaded"))
    return files.join(rejects, "source", "left").join(quads, "g", "left").select(
        "g", F.coalesce("rejects", F.lit(0)).cast("bigint").alias("rejects"),
        F.coalesce("loaded", F.lit(0)).cast("bigint").alias("loaded"))


@query("l3_reload_changed", """
SELECT 'http://example.org/nation/' || c_nationkey AS g, c_name AS o FROM customer WHERE c_acctbal >= 0
""")
def l3_reload_changed(spark, sf):
    """Files are loaded, then written again without some lines, and loaded again."""
    customer = table(spark, sf, "customer")
    line = F.concat(F.lit(f"<{EX}customer/"), "c_custkey", F.lit(f"> <{EX}name> \""), "c_name", F.lit('" .'))
    root, place = scratch_path(spark, "incoming"), scratch_path(spark, "store")
    for rows in (customer, customer.filter("c_acctbal >= 0")):
        # A comment keeps files of nations that have no line left.
        first = customer.select(F.col("c_nationkey").alias("nation"), F.lit("# names").alias("value")).distinct()
        _nation_files(spark, first.unionByName(rows.select(F.col("c_nationkey").alias("nation"), line.alias("value"))), root)
        manifest = list_sources(spark, root, graph=_nation_graph())
        load.run_load(spark, manifest, f"{place}/table", f"{place}/state", fingerprint=True)
    return load.read_loaded(spark, f"{place}/table", f"{place}/state").select("g", "o")


def _page_manifest(spark, sf):
    return table(spark, sf, "pages").select(
        F.col("url").alias("source"), F.lit("page").alias("type"), F.concat(F.lit(EX + "page/"), "page_id").alias("g"),
        F.length("html").cast("bigint").alias("length"), F.lit(None).cast("timestamp").alias("modified"),
        F.lit(False).alias("explicit"))


@query("l4_pending", """
SELECT url AS source, min('http://example.org/page/' || page_id) AS g FROM pages
WHERE url NOT LIKE '%utm_source%' GROUP BY url
""")
def l4_pending(spark, sf):
    """Pages reached through a feed are loaded already; a source counts once."""
    manifest = _page_manifest(spark, sf)
    state = load.state_rows(manifest.filter(F.col("source").contains("utm_source")))
    return load.pending(manifest, state).select("source", "g")


@query("l4_pending_per_graph", """
SELECT url AS source, 'http://example.org/page/' || page_id AS g FROM pages WHERE url NOT LIKE '%utm_source%'
""")
def l4_pending_per_graph(spark, sf):
    manifest = _page_manifest(spark, sf)
    state = load.state_rows(manifest.filter(F.col("source").contains("utm_source")))
    return load.pending(manifest, state, key="source,graph").select("source", "g")


@query("l5_load_state_triples", """
SELECT 'http://www.example.org/load' AS p, 'bnode' AS o_kind, count(*) AS n, count(DISTINCT url) AS things
  FROM (SELECT DISTINCT url FROM pages)
UNION ALL SELECT 'http://www.example.org/file', 'literal', count(*), count(DISTINCT url) FROM (SELECT DISTINCT url FROM pages)
UNION ALL SELECT 'http://www.example.org/graph', 'iri', count(*), count(DISTINCT page_id) FROM pages
""")
def l5_load_state_triples(spark, sf):
    path = scratch_path(spark, "state")
    load.record_load(_page_manifest(spark, sf), path)
    triples = load.load_state_triples(load.read_load_state(spark, path))
    return triples.groupBy("p", "o_kind").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("o").alias("things"))


@query("l6_load_stream", """
SELECT 'http://example.org/stream' AS g, c_name AS o FROM customer
UNION ALL SELECT 'http://example.org/stream', s_name FROM supplier
""")
def l6_load_stream(spark, sf):
    """A folder that grows between two runs of one stream."""
    root, place = scratch_path(spark, "incoming"), scratch_path(spark, "streamed")
    for name in ("customer", "supplier"):
        lines = scratch_path(spark, "part")
        write_rdf(graph(spark, sf, name).quads([EX + "name"]), lines, output_format="nt")
        spark.read.text(lines).write.mode("append").text(root)
        load_stream(spark, root, f"{place}/table", f"{place}/checkpoint", F.lit(EX + "stream")).awaitTermination()
    return read_quad_table(spark, f"{place}/table").select("g", "o")
