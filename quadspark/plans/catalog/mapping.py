"""M: tables to triples."""

from pyspark.sql import functions as F

from quadspark.functions import scalars as fn
from quadspark.functions.terms import (
    BNODE,
    IRI,
    RDF_TYPE,
    XSD_DATETIME,
    XSD_DECIMAL,
    XSD_INTEGER,
    Literal,
    literal_term,
)
from quadspark.operators.graphs import as_set
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
from quadspark.operators.patterns import match
from quadspark.operators.void import property_partition_by_subject
from quadspark.plans.registry import query, table
from quadspark.plans.testgraph import EX, MONEY, graph, maps, node
from quadspark.sources.storage import parts_of

TYPE = f"'{RDF_TYPE}'"
STR = "'http://www.w3.org/2001/XMLSchema#string'"


@query("m1_customer", f"""
WITH c AS (SELECT 'http://example.org/customer/' || c_custkey AS s, * FROM customer)
SELECT s, {TYPE} AS p, 'http://example.org/Customer' AS o, 'iri' AS o_kind, NULL AS o_dt FROM c
UNION ALL SELECT s, 'http://example.org/name', c_name, 'literal', {STR} FROM c
UNION ALL SELECT s, 'http://example.org/segment', c_mktsegment, 'literal', {STR} FROM c
UNION ALL SELECT s, 'http://example.org/nation', 'http://example.org/nation/' || c_nationkey, 'iri', NULL FROM c
""")
def m1_customer(spark, sf):
    return graph(spark, sf, "customer").quads().select("s", "p", "o", "o_kind", "o_dt")


@query("m1_lineitem", """
WITH l AS (SELECT l_orderkey || '-' || l_linenumber AS s, * FROM lineitem),
v AS (
  SELECT DISTINCT 'order' AS p, s, CAST(l_orderkey AS VARCHAR) AS o FROM l
  UNION ALL SELECT DISTINCT 'part', s, CAST(l_partkey AS VARCHAR) FROM l
  UNION ALL SELECT DISTINCT 'supplier', s, CAST(l_suppkey AS VARCHAR) FROM l
  UNION ALL SELECT DISTINCT 'quantity', s, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) FROM l
  UNION ALL SELECT DISTINCT 'price', s, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) FROM l
  UNION ALL SELECT DISTINCT 'flag', s, l_returnflag FROM l
  UNION ALL SELECT DISTINCT '#type', s, 'Lineitem' FROM l)
SELECT CASE p WHEN '#type' THEN 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type' ELSE 'http://example.org/' || p END AS p,
  count(*) AS triples, count(DISTINCT s) AS distinct_subjects, count(DISTINCT o) AS distinct_objects
FROM v GROUP BY 1
""")
def m1_lineitem(spark, sf):
    """Keys repeat in ``lineitem``: the mapped rows become a set first."""
    parts = parts_of(spark, f"{sf}/lineitem.parquet")
    return property_partition_by_subject(as_set(graph(spark, sf, "lineitem").quads_by_subject(parts)))


@query("m2_template", """
SELECT DISTINCT 'http://example.org/product/' || url_encode(p_name) || '/' || url_encode(p_brand) || '/' || p_size AS s
FROM part
""")
def m2_template(spark, sf):
    m = TriplesMap("part", template(EX + "product/{p_name}/{p_brand}/{p_size}"), classes=[EX + "Product"])
    return apply_mapping(table(spark, sf, "part"), m).select("s").distinct()


@query("m3_constant", """
SELECT 'http://example.org/supplier/' || s_suppkey AS s, 'http://example.org/source' AS p, o, kind AS o_kind
FROM supplier, (VALUES ('http://example.org/erp', 'iri'), ('imported', 'literal')) AS c(o, kind)
""")
def m3_constant(spark, sf):
    m = TriplesMap("supplier", node("supplier", "s_suppkey"), [
        pom(EX + "source", constant(EX + "erp")), pom(EX + "source", Literal("imported"))])
    return apply_mapping(table(spark, sf, "supplier"), m).select("s", "p", "o", "o_kind")


@query("m4_reference", """
SELECT 'http://example.org/part/' || p_partkey AS s, 'http://example.org/label' AS p, p_name AS o FROM part
UNION ALL SELECT 'http://example.org/part/' || p_partkey, 'http://example.org/kind', p_type FROM part
""")
def m4_reference(spark, sf):
    m = TriplesMap("part", node("part", "p_partkey"), [pom(EX + "label", "p_name"), pom(EX + "kind", "p_type")])
    return apply_mapping(table(spark, sf, "part"), m).select("s", "p", "o")


@query("m5_datatype", """
SELECT 'http://example.org/order/' || o_orderkey AS s, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o,
  'http://www.w3.org/2001/XMLSchema#decimal' AS o_dt FROM orders
UNION ALL SELECT 'http://example.org/order/' || o_orderkey, CAST(o_custkey AS VARCHAR),
  'http://www.w3.org/2001/XMLSchema#integer' FROM orders
""")
def m5_datatype(spark, sf):
    m = TriplesMap("orders", node("order", "o_orderkey"), [
        pom(EX + "total", expression(f"cast(o_totalprice AS {MONEY})"), XSD_DECIMAL),
        pom(EX + "customerKey", "o_custkey", XSD_INTEGER)])
    return apply_mapping(table(spark, sf, "orders"), m).select("s", "o", "o_dt")


@query("m6_term_type", """
SELECT 'page-' || page_id AS s, 'bnode' AS s_kind, url AS o, 'iri' AS o_kind, NULL AS o_dt FROM pages
UNION ALL SELECT 'page-' || page_id, 'bnode', 'html-' || page_id, 'bnode', NULL FROM pages
UNION ALL SELECT 'page-' || page_id, 'bnode', url, 'literal', 'http://www.w3.org/2001/XMLSchema#string' FROM pages
""")
def m6_term_type(spark, sf):
    m = TriplesMap("pages", template("page-{page_id}", BNODE), [
        pom(EX + "url", "url", term_type=IRI),
        pom(EX + "content", template("html-{page_id}", BNODE)),
        pom(EX + "urlText", "url")])
    return apply_mapping(table(spark, sf, "pages"), m).select("s", "s_kind", "o", "o_kind", "o_dt")


@query("m7_nulls", """
SELECT 'http://example.org/customer/' || c_custkey AS s, c_mktsegment AS o FROM customer WHERE NOT (c_acctbal < 0)
""")
def m7_nulls(spark, sf):
    df = table(spark, sf, "customer").withColumn("segment", F.when(F.col("c_acctbal") < 0, None).otherwise(
        F.col("c_mktsegment")))
    m = TriplesMap("customer", node("customer", "c_custkey"), [pom(EX + "segment", "segment")])
    return apply_mapping(df, m).select("s", "o")


@query("m8_mappings", """
SELECT p, sum(n)::BIGINT AS triples FROM (
  SELECT unnest(['http://example.org/name', 'http://example.org/nation', 'http://example.org/rank']) AS p,
    (SELECT count(*) FROM customer) AS n
  UNION ALL SELECT unnest(['http://example.org/name', 'http://example.org/nation']), (SELECT count(*) FROM supplier))
GROUP BY p
""")
def m8_mappings(spark, sf):
    """Three maps over two sources; the two maps on ``customer`` share one scan."""
    known = maps()
    extra = TriplesMap("customer", node("customer", "c_custkey"), [
        pom(EX + "rank", expression("if(c_acctbal < 0, 'low', 'high')"))])
    sources = {n: table(spark, sf, n) for n in ("customer", "supplier")}
    wanted = [EX + "name", EX + "nation", EX + "rank"]
    quads = apply_mappings(sources, [known["customer"], known["supplier"], extra], only=wanted)
    return quads.groupBy("p").agg(F.count(F.lit(1)).alias("triples"))


@query("m9_classes", """
SELECT 'http://example.org/Order' AS class, 'http://example.org/order/' || o_orderkey AS s FROM orders
UNION ALL SELECT 'http://example.org/Part', 'http://example.org/part/' || p_partkey FROM part
UNION ALL SELECT 'http://example.org/Nation', 'http://example.org/nation/' || n_nationkey FROM nation
""")
def m9_classes(spark, sf):
    quads = graph(spark, sf, "orders", "part", "nation").quads(only=[RDF_TYPE])
    return quads.select(F.col("o").alias("class"), "s")


@query("m10_parent_ref", """
SELECT 'http://example.org/order/' || o_orderkey AS s, 'http://example.org/shipsTo' AS p,
  'http://example.org/nation/' || c_nationkey AS o
FROM orders JOIN customer ON o_custkey = c_custkey
""")
def m10_parent_ref(spark, sf):
    """The parent map's subject is the nation of the customer a row refers to."""
    parent = TriplesMap("customer", node("nation", "c_nationkey"))
    child = TriplesMap("orders", node("order", "o_orderkey"), [
        pom(EX + "shipsTo", parent_ref(parent, "o_custkey", "c_custkey"))])
    sources = {n: table(spark, sf, n) for n in ("orders", "customer")}
    return apply_mappings(sources, [child]).select("s", "p", "o")


@query("m10_two_keys", """
SELECT 'http://example.org/lineitem/' || a.l_orderkey || '-' || a.l_linenumber AS s,
  'http://example.org/return/' || b.l_orderkey || '/' || b.l_linenumber AS o, count(*) AS n
FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber
WHERE b.l_returnflag = 'R' GROUP BY 1, 2
""")
def m10_two_keys(spark, sf):
    """A join condition on two columns, and no pairs of rows that share only one."""
    lines = table(spark, sf, "lineitem")
    returned = TriplesMap("returned", template(EX + "return/{l_orderkey}/{l_linenumber}"))
    keys = ["l_orderkey", "l_linenumber"]
    child = TriplesMap("lineitem", template(EX + "lineitem/{l_orderkey}-{l_linenumber}"), [
        pom(EX + "returned", parent_ref(returned, keys, keys))])
    quads = apply_mappings({"lineitem": lines, "returned": lines.filter("l_returnflag = 'R'")}, [child])
    return quads.groupBy("s", "o").agg(F.count(F.lit(1)).alias("n"))


@query("m11_predicate_map", """
SELECT 'http://example.org/user/' || user_id AS s, 'http://example.org/did/' || event_type AS p, event_id::VARCHAR AS o
FROM events UNION ALL
SELECT 'http://example.org/user/' || user_id, 'http://example.org/value', floor(value)::BIGINT::VARCHAR FROM events WHERE value >= 100
""")
def m11_predicate_map(spark, sf):
    """The predicate of a row is made by a template, beside a constant one."""
    m = TriplesMap("events", node("user", "user_id"), [
        pom(template(EX + "did/{event_type}"), "event_id", XSD_INTEGER),
        pom(EX + "value", expression("CASE WHEN value >= 100 THEN cast(floor(value) AS bigint) END"), XSD_INTEGER)])
    return apply_mapping(table(spark, sf, "events"), m).select("s", "p", "o")


@query("m11_one_predicate", """
SELECT 'http://example.org/user/' || user_id AS s, event_id::VARCHAR AS o FROM events WHERE event_type = 'click'
""")
def m11_one_predicate(spark, sf):
    """A constant predicate is turned into a test of the column that predicates are made of."""
    m = TriplesMap("events", node("user", "user_id"), [pom(template(EX + "did/{event_type}"), "event_id", XSD_INTEGER)])
    return match(MappedGraph({"events": table(spark, sf, "events")}, [m]), "?s", EX + "did/click", "?o").select("s", "o")


@query("m11_language_graph", """
SELECT 'http://example.org/doc/' || doc_id AS s, md5(text) AS text_md5, 'literal' AS o_kind,
  'http://www.w3.org/1999/02/22-rdf-syntax-ns#langString' AS o_dt, lang AS o_lang,
  'http://example.org/source/' || source AS g FROM documents
UNION ALL SELECT 'http://example.org/doc/' || doc_id, md5('http://example.org/lang/' || lang), 'iri', NULL, NULL,
  'http://example.org/source/' || source FROM documents
""")
def m11_language_graph(spark, sf):
    m = TriplesMap("documents", node("doc", "doc_id"), [
        pom(EX + "text", "text", language=reference("lang")),
        pom(EX + "lang", node("lang", "lang"))], graph=template(EX + "source/{source}"))
    quads = apply_mapping(table(spark, sf, "documents"), m)
    return quads.select("s", F.md5("o").alias("text_md5"), "o_kind", "o_dt", "o_lang", "g")


@query("m4_dates", """
SELECT 'http://example.org/order/' || o_orderkey AS s, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS o,
  'http://www.w3.org/2001/XMLSchema#dateTime' AS o_dt, year(o_orderdate)::INTEGER AS y FROM orders
""")
def m4_dates(spark, sf):
    """Timestamps have the lexical form of their datatype, so functions read them."""
    m = TriplesMap("orders", node("order", "o_orderkey"), [pom(EX + "date", "o_orderdate", XSD_DATETIME)])
    quads = apply_mapping(table(spark, sf, "orders"), m)
    year = fn.year(literal_term(F.col("o"), XSD_DATETIME)).value.cast("int")
    return quads.select("s", "o", "o_dt", year.alias("y"))
