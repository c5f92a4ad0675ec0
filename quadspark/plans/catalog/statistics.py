"""V: dataset statistics over the test graph.

The oracles count rows and distinct column values of the tables; they do not
build triples.
"""

from pyspark.sql import functions as F

from quadspark.functions.terms import BNODE, RDF_TYPE, XSD_INTEGER
from quadspark.operators import void
from quadspark.operators.mapping import GraphBySubject, MappedGraph, TriplesMap, expression, pom, reference, template
from quadspark.plans.metadata import dcat_records
from quadspark.plans.registry import query, spread_table, table
from quadspark.plans.testgraph import EX, GRAPH_TABLES, graph, maps, node
from quadspark.sources.storage import parts_of

# Values of each property, as the oracles need them: property, class, key, value, datatype.
_VALUES = """
WITH prop AS (
  SELECT 'name' AS p, 'Region' AS c, 'region/' || r_regionkey AS s, r_name AS v, 'string' AS dt FROM region
  UNION ALL SELECT 'name', 'Nation', 'nation/' || n_nationkey, n_name, 'string' FROM nation
  UNION ALL SELECT 'region', 'Nation', 'nation/' || n_nationkey, 'region/' || n_regionkey, 'iri' FROM nation
  UNION ALL SELECT 'name', 'Customer', 'customer/' || c_custkey, c_name, 'string' FROM customer
  UNION ALL SELECT 'segment', 'Customer', 'customer/' || c_custkey, c_mktsegment, 'string' FROM customer
  UNION ALL SELECT 'nation', 'Customer', 'customer/' || c_custkey, 'nation/' || c_nationkey, 'iri' FROM customer
  UNION ALL SELECT 'name', 'Supplier', 'supplier/' || s_suppkey, s_name, 'string' FROM supplier
  UNION ALL SELECT 'nation', 'Supplier', 'supplier/' || s_suppkey, 'nation/' || s_nationkey, 'iri' FROM supplier
  UNION ALL SELECT 'brand', 'Part', 'part/' || p_partkey, p_brand, 'string' FROM part
  UNION ALL SELECT 'size', 'Part', 'part/' || p_partkey, p_size::VARCHAR, 'integer' FROM part
  UNION ALL SELECT 'status', 'Order', 'order/' || o_orderkey, o_orderstatus, 'string' FROM orders
  UNION ALL SELECT 'priority', 'Order', 'order/' || o_orderkey, o_orderpriority, 'string' FROM orders
  UNION ALL SELECT 'total', 'Order', 'order/' || o_orderkey, CAST(o_totalprice AS DECIMAL(18,2))::VARCHAR, 'decimal' FROM orders
  UNION ALL SELECT 'customer', 'Order', 'order/' || o_orderkey, 'customer/' || o_custkey, 'iri' FROM orders),
typed AS (SELECT DISTINCT c, s FROM prop),
fact AS (SELECT * FROM prop UNION ALL SELECT '#type', c, s, c, 'iri' FROM typed)
"""
_P = ("CASE p WHEN '#type' THEN 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type' "
      "ELSE 'http://example.org/' || p END")


_V1 = """
WITH n AS (SELECT (SELECT count(*) FROM region) AS r, (SELECT count(*) FROM nation) AS n,
  (SELECT count(*) FROM customer) AS c, (SELECT count(*) FROM supplier) AS s, (SELECT count(*) FROM part) AS p,
  (SELECT count(*) FROM orders) AS o)
SELECT 2 * r + 3 * n + 4 * c + 3 * s + 3 * p + 5 * o AS triples, r + n + c + s + p + o AS distinct_subjects,
  11::BIGINT AS properties,
  (SELECT count(*) FROM (
    SELECT r_name AS v, 'string' AS dt FROM region UNION SELECT n_name, 'string' FROM nation
    UNION SELECT c_name, 'string' FROM customer UNION SELECT c_mktsegment, 'string' FROM customer
    UNION SELECT s_name, 'string' FROM supplier UNION SELECT p_brand, 'string' FROM part
    UNION SELECT p_size::VARCHAR, 'integer' FROM part UNION SELECT o_orderstatus, 'string' FROM orders
    UNION SELECT o_orderpriority, 'string' FROM orders
    UNION SELECT CAST(o_totalprice AS DECIMAL(18,2))::VARCHAR, 'decimal' FROM orders))
  + (SELECT count(DISTINCT n_regionkey) FROM nation)
  + (SELECT count(*) FROM (SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier))
  + (SELECT count(DISTINCT o_custkey) FROM orders) + 6 AS distinct_objects
FROM n
"""


@query("v1_void_dataset", _V1)
def v1_void_dataset(spark, sf):
    return void.void_dataset(graph(spark, sf))


@query("v1_void_dataset_approx", f"""
SELECT triples, true AS subjects_close, true AS properties_close, true AS objects_close FROM ({_V1})
""")
def v1_void_dataset_approx(spark, sf):
    """Estimated distinct counts are within 15 % of the exact ones; the estimates themselves vary with the plan."""
    found = void.void_dataset(graph(spark, sf), approx=True).crossJoin(  # one row each
        void.void_dataset(graph(spark, sf)).select(*(F.col(c).alias(f"exact_{c}") for c in (
            "distinct_subjects", "properties", "distinct_objects"))))
    close = {n: F.abs(F.col(c) - F.col(f"exact_{c}")) <= 0.15 * F.col(f"exact_{c}") for n, c in (
        ("subjects_close", "distinct_subjects"), ("properties_close", "properties"), ("objects_close", "distinct_objects"))}
    return found.select("triples", *(c.alias(n) for n, c in close.items()))


@query("v2_void_classes", """
SELECT count(*) AS classes FROM (
  SELECT 'r' WHERE EXISTS (SELECT 1 FROM region) UNION ALL SELECT 'n' WHERE EXISTS (SELECT 1 FROM nation)
  UNION ALL SELECT 'c' WHERE EXISTS (SELECT 1 FROM customer) UNION ALL SELECT 's' WHERE EXISTS (SELECT 1 FROM supplier)
  UNION ALL SELECT 'p' WHERE EXISTS (SELECT 1 FROM part) UNION ALL SELECT 'o' WHERE EXISTS (SELECT 1 FROM orders))
""")
def v2_void_classes(spark, sf):
    return void.void_classes(graph(spark, sf))


_V3 = f"""{_VALUES}
SELECT 'http://example.org/' || c AS class, count(*) AS triples, count(DISTINCT p) AS properties,
  count(DISTINCT (v, dt)) AS distinct_objects FROM fact GROUP BY c
"""
_V7 = f"""{_VALUES}
SELECT 'http://example.org/' || c AS class, {_P} AS p, count(*) AS triples, count(DISTINCT s) AS distinct_subjects,
  count(DISTINCT (v, dt)) AS distinct_objects FROM fact GROUP BY c, p
"""


def _by_subject(spark, sf):
    parts = sum(parts_of(spark, f"{sf}/{name}.parquet") for name in GRAPH_TABLES)
    return GraphBySubject(graph(spark, sf), parts)


@query("v3_class_partition", _V3)
def v3_class_partition(spark, sf):
    return void.class_partition(graph(spark, sf))


@query("v7_class_property_partition", _V7)
def v7_class_property_partition(spark, sf):
    return void.class_property_partition_by_subject(_by_subject(spark, sf))


@query("v3_v7_class_partitions", f"""{_VALUES}
SELECT 'http://example.org/' || c AS class, {_P} AS p, count(*) AS triples, count(DISTINCT s) AS distinct_subjects,
  count(DISTINCT (v, dt)) AS distinct_objects, 1::BIGINT AS properties FROM fact GROUP BY c, p
UNION ALL SELECT 'http://example.org/' || c, NULL, count(*), NULL, count(DISTINCT (v, dt)), count(DISTINCT p)
FROM fact GROUP BY c
""")
def v3_v7_class_partitions(spark, sf):
    return void.class_partitions_by_subject(_by_subject(spark, sf))


def _ranked(spark, sf):
    """Customers with further classes: by segment, and by balance."""
    balance = f"CASE WHEN c_acctbal < 0 THEN '{EX}Debtor' WHEN c_acctbal > 9000 THEN '{EX}Premium' END"
    extra = TriplesMap("customer", node("customer", "c_custkey"), [
        pom(RDF_TYPE, template(EX + "{c_mktsegment}")),
        pom(RDF_TYPE, expression(balance, "iri"))])
    return MappedGraph({"customer": table(spark, sf, "customer")}, [maps()["customer"], extra])


@query("v4_class_cooccurrence", """
WITH t AS (
  SELECT c_custkey AS s, 'Customer' AS c FROM customer UNION ALL SELECT c_custkey, c_mktsegment FROM customer
  UNION ALL SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'Debtor' ELSE 'Premium' END FROM customer
    WHERE c_acctbal < 0 OR c_acctbal > 9000)
SELECT 'http://example.org/' || a.c AS class, count(DISTINCT b.c) AS classes FROM t a JOIN t b USING (s) GROUP BY a.c
""")
def v4_class_cooccurrence(spark, sf):
    return void.class_cooccurrence(_ranked(spark, sf))


@query("v5_class_instances", """
SELECT 'http://example.org/Region' AS class, count(DISTINCT r_regionkey) AS instances FROM region
UNION ALL SELECT 'http://example.org/Nation', count(DISTINCT n_nationkey) FROM nation
UNION ALL SELECT 'http://example.org/Customer', count(DISTINCT c_custkey) FROM customer
UNION ALL SELECT 'http://example.org/Supplier', count(DISTINCT s_suppkey) FROM supplier
UNION ALL SELECT 'http://example.org/Part', count(DISTINCT p_partkey) FROM part
UNION ALL SELECT 'http://example.org/Order', count(DISTINCT o_orderkey) FROM orders
""")
def v5_class_instances(spark, sf):
    return void.class_instances(graph(spark, sf))


_V6 = f"""{_VALUES}
SELECT {_P} AS p, count(*) AS triples, count(DISTINCT s) AS distinct_subjects,
  count(DISTINCT (v, dt)) AS distinct_objects FROM fact GROUP BY p
"""


@query("v6_property_partition", _V6)
def v6_property_partition(spark, sf):
    return void.property_partition(graph(spark, sf))


@query("v8_node_kind_profile", """
WITH doc AS (SELECT doc_id, lang, text, n_chars FROM documents),
lit AS (SELECT DISTINCT text AS v, 'langString' AS dt, lang FROM doc
  UNION SELECT n_chars::VARCHAR, 'integer', NULL FROM doc UNION SELECT source, 'string', NULL FROM documents),
iri AS (SELECT 'doc/' || doc_id AS v, 1 AS s FROM doc UNION ALL SELECT DISTINCT 'lang/' || lang, 0 FROM doc),
bn AS (SELECT DISTINCT 'source-' || source AS v FROM documents)
SELECT 'distinct_nodes' AS measure, '' AS key, (SELECT count(*) FROM lit) + (SELECT count(*) FROM iri)
  + (SELECT count(*) FROM bn) AS n
UNION ALL SELECT 'distinct_iris', '', count(*) FROM iri
UNION ALL SELECT 'distinct_bnodes', '', count(*) FROM bn
UNION ALL SELECT 'distinct_literals', '', count(*) FROM lit
UNION ALL SELECT 'iri_subjects', '', count(*) FROM iri WHERE s = 1
UNION ALL SELECT 'iri_objects', '', count(*) FROM iri WHERE s = 0
UNION ALL SELECT 'bnode_subjects', '', count(*) FROM bn
UNION ALL SELECT 'bnode_objects', '', count(*) FROM bn
UNION ALL SELECT 'literals_by_datatype', CASE dt WHEN 'langString'
  THEN 'http://www.w3.org/1999/02/22-rdf-syntax-ns#langString' ELSE 'http://www.w3.org/2001/XMLSchema#' || dt END,
  count(*) FROM lit GROUP BY dt
UNION ALL SELECT 'literals_by_language', lang, count(*) FROM lit WHERE lang IS NOT NULL GROUP BY lang
""")
def v8_node_kind_profile(spark, sf):
    return void.node_kind_profile(document_graph(spark, sf))


def document_graph(spark, sf):
    """Documents with tagged text, a size, a language IRI and a blank source node."""
    docs = TriplesMap("documents", node("doc", "doc_id"), [
        pom(EX + "text", "text", language=reference("lang")), pom(EX + "chars", "n_chars", XSD_INTEGER),
        pom(EX + "lang", node("lang", "lang")), pom(EX + "source", template("source-{source}", BNODE))])
    sources = TriplesMap("documents", template("source-{source}", BNODE), [pom(EX + "label", "source")])
    return MappedGraph({"documents": spread_table(spark, sf, "documents", "doc_id")}, [docs, sources])


@query("v9_void_to_rdf", f"""{_VALUES},
stat AS (SELECT {_P} AS p, count(*) AS triples, count(DISTINCT s) AS subjects, count(DISTINCT (v, dt)) AS objects
  FROM fact GROUP BY p),
part AS (SELECT 'http://example.org/ds/void/property-' || sha256(p) AS node, * FROM stat)
SELECT 'http://example.org/ds' AS s, 'http://rdfs.org/ns/void#propertyPartition' AS p, node AS o FROM part
UNION ALL SELECT node, 'http://rdfs.org/ns/void#property', p FROM part
UNION ALL SELECT node, 'http://rdfs.org/ns/void#triples', triples::VARCHAR FROM part
UNION ALL SELECT node, 'http://rdfs.org/ns/void#distinctSubjects', subjects::VARCHAR FROM part
UNION ALL SELECT node, 'http://rdfs.org/ns/void#distinctObjects', objects::VARCHAR FROM part
""")
def v9_void_to_rdf(spark, sf):
    stats = void.property_partition(graph(spark, sf))
    return void.void_to_rdf(stats, EX + "ds").select("s", "p", "o")


@query("v10_dcat_records", """
WITH m AS (SELECT 'urn:mvn:org.example:part-' || p_partkey || ':' || p_size AS b, lower(p_type) AS t FROM part),
d AS (SELECT b, b || ':' || t AS f FROM m)
SELECT b || '#dataset' AS s, 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type' AS p,
  'http://www.w3.org/ns/dcat#Dataset' AS o FROM d
UNION ALL SELECT b || '#dataset', 'http://www.w3.org/ns/prov#wasGeneratedBy', f || '#activity' FROM d
UNION ALL SELECT b || '#dataset', 'http://www.w3.org/ns/dcat#distribution', f || '#distribution' FROM d
UNION ALL SELECT f || '#distribution', 'http://www.w3.org/ns/dcat#downloadURL', f FROM d
UNION ALL SELECT f || '#activity', 'http://www.w3.org/ns/prov#hadPlan', f || '#plan' FROM d
UNION ALL SELECT f || '#plan', 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type', 'http://www.example.org/MavenBuild' FROM d
UNION ALL SELECT f || '#plan', 'http://www.example.org/urn', b || ':pom' FROM d
""")
def v10_dcat_records(spark, sf):
    # Seven triples of a row are made distinct in memory: each task gets a bounded share of the rows.
    part = table(spark, sf, "part").repartition(parts_of(spark, f"{sf}/part.parquet"), "p_partkey")
    manifest = part.select(
        F.lit("org.example").alias("group"), F.concat(F.lit("part-"), F.col("p_partkey")).alias("artifact"),
        F.col("p_size").cast("string").alias("version"), F.lower("p_type").alias("type"))
    return dcat_records(manifest).select("s", "p", "o")
