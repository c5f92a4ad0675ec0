"""Q8 - Q10, Q20: XML made from customers and their nations."""

from pyspark.sql import functions as F

from quadspark.functions.xml import field_text, xml_parse, xml_path, xml_unnest
from quadspark.plans.metadata import xml_contacts
from quadspark.plans.registry import query, spread_table, table

_NS = "urn:example:project"


def documents(spark, sf):
    """A project per customer: a licence, the customer as developer (with a URL
    only if the balance is positive), and the nation as a developer with a name only."""
    c = spread_table(spark, sf, "customer", "c_custkey").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    url = F.when(F.col("c_acctbal") > 0, F.concat(F.lit("<url>http://example.org/u/"), "c_custkey", F.lit("</url>")))
    xml = F.concat(
        F.lit(f'<project xmlns="{_NS}"><name>p</name><licenses><license><url>http://example.org/licence/'),
        F.lower("c_mktsegment"), F.lit("</url></license></licenses><developers><developer><name>"), "c_name",
        F.lit(" é</name>"), F.coalesce(url, F.lit("<url></url>")), F.lit("<organization>"), "n_name",
        F.lit("</organization><organizationUrl>http://example.org/org/"), "n_nationkey",
        F.lit("</organizationUrl></developer><developer><name>"), "n_name",
        F.lit("</name></developer></developers></project>"))
    return c.select("c_custkey", xml.alias("xml"))


@query("q8_xml_parse", "SELECT c_custkey, 'p' AS name, c_name || ' é' AS developer FROM customer")
def q8_xml_parse(spark, sf):
    doc = xml_parse(F.col("xml"), "name string, developers struct<developer: array<struct<name: string>>>")
    parsed = documents(spark, sf).select("c_custkey", doc.alias("doc"))
    return parsed.select("c_custkey", F.col("doc.name").alias("name"),
                         F.get("doc.developers.developer.name", F.lit(0)).alias("developer"))


@query("q9_xml_unnest", """
SELECT c_custkey, c_name || ' é' AS name, n_name AS organization FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT c_custkey, n_name, NULL FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def q9_xml_unnest(spark, sf):
    rows = xml_unnest(documents(spark, sf), "xml", ("developers", "developer"), "dev", ("name", "organization"))
    return rows.select("c_custkey", field_text("dev", "name").alias("name"),
                       field_text("dev", "organization").alias("organization"))


@query("q10_xml_path", """
SELECT c_custkey, 'http://example.org/licence/' || lower(c_mktsegment) AS licence,
  CASE WHEN c_acctbal > 0 THEN 'http://example.org/u/' || c_custkey END AS url, CAST(NULL AS VARCHAR) AS missing FROM customer
""")
def q10_xml_path(spark, sf):
    xml = F.col("xml")
    return documents(spark, sf).select(
        "c_custkey", xml_path(xml, "/*/licenses/license/url/text()").alias("licence"),
        xml_path(xml, "/*/developers/developer[1]/url/text()").alias("url"),
        xml_path(xml, "/*/scm/text()").alias("missing"))


@query("q20_xml_contacts", """
WITH d AS (SELECT 'urn:x:' || c_custkey || '#' AS base, c_name || ' é' AS name, n_name AS org, lower(c_mktsegment) AS seg,
    CASE WHEN c_acctbal > 0 THEN 'http://example.org/u/' || c_custkey END AS url,
    'http://example.org/org/' || n_nationkey AS org_url
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
i AS (SELECT *, base || 'dataset' AS ds, base || 'dev/' || url_encode(coalesce(url, name)) AS dev,
    base || 'org/' || url_encode(org_url) AS oid, base || 'dev/' || url_encode(org) AS dev2 FROM d)
SELECT ds AS s, 'http://purl.org/dc/terms/license' AS p, 'http://example.org/licence/' || seg AS o, 'iri' AS o_kind FROM i
UNION ALL SELECT ds, 'http://www.w3.org/ns/dcat#contributor', dev, 'iri' FROM i
UNION ALL SELECT ds, 'http://www.w3.org/ns/dcat#contributor', dev2, 'iri' FROM i
UNION ALL SELECT dev, 'http://xmlns.com/foaf/0.1/name', name, 'literal' FROM i
UNION ALL SELECT dev2, 'http://xmlns.com/foaf/0.1/name', org, 'literal' FROM i
UNION ALL SELECT dev, 'http://www.w3.org/ns/org#memberOf', oid, 'iri' FROM i
UNION ALL SELECT oid, 'http://www.w3.org/2000/01/rdf-schema#label', org, 'literal' FROM i
UNION ALL SELECT oid, 'http://www.example.org/website', org_url, 'iri' FROM i
""")
def q20_xml_contacts(spark, sf):
    base = F.concat(F.lit("urn:x:"), F.col("c_custkey"), F.lit("#"))
    docs = documents(spark, sf).select("xml", "c_custkey")
    return xml_contacts(docs, base, F.concat(base, F.lit("dataset"))).select("s", "p", "o", "o_kind")
