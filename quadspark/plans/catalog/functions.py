"""Scalar function families over terms."""

from pyspark.sql import functions as F

from quadspark.functions import scalars as fn
from quadspark.functions.terms import XSD_DATETIME, XSD_DECIMAL, XSD_INTEGER, lang_term, literal_term, term
from quadspark.operators.patterns import bgp, bind, match
from quadspark.plans.catalog.statistics import document_graph
from quadspark.plans.registry import query, table
from quadspark.plans.testgraph import EX, graph

CUST = "'http://example.org/customer/' || "


def _bound(sol, **terms):
    for name, value in terms.items():
        sol = bind(sol, name, value)
    return sol


@query("f_term", """
SELECT 'http://example.org/doc/' || doc_id AS d, lang AS tag,
  'http://www.w3.org/1999/02/22-rdf-syntax-ns#langString' AS dt, true AS lit, false AS iri, false AS num, true AS same
FROM documents
UNION ALL SELECT 'http://example.org/doc/' || doc_id, '', 'http://www.w3.org/2001/XMLSchema#integer', true, false, true, true
FROM documents
UNION ALL SELECT 'http://example.org/doc/' || doc_id, NULL, NULL, false, true, false, true FROM documents
UNION ALL SELECT 'http://example.org/doc/' || doc_id, NULL, NULL, false, false, false, true FROM documents
""")
def f_term(spark, sf):
    sol = match(document_graph(spark, sf), "?d", "?p", "?v").filter(F.col("d_kind") == "iri")
    v = term(sol, "v")
    out = _bound(sol, tag=fn.lang(v), dt=fn.datatype(v))
    return out.select("d", "tag", "dt", fn.is_literal(v).alias("lit"), fn.is_iri(v).alias("iri"),
                      fn.is_numeric(v).alias("num"), fn.same_term(v, v).alias("same"))


@query("f_logic", """
SELECT c_name AS name, CASE WHEN c_mktsegment = 'BUILDING' THEN c_name ELSE c_mktsegment END AS v,
  c_mktsegment IN ('BUILDING', 'MACHINERY') AS listed, c_mktsegment NOT IN ('FURNITURE') AS unlisted, true AS named
FROM customer
""")
def f_logic(spark, sf):
    sol = bgp(graph(spark, sf, "customer"), [("?c", EX + "name", "?name"), ("?c", EX + "segment", "?segment")])
    name, segment = term(sol, "name"), term(sol, "segment")
    plain = {x: literal_term(F.lit(x)) for x in ("BUILDING", "MACHINERY", "FURNITURE")}
    out = _bound(sol, v=fn.if_(fn.equals(segment, plain["BUILDING"]), name, segment))
    return out.select("name", "v", fn.in_(segment, plain["BUILDING"], plain["MACHINERY"]).alias("listed"),
                      fn.not_in(segment, plain["FURNITURE"]).alias("unlisted"), fn.bound(name).alias("named"))


@query("f_string", """
SELECT p_name AS name, length(p_name)::VARCHAR AS len, substr(p_name, 2, 4) AS part, upper(p_name) AS up,
  lower(upper(p_name)) AS low, starts_with(p_name, 'cold') AS starts, ends_with(p_name, 'widget') AS ends,
  contains(p_name, 'l w') AS has, split_part(p_name, ' ', 1) AS before,
  substr(p_name, strpos(p_name, ' ') + 1) AS after, '' AS nothing, regexp_replace(p_name, '[aeiou]', '_', 'g') AS masked,
  regexp_matches(p_name, '^[a-m]') AS early, p_name || '@' || p_brand AS joined FROM part
""")
def f_string(spark, sf):
    part = table(spark, sf, "part")
    sol = part.select(F.col("p_name").alias("name"), F.col("p_brand").alias("brand"))
    n = term(sol, "name")
    out = _bound(
        sol, len=fn.strlen(n), part=fn.substr(n, 2, 4), up=fn.ucase(n), low=fn.lcase(fn.ucase(n)),
        before=fn.strbefore(n, " "), after=fn.strafter(n, " "), nothing=fn.strafter(n, "#"),
        masked=fn.replace(n, "[aeiou]", "_"), joined=fn.concat(n, literal_term(F.lit("@")), term(sol, "brand")))
    return out.select(
        "name", "len", "part", "up", "low", "before", "after", "nothing", "masked", "joined",
        fn.strstarts(n, "cold").alias("starts"), fn.strends(n, "widget").alias("ends"), fn.contains(n, "l w").alias("has"),
        fn.regex(n, "^[A-M]", "i").alias("early"))


@query("f_language", """
SELECT md5(text) AS text_md5, lang AS tag, lang = 'en' AS english, true AS any_tag, md5(upper(lang || '!')) AS shout
FROM documents
""")
def f_language(spark, sf):
    docs = table(spark, sf, "documents").select("text", "lang")
    text = lang_term(F.col("text"), F.col("lang"))
    mark = lang_term(F.concat("lang", F.lit("!")), F.col("lang"))
    joined = fn.ucase(fn.concat(fn.substr(text, 1, 0), mark))
    return docs.select(
        F.md5("text").alias("text_md5"), fn.lang(joined).value.alias("tag"), fn.langmatches(text, "EN").alias("english"),
        fn.langmatches(text, "*").alias("any_tag"), F.md5(joined.value).alias("shout"))


@query("f_numeric", """
WITH d AS (SELECT c_custkey, CAST(c_acctbal AS DECIMAL(18,2)) AS v FROM customer)
SELECT c_custkey, CAST(v AS VARCHAR) AS v, CAST(CAST(ceil(v) AS BIGINT) AS VARCHAR) AS up,
  CAST(CAST(floor(v) AS BIGINT) AS VARCHAR) AS down, CAST(CAST(floor(v + 0.5) AS BIGINT) AS VARCHAR) AS near,
  CAST(CASE WHEN v < 0 THEN 'neg' ELSE 'pos' END AS VARCHAR) AS sign, abs(v) * 100 = floor(abs(v) * 100) AS exact FROM d
""")
def f_numeric(spark, sf):
    c = table(spark, sf, "customer")
    sol = c.select("c_custkey", F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("v"))
    v = literal_term(F.col("v"), XSD_DECIMAL)
    size = fn.decimal(fn.abs_(v)) * 100
    out = _bound(sol, up=fn.ceil(v), down=fn.floor(v), near=fn.round_(v))
    sign = F.when(fn.decimal(v) < 0, "neg").otherwise("pos")
    return out.select("c_custkey", "v", "up", "down", "near", sign.alias("sign"), (size == F.floor(size)).alias("exact"))


@query("f_datetime", """
SELECT event_id, year(ts)::VARCHAR AS y, month(ts)::VARCHAR AS m, day(ts)::VARCHAR AS d, hour(ts)::VARCHAR AS h,
  minute(ts)::VARCHAR AS mi, second(ts)::VARCHAR AS s, '+01:00' AS zone, 'PT1H' AS duration FROM events
""")
def f_datetime(spark, sf):
    text = F.concat(F.date_format(F.col("ts"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+01:00"))
    sol = table(spark, sf, "events").select("event_id", text.alias("t"))
    t = literal_term(F.col("t"), XSD_DATETIME)
    out = _bound(sol, y=fn.year(t), m=fn.month(t), d=fn.day(t), h=fn.hours(t), mi=fn.minutes(t), s=fn.seconds(t), zone=fn.tz(t),
                 duration=fn.timezone(t))
    return out.select("event_id", "y", "m", "d", "h", "mi", "s", "zone", "duration")


@query("f_hash", """
SELECT doc_id, md5(text) AS md5, sha256(text) AS sha256, sha1(text) AS sha1, 96::INTEGER AS sha384_length,
  128::INTEGER AS sha512_length FROM documents
""")
def f_hash(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    t = literal_term(F.col("text"))
    return docs.select(
        "doc_id", fn.md5(t).value.alias("md5"), fn.sha256(t).value.alias("sha256"),
        fn.sha1(t).value.alias("sha1"), F.length(fn.sha384(t).value).alias("sha384_length"),
        F.length(fn.sha512(t).value).alias("sha512_length"))


@query("f_constructor", f"""
SELECT {CUST} c_custkey AS c, 'http://example.org/Segment' AS dt, 'de' AS tag, 'b' || sha256(c_custkey::VARCHAR) AS node,
  45::INTEGER AS uuid_length, 36::INTEGER AS struuid_length FROM customer
""")
def f_constructor(spark, sf):
    c = table(spark, sf, "customer")
    sol = c.select(F.concat(F.lit(EX + "customer/"), "c_custkey").alias("c"), "c_custkey", "c_mktsegment")
    segment = literal_term(F.col("c_mktsegment"))
    out = _bound(
        sol, typed=fn.strdt(segment, EX + "Segment"), tagged=fn.strlang(segment, "DE"),
        node=fn.bnode(F.col("c_custkey")), u=fn.uuid(), su=fn.struuid())
    return out.select("c", F.col("typed_dt").alias("dt"), F.col("tagged_lang").alias("tag"), "node",
                      F.length("u").alias("uuid_length"), F.length("su").alias("struuid_length"))


@query("f_equality", """
SELECT p_partkey, p_size::VARCHAR || '.0' AS text, true AS equal, false AS same FROM part
""")
def f_equality(spark, sf):
    """Equal numbers are different terms if their lexical forms differ."""
    part = table(spark, sf, "part").select("p_partkey", F.col("p_size").cast("string").alias("size"))
    text = F.concat("size", F.lit(".0"))
    a, b = literal_term(F.col("size"), XSD_DECIMAL), literal_term(text, XSD_DECIMAL)
    return part.select("p_partkey", text.alias("text"), fn.equals(a, b).alias("equal"), fn.same_term(a, b).alias("same"))


@query("f_numeric_wide", """
SELECT o_orderkey, true AS same_value, false AS next_value, true AS padded FROM orders
""")
def f_numeric_wide(spark, sf):
    """Integers beyond 64 bits and the precision of doubles compare exactly."""
    orders = table(spark, sf, "orders").select("o_orderkey")
    start = F.concat(F.lit("900719925474099"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0"))
    a, b = (literal_term(F.concat(start, F.lit(x)), XSD_INTEGER) for x in "12")
    padded = literal_term(F.concat(F.lit("+00"), start, F.lit("1.50")), XSD_DECIMAL)
    short = literal_term(F.concat(start, F.lit("1.5")), XSD_DECIMAL)
    return orders.select("o_orderkey", fn.equals(a, a).alias("same_value"), fn.equals(a, b).alias("next_value"),
                         fn.equals(padded, short).alias("padded"))
