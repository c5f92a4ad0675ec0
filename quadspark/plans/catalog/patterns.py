"""Q and X: graph patterns, solution algebra and paths."""

from pyspark.sql import functions as F

from quadspark.functions import scalars as fn
from quadspark.functions.terms import RDF_TYPE, Literal, iri_term, literal_term, mark_unbound, term
from quadspark.operators import paths
from quadspark.operators.graphs import into_graph
from quadspark.operators.mapping import TriplesMap, apply_mapping, pom, template
from quadspark.operators.patterns import (
    ask,
    avg_of,
    bgp,
    bind,
    construct,
    count_all,
    count_of,
    describe,
    distinct,
    exists,
    filter_,
    group,
    group_concat,
    join,
    lateral,
    lateral_join,
    match,
    max_of,
    min_of,
    minus,
    not_exists,
    optional,
    order_by,
    project,
    sample,
    star,
    sum_of,
    union,
    values,
)
from quadspark.plans.registry import query, table
from quadspark.plans.testgraph import EX, graph

# Node IRIs and numbers as the oracles write them.
CUST = "'http://example.org/customer/' || "
ORDER = "'http://example.org/order/' || "
NATION = "'http://example.org/nation/' || "
REGION = "'http://example.org/region/' || "


def lexical(sol, *names):
    return project(sol, *names, terms=False)


# --- Q: single patterns and expressions -----------------------------------------

@query("q1_match", f"SELECT {CUST} c_custkey AS c FROM customer WHERE c_mktsegment = 'BUILDING'")
def q1_match(spark, sf):
    return lexical(match(graph(spark, sf), "?c", EX + "segment", Literal("BUILDING")))


@query("q1_match_key", """
SELECT 'http://example.org/lineitem/' || l_orderkey || '-' || l_linenumber AS l FROM lineitem WHERE l_orderkey = 7
""")
def q1_match_key(spark, sf):
    """A constant object becomes a test of the key column."""
    return lexical(match(graph(spark, sf, "lineitem"), "?l", EX + "order", EX + "order/7"))


@query("q1_match_subject", """
SELECT 'http://example.org/part' AS p, 'http://example.org/part/' || l_partkey AS o FROM lineitem
WHERE l_orderkey = 7 AND l_linenumber = 1
UNION ALL SELECT 'http://example.org/flag', l_returnflag FROM lineitem WHERE l_orderkey = 7 AND l_linenumber = 1
""")
def q1_match_subject(spark, sf):
    """A subject of two keys, with a variable predicate."""
    found = match(graph(spark, sf, "lineitem", "orders"), EX + "lineitem/7-1", "?p", "?o")
    return lexical(filter_(found, F.col("p").isin(EX + "part", EX + "flag")))


@query("q2_project", f"SELECT {CUST} c_custkey AS c, c_name AS name FROM customer")
def q2_project(spark, sf):
    sol = bgp(graph(spark, sf, "customer"), [
        ("?c", EX + "name", "?name"), ("?c", EX + "segment", "?segment")])
    return lexical(sol, "c", "name")


@query("q3_bind", """
SELECT c_name AS name, c_name || '/' || lower(c_mktsegment) AS label FROM customer
""")
def q3_bind(spark, sf):
    sol = bgp(graph(spark, sf, "customer"), [("?c", EX + "name", "?name"), ("?c", EX + "segment", "?segment")])
    label = fn.concat(term(sol, "name"), literal_term(F.lit("/")), fn.lcase(term(sol, "segment")))
    return lexical(bind(sol, "label", label), "name", "label")


@query("q4_construct", f"""
SELECT DISTINCT {NATION} c_nationkey AS s, 'http://example.org/servesStatus' AS p, o_orderstatus AS o
FROM orders JOIN customer ON o_custkey = c_custkey
""")
def q4_construct(spark, sf):
    sol = bgp(graph(spark, sf, "orders", "customer"), [
        ("?o", EX + "customer", "?c"), ("?c", EX + "nation", "?n"), ("?o", EX + "status", "?status")])
    quads = construct(sol, [("?n", EX + "servesStatus", "?status"), ("?status", EX + "illegal", "?n")])
    return quads.select("s", "p", "o")


@query("q6_union", f"""
SELECT {CUST} c_custkey AS x, c_mktsegment AS segment, NULL AS name FROM customer
UNION ALL SELECT 'http://example.org/supplier/' || s_suppkey, NULL, s_name FROM supplier
""")
def q6_union(spark, sf):
    g = graph(spark, sf, "customer", "supplier")
    suppliers = join(match(g, "?x", RDF_TYPE, EX + "Supplier"), match(g, "?x", EX + "name", "?name"))
    return lexical(union(match(g, "?x", EX + "segment", "?segment"), suppliers), "x", "segment", "name")


@query("q7_lateral", """
SELECT c_name AS name, 'segment' AS property, c_mktsegment AS v FROM customer
UNION ALL SELECT c_name, 'length', CAST(length(c_name) AS VARCHAR) FROM customer
""")
def q7_lateral(spark, sf):
    sol = bgp(graph(spark, sf, "customer"), [("?c", EX + "name", "?name"), ("?c", EX + "segment", "?segment")])
    rows = lateral(sol, [
        {"property": literal_term(F.lit("segment")), "v": term(sol, "segment")},
        {"property": literal_term(F.lit("length")), "v": fn.strlen(term(sol, "name"))},
    ])
    return lexical(rows, "name", "property", "v")


@query("q7_lateral_join", f"""
SELECT {NATION} n_nationkey AS n, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS customers
FROM nation
""")
def q7_lateral_join(spark, sf):
    """A correlated aggregate per nation; Spark turns it into a join."""
    nations = match(graph(spark, sf, "nation"), "?n", RDF_TYPE, EX + "Nation")
    members = match(graph(spark, sf, "customer"), "?c", EX + "nation", "?m")
    nested = members.filter(F.col("m") == F.col("n").outer()).select(F.count(F.lit(1)).alias("customers"))
    return lateral_join(nations, nested).select("n", "customers")


@query("q17_count_all", """
SELECT (SELECT count(*) FROM customer) * 4 + (SELECT count(*) FROM orders) * 5 + (SELECT count(*) FROM nation) * 3
  AS count
""")
def q17_count_all(spark, sf):
    return count_all(match(graph(spark, sf, "customer", "orders", "nation"), "?s", "?p", "?o"))


# --- X: algebra ------------------------------------------------------------------

@query("x1_three_hop", f"""
SELECT {REGION} n_regionkey AS region, count(*) AS orders
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1
""")
def x1_three_hop(spark, sf):
    sol = bgp(graph(spark, sf, "orders", "customer", "nation"), [
        ("?o", EX + "customer", "?c"), ("?c", EX + "nation", "?n"), ("?n", EX + "region", "?region")])
    return group(sol, ["region"], {"orders": F.count(F.lit(1))}).select("region", "orders")


@query("x1_object_join", """
SELECT a.c_custkey::VARCHAR AS a, count(*) AS pairs FROM customer a JOIN supplier s ON a.c_nationkey = s.s_nationkey
GROUP BY 1
""")
def x1_object_join(spark, sf):
    """A join on an object variable of both patterns: one side is counted first, so no pairs are made."""
    suppliers = match(graph(spark, sf, "supplier"), "?s", EX + "nation", "?n")
    per_nation = group(suppliers, ["n"], {"suppliers": F.count(F.lit(1))})
    sol = join(match(graph(spark, sf, "customer"), "?c", EX + "nation", "?n"), per_nation)
    counts = group(sol, ["c"], {"pairs": F.sum("suppliers")})
    return counts.select(F.substring_index("c", "/", -1).alias("a"), "pairs")


@query("x1_chain", f"""
SELECT {ORDER} o_orderkey AS o, o_orderstatus AS status, c_name AS name, n_name AS nation
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderpriority = '1-URGENT' AND c_mktsegment = 'BUILDING'
""")
def x1_chain(spark, sf):
    """Seven patterns over three tables: one row answers all patterns on its subject, and rows are joined on their keys."""
    sol = bgp(graph(spark, sf, "orders", "customer", "nation"), [
        ("?o", EX + "status", "?status"), ("?o", EX + "priority", Literal("1-URGENT")), ("?o", EX + "customer", "?c"),
        ("?c", EX + "name", "?name"), ("?c", EX + "segment", Literal("BUILDING")), ("?c", EX + "nation", "?n"),
        ("?n", EX + "name", "?nation")])
    return lexical(sol, "o", "status", "name", "nation")


@query("x1_repeated_variable", """
SELECT count(*) AS loops FROM nation WHERE n_nationkey = n_regionkey
""")
def x1_repeated_variable(spark, sf):
    m = TriplesMap("nation", template(EX + "place/{n_nationkey}"), [
        pom(EX + "within", template(EX + "place/{n_regionkey}"))])
    quads = apply_mapping(table(spark, sf, "nation"), m)
    return match(quads, "?x", EX + "within", "?x").agg(F.count(F.lit(1)).alias("loops"))


@query("x1_star", f"""
SELECT {ORDER} o_orderkey AS o, o_orderstatus AS status, o_orderpriority AS priority,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total FROM orders
""")
def x1_star(spark, sf):
    sol = star(graph(spark, sf, "orders"), "o", {
        EX + "status": "status", EX + "priority": "priority", EX + "total": "total"})
    return lexical(sol)


@query("x2_optional", f"""
SELECT {CUST} c_custkey AS c, {ORDER} o_orderkey AS o
FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_totalprice > 400000
""")
def x2_optional(spark, sf):
    customers = match(graph(spark, sf, "customer"), "?c", RDF_TYPE, EX + "Customer")
    orders = bgp(graph(spark, sf, "orders"), [("?o", EX + "customer", "?c"), ("?o", EX + "total", "?total")])
    sol = optional(customers, orders, fn.decimal(term(orders, "total")) > 400000)
    return lexical(sol, "c", "o")


@query("x3_minus", f"""
SELECT {CUST} c_custkey AS c FROM customer ANTI JOIN orders ON o_custkey = c_custkey
""")
def x3_minus(spark, sf):
    customers = match(graph(spark, sf, "customer"), "?c", RDF_TYPE, EX + "Customer")
    return lexical(minus(customers, match(graph(spark, sf, "orders"), "?o", EX + "customer", "?c")), "c")


@query("x4_not_exists", f"""
SELECT {CUST} c_custkey AS c FROM customer WHERE NOT EXISTS (
  SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')
""")
def x4_not_exists(spark, sf):
    g = graph(spark, sf, "customer", "orders")
    finished = bgp(g, [("?o", EX + "customer", "?c"), ("?o", EX + "status", Literal("F"))])
    return lexical(not_exists(match(g, "?c", RDF_TYPE, EX + "Customer"), finished), "c")


@query("x4_exists", f"""
SELECT {CUST} c_custkey AS c FROM customer WHERE EXISTS (
  SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')
""")
def x4_exists(spark, sf):
    g = graph(spark, sf, "customer", "orders")
    urgent = bgp(g, [("?o", EX + "customer", "?c"), ("?o", EX + "priority", Literal("1-URGENT"))])
    return lexical(exists(match(g, "?c", RDF_TYPE, EX + "Customer"), urgent), "c")


@query("x5_filter", """
SELECT 'http://example.org/part/' || p_partkey AS x, p_size::VARCHAR AS size FROM part
WHERE p_size >= 25 AND regexp_matches(p_brand, '^Brand#[12]')
""")
def x5_filter(spark, sf):
    sol = bgp(graph(spark, sf, "part"), [("?x", EX + "size", "?size"), ("?x", EX + "brand", "?brand")])
    cond = (fn.integer(term(sol, "size")) >= 25) & fn.regex(term(sol, "brand"), "^brand#[12]", "i")
    return lexical(filter_(sol, cond), "x", "size")


@query("x6_unbound_join", f"""
WITH l AS (
  SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS seg FROM customer),
r AS (SELECT DISTINCT c_nationkey, c_mktsegment AS seg FROM customer WHERE c_acctbal > 5000
  UNION ALL SELECT n_nationkey, NULL FROM nation WHERE n_regionkey = 0)
SELECT {CUST} l.c_custkey AS c, coalesce(l.seg, r.seg) AS seg
FROM l JOIN r ON l.c_nationkey = r.c_nationkey AND (l.seg = r.seg OR l.seg IS NULL OR r.seg IS NULL)
""")
def x6_unbound_join(spark, sf):
    """Both sides may leave the segment unbound; every part is an equi-join on the nation."""
    customer = table(spark, sf, "customer")
    base = match(graph(spark, sf, "customer"), "?c", EX + "nation", "?n")
    known = customer.filter("c_acctbal >= 0")
    left = optional(base, match(_segments(known), "?c", EX + "segment", "?seg"))
    rich = customer.filter("c_acctbal > 5000")
    pairs = distinct(project(bgp(_segments(rich), [
        ("?x", EX + "segment", "?seg"), ("?x", EX + "nation", "?n")]), "n", "seg"))
    region = match(graph(spark, sf, "nation"), "?n", EX + "region", EX + "region/0")
    return lexical(join(left, union(pairs, region)), "c", "seg")


def _segments(customer):
    m = TriplesMap("customer", template(EX + "customer/{c_custkey}"), [
        pom(EX + "segment", "c_mktsegment"), pom(EX + "nation", template(EX + "nation/{c_nationkey}"))])
    return apply_mapping(customer, m)


@query("x6_unbound_minus", f"""
WITH l AS (
  SELECT c_custkey, c_nationkey, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS seg FROM customer),
r AS (SELECT DISTINCT c_nationkey, c_mktsegment AS seg FROM customer WHERE c_acctbal > 9500)
SELECT {CUST} l.c_custkey AS c FROM l WHERE NOT EXISTS (
  SELECT 1 FROM r WHERE l.c_nationkey = r.c_nationkey AND (l.seg = r.seg OR l.seg IS NULL))
""")
def x6_unbound_minus(spark, sf):
    customer = table(spark, sf, "customer")
    base = match(graph(spark, sf, "customer"), "?c", EX + "nation", "?n")
    left = optional(base, match(_segments(customer.filter("c_acctbal >= 0")), "?c", EX + "segment", "?seg"))
    right = project(bgp(_segments(customer.filter("c_acctbal > 9500")), [
        ("?x", EX + "segment", "?seg"), ("?x", EX + "nation", "?n")]), "n", "seg")
    return lexical(minus(left, right), "c")


@query("x6_many_unbound", """
WITH o AS (SELECT o_custkey AS k, o_orderkey AS n, o_orderstatus AS a, o_orderpriority AS b, floor(o_totalprice)::BIGINT % 7 AS c FROM orders),
l AS (SELECT k, CASE WHEN n % 2 = 0 THEN a END AS a, CASE WHEN n % 3 = 0 THEN b END AS b, CASE WHEN n % 5 > 1 THEN c END AS c FROM o),
r AS (SELECT k, CASE WHEN n % 3 > 0 THEN a END AS a, CASE WHEN n % 2 = 0 THEN b END AS b, CASE WHEN n % 5 < 3 THEN c END AS c FROM o)
SELECT 'http://example.org/customer/' || l.k AS k, count(*) AS n FROM l JOIN r ON l.k = r.k
  AND (l.a IS NULL OR r.a IS NULL OR l.a = r.a) AND (l.b IS NULL OR r.b IS NULL OR l.b = r.b)
  AND (l.c IS NULL OR r.c IS NULL OR l.c = r.c) GROUP BY 1
""")
def x6_many_unbound(spark, sf):
    """Orders of one customer that agree wherever both sides have a value, which rows have or lack in many ways."""
    rows = table(spark, sf, "orders")
    places = {"a": "o_orderstatus", "b": "o_orderpriority", "c": "cast(floor(o_totalprice) AS bigint) % 7"}

    def side(tests):
        bound = {v: F.expr(f"CASE WHEN {tests[v]} THEN concat('{EX}value/', {text}) END") for v, text in places.items()}
        columns = {"k": F.concat(F.lit(EX + "customer/"), "o_custkey"), **bound}
        sol = rows.select(*(x for v, c in columns.items() for x in iri_term(c).columns(v)))
        return mark_unbound(sol, list(places))

    left = side({"a": "o_orderkey % 2 = 0", "b": "o_orderkey % 3 = 0", "c": "o_orderkey % 5 > 1"})
    right = side({"a": "o_orderkey % 3 > 0", "b": "o_orderkey % 2 = 0", "c": "o_orderkey % 5 < 3"})
    return group(join(left, right), ["k"], {"n": F.count(F.lit(1))}).select("k", "n")


@query("x7_values", f"""
SELECT {CUST} c_custkey AS c, c_mktsegment AS segment, CASE c_mktsegment WHEN 'BUILDING' THEN 'b' ELSE 'm' END AS code
FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
""")
def x7_values(spark, sf):
    codes = values(spark, ["segment", "code"], [
        (Literal("BUILDING"), Literal("b")), (Literal("MACHINERY"), Literal("m"))])
    return lexical(join(match(graph(spark, sf, "customer"), "?c", EX + "segment", "?segment"), codes))


@query("x8_distinct", f"""
SELECT DISTINCT c_mktsegment AS segment, {NATION} c_nationkey AS n FROM customer
""")
def x8_distinct(spark, sf):
    sol = bgp(graph(spark, sf, "customer"), [("?c", EX + "segment", "?segment"), ("?c", EX + "nation", "?n")])
    return lexical(distinct(project(sol, "segment", "n")))


@query("x9_topk", f"""
SELECT {ORDER} o_orderkey AS o, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS total FROM orders
ORDER BY CAST(o_totalprice AS DECIMAL(18,2)) DESC, {ORDER} o_orderkey LIMIT 20
""")
def x9_topk(spark, sf):
    sol = match(graph(spark, sf, "orders"), "?o", EX + "total", "?total")
    return lexical(order_by(sol, ("total", "desc"), "o", limit=20), "o", "total")


@query("x9_offset", f"""
SELECT {CUST} c_custkey AS c, c_name AS name FROM customer ORDER BY c_name DESC LIMIT 30 OFFSET 15
""")
def x9_offset(spark, sf):
    sol = match(graph(spark, sf, "customer"), "?c", EX + "name", "?name")
    return lexical(order_by(sol, ("name", "desc"), limit=30, offset=15), "c", "name")


@query("x10_group_having", f"""
SELECT {CUST} o_custkey AS c, count(*) AS orders, count(DISTINCT o_orderpriority) AS priorities,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS VARCHAR) AS total,
  CAST(max(CAST(o_totalprice AS DECIMAL(18,2))) AS VARCHAR) AS largest
FROM orders GROUP BY o_custkey HAVING count(*) > 12
""")
def x10_group_having(spark, sf):
    sol = bgp(graph(spark, sf, "orders"), [
        ("?o", EX + "customer", "?c"), ("?o", EX + "priority", "?priority"), ("?o", EX + "total", "?total")])
    amount = fn.decimal(term(sol, "total")).cast("decimal(18,2)")
    groups = group(sol, ["c"], {
        "orders": count_of(sol, "o"), "priorities": count_of(sol, "priority", distinct=True),
        "total": sum_of(amount), "largest": max_of(amount)}, having=F.col("orders") > 12)
    return groups.select("c", "orders", "priorities", F.col("total").cast("string"), F.col("largest").cast("string"))


@query("x10_aggregates", """
SELECT p_brand AS brand, count(*) AS n, CAST(sum(p_size) AS BIGINT) AS total, CAST(sum(DISTINCT p_size) AS BIGINT) AS
  distinct_total, min(p_size)::BIGINT AS smallest, max(p_size)::BIGINT AS largest,
  CAST(floor(avg(p_size) * 100) AS BIGINT) AS mean
FROM part GROUP BY p_brand
""")
def x10_aggregates(spark, sf):
    sol = bgp(graph(spark, sf, "part"), [("?x", EX + "brand", "?brand"), ("?x", EX + "size", "?size")])
    size = fn.integer(term(sol, "size"))
    groups = group(sol, ["brand"], {
        "n": count_of(sol, "x"), "total": sum_of(size), "distinct_total": sum_of(size, distinct=True),
        "smallest": min_of(size), "largest": max_of(size),
        "mean": F.floor(avg_of(size) * 100).cast("bigint")})
    return groups.drop("brand_kind", "brand_dt", "brand_lang")


@query("x11_group_concat", f"""
SELECT {NATION} c_nationkey AS n, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS segments,
  min(1)::BIGINT AS sampled
FROM customer GROUP BY c_nationkey
""")
def x11_group_concat(spark, sf):
    sol = bgp(graph(spark, sf, "customer"), [("?c", EX + "segment", "?segment"), ("?c", EX + "nation", "?n")])
    groups = group(sol, ["n"], {
        "segments": group_concat("segment", ",", distinct=True), "any_segment": sample("segment")})
    # Any value of the group is right for a sample: test that it is one of them.
    one = F.array_contains(F.split("segments", ","), F.col("any_segment")).cast("bigint")
    return groups.select("n", "segments", one.alias("sampled"))


@query("x12_subselect", f"""
SELECT {CUST} c_custkey AS c, n AS orders
FROM customer JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, {CUST} o_custkey LIMIT 25)
  ON c_custkey = o_custkey
""")
def x12_subselect(spark, sf):
    inner = group(match(graph(spark, sf, "orders"), "?o", EX + "customer", "?c"), ["c"], {
        "orders": F.count(F.lit(1))})
    top = order_by(inner, ("orders", "desc"), "c", limit=25)
    sol = join(match(graph(spark, sf, "customer"), "?c", RDF_TYPE, EX + "Customer"), top)
    return lexical(sol, "c", "orders")


def _by_segment(spark, sf):
    customers = _segments(table(spark, sf, "customer"))
    segment = match(customers, "?s", EX + "segment", "?seg").select(F.col("s").alias("x"), "seg")
    placed = customers.join(segment, F.col("s") == F.col("x"))
    return into_graph(placed, F.concat(F.lit(EX + "segment/"), F.col("seg")))


@query("x13_graph", f"""
SELECT 'http://example.org/segment/' || c_mktsegment AS g, {CUST} c_custkey AS c FROM customer
""")
def x13_graph(spark, sf):
    return lexical(match(_by_segment(spark, sf), "?c", EX + "segment", "?seg", g="?g"), "g", "c")


@query("x13_named_graph", f"""
SELECT {CUST} c_custkey AS c, {NATION} c_nationkey AS n FROM customer WHERE c_mktsegment = 'MACHINERY'
""")
def x13_named_graph(spark, sf):
    return lexical(match(_by_segment(spark, sf), "?c", EX + "nation", "?n", g=EX + "segment/MACHINERY"))


# --- X14 - X17: paths and query forms ------------------------------------------------

@query("x14_sequence", f"""
SELECT {CUST} c_custkey AS x, {REGION} n_regionkey AS y FROM customer JOIN nation ON c_nationkey = n_nationkey
""")
def x14_sequence(spark, sf):
    g = graph(spark, sf, "customer", "nation")
    return lexical(paths.sequence(paths.hop(g, EX + "nation"), paths.hop(g, EX + "region")), "x", "y")


@query("x14_alternative_inverse", f"""
SELECT {NATION} c_nationkey AS x, {CUST} c_custkey AS y FROM customer
UNION ALL SELECT {NATION} n_nationkey, {REGION} n_regionkey FROM nation
""")
def x14_alternative_inverse(spark, sf):
    members = paths.inverse(paths.hop(graph(spark, sf, "customer"), EX + "nation"))
    region = paths.hop(graph(spark, sf, "nation"), EX + "region")
    return lexical(paths.alternative(members, region), "x", "y")


@query("x14_zero_or_one", f"""
SELECT {NATION} n_nationkey AS x, {REGION} n_regionkey AS y FROM nation
UNION SELECT v, v FROM (
  SELECT {NATION} n_nationkey AS v FROM nation UNION SELECT {REGION} n_regionkey FROM nation
  UNION SELECT n_name FROM nation UNION SELECT 'http://example.org/Nation' FROM nation)
""")
def x14_zero_or_one(spark, sf):
    g = graph(spark, sf, "nation")
    return paths.zero_or_one(g, paths.hop(g, EX + "region")).select("x", "y")


@query("x14_negated", f"""
SELECT {NATION} n_nationkey AS x, n_name AS y FROM nation
UNION ALL SELECT {NATION} n_nationkey, 'http://example.org/Nation' FROM nation
UNION ALL SELECT n_name, {NATION} n_nationkey FROM nation
UNION ALL SELECT {REGION} n_regionkey, {NATION} n_nationkey FROM nation
""")
def x14_negated(spark, sf):
    """Any predicate but the region, or backwards any but the type."""
    return lexical(paths.negated(graph(spark, sf, "nation"), [EX + "region"], [RDF_TYPE]), "x", "y")


def _turns(spark, sf):
    """Each turn of a conversation leads to the next one."""
    turns = table(spark, sf, "conversations").select("conv_id", "turn")
    m = TriplesMap("turns", template(EX + "turn/{conv_id}/{turn}"), [
        pom(EX + "next", template(EX + "turn/{conv_id}/{later}"))])
    rows = turns.withColumn("later", F.col("turn") + 1)
    exists_ = turns.select(F.col("conv_id").alias("c2"), F.col("turn").alias("t2"))
    rows = rows.join(exists_, (F.col("conv_id") == F.col("c2")) & (F.col("later") == F.col("t2")), "left_semi")
    return apply_mapping(rows, m)


_REACH = """
WITH RECURSIVE reach AS (
  SELECT a.conv_id, a.turn AS t1, b.turn AS t2 FROM conversations a JOIN conversations b
    ON a.conv_id = b.conv_id AND b.turn = a.turn + 1
  UNION SELECT r.conv_id, r.t1, b.turn FROM reach r JOIN conversations b
    ON r.conv_id = b.conv_id AND b.turn = r.t2 + 1)
"""
_TURN = "'http://example.org/turn/' || conv_id || '/' || "


@query("x15_one_or_more", f"{_REACH} SELECT {_TURN} t1 AS x, {_TURN} t2 AS y FROM reach")
def x15_one_or_more(spark, sf):
    return paths.one_or_more(paths.hop(_turns(spark, sf), EX + "next")).select("x", "y")


@query("x15_zero_or_more", f"""{_REACH}, node AS (
  SELECT DISTINCT conv_id, t FROM (SELECT conv_id, t1 AS t FROM reach UNION ALL SELECT conv_id, t2 FROM reach))
SELECT {_TURN} t1 AS x, {_TURN} t2 AS y FROM reach UNION ALL SELECT {_TURN} t, {_TURN} t FROM node
""")
def x15_zero_or_more(spark, sf):
    g = _turns(spark, sf)
    return paths.zero_or_more(g, paths.hop(g, EX + "next")).select("x", "y")


@query("x16_ask", "SELECT count(*) > 0 AS ask FROM orders WHERE o_totalprice > 450000")
def x16_ask(spark, sf):
    sol = match(graph(spark, sf, "orders"), "?o", EX + "total", "?total")
    return ask(filter_(sol, fn.decimal(term(sol, "total")) > 450000))


@query("x17_describe", """
SELECT 'http://example.org/name' AS p, c_name AS o FROM customer WHERE c_custkey = 7
UNION ALL SELECT 'http://example.org/segment', c_mktsegment FROM customer WHERE c_custkey = 7
UNION ALL SELECT 'http://example.org/nation', 'http://example.org/nation/' || c_nationkey FROM customer WHERE c_custkey = 7
UNION ALL SELECT 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type', 'http://example.org/Customer'
""")
def x17_describe(spark, sf):
    return describe(graph(spark, sf, "customer", "orders"), EX + "customer/7").select("p", "o")


@query("x17_describe_many", f"""
WITH c AS (SELECT DISTINCT customer.* FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_totalprice > 450000)
SELECT {CUST} c_custkey AS s, count(*) AS n FROM c, range(4) GROUP BY 1
""")
def x17_describe_many(spark, sf):
    sol = bgp(graph(spark, sf, "orders"), [("?o", EX + "customer", "?s"), ("?o", EX + "total", "?total")])
    rich = filter_(sol, fn.decimal(term(sol, "total")) > 450000)
    quads = describe(graph(spark, sf, "customer"), rich.select("s"))
    return quads.groupBy("s").agg(F.count(F.lit(1)).alias("n"))


@query("q16_env_param", f"SELECT {CUST} c_custkey AS c, 'urn:data:run' AS base FROM customer")
def q16_env_param(spark, sf):
    sol = match(graph(spark, sf, "customer"), "?c", RDF_TYPE, EX + "Customer")
    return lexical(bind(sol, "base", fn.env_param({"BASE": "urn:data:run"}, "BASE")), "c", "base")


@query("q11_iri", """
SELECT url AS text, url AS x FROM pages
UNION ALL SELECT url || ' broken', NULL FROM pages
UNION ALL SELECT '<' || url || '>', NULL FROM pages
""")
def q11_iri(spark, sf):
    pages = table(spark, sf, "pages")
    texts = F.array(F.col("url"), F.concat("url", F.lit(" broken")), F.concat(F.lit("<"), "url", F.lit(">")))
    sol = pages.select(F.explode(texts).alias("text"))
    return bind(sol, "x", fn.iri(literal_term(F.col("text")))).select("text", "x")


@query("q13_encode", """
SELECT 'part' AS kind, p_name AS v, url_encode(p_name) AS e FROM part
UNION ALL SELECT 'name', c_name, url_encode(c_name) FROM customer
UNION ALL SELECT 'document', md5(text), md5(url_encode(text)) FROM documents
UNION ALL SELECT 'special', p_name || '*~+/é', url_encode(p_name || '*~+/é') FROM part
""")
def q13_encode(spark, sf):
    part, customer = table(spark, sf, "part"), table(spark, sf, "customer")
    special = part.select(F.concat("p_name", F.lit("*~+/é")).alias("v"))
    rows = [
        part.select(F.lit("part").alias("kind"), F.col("p_name").alias("v"), fn.encode_for_uri(F.col("p_name")).alias("e")),
        customer.select(F.lit("name").alias("kind"), F.col("c_name").alias("v"), fn.encode_for_uri(F.col("c_name")).alias("e")),
        table(spark, sf, "documents").select(
            F.lit("document").alias("kind"), F.md5("text").alias("v"), F.md5(fn.encode_for_uri(F.col("text"))).alias("e")),
        special.select(F.lit("special").alias("kind"), "v", fn.encode_for_uri(F.col("v")).alias("e")),
    ]
    return rows[0].union(rows[1]).union(rows[2]).union(rows[3])


@query("q12_concat", """
SELECT c_custkey::VARCHAR AS key, c_name || '-' || CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS label FROM customer
""")
def q12_concat(spark, sf):
    customer = table(spark, sf, "customer")
    segment = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    return customer.select(
        F.col("c_custkey").cast("string").alias("key"),
        fn.concat_terms(F.col("c_name"), F.lit("-"), segment).alias("label"))


@query("q14_coalesce", f"""
SELECT {CUST} c_custkey AS c, CASE WHEN c_acctbal >= 0 THEN c_mktsegment ELSE {NATION} c_nationkey END AS v,
  CASE WHEN c_acctbal >= 0 THEN 'literal' ELSE 'iri' END AS v_kind
FROM customer
""")
def q14_coalesce(spark, sf):
    base = match(graph(spark, sf, "customer"), "?c", EX + "nation", "?n")
    known = table(spark, sf, "customer").filter("c_acctbal >= 0")
    sol = optional(base, match(_segments(known), "?c", EX + "segment", "?seg"))
    return bind(sol, "v", fn.coalesce_terms(term(sol, "seg"), term(sol, "n"))).select("c", "v", "v_kind")


@query("q15_str", f"SELECT {NATION} n_nationkey AS v, 'literal' AS v_kind, n_name AS name FROM nation")
def q15_str(spark, sf):
    sol = match(graph(spark, sf, "nation"), "?n", EX + "name", "?name")
    return bind(sol, "v", fn.str_(term(sol, "n"))).select("v", "v_kind", "name")

