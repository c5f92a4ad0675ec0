"""G, Q18, X18 - X20: whole graphs and updates."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadspark.functions.terms import BNODE, Literal
from quadspark.operators import canonical, graphs, versions
from quadspark.operators.mapping import MappedGraph, TriplesMap, apply_mapping, pom, template
from quadspark.operators.patterns import bgp, count_all, match
from quadspark.operators.void import class_instances, property_partition
from quadspark.plans.registry import query, table
from quadspark.plans.script import run_script
from quadspark.plans.testgraph import EX, graph, node
from quadspark.session import scratch_path

CUST = "'http://example.org/customer/' || "
NAME = "'http://example.org/name'"


def _names(spark, sf, source, condition="true"):
    """Name triples of the rows that satisfy a condition."""
    key, name = {"customer": ("c_custkey", "c_name"), "supplier": ("s_suppkey", "s_name")}[source]
    rows = table(spark, sf, source).filter(condition)
    return apply_mapping(rows, TriplesMap(source, node(source, key), [pom(EX + "name", name)]))


@query("g1_graph_union", f"""
SELECT {CUST} c_custkey AS s, c_name AS o FROM customer WHERE c_acctbal > 0 OR c_mktsegment = 'BUILDING'
UNION ALL SELECT 'http://example.org/supplier/' || s_suppkey, s_name FROM supplier
""")
def g1_graph_union(spark, sf):
    rich = _names(spark, sf, "customer", "c_acctbal > 0")
    builders = _names(spark, sf, "customer", "c_mktsegment = 'BUILDING'")
    return graphs.graph_union(rich, None, builders, rich, _names(spark, sf, "supplier")).select("s", "o")


@query("g2_natural_graph", f"SELECT {CUST} c_custkey AS s, c_name AS o, {CUST} c_custkey AS g FROM customer")
def g2_natural_graph(spark, sf):
    return graphs.natural_graph(_names(spark, sf, "customer")).select("s", "o", "g")


_PIECES = ", ".join(
    f"sum(('0x' || substr(d, {1 + 15 * i}, 15))::BIGINT::HUGEINT)::VARCHAR AS d{i}" for i in range(4))


@query("g3_skolemize", f"""
WITH r AS (SELECT c_custkey AS k, unnest([
    'http://example.org/name' || chr(1) || c_name,
    'http://example.org/segment' || chr(1) || c_mktsegment]) || chr(1) || 'literal' || chr(1)
    || 'http://www.w3.org/2001/XMLSchema#string' || chr(1) AS row FROM customer),
h AS (SELECT k, sha256(row) AS d FROM r),
n AS (SELECT k, {_PIECES} FROM h GROUP BY k),
i AS (SELECT k, 'http://example.org/Account-' || sha256(concat_ws(chr(1), d0, d1, d2, d3)) AS iri FROM n)
SELECT iri AS s, 'http://example.org/name' AS p, c_name AS o FROM i JOIN customer ON k = c_custkey
UNION ALL SELECT iri, 'http://example.org/segment', c_mktsegment FROM i JOIN customer ON k = c_custkey
UNION ALL SELECT {CUST} k, 'http://example.org/account', iri FROM i
""")
def g3_skolemize(spark, sf):
    account = template("account-{c_custkey}", BNODE)
    quads = MappedGraph({"customer": table(spark, sf, "customer")}, [
        TriplesMap("customer", account, [pom(EX + "name", "c_name"), pom(EX + "segment", "c_mktsegment")]),
        TriplesMap("customer", node("customer", "c_custkey"), [pom(EX + "account", account)])]).quads()
    named = graphs.skolemize(quads, EX, "Account", [EX + "name", EX + "segment"])
    return named.select("s", "p", "o")


@query("g3_skolemize_graph", """
WITH d AS (SELECT DISTINCT c_mktsegment, c_nationkey FROM customer)
SELECT 'http://example.org/' || p AS p, count(*) AS triples, count(*) AS subjects
FROM d, (SELECT unnest(['segment', 'branch', 'nation']) AS p) GROUP BY 1
""")
def g3_skolemize_graph(spark, sf):
    """Blank accounts that refer to blank branches: nodes that say the same become one."""
    account, branch = template("account-{c_custkey}", BNODE), template("branch-{c_custkey}", BNODE)
    quads = MappedGraph({"customer": table(spark, sf, "customer")}, [
        TriplesMap("customer", account, [pom(EX + "segment", "c_mktsegment"), pom(EX + "branch", branch)]),
        TriplesMap("customer", branch, [pom(EX + "nation", node("nation", "c_nationkey"))])]).quads()
    named = canonical.skolemize_graph(quads, EX, "Account")
    return named.groupBy("p").agg(F.count(F.lit(1)).alias("triples"), F.count_distinct("s").alias("subjects"))


@query("g4_dataset_label", """
SELECT url, replace(regexp_replace(url, '^https?://', ''), '/', '-') AS label FROM pages
""")
def g4_dataset_label(spark, sf):
    return table(spark, sf, "pages").select("url", graphs.dataset_label(F.col("url")).alias("label"))


@query("q18_move_to_graph", f"""
SELECT {CUST} c_custkey AS s, c_name AS o, CASE WHEN c_acctbal > 0 THEN 'http://example.org/kept' END AS g FROM customer
""")
def q18_move_to_graph(spark, sf):
    """The subjects to move come from a pattern; the rest stays in the default graph."""
    quads = _names(spark, sf, "customer", "c_acctbal > 0")
    moved = graphs.move_to_graph(quads, F.col("p") == EX + "name", EX + "kept")
    rest = _names(spark, sf, "customer", "NOT c_acctbal > 0")
    return graphs.graph_union(moved, graphs.move_to_graph(rest, F.col("p") == EX + "none", EX + "kept")).select(
        "s", "o", "g")


@query("q19_run_script", """
SELECT 'http://example.org/stat/class/' || c AS s, n::VARCHAR AS o FROM (
  SELECT 'Customer' AS c, count(*) AS n FROM customer UNION ALL SELECT 'Nation', count(*) FROM nation)
UNION ALL SELECT 'http://example.org/stat/property/' || p, n::VARCHAR FROM (
  SELECT 'name' AS p, (SELECT count(*) FROM customer) + (SELECT count(*) FROM nation) AS n
  UNION ALL SELECT 'segment', count(*) FROM customer UNION ALL SELECT 'nation', count(*) FROM customer
  UNION ALL SELECT 'region', count(*) FROM nation
  UNION ALL SELECT 'type', (SELECT count(*) FROM customer) + (SELECT count(*) FROM nation))
UNION ALL SELECT 'http://example.org/stat/all', ((SELECT count(*) FROM customer) * 4 + (SELECT count(*) FROM nation) * 3)::VARCHAR
""")
def q19_run_script(spark, sf):
    """Three statistics over one dataset, each a triple of the common output."""
    def stat(df, subject, value):
        m = TriplesMap("stat", template(subject), [pom(EX + "count", value)])
        return apply_mapping(df, m)

    def classes(quads):
        counts = class_instances(quads).withColumn("local", F.substring_index("class", "/", -1))
        return stat(counts, EX + "stat/class/{local}", "instances")

    def properties(quads):
        counts = property_partition(quads).withColumn("local", F.regexp_extract("p", "([^/#]+)$", 1))
        return stat(counts, EX + "stat/property/{local}", "triples")

    def everything(quads):
        return stat(count_all(match(quads, "?s", "?p", "?o")), EX + "stat/all", "count")

    quads = graph(spark, sf, "customer", "nation").quads()
    return run_script(spark, [classes, properties, everything], quads).select("s", "o")


@query("x18_insert_delete_data", f"""
SELECT {CUST} c_custkey AS s, c_name AS o FROM customer WHERE NOT c_mktsegment = 'BUILDING'
UNION ALL SELECT 'http://example.org/supplier/' || s_suppkey, s_name FROM supplier
""")
def x18_insert_delete_data(spark, sf):
    quads = graphs.insert_data(_names(spark, sf, "customer"), _names(spark, sf, "supplier"))
    old = _names(spark, sf, "customer", "c_mktsegment = 'BUILDING'")
    return graphs.delete_data(quads, old).select("s", "o")


@query("x18_delete_where", f"""
SELECT {CUST} c_custkey AS s, p FROM customer, (VALUES ('name'), ('nation'), ('segment')) AS v(p)
WHERE NOT (c_mktsegment = 'MACHINERY' AND p IN ('name', 'segment'))
""")
def x18_delete_where(spark, sf):
    quads = graph(spark, sf, "customer").quads([EX + "name", EX + "nation", EX + "segment"])
    patterns = [("?c", EX + "segment", Literal("MACHINERY")), ("?c", EX + "name", "?name")]
    left = graphs.delete_where(quads, patterns)
    return left.select("s", F.substring_index("p", "/", -1).alias("p"))


@query("x18_modify", f"""
SELECT {CUST} c_custkey AS s, 'http://example.org/inRegion' AS p, 'http://example.org/region/' || n_regionkey AS o
FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT 'http://example.org/nation/' || n_nationkey, 'http://example.org/region',
  'http://example.org/region/' || n_regionkey FROM nation
""")
def x18_modify(spark, sf):
    quads = graph(spark, sf, "customer", "nation").quads([EX + "nation", EX + "region"])
    where = bgp(quads, [("?c", EX + "nation", "?n"), ("?n", EX + "region", "?r")])
    changed = graphs.modify(quads, where, delete=[("?c", EX + "nation", "?n")],
                            insert=[("?c", EX + "inRegion", "?r")])
    return changed.select("s", "p", "o")


def _two_graphs(spark, sf):
    """Names of wealthy customers in graph a, of builders in graph b, of suppliers in the default graph."""
    return graphs.graph_union(
        graphs.into_graph(_names(spark, sf, "customer", "c_acctbal > 5000"), EX + "a"),
        graphs.into_graph(_names(spark, sf, "customer", "c_mktsegment = 'BUILDING'"), EX + "b"),
        _names(spark, sf, "supplier"))


_GRAPHS = """
WITH a AS (SELECT c_name AS o FROM customer WHERE c_acctbal > 5000),
b AS (SELECT c_name AS o FROM customer WHERE c_mktsegment = 'BUILDING'), d AS (SELECT s_name AS o FROM supplier)
"""
_OUT = "SELECT o, 'http://example.org/{1}' AS g FROM {0}"


@query("x19_add", f"""{_GRAPHS} {_OUT.format('a', 'a')} UNION ALL SELECT o, NULL FROM d
UNION ALL SELECT o, 'http://example.org/b' FROM (SELECT o FROM a UNION SELECT o FROM b)""")
def x19_add(spark, sf):
    return graphs.add_graph(_two_graphs(spark, sf), EX + "a", EX + "b").select("o", "g")


@query("x19_copy", f"{_GRAPHS} {_OUT.format('a', 'a')} UNION ALL SELECT o, NULL FROM d "
       f"UNION ALL {_OUT.format('a', 'b')}")
def x19_copy(spark, sf):
    return graphs.copy_graph(_two_graphs(spark, sf), EX + "a", EX + "b").select("o", "g")


@query("x19_move", f"{_GRAPHS} SELECT o, NULL AS g FROM d UNION ALL {_OUT.format('a', 'b')}")
def x19_move(spark, sf):
    return graphs.move_graph(_two_graphs(spark, sf), EX + "a", EX + "b").select("o", "g")


@query("x19_clear", f"{_GRAPHS} {_OUT.format('a', 'a')} UNION ALL {_OUT.format('b', 'b')}")
def x19_clear(spark, sf):
    return graphs.clear_graph(_two_graphs(spark, sf), None).select("o", "g")


def _all_versions(spark, path, last):
    """Rows of every number of a stored graph."""
    parts = [versions.read_version(spark, path, n).withColumn("number", F.lit(n).cast("long")) for n in range(last + 1)]
    return reduce(DataFrame.unionByName, parts)


@query("x18_versions", f"""
WITH c AS (SELECT {CUST} c_custkey AS s, p, c_mktsegment = 'MACHINERY' AS machinery
    FROM customer, (VALUES ('name'), ('nation'), ('segment')) AS v(p)),
d AS (SELECT 'http://example.org/supplier/' || s_suppkey AS s, 'name' AS p FROM supplier)
SELECT 0::BIGINT AS number, s, p FROM c
UNION ALL SELECT n, s, p FROM c, (VALUES (1::BIGINT), (2), (3)) AS v(n)
WHERE NOT (machinery AND (p = 'segment' OR p = 'name' AND n < 3))
UNION ALL SELECT n, s, p FROM d, (VALUES (2::BIGINT), (3)) AS v(n)
""")
def x18_versions(spark, sf):
    path = scratch_path(spark, "versions")
    versions.create(graph(spark, sf, "customer").quads([EX + "name", EX + "nation", EX + "segment"]), path)
    patterns = [("?c", EX + "segment", Literal("MACHINERY")), ("?c", EX + "name", "?name")]
    versions.modify_version(spark, path, patterns, delete=patterns)
    versions.update(spark, path, insert=_names(spark, sf, "supplier"))
    versions.compact(spark, path)
    versions.update(spark, path, insert=_names(spark, sf, "customer", "c_mktsegment = 'MACHINERY'"))
    return _all_versions(spark, path, 3).select("number", "s", F.substring_index("p", "/", -1).alias("p"))


@query("x19_versions", f"""{_GRAPHS}
SELECT 0::BIGINT AS number, * FROM ({_OUT.format('a', 'a')} UNION ALL {_OUT.format('b', 'b')} UNION ALL SELECT o, NULL FROM d)
UNION ALL SELECT 1, * FROM ({_OUT.format('a', 'a')} UNION ALL {_OUT.format('a', 'b')} UNION ALL SELECT o, NULL FROM d)
UNION ALL SELECT 2, * FROM ({_OUT.format('a', 'a')} UNION ALL SELECT o, NULL FROM a)
UNION ALL SELECT 3, o, NULL FROM a""")
def x19_versions(spark, sf):
    path = scratch_path(spark, "versions")
    versions.create(_two_graphs(spark, sf), path)
    versions.copy_version(spark, path, EX + "a", EX + "b")
    versions.copy_version(spark, path, EX + "b", None, move=True)
    versions.update(spark, path, clear=[EX + "a"])
    return _all_versions(spark, path, 3).select("number", "o", "g")


@query("x20_intersection", f"""
SELECT {CUST} c_custkey AS s, c_name AS o FROM customer WHERE c_acctbal > 0 AND c_mktsegment = 'BUILDING'
""")
def x20_intersection(spark, sf):
    return graphs.graph_intersection(
        _names(spark, sf, "customer", "c_acctbal > 0"),
        _names(spark, sf, "customer", "c_mktsegment = 'BUILDING'")).select("s", "o")


@query("x20_difference", f"""
SELECT {CUST} c_custkey AS s, c_name AS o FROM customer WHERE c_acctbal > 0 AND NOT c_mktsegment = 'BUILDING'
""")
def x20_difference(spark, sf):
    return graphs.graph_difference(
        _names(spark, sf, "customer", "c_acctbal > 0"),
        _names(spark, sf, "customer", "c_mktsegment = 'BUILDING'")).select("s", "o")


@query("l2_into_graph", f"""
SELECT {CUST} c_custkey AS s, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS g FROM customer
""")
def l2_into_graph(spark, sf):
    """A blank graph name is the default graph; names are trimmed."""
    quads = _names(spark, sf, "customer")
    segment = table(spark, sf, "customer").select(
        F.concat(F.lit(EX + "customer/"), F.col("c_custkey")).alias("x"),
        F.when(F.col("c_acctbal") >= 0, F.concat(F.lit(" "), "c_mktsegment", F.lit(" "))).otherwise("  ").alias("name"))
    placed = quads.join(segment, F.col("s") == F.col("x"))
    return graphs.into_graph(placed, F.col("name")).select("s", "g")


