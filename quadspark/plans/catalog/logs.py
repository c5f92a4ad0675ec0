"""S5, R, B: query logs and benchmark plans.

Log lines come from ``events``: user, time, and a query made from type and
properties.  The oracles hash the query text built from the same columns.
"""

from pyspark.sql import functions as F

from quadspark.operators import benchplan, querylog
from quadspark.operators.graphs import natural_graph
from quadspark.plans.registry import query, spread_table, table
from quadspark.plans.testgraph import EX
from quadspark.session import scratch_path
from quadspark.sinks.rdf import write_rdf
from quadspark.sources.querylog import list_position, normalize_query, parse_query_log, query_id, read_query_log

# The query of an event, with and without superfluous white space.
_TEXT = ("'SELECT ?x WHERE { ?x <http://example.org/type> \"' || event_type || '  event\" . ?x <http://example.org/k> '"
         " || regexp_extract(props, '\\d+') || ' FILTER(?x > 1) }'")


def _queries(spark, sf):
    """Query texts with the spacing that the query id has to ignore."""
    events = spread_table(spark, sf, "events", "event_id")
    number = F.regexp_extract("props", r"\d+", 0)
    tidy = F.concat(
        F.lit('SELECT ?x WHERE { ?x <http://example.org/type> "'), F.col("event_type"),
        F.lit('  event" . ?x <http://example.org/k> '), number, F.lit(" FILTER(?x > 1) }"))
    loose = F.concat(
        F.lit('  SELECT ?x\nWHERE {\t?x <http://example.org/type>   "'), F.col("event_type"),
        F.lit('  event" .\n ?x <http://example.org/k> '), number, F.lit(" FILTER(?x   > 1) }\n"))
    return events.select("event_id", "ts", "user_id", "event_type", "value", number.alias("k"),
                         tidy.alias("tidy"), F.when(F.col("value") > 50, loose).otherwise(tidy).alias("text"))


def _lines(spark, sf):
    """Access-log lines of the queries; errors are requests without a query."""
    q = _queries(spark, sf)
    stamp = F.date_format(F.col("ts").cast("timestamp_ntz"), "dd/MMM/yyyy:HH:mm:ss")
    path = F.when(F.col("event_type") == "error", F.concat(F.lit("/missing/"), "event_id")).otherwise(
        F.concat(F.lit("/sparql?format=json&query="), F.url_encode("text"), F.lit("&debug=on")))
    line = F.format_string('host-%d - - [%s +0000] "GET %s HTTP/1.1" 200 %d "-" "agent \\"x\\""',
                           F.col("user_id"), stamp, path, F.col("event_id"))
    return q.select("event_id", line.alias("value"))


def _log(spark, sf):
    return parse_query_log(_lines(spark, sf), "apache")


@query("s5_log", f"""
SELECT 'host-' || user_id AS host, epoch(date_trunc('second', ts))::BIGINT AS seconds,
  CASE WHEN event_type <> 'error' THEN sha256({_TEXT}) END AS query_hash FROM events
""")
def s5_log(spark, sf):
    path = scratch_path(spark, "log")
    _lines(spark, sf).select("value").write.text(path)
    log = read_query_log(spark, path, "apache", with_seq=False)
    return log.select("host", F.unix_seconds("ts").alias("seconds"), "query_hash")


@query("s5_query_list", f"""
SELECT sha256({_TEXT}) AS query_hash, row_number() OVER (ORDER BY event_id) - 1 AS seq FROM events
""")
def s5_query_list(spark, sf):
    """One query per line, in files that follow each other; their lines are numbered as one list."""
    path = scratch_path(spark, "list")
    _queries(spark, sf).repartitionByRange("event_id").sortWithinPartitions("event_id").select(
        F.col("tidy").alias("value")).write.text(path)
    log = list_position(read_query_log(spark, path, "sparql"))
    return log.select("query_hash", F.col("position").alias("seq"))


@query("s5_rdf_log", f"""
SELECT 'host-' || user_id AS host, epoch(date_trunc('second', ts))::BIGINT AS seconds, sha256({_TEXT}) AS query_hash,
  'SELECT' AS form, true AS uses_filter, run_id::INTEGER AS run_id
FROM events, range(-1, 1) AS r(run_id) WHERE event_type <> 'error'
""")
def s5_rdf_log(spark, sf):
    """A log as quads, written, read back as a log, and planned as a benchmark."""
    path, quads = scratch_path(spark, "log"), scratch_path(spark, "log-quads") + "/log.nq.gz"
    _lines(spark, sf).select("value").write.text(path)
    log = querylog.enrich(read_query_log(spark, path, "apache"), ["form", "features"])
    write_rdf(querylog.rdfize_log(log, EX + "log/"), quads)
    plan = benchplan.run_plan(querylog.read_rdf_log(spark, quads), 1, 1)
    return plan.select("host", F.unix_seconds("ts").alias("seconds"), "query_hash", "form", "uses_filter", "run_id")


@query("r2_query_id", f"SELECT event_id, sha256({_TEXT}) AS query_hash FROM events")
def r2_query_id(spark, sf):
    return _queries(spark, sf).select("event_id", query_id(F.col("text")).alias("query_hash"))


_LOGGED = f"""
WITH q AS (SELECT *, {_TEXT} AS text FROM events WHERE event_type <> 'error'),
h AS (SELECT *, 'http://example.org/log/query-' || sha256(text) AS g FROM q)
"""


@query("r1_rdfize_log", f"""{_LOGGED}
SELECT 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type' AS p, g, 'http://example.org/log#Query' AS o FROM h
UNION ALL SELECT 'http://www.w3.org/1999/02/22-rdf-syntax-ns#type', g, 'http://example.org/log#Entry' FROM h
UNION ALL SELECT 'http://example.org/log#hash', g, sha256(text) FROM h
UNION ALL SELECT 'http://example.org/log#host', g, 'host-' || user_id FROM h
UNION ALL SELECT 'http://example.org/log#time', g, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') FROM h
""")
def r1_rdfize_log(spark, sf):
    quads = querylog.rdfize_log(_log(spark, sf), EX + "log/")
    entry, text = querylog.LOG + "entry", querylog.LOG + "text"
    # Entry nodes hash the raw line and texts keep their spacing: see r1_entries and r1_texts.
    return quads.filter(~F.col("p").isin(entry, text)).select("p", "g", "o")


@query("r1_entries", f"""{_LOGGED}
SELECT g, count(*) AS entries FROM h GROUP BY g
""")
def r1_entries(spark, sf):
    quads = querylog.rdfize_log(_log(spark, sf), EX + "log/")
    entries = quads.filter(F.col("p") == querylog.LOG + "entry")
    return entries.groupBy("g").agg(F.count_distinct("o").alias("entries"))


@query("r1_repeated_lines", """
SELECT 'host-' || user_id AS host, 2 * count(*) AS entries FROM events GROUP BY user_id
""")
def r1_repeated_lines(spark, sf):
    """Every line is in the log twice; equal lines of a file are entries of their own."""
    events = spread_table(spark, sf, "events", "event_id")
    line = F.concat(F.lit("host-"), "user_id", F.lit(' - - [01/Jan/2024:10:00:00 +0000] "GET /sparql?query=ASK+%7B%7D HTTP/1.1" 200 5'))
    path = scratch_path(spark, "log")
    events.select(F.explode(F.array(line, line)).alias("value")).write.text(path)
    quads = querylog.rdfize_log(read_query_log(spark, path, "apache"), EX + "log/")
    return quads.filter(F.col("p") == querylog.LOG + "host").groupBy(F.col("o").alias("host")).agg(
        F.count_distinct("s").alias("entries"))


@query("r1_texts", f"""{_LOGGED}
SELECT g, text FROM h
""")
def r1_texts(spark, sf):
    """The text of each entry's query, with its spacing collapsed."""
    quads = querylog.rdfize_log(_log(spark, sf), EX + "log/")
    texts = quads.filter(F.col("p") == querylog.LOG + "text")
    return texts.select("g", normalize_query(F.col("o")).alias("text"))


@query("r2_comments", """
SELECT event_id, true AS comment_ignored, false AS next_line_ignored, false AS spaces_ignored FROM events
""")
def r2_comments(spark, sf):
    """A comment ends with its line; an apostrophe in an IRI begins no string."""
    number = F.col("event_id").cast("string")

    def text(*parts):
        return query_id(F.concat(*(p if not isinstance(p, str) else F.lit(p) for p in parts)))

    plain = text("ASK { ?s <http://x/it's#a> ?o . FILTER(?o > ", number, ") }")
    noted = text("ASK {  ?s <http://x/it's#a>   ?o . # it's a note\n FILTER(?o > ", number, ") }")
    swallowed = text("ASK { ?s <http://x/it's#a> ?o . # it's a note FILTER(?o > ", number, ") }\n}")
    spaced = text("ASK { ?s <http://x/it's#a> ?o . FILTER(?o > '", number, "  ') }")
    closer = text("ASK { ?s <http://x/it's#a> ?o . FILTER(?o > '", number, " ') }")
    return table(spark, sf, "events").select(
        "event_id", (plain == noted).alias("comment_ignored"), (plain == swallowed).alias("next_line_ignored"),
        (spaced == closer).alias("spaces_ignored"))


@query("r3_names", """
SELECT event_id, 'ASK' AS form, false AS uses_limit, false AS uses_union, value > 250 AS uses_filter FROM events
""")
def r3_names(spark, sf):
    """Variables, prefixed names and strings that look like keywords."""
    filters = F.when(F.col("value") > 250, F.lit("FILTER(?limit > 1)")).otherwise(F.lit("# FILTER(?limit > 1)\n"))
    text = F.concat(F.lit("ASK { ?limit ex:union \'\'\'it's a FILTER\'\'\' ; union:x $select . "), filters, F.lit("}"))
    log = table(spark, sf, "events").select("event_id", "value", text.alias("query"))
    return querylog.enrich(log, ["form", "features"]).select("event_id", "form", "uses_limit", "uses_union", "uses_filter")


@query("r3_enrich", f"""
SELECT event_id, 'SELECT' AS form, true AS uses_filter, false AS uses_optional, false AS uses_union,
  false AS uses_distinct, false AS uses_limit, false AS uses_aggregate FROM events WHERE value <= 250
UNION ALL SELECT event_id, 'CONSTRUCT', false, true, true, true, true, true FROM events WHERE value > 250
""")
def r3_enrich(spark, sf):
    """Keywords inside strings, IRIs and comments do not count."""
    q = _queries(spark, sf)
    rich = F.concat(
        F.lit("# SELECT filter\nCONSTRUCT { ?x <http://example.org/filter> ?n } WHERE { SELECT DISTINCT ?x (count(*) AS ?n) "
              '{ { ?x ?p "a filter" } UNION { ?x ?q '), F.col("k"), F.lit(" } optional { ?x ?r ?s } } LIMIT 10 }"))
    log = q.select("event_id", F.when(F.col("value") > 250, rich).otherwise(F.col("text")).alias("query"))
    return querylog.enrich(log, ["features", "form"]).drop("query")


@query("r4_query_only", f"""{_LOGGED}
SELECT p, count(*) AS n FROM h, (VALUES ('http://example.org/log#entry'), ('http://example.org/log#hash'),
  ('http://example.org/log#text'), ('http://www.w3.org/1999/02/22-rdf-syntax-ns#type'),
  ('http://www.w3.org/1999/02/22-rdf-syntax-ns#type')) AS v(p) GROUP BY p
""")
def r4_query_only(spark, sf):
    quads = querylog.rdfize_log(querylog.query_only(_log(spark, sf)), EX + "log/")
    return quads.groupBy("p").agg(F.count(F.lit(1)).alias("n"))


@query("r5_merge_graphs", f"""{_LOGGED}
SELECT true AS merged, count(DISTINCT g) AS n FROM h UNION ALL SELECT false, count(*) FROM h
""")
def r5_merge_graphs(spark, sf):
    """Hash triples of the query graphs, with and without merging equal graphs."""
    quads = querylog.rdfize_log(_log(spark, sf), EX + "log/").filter(F.col("p") == querylog.LOG + "hash")
    parts = [
        querylog.merge_graphs(quads, merge).agg(F.count(F.lit(1)).alias("n")).select(F.lit(merge).alias("merged"), "n")
        for merge in (True, False)]
    return parts[0].unionByName(parts[1])


@query("r6_hash_host", "SELECT event_id, sha256('pepper' || 'host-' || user_id) AS host FROM events")
def r6_hash_host(spark, sf):
    return querylog.hash_host(_log(spark, sf), "pepper").select("event_id", "host")


# --- B ------------------------------------------------------------------------------------

@query("b1_run_plan", "SELECT run_id::INTEGER AS run_id, item_id FROM benchmark, range(-2, 2) AS r(run_id)")
def b1_run_plan(spark, sf):
    queries = table(spark, sf, "benchmark").select("item_id")
    return benchplan.run_plan(queries, 2, 2)


_LIMITED = """
WITH q AS (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS seq FROM benchmark)
SELECT run_id::INTEGER AS run_id, item_id FROM q, range(-2, 2) AS r(run_id) WHERE run_id >= 0 OR seq < 5
"""


@query("b2_limit_warmup", _LIMITED)
def b2_limit_warmup(spark, sf):
    queries = benchplan.with_position(table(spark, sf, "benchmark").select("item_id"), 5, "item_id")
    plan = benchplan.limit_warmup(benchplan.run_plan(queries, 2, 2), 5)
    return plan.select("run_id", "item_id")


@query("b3_gate_warmup", "SELECT run_id::INTEGER AS run_id, md5(text) AS text_md5 FROM benchmark, range(0, 3) AS r(run_id)")
def b3_gate_warmup(spark, sf):
    queries = table(spark, sf, "benchmark").select(F.md5("text").alias("text_md5"))
    return benchplan.gate_warmup(benchplan.run_plan(queries, 1, 3), warmup_log=False).select("run_id", "text_md5")


@query("b4_run_metadata", """
WITH x AS (SELECT DISTINCT 'http://example.org/data/' || source AS id, 'http://example.org/endpoint/' || lang AS url
  FROM documents),
c AS (SELECT *, 'http://example.org/exp/config-' || sha256(concat_ws(chr(1), id, url, 'http://example.org/exp/')) AS config FROM x),
e AS (SELECT *, 'http://example.org/exp/exec-' || sha256(concat_ws(chr(1), config, '2024-01-01T00:00:00Z')) AS exec FROM c),
r AS (SELECT *, 'http://example.org/exp/run-' || sha256(concat_ws(chr(1), exec, run_id::VARCHAR)) AS run
  FROM e, range(-1, 2) AS v(run_id)),
t AS (
  SELECT config AS s, 'identifier' AS p, id AS o FROM c
  UNION ALL SELECT config, 'label', replace(replace(id, 'http://', ''), '/', '-') FROM c
  UNION ALL SELECT config, 'service', url FROM c UNION ALL SELECT config, 'baseIri', 'http://example.org/exp/' FROM c
  UNION ALL SELECT config, 'type', 'http://example.org/experiment#Config' FROM c
  UNION ALL SELECT exec, 'type', 'http://example.org/experiment#Execution' FROM e
  UNION ALL SELECT exec, 'config', config FROM e UNION ALL SELECT exec, 'timestamp', '2024-01-01T00:00:00Z' FROM e
  UNION ALL SELECT run, 'type', 'http://example.org/experiment#Run' FROM r
  UNION ALL SELECT run, 'exec', exec FROM r UNION ALL SELECT run, 'runId', run_id::VARCHAR FROM r
  UNION ALL SELECT run, 'timestamp', '2024-01-01T00:00:00Z' FROM r)
SELECT s, p, o, s AS g FROM t
""")
def b4_run_metadata(spark, sf):
    """An experiment per data source and language, with one warm-up and two measured runs."""
    experiments = table(spark, sf, "documents").select(
        F.concat(F.lit(EX + "data/"), "source").alias("dataset_id"),
        F.concat(F.lit(EX + "endpoint/"), "lang").alias("service_url")).distinct()
    plan = benchplan.run_plan(experiments, 1, 2)
    quads = benchplan.run_metadata(plan, EX + "exp/", F.lit("2024-01-01T00:00:00Z"))
    local = F.regexp_extract("p", "([^/#]+)$", 1)
    return natural_graph(quads).select("s", local.alias("p"), "o", "g")
