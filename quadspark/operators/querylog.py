"""Query-log records to quads, and record enrichment."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadspark.functions.terms import (
    IRI,
    LITERAL,
    QUAD_COLUMNS,
    RDF_TYPE,
    XSD_BOOLEAN,
    XSD_DATETIME,
    XSD_INTEGER,
    XSD_STRING,
    null,
)
from quadspark.sources.querylog import MARK, UNITS
from quadspark.sources.rdf import read_rdf_lines
from quadspark.sources.storage import stored_table

# Our vocabulary for log records.
LOG = "http://example.org/log#"

Enricher = Callable[[DataFrame], DataFrame]


# --- R3: enrichers --------------------------------------------------------------

# Comments, besides IRIs and strings: none of them holds keywords.
_OPAQUE = rf"(?s){MARK}(?:{UNITS}|#[^\r\n]*+)"
FEATURES = ("filter", "optional", "union", "distinct", "limit", "aggregate")
_AGGREGATES = ("COUNT", "SUM", "AVG", "MIN", "MAX", "SAMPLE", "GROUP_CONCAT")
FORMS = ("SELECT", "CONSTRUCT", "ASK", "DESCRIBE")


def _keyword(*words: str) -> str:
    """One of the words, in any case, as a group.

    Names are no keywords: variables, and both parts of prefixed names.  What
    stands before a word is looked at last, where the word is found; only
    characters that begin a word are looked at further.
    """
    begins = "".join(sorted({w[0] for w in words}))
    return rf"(?i)(?=[{begins}])({'|'.join(rf'{w}(?<![\w?$:\-]{w})' for w in words)})"


_AFTER = r"(?![\w:\-])"


def _bare(query: str = "query") -> Column:
    return F.regexp_replace(F.col(query), _OPAQUE, " ")


def query_features(log: DataFrame) -> DataFrame:
    """Flags for the constructs a query uses."""
    stripped = log.withColumn("__bare", _bare())
    for name in FEATURES:
        pattern = _keyword(*_AGGREGATES) + r"\s*\(" if name == "aggregate" else _keyword(name) + _AFTER
        stripped = stripped.withColumn(f"uses_{name}", F.col("__bare").rlike(pattern))
    return stripped.drop("__bare")


def query_form(log: DataFrame) -> DataFrame:
    """The query form, null if there is none."""
    form = F.upper(F.regexp_extract(_bare(), _keyword(*FORMS) + _AFTER, 1))
    return log.withColumn("form", F.nullif(form, F.lit("")))


ENRICHERS: dict[str, Enricher] = {"features": query_features, "form": query_form}


def enrich(log: DataFrame, names: Sequence[str] = (), registry: dict[str, Enricher] | None = None) -> DataFrame:
    """Apply named record transforms in order; none by default."""
    known = {**ENRICHERS, **(registry or {})}
    for name in names:
        if name not in known:
            raise KeyError(f"no enricher {name}; known: {sorted(known)}")
        log = log.transform(known[name])
    return log


# --- R4, R6: record shape ----------------------------------------------------------

def query_only(log: DataFrame) -> DataFrame:
    """Records without the trace of a remote execution."""
    return log.drop("host", "ts")


def hash_host(log: DataFrame, salt: str) -> DataFrame:
    """Replace the client by a salted hash."""
    return log.withColumn("host", F.sha2(F.concat(F.lit(salt), F.col("host")), 256))


# --- R1, R5: records to quads ---------------------------------------------------------

def rdfize_log(log: DataFrame, base_iri: str) -> DataFrame:
    """One record per log entry as quads; the graph is the query.

    An entry is identified by its file and line number, or by its raw line where
    it has no number.  Host and time are written only if the log has these
    columns; enricher columns (``uses_*``, ``form``) become properties of the query.
    """
    columns = set(log.columns)
    query = F.concat(F.lit(base_iri + "query-"), F.col("query_hash"))
    numbers = [F.concat(F.lit("#"), F.col("seq").cast("string"))] if "seq" in columns else []
    lines = [F.col("raw")] if "raw" in columns else []
    identity = [F.col("source")] if "source" in columns else []
    identity += [F.coalesce(*numbers, *lines)] if numbers or lines else []
    entry = F.concat(F.lit(base_iri + "entry-"), F.sha2(
        F.concat_ws("\u0001", *(F.coalesce(c, F.lit("")) for c in identity)), 256))
    base = log.withColumns({"__query": query, "__entry": entry})
    structs = []

    def add(s: str, p: str, o: Column, kind: str = LITERAL, dt: str | None = XSD_STRING):
        structs.append(F.struct(
            F.col(s).alias("s"), F.lit(p).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"),
            (F.lit(dt) if kind == LITERAL else null()).alias("o_dt")))

    add("__query", RDF_TYPE, F.lit(LOG + "Query"), IRI)
    add("__query", LOG + "text", F.col("query"))
    add("__query", LOG + "hash", F.col("query_hash"))
    for c in log.columns:
        if c.startswith("uses_"):
            add("__query", LOG + c, F.col(c).cast("string"), LITERAL, XSD_BOOLEAN)
    if "form" in columns:
        add("__query", LOG + "form", F.col("form"))
    add("__query", LOG + "entry", F.col("__entry"), IRI)
    add("__entry", RDF_TYPE, F.lit(LOG + "Entry"), IRI)
    if "source" in columns:
        add("__entry", LOG + "source", F.col("source"))
    if "seq" in columns:
        add("__entry", LOG + "position", F.col("seq").cast("string"), LITERAL, XSD_INTEGER)
    if "host" in columns:
        add("__entry", LOG + "host", F.col("host"))
    if "ts" in columns:
        add("__entry", LOG + "time", F.date_format(
            F.convert_timezone(None, F.lit("UTC"), F.to_timestamp_ntz(F.col("ts"))), "yyyy-MM-dd'T'HH:mm:ss'Z'"),
            LITERAL, XSD_DATETIME)
    rows = F.when(F.col("query").isNotNull(), F.array(*structs))
    quads = base.select("__query", F.inline(rows)).filter(F.col("o").isNotNull())
    return quads.select(
        "s", F.lit(IRI).alias("s_kind"), "p", "o", "o_kind", "o_dt", null().alias("o_lang"),
        F.col("__query").alias("g")).select(*QUAD_COLUMNS)


def log_of_quads(quads: DataFrame) -> DataFrame:
    """Log records from what ``rdfize_log`` makes: one for each entry, with its query.

    Properties that are missing are null; flags and form appear where a query
    has them.  Quads may be repeated, merged, or without their graph.

    The quads are read once, and the values of each node are stored.  Only where
    an entry has several queries are its links read from the quads again.
    """
    flags = [f"uses_{name}" for name in FEATURES]
    about_query = {"query": LOG + "text", "query_hash": LOG + "hash", "form": LOG + "form", **{f: LOG + f for f in flags}}
    about_entry = {"source": LOG + "source", "seq": LOG + "position", "host": LOG + "host", "ts": LOG + "time"}
    entry = LOG + "entry"
    known = [entry, *about_query.values(), *about_entry.values()]

    def value(p: str) -> Column:
        return F.min(F.when(F.col("__p") == known.index(p) + 1, F.col("o")))

    # A link belongs to its entry, so that it meets the entry's values.  The hash comes first: rows are
    # sorted by their key, and IRIs begin alike.  A number for the property makes them shorter.
    link = F.col("p") == entry
    rows = quads.filter(F.col("p").isin(known)).select(
        F.when(link, F.col("o")).otherwise(F.col("s")).alias("__node"), F.when(link, F.struct("s")).alias("__link"),
        F.array_position(F.array(*map(F.lit, known)), F.col("p")).alias("__p"), F.when(~link, F.col("o")).alias("o"))
    nodes = rows.groupBy(F.xxhash64("__node").alias("__hash"), "__node").agg(
        F.min("__link").alias("__first"), F.max("__link").alias("__last"),
        *(F.when(F.col("__node").isNotNull(), value(p)).alias(name) for name, p in about_entry.items()),
        *(value(p).alias(name) for name, p in about_query.items()))
    # The names of entries are not needed any more, but to find further links.
    one, described = F.col("__first") == F.col("__last"), F.coalesce(*(F.col(name) for name in about_query)).isNotNull()
    stored, _ = stored_table(
        nodes.withColumn("__node", F.when(described | ~one, F.col("__node"))).drop("__hash"), "log-nodes")
    found = stored.filter(one).select(F.col("__first.s").alias("__query"), *about_entry)
    several = stored.filter(~one).select("__node", *about_entry)
    if not several.isEmpty():
        links = quads.filter(link).select(F.col("s").alias("__query"), F.col("o").alias("__entry")).distinct()
        more = links.join(several, F.col("__entry").eqNullSafe(F.col("__node"))).select("__query", *about_entry)
        found = found.unionByName(more)
    queries = stored.filter(described).select(F.col("__node").alias("__query"), *about_query)
    found = found.join(queries, "__query", "left")
    return found.select(
        "source", F.col("seq").cast("bigint").alias("seq"), null().alias("raw"), "host",
        F.to_timestamp("ts").alias("ts"), "query", "query_hash", "form", *(F.col(f).cast("boolean").alias(f) for f in flags))


def read_rdf_log(spark: SparkSession, paths: str | Sequence[str], on_reject: str = "fail") -> DataFrame:
    """Log records from N-Triples or N-Quads files that hold a log as quads."""
    return log_of_quads(read_rdf_lines(spark, paths, on_reject))


def merge_graphs(quads: DataFrame, merge: bool = False) -> DataFrame:
    """Keep one set of quads per log entry, or merge equal graphs into one set."""
    return quads.dropDuplicates() if merge else quads
