"""N-Triples and N-Quads lines to quads, without leaving the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadspark.functions.terms import BNODE, IRI, LANG_STRING, LITERAL, QUAD_COLUMNS, XSD_STRING, null

# Line grammar.  Repetitions are possessive: they neither backtrack nor recurse,
# so a literal of any length is matched in one pass.  A greedy run in a possessive
# or atomic group is a tight loop in Java, and a class whose characters are all
# named is one lookup; possessive runs and ranges take several times as long.
_UCHAR = r"\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}"
# Characters that an IRI cannot hold: those up to the space, and marks.
NOT_IRI = "".join(rf"\x{i:02x}" for i in range(0x21)) + r'<>"{}|^`\\'
_IRI_BODY = rf"(?:[^{NOT_IRI}]+|{_UCHAR})++"
_BLANK = r"[\p{L}\p{N}_](?:[\p{L}\p{N}_\-·]|\.(?=[\p{L}\p{N}_.\-]))*+"
_STRING = r'(?>[^"\\\r\n]*)(?:\\[^\r\n](?>[^"\\\r\n]*))*+'
_WS = r"[ \t]*+"
_LINE = (
    rf"(?s)^{_WS}(?:<({_IRI_BODY})>|_:({_BLANK})){_WS}<({_IRI_BODY})>{_WS}"
    rf'(?:<({_IRI_BODY})>|_:({_BLANK})|"({_STRING})"(?:\^\^<({_IRI_BODY})>|@([A-Za-z]++(?:-[A-Za-z0-9]++)*+))?){_WS}'
    rf"(?:<({_IRI_BODY})>|_:({_BLANK}))?{_WS}\.{_WS}(?:#.*)?\z"
)
_GROUPS = 10
# A line holds no line feed, so it can separate the groups.
# Code points beyond the basic plane, as eight digits.
_ASTRAL = r"^00(?:0[1-9A-Fa-f]|10)[0-9A-Fa-f]{4}"
_SPLIT = "\n".join(f"${i}" for i in range(1, _GROUPS + 1))


def unescape(value: Column) -> Column:
    """Decode string escapes; only values that hold a backslash are touched.

    The escapes are those of JSON, apart from ``\\'`` and the eight-digit form.
    An escaped backslash is set aside as a line feed while the latter is decoded.
    """
    aside = F.replace(value, F.lit("\\\\"), F.lit("\n"))
    short = F.regexp_replace(aside, r"\\U0000([0-9A-Fa-f]{4})", r"\\u$1")
    pieces = F.split(short, r"\\U")
    decoded = F.transform(
        pieces,
        lambda x, i: F.when(i == 0, x).when(
            x.rlike(_ASTRAL),
            F.concat(F.decode(F.unhex(F.substring(x, 1, 8)), "UTF-32"), F.substring(x, 9, 2**31 - 1))),
    )
    legal = ~short.rlike(rf"\\U(?!{_ASTRAL[1:]})")
    wide = F.when(legal, F.replace(F.array_join(decoded, ""), F.lit("\n"), F.lit("\\\\")))
    narrow = F.when(F.contains(value, F.lit("\\U")), wide).otherwise(value)
    options = {"allowBackslashEscapingAnyCharacter": "true", "allowUnquotedControlChars": "true"}
    parsed = F.from_json(F.concat(F.lit('["'), narrow, F.lit('"]')), "array<string>", options)
    return F.when(F.contains(value, F.lit("\\")), parsed.getItem(0)).otherwise(value)


def parse_rdf_lines(lines: DataFrame, line: str = "value", scope: Column | None = None) -> DataFrame:
    """Parse a column of N-Triples / N-Quads lines.

    Returns the quad columns and ``reject``: the raw line if it is malformed,
    else null.  Comments and blank lines give no row.  ``scope`` is put into
    blank-node labels, which are local to their file; it may use the other columns.
    """
    kept = lines.filter(~F.col(line).rlike(r"^[ \t]*+(?:#.*)?$"))
    parts = F.split(F.regexp_replace(F.col(line), _LINE, _SPLIT), "\n", -1)
    # Only lines with a backslash are decoded; labels and tags hold none.
    decoded = F.when(F.contains(F.col(line), F.lit("\\")), F.transform("__p", unescape)).otherwise(F.col("__p"))
    # The decoded groups leave through a generator: a filter on the result stays
    # above it.  Pushed below, it would match and decode every line once more.
    parsed = kept.withColumn("__p", parts).withColumn("__p", decoded).withColumn("__p", F.explode(F.array("__p")))
    group = [F.get(F.col("__p"), F.lit(i)) for i in range(_GROUPS)]
    s_iri, s_blank, p, o_iri, o_blank, text, dt, lang, g_iri, g_blank = group
    ok = F.size("__p") == _GROUPS
    if scope is not None:
        # Made once for a line, and only for lines with a blank node.
        blank = (s_blank != "") | (o_blank != "") | (g_blank != "")
        parsed = parsed.withColumn("__label", F.when(blank, scope))

    def label(value: Column) -> Column:
        return value if scope is None else F.concat(F.col("__label"), F.lit("-"), value)

    def pick(iri: Column, blank: Column, otherwise: Column) -> Column:
        return F.when(iri != "", iri).when(blank != "", label(blank)).otherwise(otherwise)

    is_literal = (o_iri == "") & (o_blank == "")
    value = pick(o_iri, o_blank, text)
    # An undecodable escape (a code point out of range) makes the line malformed.
    good = ok
    for part in (s_iri, p, o_iri, text, dt, g_iri):
        good = good & part.isNotNull()
    columns = {
        "s": pick(s_iri, s_blank, null()),
        "s_kind": F.when(s_iri != "", IRI).otherwise(BNODE),
        "p": p,
        "o": value,
        "o_kind": F.when(o_iri != "", IRI).when(o_blank != "", BNODE).otherwise(LITERAL),
        "o_dt": F.when(is_literal, F.when(dt != "", dt).when(lang != "", LANG_STRING).otherwise(XSD_STRING)),
        "o_lang": F.when(is_literal & (lang != ""), F.lower(lang)),
        "g": pick(g_iri, F.lit(""), F.when(g_blank != "", F.concat(F.lit("_:"), label(g_blank)))),
    }
    others = [c for c in lines.columns if c != line]
    return parsed.select(
        *others, *(F.when(good, c).alias(name) for name, c in columns.items()),
        F.when(~good, F.col(line)).alias("reject"))


def dataset_scope(path: Column | None = None) -> Column:
    """What blank-node labels are local to: the file, or the folder that a Spark job has written it to."""
    path = F.col("_metadata.file_path") if path is None else path
    return F.substring(F.sha2(F.regexp_replace(path, r"/part-\d{5}-[^/]*$", ""), 256), 1, 12)


def accepted(parsed: DataFrame, on_reject: str = "fail", source: str = "source") -> DataFrame:
    """Parsed rows without malformed lines: these end the job (``fail``) or are left out (``skip``).

    Who skips them reads them with ``read_rdf_rejects``.
    """
    good = F.col("reject").isNull()
    if on_reject == "fail":
        told = F.concat(F.lit("malformed line in "), F.col(source), F.lit(": "), F.left("reject", F.lit(200)))
        good = F.when(good, F.lit(True)).otherwise(F.raise_error(told).cast("boolean"))
    elif on_reject != "skip":
        raise ValueError("on_reject is 'fail' or 'skip'")
    return parsed.filter(good)


def scan_rdf_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Quads, rejects and the file of each line; the parts below select from it.

    Plain and bz2 files are split among tasks; a gz file is one task.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("source"))
    return parse_rdf_lines(lines, scope=dataset_scope(F.col("source")))


def read_rdf_lines(spark: SparkSession, paths: str | Sequence[str], on_reject: str = "fail") -> DataFrame:
    """Quads of N-Triples / N-Quads files, plain, ``.gz`` or ``.bz2``."""
    return accepted(scan_rdf_lines(spark, paths), on_reject).select(*QUAD_COLUMNS)


def read_rdf_rejects(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Malformed lines with their file."""
    return scan_rdf_lines(spark, paths).filter(F.col("reject").isNotNull()).select("source", "reject")


def scan_trig_blocks(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Quads, rejects and the file of each line of graph blocks.

    One row per block, so a block has to fit into a task; the writer bounds it.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    blocks = spark.read.option("lineSep", "\n}\n").text(paths)
    header = r"^\s*(?:GRAPH )?(?:<([^>]*)> |(_:\S+) )?\{"
    rows = blocks.select(
        F.regexp_extract("value", header, 1).alias("gi"),
        F.regexp_extract("value", header, 2).alias("gb"),
        F.col("_metadata.file_path").alias("source"), dataset_scope().alias("__scope"),
        F.explode(F.split(F.regexp_replace("value", header, ""), "\n")).alias("line"),
    )
    parsed = parse_rdf_lines(rows, "line", F.col("__scope"))
    label = F.concat(F.lit("_:"), F.col("__scope"), F.lit("-"), F.substring("gb", 3, 2**31 - 1))
    graph = F.when(F.col("gi") != "", unescape(F.col("gi"))).when(F.col("gb") != "", label)
    return parsed.withColumn("g", F.when(F.col("reject").isNull(), graph)).select("source", *QUAD_COLUMNS, "reject")


def read_trig_blocks(spark: SparkSession, paths: str | Sequence[str], on_reject: str = "fail") -> DataFrame:
    """Quads from the block layout of ``sinks.rdf.write_trig_blocks``."""
    return accepted(scan_trig_blocks(spark, paths), on_reject).select(*QUAD_COLUMNS)
