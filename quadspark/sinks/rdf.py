"""Write quads as text lines, graph blocks or a Parquet table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadspark.functions.terms import IRI, LANG_STRING, LITERAL, QUAD_COLUMNS, XSD_STRING, as_quads
from quadspark.operators.patterns import predicate_key
from quadspark.sources.rdf import NOT_IRI
from quadspark.sources.storage import path_exists, stored_lookup

_MODES = {"ERROR": "errorifexists", "OVERWRITE": "overwrite", "SKIP": "ignore"}
_CODECS = {"gz": "gzip", "gzip": "gzip", "bz2": "bzip2", "zst": "zstd", "deflate": "deflate"}
_FORMATS = ("nt", "nq", "ttl", "trig")
DEFAULT_FORMAT = "trig"
# Characters of a graph block's lines, about: bounds the row that holds a block.
BLOCK_CHARS = 4_000_000


def writer_mode(mode: str) -> str:
    """ERROR, OVERWRITE or SKIP if the target exists."""
    if mode.upper() not in _MODES:
        raise ValueError(f"mode is one of {sorted(_MODES)}")
    return _MODES[mode.upper()]


def save(df: DataFrame, path: str, mode: str = "ERROR", fmt: str = "parquet", **options: str) -> None:
    """Write all or nothing: the committer moves task output in place at the end."""
    df.write.mode(writer_mode(mode)).options(**options).format(fmt).save(path)


def format_and_codec(
    path: str, output_format: str | None = None, output_type: str | None = None
) -> tuple[str, str | None]:
    """Format and codec: the output format first, then the output type, then the file name.

    The last codec suffix counts; Spark writes one codec per file.
    """
    named = output_format or output_type or path.rsplit("/", 1)[-1]
    parts = named.lower().split(".")
    codec = None
    for source in (parts, path.lower().rsplit("/", 1)[-1].split(".")):
        if source[-1] in _CODECS:
            codec = _CODECS[source[-1]]
            break
    fmt = next((p for p in reversed(parts) if p in _FORMATS), None)
    if fmt is None and (output_format or output_type):
        raise ValueError(f"format is one of {_FORMATS}")
    return fmt or DEFAULT_FORMAT, codec


def escape(value: Column) -> Column:
    """Escape a literal for a line; values without a special character stay untouched."""
    escaped = value
    for raw, code in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r")):
        escaped = F.replace(escaped, F.lit(raw), F.lit(code))
    return F.when(~value.rlike(r'\A[^"\\\n\r]*\z'), escaped).otherwise(value)


# Characters that an IRI cannot hold in a line, and labels that need no change.
_NOT_IRI = f"[{NOT_IRI}]"
# One run of a text is a tighter loop than a search at each of its characters.
_IRI = rf"\A[^{NOT_IRI}]*\z"
_LABEL = r"^(?!hex-)[\p{L}\p{N}_](?:[\p{L}\p{N}_\-·.]*[\p{L}\p{N}_\-·])?$"


def escape_iri(value: Column) -> Column:
    """Characters that an IRI cannot hold become numeric escapes, which every reader decodes."""
    escaped = F.array_join(F.transform(F.split(value, ""), lambda c: F.when(
        c.rlike(_NOT_IRI), F.concat(F.lit("\\u"), F.lpad(F.hex(F.ascii(c)), 4, "0"))).otherwise(c)), "")
    return F.when(~value.rlike(_IRI), escaped).otherwise(value)


def blank_label(value: Column) -> Column:
    """A label of legal characters; other labels become their bytes in hexadecimal form, so none coincide."""
    return F.when(value.rlike(_LABEL), value).otherwise(F.concat(F.lit("hex-"), F.hex(F.encode(value, "UTF-8"))))


def _resource(value: Column, kind: Column) -> Column:
    return F.when(kind == IRI, F.concat(F.lit("<"), escape_iri(value), F.lit(">"))).otherwise(
        F.concat(F.lit("_:"), blank_label(value)))


def term_line(df: DataFrame, with_graph: bool) -> Column:
    """A triple or quad as one line."""
    suffix = (
        F.when(F.col("o_lang").isNotNull() & (F.col("o_dt") == LANG_STRING), F.concat(F.lit("@"), "o_lang"))
        .when(F.col("o_dt") == XSD_STRING, F.lit(""))
        .otherwise(F.concat(F.lit("^^<"), escape_iri(F.col("o_dt")), F.lit(">")))
    )
    literal = F.concat(F.lit('"'), escape(F.col("o")), F.lit('"'), suffix)
    obj = F.when(F.col("o_kind") == LITERAL, literal).otherwise(_resource(F.col("o"), F.col("o_kind")))
    parts = [_resource(F.col("s"), F.col("s_kind")), F.concat(F.lit("<"), escape_iri(F.col("p")), F.lit(">")), obj]
    if with_graph:
        parts.append(graph_token(F.col("g")))
    return F.concat_ws(" ", *parts, F.lit("."))


def graph_token(g: Column) -> Column:
    """A graph name; blank ones are stored with their ``_:`` mark.  Null for the default graph."""
    label = F.concat(F.lit("_:"), blank_label(F.substring(g, 3, 2**31 - 1)))
    return F.when(F.startswith(g, F.lit("_:")), label).when(
        g.isNotNull(), F.concat(F.lit("<"), escape_iri(g), F.lit(">")))


def write_rdf(
    df: DataFrame, path: str, output_format: str | None = None, output_type: str | None = None, mode: str = "ERROR"
) -> None:
    """Write quads as N-Triples or N-Quads, or as graph blocks for ``trig``.

    ``ttl`` is written as its N-Triples subset; ``nt`` and ``ttl`` hold triples,
    so the graph name is dropped there.
    """
    fmt, codec = format_and_codec(path, output_format, output_type)
    if fmt == "trig":
        write_trig_blocks(df, path, mode, codec)
        return
    quads = as_quads(df)
    lines = quads.select(term_line(quads, fmt == "nq").alias("value"))
    _write_text(lines, path, mode, codec)


def _write_text(lines: DataFrame, path: str, mode: str, codec: str | None, **options: str) -> None:
    writer = lines.write.mode(writer_mode(mode)).options(**options)
    # The third level of gzip takes less than half the time of the usual sixth, for a fifth more bytes.
    level = {"zlib.compress.level": "THREE"} if codec == "gzip" else {}
    (writer.options(compression=codec, **level) if codec else writer).text(path)


def write_trig_blocks(
    df: DataFrame, path: str, mode: str = "ERROR", codec: str | None = None, block_chars: int = BLOCK_CHARS
) -> None:
    """Write one block per named graph; a graph name may head several blocks.

    Graphs beyond ``block_chars`` are cut into blocks of about that size by a
    hash of the triple, so that a graph of any size is spread over all tasks.
    Copies of a triple collapse before the shuffle.
    """
    _write_text(trig_blocks(df, block_chars), path, mode, codec, lineSep="\n}\n")


def trig_blocks(df: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    quads = as_quads(df)
    rows = quads.select("g", term_line(quads, False).alias("line"))
    sizes = rows.groupBy("g").agg(F.sum(F.length("line").cast("long")).alias("chars"))
    # Sent to the lines where it is small: shuffled by graph, the lines of one large graph would meet in a task.
    large = stored_lookup(sizes.filter(F.col("chars") > block_chars).select(
        F.col("g").alias("__g"), F.ceil(F.col("chars") / block_chars).cast("int").alias("__blocks")), "large-graphs")
    # The default graph is null and joins by null-safe equality.
    cut = rows.join(large, F.col("g").eqNullSafe(F.col("__g")), "left").select(
        "g", "line", F.coalesce(F.pmod(F.xxhash64("line"), F.col("__blocks")), F.lit(0)).alias("__block"))
    blocks = cut.groupBy("g", "__block").agg(F.sort_array(F.collect_set("line")).alias("lines"))
    head = F.concat(F.coalesce(F.concat(graph_token(F.col("g")), F.lit(" ")), F.lit("")), F.lit("{\n"))
    return blocks.select(F.concat(head, F.array_join("lines", "\n")).alias("value"))


def write_quad_table(
    df: DataFrame, path: str, mode: str = "ERROR", partition_predicates: bool = False, extra: Sequence[str] = ()
) -> None:
    """Store a graph as Parquet.

    Repeated quads are dropped.  Rows are range-partitioned and sorted by
    (predicate, subject, object), so one frequent predicate or subject spreads
    over many files and the column statistics let a scan skip files.
    ``partition_predicates`` also gives each predicate its folder; use it when
    there are few of them.  ``extra`` names further columns to keep.
    """
    quads = (df.select(*QUAD_COLUMNS, *extra) if extra else as_quads(df)).dropDuplicates().withColumn("p_key", predicate_key(F.col("p")))
    order = ["p", "s", "o", "g"]
    stored = quads.repartitionByRange(*order).sortWithinPartitions("p_key" if partition_predicates else "p", *order)
    writer = stored.write.mode(writer_mode(mode))
    (writer.partitionBy("p_key") if partition_predicates else writer).parquet(path)


def read_quad_table(spark: SparkSession, path: str, batches: bool = False) -> DataFrame:
    """A stored graph.  ``p_key`` stays visible: ``match`` filters on it to prune files.

    ``batches`` adds the batch number of a table that was loaded by a stream.
    """
    columns = [*QUAD_COLUMNS, "p_key"]
    schema = ", ".join(f"{c} string" for c in columns)
    if batches:
        columns, schema = [*columns, "batch"], schema + ", batch bigint"
    # Spark adds the folders of the parts as columns; they are not part of the graph.
    return spark.read.schema(schema).parquet(path).select(*columns)


def publish_if_changed(spark: SparkSession, df: DataFrame, path: str, changed: bool, fmt: str = "parquet") -> bool:
    """Rewrite the published copy if something was loaded or it is missing; tells whether it did."""
    if not changed and path_exists(spark, path):
        return False
    save(df, path, "OVERWRITE", fmt)
    return True
