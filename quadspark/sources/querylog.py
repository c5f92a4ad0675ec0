"""Query logs to records ``(source, seq, raw, host, ts, query, query_hash)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quadspark.functions.terms import null
from quadspark.sources.storage import stored_lookup

# Common and combined web-server log lines; the second server format named for
# these logs writes the same line shape.
_ACCESS_LINE = (
    r'(?s)^(\S++) \S++ \S++ \[([^\]]++)\] "[A-Z]++ ([^" ]++)[^"]*+" (\d{3}) \S++.*\z'
)
_ACCESS_TIME = "dd/MMM/yyyy:HH:mm:ss Z"
_QUERY_PARAM = r"[?&]query=([^&#\s]*+)"
LOG_FORMATS = ("apache", "virtuoso", "sparql")


# Units that may hold white space or marks: IRIs and strings.
_STRINGS = (
    r'''"""(?:[^"\\]|\\.|"(?!""))*+"""'''
    r"|'''(?:[^'\\]|\\.|'(?!''))*+'''"
    r'|"[^"\\\n]*+(?:\\.[^"\\\n]*+)*+"'
    r"|'[^'\\\n]*+(?:\\.[^'\\\n]*+)*+'"
)
UNITS = rf"<[^<>\s\"{{}}|^`]*+>|{_STRINGS}"
# A run of non-space characters in which units count as one.
_RUN = rf"""((?:[^\s"'<]+|{UNITS}|["'<])++)\s*+"""
# What a unit or a comment begins with: other characters are passed over by one test.
MARK = r"""(?=[<"'#])"""


def normalize_query(query: Column) -> Column:
    """Drop comments, trim, and collapse white space outside strings to one space."""
    bare = F.regexp_replace(query, rf"(?s){MARK}(?:({UNITS})|#[^\r\n]*+)", "$1")
    return F.rtrim(F.regexp_replace(F.ltrim(F.regexp_replace(bare, r"^\s+", "")), r"(?s)\s*+" + _RUN, "$1 "))


def query_id(query: Column) -> Column:
    """Stable id of a query text; variables are not renamed."""
    return F.sha2(normalize_query(query), 256)


def parse_query_log(lines: DataFrame, log_format: str, line: str = "value") -> DataFrame:
    """Parse a column of log lines; other columns are kept.

    Lines without a query (other requests, malformed lines) have a null
    ``query``; ``queries_only`` drops them.
    """
    others = [c for c in lines.columns if c != line]
    raw = F.col(line)
    if log_format == "sparql":
        text = F.when(F.trim(raw) != "", raw)
        parsed = lines.select(
            *others, raw.alias("raw"), null().alias("host"), F.lit(None).cast("timestamp").alias("ts"),
            text.alias("query"))
    elif log_format in LOG_FORMATS:
        # One pass of the line pattern; a line has no line feed, so it separates the groups.
        fields = F.split(F.regexp_replace(raw, _ACCESS_LINE, "$1\n$2\n$3\n$4"), "\n", -1)
        # The groups leave through a generator: a filter on the result stays
        # above it.  Pushed below, it would match every line once more.
        split = lines.select(*others, raw.alias("raw"), F.explode(F.array(fields)).alias("__f"))
        ok = F.size("__f") == 4
        encoded = F.nullif(F.regexp_extract(F.get("__f", F.lit(2)), _QUERY_PARAM, 1), F.lit(""))
        parsed = split.select(
            *others, "raw", F.when(ok, F.get("__f", F.lit(0))).alias("host"),
            F.when(ok, F.try_to_timestamp(F.get("__f", F.lit(1)), F.lit(_ACCESS_TIME))).alias("ts"),
            F.when(ok, F.try_url_decode(encoded)).alias("query"))
    else:
        raise ValueError(f"log format is one of {LOG_FORMATS}")
    return parsed.select("*", query_id(F.col("query")).alias("query_hash"))


def queries_only(log: DataFrame) -> DataFrame:
    return log.filter(F.col("query").isNotNull())


def read_query_log(
    spark: SparkSession, paths: str | Sequence[str], log_format: str, with_seq: bool = True
) -> DataFrame:
    """Log records of files.  ``seq`` is the line number in the file, from 0.

    It tells equal lines apart, and does not depend on how files are split.
    Numbering costs a pass that counts the lines per split; without it ``seq``
    is null.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("source"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__row"),
        "value",
    )
    numbered = _number(lines) if with_seq else lines.withColumn("seq", F.lit(None).cast("bigint"))
    log = parse_query_log(numbered.drop("__block", "__row"), log_format)
    return log.select("source", "seq", "raw", "host", "ts", "query", "query_hash")


def _number(lines: DataFrame) -> DataFrame:
    """Line numbers from the position in a split plus the lines of earlier splits.

    The rows of a split are consecutive in one task, so the row id relative to
    the split's first one is the position; only one row per split is ordered.
    The files are read twice.  Should they be split differently the second time
    (the cluster was resized), the query fails instead of numbering wrongly.
    """
    splits = lines.groupBy("source", "__block").agg(
        F.min("__row").alias("__first"), F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(
        Window.partitionBy("source").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1))
    offsets = stored_lookup(splits.select(
        F.col("source").alias("__src"), F.col("__block").alias("__blk"), "__first",
        F.coalesce(before, F.lit(0)).alias("__before")), "splits")
    joined = lines.join(
        offsets, (F.col("source") == F.col("__src")) & (F.col("__block") == F.col("__blk")), "left")
    # The upper bits of a row id are those of its task.
    same_task = F.shiftright("__row", 33) == F.shiftright("__first", 33)
    seq = F.when(same_task & (F.col("__row") >= F.col("__first")), F.col("__row") - F.col("__first") + F.col("__before"))
    checked = F.coalesce(seq, F.raise_error(F.lit("the files were split differently in the second pass")).cast("bigint"))
    return joined.select(*lines.columns, checked.alias("seq"))


def list_position(log: DataFrame) -> DataFrame:
    """Number the records of all files together (``position``, from 0): files by name, then lines.

    A list that several tasks have written in order is one list.  Files are
    counted; no row moves.
    """
    files = log.groupBy("source").agg((F.max("seq") + 1).alias("__lines"))
    # One row for each file, whatever their size.
    before = F.sum("__lines").over(Window.orderBy("source").rowsBetween(Window.unboundedPreceding, -1))
    offsets = stored_lookup(files.select(F.col("source").alias("__file"), F.coalesce(before, F.lit(0)).alias("__before")), "files")
    numbered = log.join(offsets, F.col("source") == F.col("__file"))
    return numbered.select(*log.columns, (F.col("seq") + F.col("__before")).alias("position"))
