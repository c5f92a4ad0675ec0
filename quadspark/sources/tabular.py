"""CSV, JSON and XML sources for mappings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quadspark.session import scratch_path
from quadspark.sources.splits import CsvPieces, JsonPieces, read_records


def resolve(path: str, base_dir: str | None) -> str:
    """A relative path is taken from the work directory."""
    if base_dir is None or path.startswith("/") or "://" in path:
        return path
    return f"{base_dir.rstrip('/')}/{path}"


# Options under which a line break outside quotes ends a record, and no other does.
_SPLITTABLE = {"sep", "delimiter", "quote", "escape", "header", "nullValue", "emptyValue", "nanValue", "dateFormat",
               "timestampFormat", "mode"}
_BLANKS_KEPT = {"ignoreLeadingWhiteSpace", "ignoreTrailingWhiteSpace"}


def read_csv_source(
    spark: SparkSession, path: str, multiline: bool = False, base_dir: str | None = None,
    schema: str | StructType | None = None, **options: str,
) -> DataFrame:
    """CSV with a header; without a schema every column is a string, and an empty field is null.

    A file whose fields hold line breaks (``multiline``) is read in byte ranges
    by many tasks, too.  Options that change what a record is, beyond another
    delimiter, quote or escape, leave such a file to one task, and so do folders
    whose names give columns.
    """
    source = resolve(path, base_dir)
    given = {"header": "true", "escape": '"', **{k: str(v) for k, v in options.items()}}
    reader = spark.read.options(**given).option("multiLine", multiline)
    reader = reader if schema is None else reader.schema(schema)
    if not multiline or not _splittable(given) or _partitioned(spark, source):
        return reader.csv(source)
    # The schema comes from the head of the first file.
    fields = reader.csv(source).schema
    form = CsvPieces(given.get("sep", given.get("delimiter", ",")), given.get("quote", '"'), given["escape"])
    records = read_records(spark, source, form)
    if given["header"].lower() == "true":
        records = records.where("NOT header")
    parsing = {k: v for k, v in given.items() if k != "header"} | {"multiLine": "true", "lineSep": "\n"}
    rows = records.where("record <> ''")
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in fields)
    return rows.select(F.from_csv("record", columns, parsing).alias("row")).select("row.*")


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _partitioned(spark: SparkSession, path: str) -> bool:
    return spark.read.text(path).columns != ["value"]


def _splittable(options: dict[str, str]) -> bool:
    options = {k: v for k, v in options.items() if not (k in _BLANKS_KEPT and v.lower() == "false")}
    one_character = all(len(options.get(k, "x")) == 1 for k in ("sep", "delimiter", "quote", "escape"))
    return set(options) <= _SPLITTABLE and one_character and options.get("mode", "permissive").lower() != "dropmalformed"


def read_json_source(
    spark: SparkSession, path: str, mode: str = "array", schema: str | StructType | None = None,
    base_dir: str | None = None,
) -> DataFrame:
    """JSON documents: ``array`` (one array per file), ``sequence`` (records
    started by the record separator) or ``lines``.

    The objects of an array are found in byte ranges by many tasks.  Without a
    schema Spark reads the input once more to infer it.
    """
    source = resolve(path, base_dir)
    reader = spark.read if schema is None else spark.read.schema(schema)
    if mode == "array" and _partitioned(spark, source):
        reader = reader.option("multiLine", True)
    elif mode == "array":
        records = read_records(spark, source, JsonPieces())
        # Brackets and commas between records go; a line break inside one is white space.
        bare = F.regexp_replace("record", r"^[\s,\[\x{FEFF}]+|[\s\]]+$", "")
        lines = records.select(F.translate(bare, "\r\n", "  ").alias("value")).where("value <> ''")
        place = scratch_path(spark, "json-records")
        lines.write.text(place)
        source = place
    elif mode == "sequence":
        reader = reader.option("lineSep", "\x1e")
    elif mode != "lines":
        raise ValueError("mode is 'array', 'sequence' or 'lines'")
    return reader.json(source)


def read_xml_docs(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """One document per row, with its file."""
    return spark.read.text(paths, wholetext=True).select(
        F.col("_metadata.file_path").alias("source"), F.col("value").alias("xml"))


def read_xml_rows(
    spark: SparkSession, path: str, row_tag: str, schema: str | StructType | None = None
) -> DataFrame:
    """Row-oriented XML: one row per ``row_tag`` element; files are split among tasks."""
    reader = spark.read.format("xml").option("rowTag", row_tag)
    return (reader if schema is None else reader.schema(schema)).load(path)
