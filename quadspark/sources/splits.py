"""Records that span lines, read from byte ranges of one file by many tasks.

Spark cuts a text file into byte ranges at a separator.  Whether a piece between
two separators ends a record depends on all text before it: whether a quote is
open, and how deep the braces are nested.  Every range is therefore followed
under both assumptions on its first piece; the ranges' results are combined in
the order of the file; and a second pass, which knows where each range begins,
joins pieces to records.  Only the pieces of records that cross a border between
ranges are shuffled.

Text is read twice and is UTF-8.  A record is one value in memory, a range is not.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quadspark.session import ship
from quadspark.sources.storage import MAX_BROADCAST_BYTES, path_size, stored_table

_RANGE = "path string, start long, out0 long, deep0 long, out1 long, deep1 long, first string"
_STATE = "path string, start long, inside long, depth long, base long, crlf boolean"
_PART = "path string, start long, role string, header boolean, record string"
# Characters of records that leave a task at a time.
_CHARS_OUT = 1 << 20


@dataclass(frozen=True)
class CsvPieces:
    """Lines; a quote opens at the start of a field only.

    Where the first line ends in CR LF, every line break counts as one character.
    """

    delimiter: str = ","
    quote: str = '"'
    escape: str = '"'
    separator: str = "\n"
    #: What a piece that ends a record is followed by, as part of the record.
    ending: str = ""

    def step(self):
        """A function of a piece and whether it begins inside quotes: whether it ends inside, and its change of depth."""
        q, d, e = (re.escape(x) for x in (self.quote, self.delimiter, self.escape))
        text = rf"(?:[^{q}]++|{q}{q})*+" if self.escape == self.quote else rf"(?:[^{q}{e}]++|{e}(?s:.)?)*+"
        opens = re.compile(rf"(?s)(?:(?:{q}{text}{q}[^{d}]*+|(?!{q})[^{d}]*+){d})*+{q}{text}\Z")
        body, rest = re.compile(text), re.compile(rf"(?s){q}[^{d}]*+{d}?")
        quote = self.quote

        def run(piece: str, inside: int) -> tuple[int, int]:
            if quote not in piece:
                return inside, 0
            if inside:
                at = body.match(piece).end()
                if at == len(piece):
                    return 1, 0
                piece = piece[rest.match(piece, at).end():]
            return int(opens.match(piece) is not None), 0

        return run

    def first(self, piece: str) -> str:
        """What the first piece of a file tells about all."""
        return "\r" if piece.endswith("\r") else "\n"

    def base(self, first: str) -> int:
        return 0


@dataclass(frozen=True)
class JsonPieces:
    """Text up to a closing brace; records are the objects in the outermost array, or one outermost object."""

    separator: str = "}"
    ending: str = "}"

    def step(self):
        strings = re.compile(r'"(?:[^"\\]++|\\(?s:.))*+"')
        body = re.compile(r'(?:[^"\\]++|\\(?s:.)|\\\Z)*+')

        def run(piece: str, inside: int) -> tuple[int, int]:
            if inside:
                at = body.match(piece).end()
                if at == len(piece):
                    return 1, 0
                piece = piece[at + 1:]
            bare = strings.sub("", piece) if '"' in piece else piece
            bare, quote, _ = bare.partition('"')
            depth = bare.count("{") + bare.count("[") - bare.count("]")
            return (1, depth) if quote else (0, depth - 1)

        return run

    def first(self, piece: str) -> str:
        return piece.lstrip("\ufeff \t\r\n")[:1]

    def base(self, first: str) -> int:
        """Depth between two records."""
        return 1 if first == "[" else 0


Pieces = CsvPieces | JsonPieces


def _follow(pieces: Pieces):
    """What each range makes of both states it may begin in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, key, row = pieces.step(), None, {}
        for batch in batches:
            paths, starts = batch.column("path").to_pylist(), batch.column("start").to_pylist()
            for path, start, text in zip(paths, starts, batch.column("value").to_pylist(), strict=True):
                if (path, start) != key:
                    if key is not None:
                        yield pa.RecordBatch.from_pylist([row])
                    key, row = (path, start), {"path": path, "start": start, "out0": 0, "deep0": 0, "out1": 1, "deep1": 0, "first": ""}
                for n in "01":
                    row["out" + n], change = step(text, row["out" + n])
                    row["deep" + n] += change
                row["first"] = row["first"] or pieces.first(text)
        if key is not None:
            yield pa.RecordBatch.from_pylist([row])

    return run


def _states(pieces: Pieces):
    """The state at the beginning of each range of a file."""

    def run(ranges: pd.DataFrame) -> pd.DataFrame:
        inside = depth = 0
        rows = []
        ranges = ranges.sort_values("start")
        first = next((c for c in ranges["first"] if c), "")
        base, crlf = pieces.base(first), first == "\r"
        for r in ranges.itertuples():
            rows.append((r.path, r.start, inside, depth, base, crlf))
            depth += r.deep1 if inside else r.deep0
            inside = r.out1 if inside else r.out0
        return pd.DataFrame(rows, columns=["path", "start", "inside", "depth", "base", "crlf"])

    return run


def _cut(pieces: Pieces):
    """Whole records of each range, and the pieces of those that cross its borders.

    The roles of pieces are: ``open`` begins a record, ``close`` ends one and
    ``middle`` is inside one.  header marks a file's first record.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step, separator, ending = pieces.step(), pieces.separator, pieces.ending
        key, out, size = None, [], 0
        pending: list[str] = []
        inside = depth = base = 0
        begun = header = False

        def emit(role: str, end: str) -> int:
            text = separator.join(pending) + end
            out.append((*key, role, header, text))
            pending.clear()
            return len(text)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.string())
            names = ("path", "start", "role", "header", "record")
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("path", "start", "inside", "depth", "base", "crlf", "value"))
            for path, start, inside0, depth0, base0, crlf, text in zip(*columns, strict=True):
                if (path, start) != key:
                    if pending:
                        emit("open" if begun else "middle", "")
                    if inside0 is None:
                        raise RuntimeError(f"{path} was cut at other places in the second pass")
                    key, inside, depth, base = (path, start), inside0, depth0, base0
                    header = start == 0
                    begun = header or (inside == 0 and depth == base)
                text = text.removesuffix("\r") if crlf else text
                pending.append(text)
                inside, change = step(text, inside)
                depth += change
                if inside == 0 and depth == base:
                    size += emit("record" if begun else "close", ending)
                    begun, header = True, False
                    if size > _CHARS_OUT:
                        yield batch_of(out)
                        out, size = [], 0
        if pending:
            emit("open" if begun else "middle", "")
        if out:
            yield batch_of(out)

    return run


def read_records(spark: SparkSession, path: str, pieces: Pieces) -> DataFrame:
    """The records of text files, as (record, header): header marks the first one of each file.

    Their order is not kept.  An unfinished record at the end of a file counts as one.
    """
    ship(spark)
    text = spark.read.option("lineSep", pieces.separator).text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")
    followed, _ = stored_table(text.mapInArrow(_follow(pieces), _RANGE), "text-ranges")
    # One row for each range of a file, some 800,000 for 100 TB.
    states, place = stored_table(followed.groupBy("path").applyInPandas(_states(pieces), _STATE), "text-states")
    if path_size(spark, place) <= MAX_BROADCAST_BYTES:
        known = text.join(F.broadcast(states), ["path", "start"], "left")
    else:
        known = text.withColumn("row", F.monotonically_increasing_id()).join(states, ["path", "start"], "left")
        known = known.repartition("path", "start").sortWithinPartitions("path", "start", "row").drop("row")
    parts = known.mapInArrow(_cut(pieces), _PART)
    whole = parts.where("role = 'record'").select("record", "header")
    crossing, _ = stored_table(parts.where("role <> 'record'"), "text-crossings")
    return whole.unionByName(_joined(crossing, pieces.separator))


def _joined(crossing: DataFrame, separator: str) -> DataFrame:
    """Records from the pieces at the borders of ranges; their number is that of the ranges."""
    # A range's closing piece comes before the one that it opens.
    place = F.when(F.col("role") == "open", 1).otherwise(0)
    opened = F.sum(place).over(Window.partitionBy("path").orderBy("start", place))
    numbered = crossing.select("path", opened.alias("number"), F.struct(
        "start", place.alias("place"), "header", "record").alias("piece"))
    records = numbered.groupBy("path", "number").agg(F.sort_array(F.collect_list("piece")).alias("pieces"))
    return records.select(F.array_join(F.transform("pieces", lambda p: p["record"]), separator).alias("record"),
                          F.col("pieces")[0]["header"].alias("header"))
