"""Legacy archive converter, ARC to WARC (operator 3).

ARC files of version 1 or 2 are parsed by the fields that their version has in
a header line and by the declared length of the content.  Each record becomes a
WARC record with a synthesised identifier, timestamp, type and digests; of
records with equal payloads, that with the largest page id is the response and
the others are revisits of it.

A task writes one file, through Spark's text writer, so files can be on any
store that Spark reaches and a retried task leaves no half file; the bytes are
those of the archive.  A file holds what one input split or shuffle partition
holds, and is read as a stream, record by record.

Defined results: null html is an empty payload; a null url is written as ``-``
and has no target; a null page id is written as an empty number, read back as
null, and a revisit if its payload has a response; rows that repeat the
response's page id are responses too; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterable, Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadspark.llm.tables import release, ship, stored
from quadspark.llm.words import slices
from quadspark.session import scratch_path

#: Header fields by version, as the format defines them.
FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
        "Filename", "Archive-length"),
}
DATE, ADDRESS, ORIGIN = "20240101000000", "0.0.0.0", "InternetArchive"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BATCH_BYTES = 4 << 20


def sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _http(page_id: int | None, payload: bytes) -> bytes:
    number = "" if page_id is None else page_id
    return (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nX-Page-Id: {number}\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode() + payload


def _batches(rows: Iterable[dict], schema: pa.Schema, size_of: str) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded bytes."""
    some, size = [], 0
    for row in rows:
        some.append(row)
        size += len(row[size_of] or b"") + 256
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_pylist(some, schema)
            some, size = [], 0
    if some:
        yield pa.RecordBatch.from_pylist(some, schema)


def _write(raw: DataFrame, path: str) -> None:
    """Rows of bytes as the lines of gzip files, one file a task; nothing but a line feed is added to a row."""
    raw.select(F.col("raw").cast("string").alias("value")).write.option("compression", "gzip").text(path)


# ---------------------------------------------------------------- ARC


def arc_header(version: int, url: str, date: str, kind: str, length: int, code: str = "200", checksum: str = "-",
               location: str = "-", offset: int = 0, filename: str = "-") -> bytes:
    values = {"URL": url, "IP-address": ADDRESS, "Archive-date": date, "Content-type": kind, "Result-code": code,
              "Checksum": checksum, "Location": location, "Offset": str(offset), "Filename": filename,
              "Archive-length": str(length)}
    return " ".join(values[f] for f in FIELDS[version]).encode() + b"\n"


def _arc_rows(batches: Iterable[pa.RecordBatch], version: int, name: str, date: str) -> Iterator[dict]:
    about = f"{version} 0 {ORIGIN}\n{' '.join(FIELDS[version])}\n".encode()
    row = arc_header(version, f"filedesc://{name}", date, "text/plain", len(about), filename=name) + about
    offset = len(row) + 1
    yield {"raw": row}
    for batch in slices(batches, "payload"):
        for page_id, url, payload in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload")), strict=True):
            block = _http(page_id, payload or b"")
            # Blanks would end the field.
            target = "".join(f"%{b:02X}" if b <= 32 or b == 127 else chr(b) for b in url.encode()).encode(
                "latin-1").decode("utf-8") if url else "-"
            row = arc_header(version, target, date, "text/html", len(block), offset=offset, filename=name) + block
            offset += len(row) + 1
            yield {"raw": row}


def write_arc(pages: DataFrame, path: str, versions: tuple[int, ...] = (1, 2), date: str = DATE) -> None:
    """Pages (page_id, url, html) as ARC files; the versions take turns by file."""
    schema = pa.schema([("raw", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()
        yield from _batches(_arc_rows(batches, versions[number % len(versions)], f"part-{number:05d}.arc.gz", date),
                            schema, "raw")

    ship(pages.sparkSession)
    source = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                          F.encode(F.col("html").cast("string"), "UTF-8").alias("payload"))
    _write(source.mapInArrow(run, "raw binary"), path)


def parse_arc(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and content of each record after the version block.

    The version block's second line begins with the version, and its third line
    names the fields.
    """
    version, fields = 0, FIELDS[1]
    while line := stream.readline():
        if not line.strip():
            continue
        # All fields but the first are free of blanks.
        values = line.decode("utf-8", "replace").rstrip("\r\n").rsplit(" ", len(fields) - 1)
        if values[0].startswith("filedesc://") or not version:
            length = int(line.split()[-1])
            about = stream.read(length).decode("utf-8", "replace").split("\n")
            version = int(about[0].split()[0])
            if version not in FIELDS:
                raise ValueError(f"ARC version {version} is unknown")
            fields = tuple(about[1].split()) if len(about) > 1 and about[1].strip() else FIELDS[version]
            continue
        if len(values) != len(fields):
            raise ValueError(f"not an ARC header of version {version}: {line[:200]!r}")
        header = dict(zip(fields, values, strict=True))
        content = stream.read(int(header["Archive-length"]))
        if len(content) != int(header["Archive-length"]):
            raise ValueError("an ARC record is shorter than declared")
        yield header, content


# ---------------------------------------------------------------- conversion

_RECORD = pa.schema([
    ("page_id", pa.int64()), ("record_id", pa.string()), ("target", pa.string()), ("date", pa.string()),
    ("address", pa.string()), ("head", pa.binary()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string())])
_RECORD_DDL = ("page_id long, record_id string, target string, date string, address string, head binary, "
               "payload binary, payload_bytes long, payload_digest string")


def record_id(page_id: int | None, digest: str) -> str:
    """The same for the same page and payload, so that a retried task makes the same one."""
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}"


def _head_fields(head: bytes) -> dict[str, str]:
    lines = head.decode("latin-1").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines) if v}


def _number(text: str | None) -> int | None:
    return int(text) if text else None


def _convert(header: dict[str, str], content: bytes) -> dict:
    """The parts of the WARC record that stands for an ARC record."""
    head, _, payload = content.partition(b"\r\n\r\n")
    digest = sha1(payload)
    page_id = _number(_head_fields(head).get("x-page-id"))
    when = datetime.strptime(header["Archive-date"].ljust(14, "0"), "%Y%m%d%H%M%S").replace(tzinfo=UTC)
    return {"page_id": page_id, "record_id": record_id(page_id, digest),
            "target": None if header["URL"] == "-" else header["URL"], "date": when.strftime("%Y-%m-%dT%H:%M:%SZ"),
            "address": header["IP-address"], "head": head + b"\r\n\r\n", "payload": payload,
            "payload_bytes": len(payload), "payload_digest": digest}


def _files(spark: SparkSession, path: str) -> DataFrame:
    ship(spark)
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")


def _streams(batches: Iterable[pa.RecordBatch]) -> Iterator[io.BufferedIOBase]:
    for batch in batches:
        for content in batch.column("content"):
            yield io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_py())), 1 << 16)


def converted(spark: SparkSession, path: str) -> DataFrame:
    """WARC records, without their type, of the ARC files in a folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for stream in _streams(batches):
            yield from _batches((_convert(h, c) for h, c in parse_arc(stream)), _RECORD, "payload")

    return _files(spark, path).mapInArrow(run, _RECORD_DDL)


# ---------------------------------------------------------------- WARC


def _warc_record(kind: str, fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields if v is not None),
             f"WARC-Block-Digest: sha1:{sha1(block)}", f"Content-Length: {len(block)}"]
    # The writer adds the last line feed.
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r"


def _warc_rows(batches: Iterable[pa.RecordBatch], number: int) -> Iterator[dict]:
    about = b"software: quadspark\r\nformat: WARC File Format 1.1\r\n"
    date = datetime.strptime(DATE, "%Y%m%d%H%M%S").strftime("%Y-%m-%dT%H:%M:%SZ")
    yield {"raw": _warc_record("warcinfo", [
        ("WARC-Record-ID", f"<{record_id(None, f'info:{number}')}>"), ("WARC-Date", date),
        ("Content-Type", "application/warc-fields")], about)}
    for batch in slices(batches, "payload"):
        for r in batch.to_pylist():
            fields = [("WARC-Record-ID", f"<{r['record_id']}>"), ("WARC-Target-URI", r["target"]),
                      ("WARC-Date", r["date"]), ("WARC-IP-Address", r["address"]),
                      ("Content-Type", "application/http; msgtype=response"),
                      ("WARC-Payload-Digest", f"sha1:{r['payload_digest']}")]
            if r["refers_to"] is None:
                yield {"raw": _warc_record("response", fields, r["head"] + r["payload"])}
            else:
                fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", f"<{record_id(r['refers_to'], r['payload_digest'])}>")]
                yield {"raw": _warc_record("revisit", fields, r["head"])}


def write_warc(records: DataFrame, path: str) -> None:
    """Records with ``refers_to`` (page id of the response, or null for a response itself) as WARC files."""
    schema = pa.schema([("raw", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(_warc_rows(batches, TaskContext.get().partitionId()), schema, "raw")

    _write(records.mapInArrow(run, "raw binary"), path)


def parse_warc(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a WARC record: {line[:200]!r}")
        header: dict[str, str] = {}
        while (line := stream.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            header[name.strip().lower()] = value.strip()
        block = stream.read(int(header["content-length"]))
        if f"sha1:{sha1(block)}" != header.get("warc-block-digest", f"sha1:{sha1(block)}"):
            raise ValueError(f"{header.get('warc-record-id')}: the block does not have its digest")
        yield header, block


def _read_back(header: dict[str, str], block: bytes) -> dict:
    head, _, payload = block.partition(b"\r\n\r\n")
    fields = _head_fields(head)
    whole = header["warc-type"] == "response"
    digest = header["warc-payload-digest"].removeprefix("sha1:")
    if whole and sha1(payload) != digest:
        raise ValueError(f"{header['warc-record-id']}: the payload does not have its digest")
    return {"page_id": _number(fields.get("x-page-id")),
            "payload_bytes": len(payload) if whole else int(fields["content-length"]), "payload_digest": digest,
            "record_type": header["warc-type"], "record_id": header["warc-record-id"].strip("<>"),
            "refers_to_id": header.get("warc-refers-to", "").strip("<>") or None,
            "payload": payload if whole else None}


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Response and revisit records: page_id, payload_bytes, payload_digest, record_type, record_id, refers_to_id, payload.

    Digests are checked.
    """
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("record_id", pa.string()), ("refers_to_id", pa.string()),
                        ("payload", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for stream in _streams(batches):
            rows = (_read_back(h, b) for h, b in parse_warc(stream) if h["warc-type"] in ("response", "revisit"))
            yield from _batches(rows, schema, "payload")

    return _files(spark, path).mapInArrow(
        run, "page_id long, payload_bytes long, payload_digest string, record_type string, record_id string, "
             "refers_to_id string, payload binary")


def convert_archives(spark: SparkSession, arc_path: str, warc_path: str) -> None:
    """Write the WARC files that stand for the ARC files in a folder."""
    records = converted(spark, arc_path)
    same = stored(records.groupBy("payload_digest").agg(
        F.max("page_id").alias("response"), F.count("*").alias("n")).where("n > 1").drop("n"), "llm-same-payload")
    other = F.when(~F.col("page_id").eqNullSafe(F.col("response")), F.col("response"))
    write_warc(records.join(same, "payload_digest", "left").select(*_RECORD.names, other.alias("refers_to")), warc_path)
    release(spark)


def archive_pages(pages: DataFrame, arc_path: str | None = None, warc_path: str | None = None) -> DataFrame:
    """Pages through ARC and WARC files and back: page_id, payload_bytes, payload_digest, record_type and refers_to."""
    spark = pages.sparkSession
    arc_path = arc_path or scratch_path(spark, "llm-arc")
    warc_path = warc_path or scratch_path(spark, "llm-warc")
    write_arc(pages, arc_path)
    convert_archives(spark, arc_path, warc_path)
    back = stored(read_warc(spark, warc_path).drop("payload"), "llm-read-back")
    responses = stored(back.where("record_type = 'response'").groupBy("record_id").agg(
        F.max("page_id").alias("refers_to")), "llm-responses")
    return back.join(responses.withColumnRenamed("record_id", "refers_to_id"), "refers_to_id", "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
