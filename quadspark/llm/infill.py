"""Fill-in-the-middle transformation (operator 13).

A text is cut into units, runs of ASCII letters and single other characters.
Two cuts drawn by a hash of the id make a prefix, a middle and a suffix, which
are put behind marks in one of two orders, or the text stays plain.

Each Arrow batch goes through ``pyarrow.compute``: units are split into lists,
the lists flattened with the index of their text, every unit gets its ordinal
and with it a role, the units of a role are rebuilt into lists and these joined.
A text longer than a batch's bytes goes through in pieces that end between two
units.  The work is one pass without a shuffle.

Defined results: a null text is empty; an empty text has no unit and is plain;
a null id is drawn for as the empty string; repeated rows are transformed one
by one; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadspark.llm.tables import doc_texts, ship
from quadspark.llm.words import SLICE_BYTES, slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: A unit in the bytes of UTF-8: letters, or another byte with the bytes that continue its character.
UNIT = rb"[A-Za-z]+|[^A-Za-z][\x80-\xBF]*"
#: A byte that no UTF-8 text holds.
END = b"\xff"
#: Per cent of the texts that stay plain, and of the others those whose suffix comes first.
PLAIN_PERCENT, SPM_PERCENT = 10, 20
_BOUNDARY = re.compile(rb"[^A-Za-z\x80-\xBF]")
_OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def _pieces(text: bytes, limit: int) -> list[bytes]:
    """The text in pieces of about so many bytes, cut where a unit begins."""
    cuts = [0]
    while len(text) - cuts[-1] > limit and (found := _BOUNDARY.search(text, cuts[-1] + limit)):
        cuts.append(found.start())
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True)]


def _offsets(counts: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())


def _joined(counts: np.ndarray, values: pa.Array) -> pa.Array:
    """So many neighbouring values each, joined."""
    return pc.binary_join(pa.ListArray.from_arrays(_offsets(counts), values), pa.scalar(b"", values.type))


def _roles(pieces: pa.Array, before: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[pa.Array]:
    """Prefix, middle and suffix of each piece.

    before: units of the text that come before the piece; low and high: units
    of the text before the middle and before the suffix.
    """
    marked = pc.replace_substring_regex(pieces, pattern=UNIT, replacement=rb"\0" + END)
    lists = pc.split_pattern(marked, pattern=END)  # the last one is empty and harms nobody
    owner, unit = pc.list_parent_indices(lists), pc.list_flatten(lists)
    first = np.asarray(lists.offsets)[:-1]
    ordinal = pc.add(pc.subtract(pa.array(np.arange(len(unit))), pc.take(pa.array(first - first[:1], pa.int64()), owner)),
                     pc.take(pa.array(before), owner))
    is_prefix = pc.less(ordinal, pc.take(pa.array(low), owner))
    is_suffix = pc.greater_equal(ordinal, pc.take(pa.array(high), owner))
    out = []
    for role in (is_prefix, pc.invert(pc.or_(is_prefix, is_suffix)), is_suffix):
        counts = np.bincount(np.asarray(pc.filter(owner, role)), minlength=len(pieces))
        out.append(_joined(counts, pc.filter(unit, role)))
    return out


def transform(batch: pa.RecordBatch, piece_bytes: int = SLICE_BYTES) -> pa.RecordBatch:
    """doc_id, text and the draws h1 to h4, transformed."""
    text = pc.fill_null(batch.column("text").cast(pa.large_binary()), b"")
    draws = {h: np.asarray(batch.column(h)) for h in ("h1", "h2", "h3", "h4")}
    cut = [_pieces(t.as_py(), piece_bytes) for t in text]
    per_text = np.array([len(p) for p in cut])
    pieces = pa.array([p for parts in cut for p in parts], pa.large_binary())
    units = np.asarray(pc.count_substring_regex(pieces, pattern=UNIT)).astype(np.int64)
    first = np.cumsum(per_text) - per_text
    n = np.add.reduceat(units, first)
    total = np.cumsum(units) - units
    before = total - np.repeat(total[first], per_text)
    ends = [draws["h1"] % (n + 1), draws["h2"] % (n + 1)]
    low, high = (np.repeat(f(*ends), per_text) for f in (np.minimum, np.maximum))

    lengths = np.cumsum(np.asarray(pc.binary_length(pieces)))
    groups = np.flatnonzero(np.diff(lengths // piece_bytes)) + 1
    found = [_roles(pieces[a:b], before[a:b], low[a:b], high[a:b])
             for a, b in zip([0, *groups], [*groups, len(pieces)], strict=True) if b > a]
    prefix, middle, suffix = (_joined(per_text, pa.concat_arrays(parts)) for parts in zip(*found, strict=True))

    plain = pa.array((n == 0) | (draws["h3"] % 100 >= 100 - PLAIN_PERCENT))
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain = pc.or_(plain, pc.match_substring(text, pattern=mark.encode()))
    spm = pa.array(draws["h4"] % 100 < SPM_PERCENT)
    p, s, m = (pa.scalar(x.encode(), pa.large_binary()) for x in (PREFIX, SUFFIX, MIDDLE))
    nothing = pa.scalar(b"", pa.large_binary())
    ordered = pc.if_else(spm, pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, nothing),
                         pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, nothing))

    def chars(part: pa.Array) -> pa.Array:
        return pc.if_else(plain, pa.scalar(None, pa.int64()), pc.utf8_length(part.cast(pa.large_string())).cast(pa.int64()))

    return pa.RecordBatch.from_pydict({
        "doc_id": batch.column("doc_id"), "n": pa.array(n, pa.int64()),
        "form": pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm")),
        "prefix_chars": chars(prefix), "middle_chars": chars(middle),
        "output": pc.if_else(plain, text, ordered).cast(pa.large_string()).cast(pa.string())})


def _draw(number: int) -> Column:
    digest = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * number - 7, 8), 16, 10).cast("long").alias(f"h{number}")


def infill(documents: DataFrame) -> DataFrame:
    """doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars and the output text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(transform, slices(batches, "text"))

    return doc_texts(documents).select("doc_id", "text", *map(_draw, range(1, 5))).mapInArrow(run, _OUT)


def restore(output: pa.Array, form: pa.Array) -> pa.Array:
    """The texts before the transformation."""
    plain = pc.equal(form, "plain")
    marks = "|".join(map(re.escape, (PREFIX, SUFFIX, MIDDLE)))
    # A plain text has no three marks that could be split at; any text with as many parts does.
    safe = pc.if_else(plain, PREFIX + SUFFIX + MIDDLE, output)
    parts = pc.split_pattern_regex(safe, pattern=marks, max_splits=3)
    one, two, middle = (pc.list_element(parts, i) for i in (1, 2, 3))
    spm = pc.equal(form, "spm")
    whole = pc.binary_join_element_wise(pc.if_else(spm, two, one), middle, pc.if_else(spm, one, two), "")
    return pc.if_else(plain, output, whole)


def restored(transformed: DataFrame) -> DataFrame:
    """The rows of ``infill`` with the text that output and form give back, as column ``restored``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "output"):
            output = batch.column("output").cast(pa.string())
            back = restore(output, batch.column("form").cast(pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, back], [*batch.schema.names, "restored"])

    ship(transformed.sparkSession)
    return transformed.mapInArrow(run, _OUT + ", restored string")
