"""Substring dedup by window fingerprints (operator 1).

This takes the place of a greedy relative Lempel-Ziv parse: there are no longest
factors and no reference blocks.  A parse goes through a document word by word
against an index that a task has to hold; windows of one fixed length, which are
all that decides here, meet their equals in joins instead.

The anchor of a 50-word window is its least 10-word hash (winnowing); a *run* is
a maximal row of windows with one anchor.  Equal passages have equal anchors
and, away from their ends, equal runs, so there are two steps:

* **Whole runs.**  A run that also occurs in a document with a smaller id is
  matched as a whole, without looking at its windows.
* **Single windows.**  Runs that are first of their kind, but whose anchor
  also occurs with other words around it, are compared window by window.

Windows found in either step are merged into spans.  A window is judged on the
input, so nothing depends on the order of the rows, and the result is exact
(up to collisions of two independent 64-bit hashes).  Texts of one id are told
apart by a 64-bit hash, and any number of equal rows have one list of windows.

All counts per key combine before their shuffle; joins that carry hot keys have
tables on both sides, so adaptive execution can split them.  Each phase ends in
a table in the shared folder.

Defined results: a null or empty text has no words; a document with a null id
is no reference and loses nothing; a row is never a reference to rows of the
same id; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadspark.llm.tables import doc_texts, release, stored
from quadspark.llm.words import Words, covered, slices, sliding_min, texts

WINDOW = 50
ANCHOR_WORDS = 10
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def window_anchors(words: Words, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows and the anchor of each."""
    start = words.windows(window)
    if not len(start):
        return start, np.zeros(0, np.uint64)
    place = np.arange(len(words.hash) - anchor + 1)
    least = sliding_min(words.runs(place, place + anchor), window - anchor + 1)
    return start, least[start]


def _runs(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = Words(texts(batch))
            start, least = window_anchors(words, window, anchor)
            if not len(start):
                continue
            new = np.ones(len(start), bool)
            new[1:] = (least[1:] != least[:-1]) | (words.text[start[1:]] != words.text[start[:-1]])
            at = np.flatnonzero(new)
            count = np.diff(np.append(at, len(start)))
            first, owner = start[at], words.text[start[at]]
            yield pa.RecordBatch.from_pydict({
                "anchor": _signed(least[at]), "run": _signed(words.runs(first, first + count + window - 1)),
                "doc_id": batch.column("doc_id").take(pa.array(owner)), "print": batch.column("print").take(pa.array(owner)),
                "start": pa.array((first - words.first[owner]).astype(np.int32)),
                "n": pa.array(count.astype(np.int32))})

    return run


def _window_hashes(window: int):
    """Hashes of the windows of the listed runs of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = Words(texts(batch))
            listed = batch.column("runs")
            owner = np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(listed.offsets)))
            flat = listed.flatten()
            start, n = np.asarray(flat.field("start")).astype(np.int64), np.asarray(flat.field("n")).astype(np.int64)
            which = np.repeat(np.arange(len(n)), n)
            place = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + start[which]
            begin = words.first[owner[which]] + place
            take = pa.array(owner[which])
            yield pa.RecordBatch.from_pydict({
                "anchor": flat.field("anchor").take(pa.array(which)), "w": _signed(words.runs(begin, begin + window)),
                "doc_id": batch.column("doc_id").take(take), "print": batch.column("print").take(take),
                "start": pa.array(place.astype(np.int32))})

    return run


def _spans(texts_of: list[bytes], listed: list, window: int) -> tuple[list, list]:
    """Per document the removed spans as (first word, end) and the kept words."""
    spans, kept = [], []
    for text, found in zip(texts_of, listed, strict=True):
        words = text.split()
        if not found:
            spans.append([])
            kept.append(b" ".join(words))
            continue
        start = np.array([x["start"] for x in found])
        inside = covered(len(words), start, start + np.array([x["n"] for x in found]) + window - 1)
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
        spans.append([{"start": int(a), "end": int(b)} for a, b in edge.reshape(-1, 2)])
        kept.append(b" ".join(w for w, gone in zip(words, inside.tolist(), strict=True) if not gone))
    return spans, kept


def _cut(window: int):
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            documents = texts(batch)
            spans, kept = _spans(documents, batch.column("found").to_pylist(), window)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "n_words": pa.array([len(d.split()) for d in documents], pa.int64()),
                "spans": pa.array(spans, kind), "kept_text": pa.array(kept, pa.binary()).cast(pa.string())})

    return run


def _print(text: Column) -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def repeated_windows(documents: DataFrame, window: int = WINDOW, anchor: int = ANCHOR_WORDS) -> DataFrame:
    """Per document with repeated windows its doc_id, the hash of its text (print), and rows of such windows.

    Column ``found`` has (start, n): n windows from the word ``start`` on.
    """
    if not 0 < anchor <= window:
        raise ValueError("an anchor has from one word up to a window")
    spark = documents.sparkSession
    source = doc_texts(documents).withColumn("print", _print(F.col("text")))
    known = source.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    key = ["doc_id", "print"]

    runs = stored(known.mapInArrow(
        _runs(window, anchor), "anchor long, run long, doc_id long, print long, start int, n int"), "llm-runs")
    # Anchors that two documents share; "mixed" if with other words around them.
    shared = stored(runs.groupBy("anchor").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most"),
        (F.min("run") != F.max("run")).alias("mixed"),
    ).where("least < most").select("anchor", "mixed"), "llm-anchors")
    release(spark)
    common = stored(runs.join(shared, "anchor"), "llm-common")
    release(spark)
    first = stored(common.groupBy("anchor", "run").agg(F.min("doc_id").alias("least")), "llm-first")
    judged = stored(common.join(first, ["anchor", "run"]).select(
        *key, "start", "n", "anchor", "mixed", (F.col("least") < F.col("doc_id")).alias("factor"),
    ).where("factor or mixed"), "llm-judged")
    release(spark)

    # Equal rows have equal runs: sets, so that each of many copies gets them once.
    edges = judged.where("not factor").groupBy(*key).agg(F.collect_set(F.struct("start", "n", "anchor")).alias("runs"))
    windows = stored(source.join(edges, key).select(*key, "text", "runs").mapInArrow(
        _window_hashes(window), "anchor long, w long, doc_id long, print long, start int"), "llm-windows")
    release(spark)
    earlier = stored(windows.groupBy("anchor", "w").agg(
        F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").drop("most"), "llm-earlier")
    single = windows.join(earlier, ["anchor", "w"]).where("least < doc_id").select(*key, "start", F.lit(1).alias("n"))
    found = judged.where("factor").select(*key, "start", "n").unionByName(single)
    lists = stored(found.groupBy(*key).agg(F.collect_set(F.struct("start", "n")).alias("found")), "llm-found")
    release(spark)
    return lists


def remove_repeats(documents: DataFrame, window: int = WINDOW, anchor: int = ANCHOR_WORDS) -> DataFrame:
    """Per document doc_id, n_words, spans (removed word ranges) and kept_text.

    kept_text has the remaining words, joined by one space.
    """
    lists = repeated_windows(documents, window, anchor)
    keyed = doc_texts(documents).withColumn("print", _print(F.col("text")))
    return keyed.join(lists, ["doc_id", "print"], "left").select("doc_id", "text", "found").mapInArrow(
        _cut(window), "doc_id long, n_words long, spans array<struct<start:int,end:int>>, kept_text string")


def cut_repeats(documents: DataFrame, window: int = WINDOW, anchor: int = ANCHOR_WORDS) -> DataFrame:
    """The documents, with all columns, without their repeated passages.

    White space between the words that stay is left as it is.  Documents of
    which no word is left go; those that had none stay.
    """
    lists = repeated_windows(documents, window, anchor)
    names = documents.columns
    at = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            new, stay = [], []
            for text, found in zip(texts(batch), batch.column("found").to_pylist(), strict=True):
                if found:
                    place = [m.start() for m in _WORD.finditer(text)] + [len(text)]
                    spans = _spans([text], [found], window)[0][0]
                    edge = [0, *(place[x] for s in spans for x in (s["start"], s["end"])), len(text)]
                    text = b"".join(text[a:b] for a, b in zip(edge[::2], edge[1::2], strict=True))
                stay.append(not found or bool(text.strip()))
                new.append(text)
            cut = pa.array(new, pa.binary()).cast(pa.string())
            cut = pc.if_else(batch.column("text").is_null(), pa.scalar(None, pa.string()), cut)
            columns = [cut if i == at else c for i, c in enumerate(batch.column("row").flatten())]
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(stay, pa.bool_()))

    # The documents' columns travel inside one, so that no name of theirs meets ours.
    text = F.col("text").cast("string")
    keyed = documents.select(F.struct("*").alias("row"), F.col("doc_id").cast("long"), text.alias("text"), _print(text).alias("print"))
    return keyed.join(lists, ["doc_id", "print"], "left").select("row", "text", "found").mapInArrow(run, documents.schema)


def removed_words(spans: str = "spans") -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"])
