"""Quality classifier: logistic regression on hashed word n-grams (operator 12).

Words are runs of letters and digits, or of other signs, in lower case, with all
digits alike.  Runs of one and two words are hashed into ``BUCKETS``, and two
equal neighbours are one feature whatever the word; a document is the logarithms
of their counts, scaled to length one.  Weights are learnt by
follow-the-regularised-leader, one document after the other, in passes over a
table of encoded documents; a pass streams through one task, and the driver
holds two numbers a bucket.  Scores are sparse dot products in one pass over all
whole texts, without a shuffle.

The labelled documents that are learnt from are at most ``max_documents``, drawn
by a hash of the id; their texts count as a whole.

Defined results: null and empty texts have no word, so the bias decides; without
a labelled document every score is a half; of several labels of one document the
largest counts, and of several texts the least; labels without an id or a label
are skipped; repeated rows are scored one by one; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadspark.llm.tables import doc_texts, stored
from quadspark.llm.words import Words, slices

#: Bound of the sample that is learnt from.
MAX_DOCUMENTS = 20_000
BUCKETS = 1 << 18
GRAMS = (1, 2)
PASSES = 4
#: Learning rate, its offset, and the weights of the absolute and squared penalties.
ALPHA, BETA, L1, L2 = 2.0, 1.0, 0.02, 0.02
THRESHOLD = 0.7
_SIGNS = re.compile(rb"[^0a-z\s\x80-\xFF]+")
_DIGITS = bytes(48 if 48 <= b <= 57 else b for b in range(256))


def encode(documents: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, bucket and value of every feature, in the order of the documents."""
    words = Words([_SIGNS.sub(rb" \g<0> ", d.translate(_DIGITS)) for d in documents])
    keys = []
    for size in GRAMS:
        start = words.windows(size)
        bucket = words.runs(start, start + size) % np.uint64(BUCKETS)
        if size == 2:
            bucket[words.hash[start] == words.hash[start + 1]] = 0
        keys.append(words.text[start] * BUCKETS + bucket.astype(np.int64))
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    document, bucket = key // BUCKETS, key % BUCKETS
    value = np.log1p(count)
    norm = np.sqrt(np.bincount(document, value**2, len(documents)))
    return document, bucket, value / norm[document]


def _lower(batch: pa.RecordBatch) -> list[bytes]:
    lower = pc.utf8_lower(batch.column("text").cast(pa.string()))
    return [x or b"" for x in lower.cast(pa.binary()).to_pylist()]


@dataclass
class Leader:
    """State of follow-the-regularised-leader; the last bucket is the bias."""

    z: np.ndarray
    n: np.ndarray

    @staticmethod
    def new() -> Leader:
        return Leader(np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1))

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= L1, 0.0, (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, bucket: np.ndarray, value: np.ndarray, label: int) -> None:
        at, x = np.append(bucket, BUCKETS), np.append(value, 1.0)
        w = self.weights(at)
        gradient = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
        n = self.n[at]
        self.z[at] += gradient - (np.sqrt(n + gradient**2) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + gradient**2


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        document, bucket, value = encode(_lower(batch))
        cut = np.searchsorted(document, np.arange(batch.num_rows + 1))
        offsets = pa.array(cut, pa.int32())
        yield pa.RecordBatch.from_pydict({
            "label": batch.column("label"),
            "buckets": pa.ListArray.from_arrays(offsets, pa.array(bucket, pa.int32())),
            "counts": pa.ListArray.from_arrays(offsets, pa.array(value, pa.float32()))})


def _pass(leader: Leader):
    """One pass over the encoded documents; gives the state after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = Leader(leader.z.copy(), leader.n.copy())
        for batch in batches:
            buckets, values = batch.column("buckets"), batch.column("counts")
            for i, label in enumerate(batch.column("label").to_pylist()):
                state.learn(np.asarray(buckets[i].values), np.asarray(values[i].values, np.float64), label)
        yield pa.RecordBatch.from_pydict({"z": [state.z.tobytes()], "n": [state.n.tobytes()]})

    return run


def train(documents: DataFrame, labels: DataFrame, max_documents: int = MAX_DOCUMENTS) -> np.ndarray:
    """Weights of the buckets, and the bias, from the labelled documents (doc_id, quality)."""
    order = F.md5(F.col("doc_id").cast("string"))
    marks = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("label")).where(
        "doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").alias("label"))
    drawn = marks.orderBy(order, "doc_id").limit(max_documents)
    # At most max_documents ids are sent, and as many documents kept.
    texts = doc_texts(documents).join(F.broadcast(drawn), "doc_id")
    texts = texts.groupBy("doc_id").agg(F.max("label").alias("label"), F.min("text").alias("text"))
    mixed = texts.sortWithinPartitions(order, "doc_id")
    encoded = stored(mixed.mapInArrow(_encode, "label int, buckets array<int>, counts array<float>"), "llm-encoded")
    leader = Leader.new()
    for _ in range(PASSES):
        # The sample is bounded, and the leader follows one document after the other: one task.
        row = encoded.coalesce(1).mapInArrow(_pass(leader), "z binary, n binary").first()
        if row is not None:
            leader = Leader(np.frombuffer(row.z), np.frombuffer(row.n))
    return leader.weights()


def _score(weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            document, bucket, value = encode(_lower(batch))
            logit = weights[-1] + np.bincount(document, weights[bucket] * value, batch.num_rows)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "score": pa.array(1 / (1 + np.exp(-logit)), pa.float64())})

    return run


def quality(documents: DataFrame, weights: np.ndarray) -> DataFrame:
    """doc_id and score of every document."""
    return doc_texts(documents).mapInArrow(_score(weights), "doc_id long, score double")


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are kept for testing: a quarter, by a checksum of the id."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def scored(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labels that are not held out, and score all documents."""
    weights = train(documents, labels.where(~held_out(F.col("doc_id"))))
    return quality(documents, weights).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
