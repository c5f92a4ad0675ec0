"""Toxicity by multiple-instance learning (operator 2).

Only documents have labels, but sentences offend.  A sentence's probability is
logistic in its words and their beginnings, and a document is toxic if any of
its sentences is: P = 1 - prod(1 - p), the noisy-or.  Training pushes the
documents' probabilities to their labels, which sorts out the sentences; those
above a half are located.

The weights are fitted on the driver, on at most ``max_documents`` labelled
documents, drawn by a hash of the id.  Their texts count as a whole: sentences
of a document with the same selected features are sent once, with their number.
Scoring is one pass over all whole texts, without a shuffle.

Defined results: null and empty texts have no sentence and score 0; without
labelled documents of both kinds, or without any telling word, every score is
0; of several labels of one document the largest counts, and of several texts
the least; labels without an id or a label are skipped; repeated rows are
scored one by one; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadspark.llm.tables import doc_texts, ship, stored
from quadspark.llm.words import mix, slices

MAX_DOCUMENTS = 10_000
#: A word's features are itself and its first bytes, so that inflected and compound forms share weights.
PREFIXES = (4, 5, 7)
#: Evidence (log-likelihood ratio) that a feature needs beyond what chance gives the best of all.
EVIDENCE = 4.0
#: At most so many features, those of most evidence, have a weight.
MAX_FEATURES = 20_000
STEPS, RATE, DECAY = 300, 0.1, 1e-4
THRESHOLD = 0.7
#: Ends of sentences.
ENDS = ".!?\n"
_BREAK = b"\x01"
_TABLE = bytes(
    1 if chr(b) in ENDS else b if b >= 128 or chr(b).isalnum() or b == 1 else 32 for b in range(256))


class Sentences:
    """The words of lower-case texts with their sentences; sentences have a word at least."""

    def __init__(self, documents: list[bytes]):
        found = [d.translate(_TABLE).replace(_BREAK, b" \x01 ").split() for d in documents]
        flat = [w for d in found for w in d]
        breaks = np.fromiter((w == _BREAK for w in flat), bool, len(flat))
        text = np.repeat(np.arange(len(found)), [len(d) for d in found])
        number = np.cumsum(breaks)
        at = np.flatnonzero(~breaks)
        words = [w for w in flat if w != _BREAK]
        #: Features of each word, one row for each kind.
        self.features = np.array([
            np.fromiter(map(zlib.crc32, words), np.int64, len(words)),
            *(np.fromiter((zlib.crc32(w[:n], n) for w in words), np.int64, len(words)) for n in PREFIXES)])
        new = np.ones(len(at), bool)
        new[1:] = (number[at][1:] != number[at][:-1]) | (text[at][1:] != text[at][:-1])
        #: First word and text of each sentence, and its number in the text, breaks counted.
        self.first = np.flatnonzero(new)
        self.text = text[at][self.first]
        before = np.concatenate([[0], number])[np.searchsorted(text, self.text)]
        self.number = number[at][self.first] - before
        #: The sentence of each word.
        self.sentence = np.cumsum(new) - 1


@dataclass
class Model:
    words: np.ndarray  # sorted hashes of features
    weights: np.ndarray
    bias: float

    def logits(self, sentences: Sentences) -> np.ndarray:
        """The logit of each sentence."""
        if not len(sentences.first):
            return np.zeros(0)
        total = np.zeros(sentences.features.shape[1])
        for row in sentences.features if len(self.words) else ():
            place = np.minimum(np.searchsorted(self.words, row), len(self.words) - 1)
            total += np.where(self.words[place] == row, self.weights[place], 0.0)
        return self.bias + np.add.reduceat(total, sentences.first)


def select(described: DataFrame) -> list[int]:
    """Features whose documents are toxic more often than chance would let any feature's be.

    described: doc_id, toxic, content (hash of the set of sentences) and distinct
    features.  Labels are noisy and copies repeat their noise, so documents with
    the same sentences are one observation, with the label of most.
    """
    groups = described.groupBy("content").agg(
        F.min(F.struct("doc_id", "features"))["features"].alias("features"), (F.avg("toxic") > 0.5).cast("int").alias("mark"))
    groups = stored(groups, "llm-observations")
    rate = groups.agg(F.avg("mark")).first()[0]
    if not rate or rate == 1:
        return []
    counts = stored(groups.select("mark", F.explode("features").alias("feature")).groupBy("feature").agg(
        F.count("*").alias("total"), F.sum("mark").alias("bad")), "llm-features")

    def term(n: Column, share: float) -> Column:
        return F.when(n > 0, n * F.log(n / (F.col("total") * share))).otherwise(0.0)

    bad, total = F.col("bad"), F.col("total")
    evidence = 2 * (term(bad, rate) + term(total - bad, 1 - rate))
    chance = 2 * math.log(max(2, counts.count())) + EVIDENCE
    found = counts.where((bad > total * rate) & (evidence > chance)).orderBy(evidence.desc(), "feature")
    return [r.feature for r in found.select("feature").take(MAX_FEATURES)]


def fit(vocabulary: np.ndarray, documents: list[np.ndarray], content: np.ndarray, toxic: np.ndarray) -> Model:
    """Weights of the selected features, by Adam on the noisy-or likelihood.

    documents: per document the selected features' places in the vocabulary; each
    sentence ends in the number of sentences like it, negated.
    """
    flat, text = np.concatenate(documents), np.repeat(np.arange(len(documents)), [len(d) for d in documents])
    ends = flat < 0
    owner, alike = text[ends], -flat[ends].astype(float)
    sentence = (np.cumsum(ends) - ends)[~ends]
    word = flat[~ends]
    _, group, size = np.unique(content, return_inverse=True, return_counts=True)
    weight = 1 / size[group] / len(size)
    parameters = np.zeros(len(vocabulary) + 1)
    parameters[-1] = -5.0
    first, second = np.zeros_like(parameters), np.zeros_like(parameters)
    for step in range(1, STEPS + 1):
        logit = parameters[-1] + np.bincount(sentence, parameters[word], len(owner))
        p = 1 / (1 + np.exp(-logit))
        none = np.bincount(owner, alike * np.logaddexp(0, logit), len(documents))  # -log of: no sentence offends
        slope = np.where(toxic, -1 / np.expm1(np.clip(none, 1e-6, 50)), 1.0)
        by_sentence = (np.maximum(slope, -1e3) * weight)[owner] * p * alike
        gradient = np.append(np.bincount(word, by_sentence[sentence], len(vocabulary)), by_sentence.sum())
        gradient[:-1] += DECAY * parameters[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        parameters -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Model(vocabulary, parameters[:-1], float(parameters[-1]))


def _lower(batch: pa.RecordBatch) -> list[bytes]:
    lower = pc.utf8_lower(batch.column("text").cast(pa.string()))
    return [x or b"" for x in lower.cast(pa.binary()).to_pylist()]


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct features of each document, and the hash of its set of sentences."""
    for batch in slices(batches, "text"):
        found = Sentences(_lower(batch))
        content = np.zeros(batch.num_rows, np.uint64)
        if len(found.first):
            words = mix(found.features[0].astype(np.uint64))
            sentence = mix(np.add.reduceat(words, found.first))
            order = np.lexsort((sentence, found.text))
            text, sentence = found.text[order], sentence[order]
            new = np.ones(len(order), bool)
            new[1:] = (text[1:] != text[:-1]) | (sentence[1:] != sentence[:-1])
            np.add.at(content, text[new], mix(sentence[new]))
        owner = found.text[found.sentence]
        cut = np.searchsorted(owner, np.arange(batch.num_rows + 1))
        features = [np.unique(found.features[:, a:b]).astype(np.uint32).view(np.int32)
                    for a, b in zip(cut, cut[1:], strict=False)]
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column("doc_id"), "toxic": batch.column("toxic"),
            "content": pa.array(content.view(np.int64)), "features": pa.array(features, pa.list_(pa.int32()))})


def _encode(vocabulary: np.ndarray):
    """Places of the selected features of each document's sentences; equal sentences are merged as in ``fit``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = Sentences(_lower(batch))
            place = np.minimum(np.searchsorted(vocabulary, found.features), len(vocabulary) - 1)
            chosen = vocabulary[place] == found.features
            _, word = np.nonzero(chosen)
            value, sentence = place[chosen].astype("<i4"), found.sentence[word]
            order = np.lexsort((value, sentence))
            value, sentence = value[order], sentence[order]
            alike: list[Counter[bytes]] = [Counter() for _ in range(batch.num_rows)]
            first = np.flatnonzero(np.diff(sentence, prepend=-1))
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(value)], strict=False):
                alike[found.text[sentence[a]]][value[a:b].tobytes()] += 1
            plain = np.bincount(found.text, minlength=batch.num_rows) - np.bincount(
                found.text[sentence[first]], minlength=batch.num_rows)
            for counts, n in zip(alike, plain.tolist(), strict=True):
                counts.update({b"": n} if n else {})
            words = [b"".join(k + np.array([-n], "<i4").tobytes() for k, n in sorted(c.items())) for c in alike]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "words": pa.array(words, pa.binary())})

    return run


def train(documents: DataFrame, labels: DataFrame, max_documents: int = MAX_DOCUMENTS) -> Model:
    """Fit on the labelled documents (doc_id, toxic)."""
    marks = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where(
        "doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    drawn = marks.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(max_documents)
    # At most max_documents ids are sent, and as many documents kept.
    texts = doc_texts(documents).where("text is not null").join(F.broadcast(drawn), "doc_id")
    sample = stored(texts.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")), "llm-labelled")
    described = stored(sample.mapInArrow(
        _describe, "doc_id long, toxic int, content long, features array<int>"), "llm-features-of")
    vocabulary = np.unique(np.array(select(described), np.int32).view(np.uint32).astype(np.int64))
    if not len(vocabulary):
        return Model(np.zeros(0, np.int64), np.zeros(0), -np.inf)
    rows = sorted(described.select("doc_id", "toxic", "content").collect(), key=lambda r: r.doc_id)
    toxic, content = np.array([r.toxic > 0 for r in rows], bool), np.array([r.content for r in rows])
    words = {r.doc_id: np.frombuffer(r.words, "<i4") for r in sample.mapInArrow(
        _encode(vocabulary), "doc_id long, words binary").collect()}
    return fit(vocabulary, [words[r.doc_id] for r in rows], content, toxic)


def _judge(batch: pa.RecordBatch, model: Model) -> tuple[Sentences, np.ndarray, np.ndarray]:
    """Sentences, their logits, and the score of each text."""
    found = Sentences(_lower(batch))
    logit = model.logits(found)
    return found, logit, -np.expm1(-np.bincount(found.text, np.logaddexp(0, logit), batch.num_rows))


def _score(model: Model):
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found, logit, score = _judge(batch, model)
            offending: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            ends: dict[int, list[int]] = {}
            for i in np.flatnonzero(logit > 0).tolist():
                d, k = int(found.text[i]), int(found.number[i])
                if d not in ends:
                    whole = batch.column("text")[d].as_py()
                    ends[d] = [-1, *(m.start() for m in re.finditer(f"[{ENDS}\x01]", whole)), len(whole)]
                offending[d].append({"start": ends[d][k] + 1, "end": ends[d][k + 1],
                                     "score": float(1 / (1 + np.exp(-logit[i])))})
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "score": pa.array(score, pa.float64()),
                "offending": pa.array(offending, kind)})

    return run


def toxicity(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and offending: places (characters start to end) and scores of the offending sentences."""
    return doc_texts(documents).mapInArrow(
        _score(model), "doc_id long, score double, offending array<struct<start:bigint,end:bigint,score:double>>")


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are kept for testing: a third, by a checksum of the id."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def scored(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Train on the labels that are not held out, and score all documents."""
    model = train(documents, labels.where(~held_out(F.col("doc_id"))))
    return toxicity(documents, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "offending")


def without_toxic(documents: DataFrame, model: Model) -> DataFrame:
    """The documents, with all columns, whose score is below the threshold."""

    names = documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = pa.RecordBatch.from_arrays(batch.column("row").flatten(), names)
            yield rows.filter(pa.array(_judge(batch, model)[2] < THRESHOLD))

    ship(documents.sparkSession)
    # Inside one column, names may have any form.
    return documents.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text")).mapInArrow(run, documents.schema)
