"""Packing documents into sequences with a grouping genetic algorithm (operator 7).

Documents become token ids; those longer than a sequence are cut.  Pieces are
dealt to shards of about ``SHARD`` pieces, and each shard is packed on several
*islands*.  A solution is a grouping of pieces into bins.  Crossover injects
well-filled bins of one parent into the other, drops the bins that then hold a
piece twice, and best-fits the displaced pieces.  After each epoch the elite of
an island moves to the next one, as rows of a table.  Bins that are not well
filled, of each shard the emptiest half at most, are opened, and their pieces
are dealt and packed again over all shards, until one shard is left: every level
has half as many, and what one shard leaves open meets the rest of the others.

A shard that already needs no more bins than its tokens (the lower bound) is
not evolved further.

Token ids do not move through shuffles: only lengths are packed.

Defined results: a null or empty text is one piece that holds the end token; repeated
rows are packed one by one; other columns are ignored.
"""

from __future__ import annotations

import math
import random
from bisect import bisect_left, insort
from collections.abc import Iterator
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quadspark.llm.tables import BLANKS, doc_texts, release, stored
from quadspark.llm.words import slices, texts

CAPACITY, END_ID = 4096, 1
SHARD, ISLANDS, EPOCHS, GENERATIONS, POPULATION = 4096, 3, 2, 12, 4
#: Bins with at least this share of their capacity are not opened again.
WELL_FILLED = 0.999
#: Chunks of text whose ids a Python worker remembers.
REMEMBERED, LONG_CHUNK = 1_000_000, 64
#: Bytes of text whose chunks are looked up at once (or one text, if longer), and chunks whose ids are joined at once.
TEXT_BYTES, CHUNKS = 4 << 20, 1 << 20
#: Fixed by the Unicode standard: the only character whose lower case is two characters whatever its neighbours.
DOTTED = "\u0130"

# ---------------------------------------------------------------- tokens


class Encoder:
    """Ids of texts, with the ids of their chunks remembered.

    The tokenizer splits at white space before anything else, and where letters
    meet marks, so the ids of a text are those of its chunks.  A batch's chunks
    are made distinct before they are looked up.  Letters are encoded many words at a time:
    each word is one piece, whose last id carries the vocabulary's end mark.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.chunks: dict[bytes, bytes] = {}
        self.rests: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _encode_words(self, words: list[str]) -> dict[str, bytes]:
        found: dict[str, bytes] = {}
        for at in range(0, len(words), 256):
            some = words[at:at + 256]
            ids = self._ids(" ".join(some))
            stops = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            if len(stops) == len(some):
                raw = ids.tobytes()
                found.update(zip(some, (raw[a:b] for a, b in zip([0, *stops], stops, strict=False)), strict=True))
            else:  # the words do not split as expected
                found.update((w, self._ids(w).tobytes()) for w in some)
        return found

    def _encode_chunks(self, chunks: list[bytes]) -> dict[bytes, bytes]:
        words: dict[bytes, str] = {}
        parts, found, known, rests = [], {}, self.chunks, self.rests
        for chunk in chunks:
            if chunk.isalpha():  # ASCII letters
                words[chunk] = chunk.decode()
                continue
            text = chunk.decode("utf-8", "replace")
            word = text.rstrip(punctuation)
            # The one letter that in lower case is a letter and a mark, which joins the marks that follow.
            if word.isalpha() and DOTTED not in word:
                # ASCII marks behind a word are a piece of their own.
                rest, core = text[len(word):], word.encode()
                if core not in known:
                    words[core] = word
                if rest:
                    parts.append((chunk, core, rest))
                    if rest not in rests:
                        rests[rest] = self._ids(rest).tobytes()
            else:
                found[chunk] = self._ids(text).tobytes()
        ids = self._encode_words(list(words.values()))
        found.update([(core, ids[word]) for core, word in words.items()])
        found.update([(chunk, (found.get(core) or known[core]) + rests[rest]) for chunk, core, rest in parts])
        if len(rests) > REMEMBERED // 10:
            rests.clear()
        return found

    def encode(self, documents: list[bytes]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        chunks, first = _chunks(documents)
        coded = chunks.dictionary_encode()
        place, used = coded.indices.to_numpy(), coded.dictionary.to_pylist()
        known = self.chunks
        new = self._encode_chunks([c for c in used if c not in known])
        if len(known) + len(new) > REMEMBERED:
            kept = {c: known[c] for c in used if c in known}
            known.clear()
            known.update(kept)
        known.update(new)
        ids = [known[c] for c in used]
        for c in [c for c in new if len(c) > LONG_CHUNK]:
            del known[c]
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        start, flat = np.cumsum(size) - size, np.frombuffer(b"".join(ids), "<u4")
        before = np.zeros(len(place) + 1, np.int64)
        np.cumsum(size[place], out=before[1:])
        out = bytearray()
        for a in range(0, len(place), CHUNKS):
            some = place[a:a + CHUNKS]
            many = before[a:a + len(some) + 1]
            shift = np.repeat(start[some] - many[:-1], size[some])
            out += flat[shift + np.arange(many[0], many[-1])].tobytes()
        stops = (4 * before[first]).tolist()
        return [bytes(out[a:b]) for a, b in zip(stops, stops[1:], strict=False)]


#: Kinds of bytes.  A Latin-1 letter is a lead and a tail in UTF-8; both signs for times and division are others.
_BLANK, _ALNUM, _MARK, _QUOTE, _LEAD, _TAIL, _OTHER = range(7)
_KINDS = bytes(
    _BLANK if b in BLANKS else _QUOTE if b == 39 else _ALNUM if b < 128 and chr(b).isalnum() else _MARK if b < 128
    else _LEAD if b == 0xC3 else _TAIL if b < 0xC0 and b not in (0x97, 0xB7) else _OTHER for b in range(256))


def _chunks(documents: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """Chunks with the tokens of the texts, one after the other, and the number of those before each text and at the end.

    Chunks end at white space, and where letters or digits meet ASCII marks, so
    that words repeat more often: there a piece of the tokenizer ends as well,
    but behind an apostrophe, which is one piece with some letters.  Chunks of
    ASCII and Latin-1 letters and marks are in lower case; other characters may
    join a letter to one that has no upper case.  Texts with names of special
    tokens are only split at white space.
    """
    joined = b" ".join([*documents, b""])
    last = np.cumsum(np.fromiter(map(len, documents), np.int64, len(documents)) + 1)
    kind = np.frombuffer(joined.translate(_KINDS), np.uint8)
    tail = kind == _TAIL
    latin = np.zeros(len(kind), bool)
    latin[1:] = tail[1:] & (kind[:-1] == _LEAD)
    other = (kind == _OTHER) | (tail & ~latin)
    alnum, mark = kind == _ALNUM, kind == _MARK
    ends, begins = alnum | latin, alnum.copy()
    begins[:-1] |= latin[1:]
    cut = np.zeros(len(kind), bool)
    cut[1:] = (ends[:-1] & (mark | (kind == _QUOTE))[1:]) | (mark[:-1] & begins[1:])
    for i, text in enumerate(documents):
        if b"<|" in text:
            whole = slice(last[i] - 1 - len(text), last[i] - 1)
            cut[whole], other[whole] = False, kind[whole] != _BLANK
    solid = kind != _BLANK
    cut[1:] |= ~solid[:-1]
    cut[:1] = True
    cut &= solid
    starts = np.flatnonzero(cut)
    stops = np.append(np.flatnonzero(cut[solid]), np.count_nonzero(solid))
    data = np.frombuffer(joined.lower(), np.uint8)[solid]
    if other.any():
        same = np.repeat(np.logical_or.reduceat(other, starts), np.diff(stops))
        data = np.where(same, np.frombuffer(joined, np.uint8)[solid], data)
    chunks = pa.Array.from_buffers(
        pa.binary(), len(starts), [None, pa.py_buffer(stops.astype(np.int32)), pa.py_buffer(data)])
    return chunks, np.append(0, np.searchsorted(starts, last))


_ENCODERS: dict[str, Encoder] = {}


def _pieces(path: str, capacity: int, end_id: int):
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _ENCODERS:
            _ENCODERS[path] = Encoder(path)
        encoder = _ENCODERS[path]
        size = 4 * capacity
        for batch in slices(batches, "text", TEXT_BYTES):
            rows = [(i, at, ids[at:at + size]) for i, ids in enumerate(x + end for x in encoder.encode(texts(batch)))
                    for at in range(0, len(ids), size)]
            owner, at, ids = zip(*rows, strict=True)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id").take(pa.array(owner)),
                "piece": pa.array([a // size for a in at], pa.int32()),
                "start": pa.array([a // 4 for a in at], pa.int64()), "ids": pa.array(ids, pa.binary())})

    return run


def token_pieces(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start (ids of the document before it) and ids (little-endian unsigned 32-bit numbers)."""
    return doc_texts(documents).mapInArrow(
        _pieces(tokenizer, capacity, end_id), "doc_id long, piece int, start long, ids binary")


# ---------------------------------------------------------------- evolution


class Packing:
    """A grouping of pieces into bins; ``size`` has the pieces' lengths."""

    def __init__(self, size: list[int], capacity: int):
        self.size, self.capacity = size, capacity
        self.bins: list[list[int]] = []

    def fills(self) -> list[int]:
        return [sum(self.size[i] for i in b) for b in self.bins]

    def score(self) -> tuple[int, int]:
        """Fewer bins are better, then fuller ones."""
        return -len(self.bins), sum(f * f for f in self.fills())

    def best_fit(self, pieces: list[int]) -> Packing:
        """Put each piece into the bin that it leaves the least space in."""
        space = sorted((self.capacity - f, b) for b, f in enumerate(self.fills()))
        for i in pieces:
            at = bisect_left(space, (self.size[i], -1))
            if at < len(space):
                left, b = space.pop(at)
                self.bins[b].append(i)
            else:
                left, b = self.capacity, len(self.bins)
                self.bins.append([i])
            insort(space, (left - self.size[i], b))
        return self

    def child(self, other: Packing, rng: random.Random) -> Packing:
        """This grouping with well-filled bins of the other one."""
        fills = other.fills()
        order = sorted(range(len(fills)), key=lambda b: (-fills[b], b))
        chosen = [other.bins[b] for b in order[: max(1, len(order) // 2)] if rng.random() < 0.5]
        taken = {i for b in chosen for i in b}
        out = Packing(self.size, self.capacity)
        out.bins = [list(b) for b in chosen]
        displaced = []
        for b in self.bins:
            if taken.isdisjoint(b):
                out.bins.append(list(b))
            else:
                displaced += [i for i in b if i not in taken]
        # Mutation: the emptiest bins are opened as well.
        left = out.fills()
        for b in sorted(sorted(range(len(left)), key=lambda b: (left[b], b))[:2], reverse=True):
            displaced += out.bins.pop(b)
        return out.best_fit(sorted(displaced, key=lambda i: (-self.size[i], i)))


def _start(size: list[int], capacity: int, seed: int) -> list[Packing]:
    """Best fit by decreasing length, and by slightly shuffled lengths."""
    rng = random.Random(seed)
    order = sorted(range(len(size)), key=lambda i: (-size[i], i))
    first = Packing(size, capacity).best_fit(order)
    if len(first.bins) == math.ceil(sum(size) / capacity):
        return [first]
    noisy = [sorted(order, key=lambda i: -size[i] * rng.uniform(0.85, 1)) for _ in range(POPULATION - 1)]
    return [first, *(Packing(size, capacity).best_fit(o) for o in noisy)]


def _from_bins(size: list[int], capacity: int, bins: list[int]) -> Packing:
    out = Packing(size, capacity)
    out.bins = [[] for _ in range(max(bins) + 1)]
    for i, b in enumerate(bins):
        out.bins[b].append(i)
    return out


def evolve(size: list[int], capacity: int, seed: int, elites: list[list[int]] = ()) -> tuple[list[int], int, int]:
    """The best grouping found, as the bin of each piece, its number of bins and its fullness.

    elites: groupings to start from, beside the seeded ones.
    """
    population = [_from_bins(size, capacity, e) for e in elites] or _start(size, capacity, seed)
    least = math.ceil(sum(size) / capacity)
    rng = random.Random(seed + 1)
    if len(population) == 1 and len(population[0].bins) > least:
        population += _start(size, capacity, seed)
    scored = sorted(((p.score(), n, p) for n, p in enumerate(population)), reverse=True)
    for n in range(GENERATIONS):
        if -scored[0][0][0] <= least:
            break
        a, b = rng.sample(range(len(scored)), 2)
        new = scored[a][2].child(scored[b][2], rng)
        scored = sorted([*scored, (new.score(), len(population) + n, new)], reverse=True)[:POPULATION]
    (bins, fullness), _, best = scored[0]
    out = [0] * len(size)
    for b, pieces in enumerate(best.bins):
        for i in pieces:
            out[i] = b
    return out, -bins, fullness


def _islands(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                bins, count, fullness = evolve(row["size"], capacity, 1000 * row["shard"] + row["island"], row["elites"])
                yield pa.RecordBatch.from_pylist([{**row, "bins": bins, "count": count, "fullness": fullness}], pa.schema(
                    [("shard", pa.int64()), ("island", pa.int32()), ("bins", pa.list_(pa.int32())),
                     ("count", pa.int64()), ("fullness", pa.int64())]))

    return run


def _evolved(shards: DataFrame, n: int, capacity: int) -> DataFrame:
    """The best grouping of each shard, after all epochs and migrations."""
    kind = "shard long, island int, bins array<int>, count long, fullness long"
    # A number of its own: by their few bytes, shards would be put into one task.
    tasks = max(math.ceil(n * ISLANDS / 8), min(n * ISLANDS, shards.sparkSession.sparkContext.defaultParallelism))
    islands = shards.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))))
    start = islands.withColumn("elites", F.expr("cast(array() as array<array<int>>)"))
    elite = None
    for epoch in range(EPOCHS):
        if elite is not None:
            moved = elite.select("shard", F.expr(f"(island + 1) % {ISLANDS}").alias("island"), F.col("bins").alias("migrant"))
            own = elite.select("shard", "island", F.col("bins").alias("own"))
            start = islands.join(own, ["shard", "island"]).join(moved, ["shard", "island"]).withColumn(
                "elites", F.array_distinct(F.array("own", "migrant")))
        work = start.select("shard", "island", "size", "elites").repartition(tasks, "shard", "island")
        elite = stored(work.mapInArrow(_islands(capacity), kind), f"llm-epoch{epoch}")
    return elite.groupBy("shard").agg(F.max_by(
        "bins", F.struct(-F.col("count"), "fullness", -F.col("island"))).alias("bins"))


def pack(pieces: DataFrame, length: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """Give every row a place: sequence_id and offset are added to its columns.

    Lengths are from 1 to the capacity.
    """
    spark = pieces.sparkSession
    columns = pieces.columns
    full = pieces.where(F.col(length) == capacity)
    out = [full.select(*columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"))]
    rest = stored(pieces.where(F.col(length) < capacity), "llm-rest")
    count = rest.count()
    level = 1
    while count:
        n = math.ceil(count / SHARD)
        # The rest is a table, so rows have the same number in every run of a task.
        dealt = rest.withColumn("_row", F.monotonically_increasing_id()).withColumn(
            "_shard", F.pmod(F.xxhash64("_row"), F.lit(n)))
        items = F.array_sort(F.collect_list(F.struct(F.col(length).alias("_size"), "_row", *columns)))
        shards = stored(dealt.groupBy(F.col("_shard").alias("shard")).agg(items.alias("items")).withColumn(
            "size", F.col("items._size")), "llm-shards")
        best = _evolved(shards.select("shard", "size"), n, capacity)
        placed = shards.join(best, "shard").select("shard", F.explode(F.arrays_zip("items", "bins")).alias("x"))
        placed = placed.select(*(F.col(f"x.items.{c}").alias(c) for c in columns), F.col("x.bins").alias("_bin"),
                               F.col("shard").alias("_shard"))
        placed = stored(placed, "llm-placed")
        release(spark)
        fill = placed.groupBy("_shard", "_bin").agg(F.sum(length).alias("_fill"))
        emptiest, shard = Window.partitionBy("_shard").orderBy("_fill", "_bin"), Window.partitionBy("_shard")
        ranked = fill.withColumns({"_rank": F.row_number().over(emptiest), "_of": F.count("*").over(shard)})
        open_bins = stored(ranked.where((F.col("_fill") < WELL_FILLED * capacity) & (F.col("_rank") * 2 <= F.col("_of"))).select(
            "_shard", "_bin"), "llm-open")
        opened = placed.join(open_bins, ["_shard", "_bin"], "left_semi").select(*columns)
        left = 0 if n == 1 else opened.count()
        done = placed.join(open_bins, ["_shard", "_bin"], "left_anti") if left else placed
        # A shard has fewer than 2**16 bins.
        number = F.lit(level << 48) + F.shiftleft("_shard", 16) + F.col("_bin")
        out.append(done.select(*columns, number.alias("sequence_id")))
        rest, count, level = (stored(opened, "llm-rest") if left else rest), left, level + 1
    merged = out[0]
    for more in out[1:]:
        merged = merged.unionByName(more)
    # A sequence holds at most as many pieces as tokens.
    before = Window.partitionBy("sequence_id").orderBy(*columns).rowsBetween(Window.unboundedPreceding, -1)
    return merged.withColumn("offset", F.coalesce(F.sum(length).over(before), F.lit(0)).cast("long"))


def packed(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Every piece's doc_id, piece, start, length, ids_crc32, sequence_id and offset."""
    pieces = token_pieces(documents, tokenizer, capacity, end_id).select(
        "doc_id", F.col("piece").cast("int"), "start", (F.length("ids") / 4).cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"))
    return pack(stored(pieces, "llm-pieces"), capacity=capacity)
