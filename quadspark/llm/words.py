"""Words of texts as arrays of hashes, and hashes of runs of words.

A word is a maximal run of bytes other than space and 0x09-0x0D, which is what
``bytes.split`` gives.  All functions work on Arrow batches inside a task.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from xxhash import xxh3_64_intdigest

#: Bytes of text that are in numpy arrays at once (or one text, if longer).
SLICE_BYTES = 1 << 20
#: Odd multiplier of run hashes, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in pieces whose texts have about ``limit`` bytes."""
    for batch in batches:
        lengths = np.asarray(pc.binary_length(batch.column(column)).fill_null(0)) + 64
        piece = np.cumsum(lengths) // limit
        cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [x or b"" for x in batch.column(column).cast(pa.binary()).to_pylist()]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of several texts, one after the other."""

    def __init__(self, documents: list[bytes]):
        found = [d.split() for d in documents]
        #: Words of each text, and the index of its first; one entry more at the end.
        self.count = np.fromiter(map(len, found), np.int64, len(found))
        self.first = np.concatenate([[0], np.cumsum(self.count)])
        total = int(self.first[-1])
        self.hash = np.fromiter((xxh3_64_intdigest(w) for d in found for w in d), np.uint64, total)
        #: The text that each word belongs to.
        self.text = np.repeat(np.arange(len(found)), self.count)
        powers = np.full(total + 1, BASE, np.uint64)
        powers[0] = 1
        self._power = np.cumprod(powers)
        inverses = np.full(total, INVERSE, np.uint64)
        inverses[:1] = 1
        self._sum = np.zeros(total + 1, np.uint64)
        np.cumsum(self.hash * np.cumprod(inverses), out=self._sum[1:])

    def runs(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the words from start up to end, wherever they stand."""
        return mix((self._sum[end] - self._sum[start]) * self._power[start] + (end - start).astype(np.uint64))

    def windows(self, size: int) -> np.ndarray:
        """Starts of all windows of so many words that lie within one text."""
        start = np.arange(max(0, len(self.hash) - size + 1))
        return start[self.text[start] == self.text[start + size - 1]] if len(start) else start


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[: len(x) - have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def covered(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which of n places lie in one of the ranges."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, start, 1)
    np.subtract.at(change, end, 1)
    return np.cumsum(change[:-1]) > 0


def per_text(first: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sum of the values of each text's words."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]
