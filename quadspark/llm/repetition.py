"""Quality rules on repetition (operator 9).

Rolling hashes of n-grams of several lengths measure how many characters of a
text lie inside n-grams that occur earlier in it, and inside lines that repeat
an earlier one.  A text is judged alone, so the work is one pass without a shuffle.

Defined results: a null or empty text has no words and fails the base rule; a
null ``doc_id`` is kept as it is; repeated rows are judged one by one; columns
other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadspark.llm.tables import doc_texts
from quadspark.llm.words import Words, covered, per_text, slices, texts

#: Length of n-grams in words -> largest share of characters inside those that occur earlier.
#: Fixed values of published quality rules.
NGRAM_LIMITS = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Largest share of characters in lines that repeat an earlier one.
LINE_CHARS_LIMIT = 0.20
MIN_WORDS, REPEAT_WINDOW, REPEAT_PERCENT = 10, 5, 20
SYMBOLS = b"#*$%&|<>"

_BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
#: Bytes that begin a character, other than white space.
_CHARACTER = (np.arange(256) & 0xC0 != 0x80) & ~_BLANK
_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))


def repeated_starts(words: Words, size: int, among: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the n-grams that occur twice or more in their text, and of those that occur earlier in it."""
    start = words.windows(size)
    if among is not None:  # what is repeated begins with what is repeated one word shorter
        start = start[among[start]]
    if not len(start):
        return start, start
    key = words.runs(start, start + size)
    order = np.lexsort((key, words.text[start]))
    same = (key[order][1:] == key[order][:-1]) & (words.text[start][order][1:] == words.text[start][order][:-1])
    later = np.zeros(len(start), bool)
    later[order[1:]] = same  # the order keeps equal ones in place
    twice = later.copy()
    twice[order[:-1]] |= same
    return start[twice], start[later]


def _lines(text: bytes) -> tuple[int, int, int]:
    """Lines that repeat an earlier one, the characters of lines with a word, and those of the repeats."""
    seen: set[bytes] = set()
    repeats = chars = repeated_chars = 0
    for line in text.split(b"\n"):
        if line.strip():
            size = len(line) if line.isascii() else len(line.decode("utf-8", "replace"))
            chars += size
            if line in seen:
                repeats += 1
                repeated_chars += size
            seen.add(line)
    return repeats, chars, repeated_chars


def measure(batch: pa.RecordBatch) -> pa.RecordBatch:
    documents = texts(batch)
    words = Words(documents)
    joined = np.frombuffer(b"\n".join(documents), np.uint8)
    begin = np.concatenate([[0], np.cumsum([len(d) + 1 for d in documents])])
    begin[-1] -= 1
    characters = np.concatenate([[0], np.cumsum(_CHARACTER[joined])])
    symbols = per_text(begin, _SYMBOL[joined])
    blank = np.concatenate([[True], _BLANK[joined], [True]])
    size = characters[np.flatnonzero(~blank[:-1] & blank[1:])] - characters[np.flatnonzero(blank[:-1] & ~blank[1:])]
    chars = per_text(words.first, size)

    n, among = len(words.hash), None
    out: dict[str, np.ndarray] = {}
    for length in sorted({REPEAT_WINDOW, *NGRAM_LIMITS}):
        start, later = repeated_starts(words, length, among)
        if length == REPEAT_WINDOW:
            repeat_words = per_text(words.first, covered(n, start, start + length))
        if length in NGRAM_LIMITS:
            inside = covered(n, later, later + length)
            out[f"dup_{length}gram_share"] = per_text(words.first, size * inside) / np.maximum(chars, 1)
        among = np.zeros(n, bool)
        among[start] = True
    lines = np.array([_lines(d) for d in documents], np.int64).reshape(-1, 3)
    out["dup_line_chars_share"] = lines[:, 2] / np.maximum(lines[:, 1], 1)
    base = {"n_words": words.count, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": lines[:, 0],
            "n_repeat_words": repeat_words}
    return pa.RecordBatch.from_pydict({
        "doc_id": batch.column("doc_id"), **{k: pa.array(v, pa.int64()) for k, v in base.items()},
        **{k: pa.array(v, pa.float64()) for k, v in out.items()}})


def repetition(documents: DataFrame) -> DataFrame:
    """Counts and shares of every text, and the verdict.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    the share of characters inside repeated n-grams of each length, that of
    characters in repeated lines, base_failed and kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return map(measure, slices(batches, "text"))

    shares = [*(f"dup_{n}gram_share" for n in NGRAM_LIMITS), "dup_line_chars_share"]
    limits = [*NGRAM_LIMITS.values(), LINE_CHARS_LIMIT]
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    source = doc_texts(documents)
    measured = source.mapInArrow(run, "doc_id long, " + ", ".join(
        [*(f"{c} long" for c in counts), *(f"{c} double" for c in shares)]))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    passed = ~failed
    for share, limit in zip(shares, limits, strict=True):
        passed = passed & (F.col(share) <= limit)
    return measured.withColumns({"base_failed": failed, "kept": passed})
