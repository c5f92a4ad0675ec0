"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def repeated(documents: list[tuple], window: int) -> list[tuple]:
    """(doc_id, words, removed words, kept words) of rows (doc_id, text)."""
    first: dict[tuple, int] = {}
    for doc_id, text in documents:
        w = words(text)
        for i in range(len(w) - window + 1):
            if doc_id is not None:
                g = tuple(w[i:i + window])
                first[g] = min(first.get(g, doc_id), doc_id)
    out = []
    for doc_id, text in documents:
        w, gone = words(text), set()
        for i in range(len(w) - window + 1):
            if doc_id is not None and first[tuple(w[i:i + window])] < doc_id:
                gone.update(range(i, i + window))
        out.append((doc_id, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


class Union:
    def __init__(self):
        self.up: dict = {}

    def root(self, x):
        while self.up.get(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def shingles(text: str | None, size: int) -> set:
    w = words((text or "").translate(LOWER))
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def near(documents: list[tuple], size: int, percent: int) -> list[tuple]:
    """(doc_id, shingles, component, kept) of rows (doc_id, text); ids that occur twice are one vertex."""
    sets = [(d, shingles(t, size)) for d, t in documents]
    union = Union()
    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            both = len(x & y)
            if None not in (a, b) and both and 100 * both >= percent * (len(x) + len(y) - both):
                union.join(a, b)
    return [(d, len(s), None if d is None else union.root(d), d is None or union.root(d) == d) for d, s in sets]


def repetition(text: str | None) -> dict:
    w = words(text)
    grams = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    inside = {i + j for i in range(len(w) - 4) if grams[tuple(w[i:i + 5])] > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside),
            "base_failed": len(w) < 10 or 100 * len(inside) > 20 * len(w)}


def ngram_share(text: str, size: int) -> float:
    """Share of characters inside n-grams that occur earlier in the text."""
    w, seen, inside = words(text), set(), set()
    for i in range(len(w) - size + 1):
        if tuple(w[i:i + size]) in seen:
            inside.update(range(i, i + size))
        seen.add(tuple(w[i:i + size]))
    return sum(len(w[i]) for i in inside) / max(1, sum(map(len, w)))


def near_vectors(rows: list[tuple], threshold: float) -> list[tuple]:
    """(vec_id, links, component, kept) of rows (vec_id, vector, label)."""
    import numpy as np

    good = [(v, np.array(x, float) / np.abs(x).max(), label) for v, x, label in rows
            if v is not None and label is not None and x and None not in x and np.isfinite(x).all() and any(x)]
    union, links = Union(), defaultdict(int)
    for k, (a, x, p) in enumerate(good):
        for b, y, q in good[:k]:
            if p == q and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                union.join(a, b)
                links[a] += 1
                links[b] += 1
    ok = {v for v, _, _ in good}
    return [(v, links[v] if v in ok else 0, union.root(v), v is None or union.root(v) == v) for v, _, _ in rows]
