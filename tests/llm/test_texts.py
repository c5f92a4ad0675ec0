"""Substring dedup, near duplicates and repetition rules against brute force."""

import random

from llm import brute
from pyspark.sql import functions as F

from quadspark.llm.forest import near_duplicates
from quadspark.llm.repetition import repetition
from quadspark.llm.substring import cut_repeats, remove_repeats, removed_words, repeated_windows

EDGES = [(100, None), (101, ""), (102, " \t\n\x0b\x0c\r "), (103, "one"), (104, "a b\x1cc É ß"), (None, "no id at all"),
         (None, None), (105, "Same words here\nSame words here"), (105, "Same words here\nSame words here")]


def copies(prose, seed=1):
    """Texts with shared passages, near copies of several degrees, and exact copies."""
    rng = random.Random(seed)
    passage = prose("passage", 70)
    rows = []
    for i in range(12):
        rows.append((i, f"{prose(i, 40)} {passage} {prose(-i - 1, 30)}" if i % 3 == 0 else prose(i, 90)))
    for i in range(40):
        words = rows[5][1].split()
        for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(9)}"
        rows.append((20 + i, " ".join(words)))
    rows.append((90, rows[1][1] + "  \n" + rows[1][1]))
    rng.shuffle(rows)
    return rows + EDGES


def test_substring(documents, prose):
    rows = copies(prose) + [(200, prose("long", 60_000, 10**6)), (201, prose("long", 60_000, 10**6)[:300_000])]
    found = remove_repeats(documents(rows), window=50).select("doc_id", "n_words", removed_words().alias("n"), "kept_text")
    assert sorted(map(tuple, found.collect()), key=str) == sorted(brute.repeated(rows, 50), key=str)


def test_substring_short_windows(documents):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(25)))) for i in range(60)]
    found = remove_repeats(documents(rows), window=6, anchor=2).select("doc_id", "n_words", removed_words().alias("n"), "kept_text")
    assert sorted(map(tuple, found.collect())) == sorted(brute.repeated(rows, 6))


def test_one_id_with_several_texts(documents, prose):
    """A row is no reference to rows of its own id, and spans go to the text they belong to."""
    rows = [(1, prose(1, 80)), (1, prose(2, 80)), (2, prose(2, 80)), (2, prose(3, 80)), (2, prose(1, 60))]
    found = remove_repeats(documents(rows), window=50).select("doc_id", "n_words", removed_words().alias("n"), "kept_text")
    assert sorted(map(tuple, found.collect())) == sorted(brute.repeated(rows, 50))


def test_many_equal_rows_cost_as_much_as_their_number(documents, prose):
    """Lists of windows do not multiply by the copies of a row."""
    text, other = prose("a", 300), prose("b", 300)
    rows = [(1, f"{other} {text[:900]}")] + [(2, f"{text} {other[:900]}")] * 60
    found = remove_repeats(documents(rows), window=50).select("doc_id", "n_words", removed_words().alias("n"), "kept_text")
    assert sorted(map(tuple, found.collect())) == sorted(brute.repeated(rows, 50))
    lists = repeated_windows(documents(rows), window=50)
    assert max(len(r.found) for r in lists.collect()) <= 600


def test_cut_keeps_columns_and_white_space(documents, prose):
    passage = prose("p", 50)
    rows = [(1, passage), (2, f"First  line\n{passage}\n\tlast line"), (3, passage), (4, None), (5, "  ")]
    given = documents(rows)
    cut = cut_repeats(given, window=50)
    assert cut.schema == given.schema
    assert {r.doc_id: r.text for r in cut.collect()} == {1: passage, 2: "First  line\nlast line", 4: None, 5: "  "}


def test_near_duplicates(documents, prose):
    rows = copies(prose)
    for size, percent in ((3, 85), (5, 80)):
        found = near_duplicates(documents(rows), size, percent).collect()
        assert sorted(map(tuple, found), key=str) == sorted(brute.near(rows, size, percent), key=str)


def test_near_duplicates_in_a_dense_group(documents, prose):
    """Chains of copies whose ends are not similar, in one region."""
    rng = random.Random(5)
    base = prose("base", 120).split()
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(rng.randrange(7)):
            words[rng.randrange(len(words))] = f"y{rng.randrange(1000)}"
        rows.append((i, " ".join(words)))
    found = near_duplicates(documents(rows), 3, 85).collect()
    want = brute.near(rows, 3, 85)
    assert len({r[2] for r in want}) > 3
    assert sorted(map(tuple, found)) == sorted(want)


def test_repetition(documents, prose):
    rows = copies(prose) + [(300, "\n".join(["the same line again"] * 6 + ["another line # | *"])),
                            (301, prose("long", 30_000, 50))]
    found = {(r.doc_id, r.n_words): r for r in repetition(documents(rows)).collect()}
    for doc_id, text in rows:
        r = found[doc_id, len(brute.words(text))]
        want = brute.repetition(text)
        assert {k: r[k] for k in want} == want
        assert not (r.kept and r.base_failed)
        for size in (5, 7, 10):
            assert abs(r[f"dup_{size}gram_share"] - brute.ngram_share(text or "", size)) < 1e-12
    assert not found[300, 29].kept and found[5, 90].kept


def test_empty_tables(documents):
    empty = documents([(1, "x")]).where("doc_id = 2")
    assert remove_repeats(empty).count() == near_duplicates(empty).count() == repetition(empty).count() == 0
    assert cut_repeats(empty).count() == 0


def test_types(documents):
    found = remove_repeats(documents([(1, "x")])).select(removed_words().alias("n"), F.sha2("kept_text", 256).alias("s"))
    assert [t for _, t in found.dtypes] == ["bigint", "string"]
