"""Packing, mixing, sharding, toxicity and the pipeline."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm import brute
from llm.conftest import make_documents

from quadspark.llm import mixing, packing, sharding, toxicity
from quadspark.llm.queries import tokenizer_path

EDGES = [(100, None, None), (101, "", "b"), (102, " \n ", "b"), (None, "no id", "a"), (103, "same", "c"), (103, "same", "c")]


# ---------------------------------------------------------------- packing


def test_tokens_are_the_tokenizers(spark, documents):
    from tokenizers import Tokenizer

    odd = ["Don't STOP, it's 42nd... ok?!", "É è\u0301 ß straße ÀÉ, Œuvre.", "a\u00a0b\u2003c\x1cd\x85e", "<|endoftext|> x<|startoftext|>y",
           "naïve,. ,., ...,word. Σας ΟΔΟΣ. ", "İstanbul DŽ ﬁ Å \u212b", "word" * 500, "漢字かな交じり 한국어", "\x01 \x01a", "x" * 70 + ",",
           "İ, İ| İ__ BELGESİ, İ. xİ! Aİb,"]
    rng = random.Random(1)
    rows = [(i, t) for i, t in enumerate(odd)] + [(50 + i, " ".join(rng.choice(odd)[:rng.randrange(30)] for _ in range(40))) for i in range(60)]
    rows += [(300, "many words " * 9000)] + [r[:2] for r in EDGES]
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        want.update((doc_id, k // 4096, k, np.array(ids[k:k + 4096], "<u4").tobytes()) for k in range(0, len(ids), 4096))
    found = packing.token_pieces(documents(rows), tokenizer_path()).collect()
    assert Counter((r.doc_id, r.piece, r.start, bytes(r.ids)) for r in found) == want


def test_remembered_chunks_are_bounded(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 20)
    encoder = packing.Encoder(tokenizer_path())
    texts = [" ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)} Same, 7{i}" for i in range(k, k + 30)).encode() for k in range(0, 300, 10)]
    for at in range(0, 30, 5):
        got = encoder.encode(texts[at:at + 5])
        assert got == [np.array(encoder.tokenizer.encode(t.decode(), add_special_tokens=False).ids, "<u4").tobytes() for t in texts[at:at + 5]]
        assert len(encoder.chunks) <= 20 + 150


def test_marks_do_not_make_other_words():
    """Words are remembered once, whatever ASCII marks stand around them; the ids stay the tokenizer's."""
    encoder = packing.Encoder(tokenizer_path())
    texts = ["Alpha! alpha? (alpha) alpha-alpha, \"ALPHA\".", "été! (Été) été-alpha; alpha", "", " \n", "don't 'alpha' !'s 5's x'alpha"]
    assert encoder.encode([t.encode() for t in texts]) == [
        np.array(encoder.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert {c for c in encoder.chunks if b"alpha" in c.lower()} == {b"alpha", b"'alpha"}
    assert encoder.encode([]) == []


def test_ids_at_marks_are_the_tokenizers():
    """Any mix of letters, marks, joining characters, apostrophes and names of special tokens."""
    encoder, rng = packing.Encoder(tokenizer_path()), random.Random(3)
    parts = [*"JjIsStTrReEHwW'''.,;!-_(|<>9 \n\x1c\x00éÉß×÷İſ’漢я", "\u0301", "\u030c", "\u0331", "\u0338", "\u00a0", "\u037e", "\u212a",
             "<|endoftext|>", "<|ENDOFTEXT|>", "it's", "word", "Word,", "J\u030c"]
    for _ in range(100):
        some = rng.sample(parts, 12)
        texts = ["".join(rng.choices(some, k=rng.randrange(30))) for _ in range(20)]
        assert encoder.encode([t.encode() for t in texts]) == [
            np.array(encoder.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def places(rows):
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for members in sequences.values():
        end = 0
        for offset, length in sorted(members):
            assert offset == end
            end += length
    return sequences


@pytest.mark.parametrize("kind", ["small", "mixed", "large", "equal"])
def test_packing(spark, monkeypatch, kind):
    monkeypatch.setattr(packing, "SHARD", 60)
    rng = random.Random(kind)
    draw = {"small": lambda: rng.randrange(1, 30), "mixed": lambda: rng.choice([100, 60, 41, 34, 26, rng.randrange(1, 101)]),
            "large": lambda: rng.randrange(51, 101), "equal": lambda: 34}[kind]
    rows = [(i // 2, 0, draw()) for i in range(400)]
    table = spark.createDataFrame(rows, "doc_id long, shard int, length long").repartition(3)
    found = packing.pack(table, capacity=100).collect()
    sequences = places(found)
    assert Counter((r.doc_id, r.shard, r.length) for r in found) == Counter(rows)
    assert max(sum(n for _, n in m) for m in sequences.values()) <= 100
    # Shards of 60 pieces against best fit by decreasing length over all pieces at once.
    size = sorted((r[2] for r in rows), reverse=True)
    whole = len(packing.Packing(size, 100).best_fit(list(range(400))).bins)
    assert len(sequences) <= whole * 1.03 + 1
    if kind == "small":
        assert len(sequences) <= math.ceil(sum(size) / 100) + 1


def test_evolution_improves_and_keeps_pieces():
    rng = random.Random(4)
    size = [rng.choice([60, 50, 40, 35, 30, 25, 20, 15]) for _ in range(200)]
    first = packing.Packing(size, 100).best_fit(sorted(range(200), key=lambda i: -size[i]))
    bins, count, _ = packing.evolve(size, 100, 7)
    assert count <= len(first.bins) and len(set(bins)) == count
    fills = Counter()
    for i, b in enumerate(bins):
        fills[b] += size[i]
    assert max(fills.values()) <= 100
    again = packing.evolve(size, 100, 9, [bins, packing.evolve(size, 100, 8)[0]])
    assert again[1] <= count


def test_crossover_places_every_piece_once():
    rng = random.Random(5)
    size = [rng.randrange(5, 60) for _ in range(80)]
    a = packing.Packing(size, 100).best_fit(list(range(80)))
    b = packing.Packing(size, 100).best_fit(list(range(79, -1, -1)))
    child = a.child(b, rng)
    assert sorted(i for x in child.bins for i in x) == list(range(80)) and max(child.fills()) <= 100


def test_nothing_to_pack(documents):
    empty = documents([(1, "x")]).where("doc_id = 2")
    assert packing.packed(empty, tokenizer_path()).count() == 0


# ---------------------------------------------------------------- mixing


def test_targets():
    assert mixing.targets([100, 100, 100], (5, 2, 1)) == [200.0, 500 / 3, 250 / 3]
    assert mixing.targets([], (5,)) == [] and mixing.targets([0, 0], (1,)) == [0.0, 0.0]
    for seed in range(30):
        rng = random.Random(seed)
        sizes = [rng.randrange(50) for _ in range(9)]
        want = mixing.targets(sizes)
        assert abs(sum(want) - 1.5 * sum(sizes)) < 1e-6 and all(w <= 2 * s + 1e-9 for w, s in zip(want, sizes, strict=True))


def least_repetition(capacity, members, quota, repeats):
    """By brute force on small numbers: the least number of repeated words of a largest flow."""
    import itertools

    best = None
    choices = [[c for c in itertools.product(range(repeats * cap + 1), repeat=len(m)) if sum(c) <= repeats * cap]
               for cap, m in zip(capacity, members, strict=True)]
    for flows in itertools.product(*choices):
        got = [0] * len(quota)
        for m, f in zip(members, flows, strict=True):
            for s, x in zip(m, f, strict=True):
                got[s] += x
        if all(g <= q for g, q in zip(got, quota, strict=True)):
            again = sum(max(0, sum(f) - c) for f, c in zip(flows, capacity, strict=True))
            key = (-sum(got), again)
            best = key if best is None else min(best, key)
    return best


@pytest.mark.parametrize("seed", range(12))
def test_flow_is_largest_and_repeats_least(seed):
    rng = random.Random(seed)
    members = [[0], [1], [0, 1]][: rng.randrange(1, 4)]
    capacity = [rng.randrange(4) for _ in members]
    quota = [rng.randrange(7), rng.randrange(7)]
    flow = mixing.route(capacity, members, quota, 2)
    total = sum(sum(f.values()) for f in flow)
    again = sum(max(0, sum(f.values()) - c) for f, c in zip(flow, capacity, strict=True))
    assert (-total, again) == least_repetition(capacity, members, quota, 2)


def sample_rows(prose):
    rng = random.Random(6)
    rows = [(i, prose(i, rng.choice([0, 1, 5, 40, 90])), rng.choice("aaabcd")) for i in range(90)]
    return rows + [(200 + i, "null source text", None) for i in range(4)] + EDGES


def test_mix(spark, documents, prose):
    from pyspark.sql import functions as F

    rows = sample_rows(prose)
    runs = [sorted(map(str, mixing.mix(documents(rows), F.array("source")).collect())) for _ in range(2)]
    assert runs[0] == runs[1]
    found = mixing.mix(documents(rows), F.array("source")).collect()
    assert len(found) == len(rows)
    size, taken, target = Counter(), Counter(), {}
    for r in found:
        (t,) = r.takes
        assert 0 <= r.taken <= 2 * r.size and t.words == r.taken and t.source == r.sources[0]
        size[t.source] += r.size
        taken[t.source] += r.taken
        target[t.source] = t.target
        assert t.source_size == sum(len(brute.words(x[1])) for x in rows if x[2] == t.source)
    names = sorted(size, key=lambda s: (s is None, s or ""))
    assert [target[s] for s in names] == mixing.targets([size[s] for s in names])
    assert all(abs(taken[s] - target[s]) <= 0.5 for s in names)


def test_mix_of_overlapping_sources(spark, documents, prose):
    from pyspark.sql import functions as F

    rows = [(i, prose(i, 50), random.Random(i).choice(["a", "b", "a,b"])) for i in range(60)]
    found = mixing.mix(documents(rows), F.split("source", ","), weights=(1, 3)).collect()
    got, target = Counter(), {}
    for r in found:
        assert r.taken == sum(t.words for t in r.takes) <= 2 * r.size
        for t in r.takes:
            got[t.source] += t.words
            target[t.source] = t.target
    # As much as the largest flow: overlapping sources may not all reach their targets.
    capacity = Counter()
    for r in found:
        capacity["".join(r.sources)] += r.size
    flow = mixing.route(list(capacity.values()), [["ab".index(s) for s in p] for p in capacity], [round(target[s]) for s in "ab"])
    assert sum(got.values()) == sum(sum(f.values()) for f in flow)
    assert all(got[s] <= target[s] + 1 for s in got)


def test_mixed_texts(spark, documents, prose):
    from pyspark.sql import functions as F

    rows = sample_rows(prose)
    given = documents(rows)
    out = mixing.mixed(given, F.array("source"))
    assert out.columns == given.columns
    taken = {}
    for r in mixing.mix(given, F.array("source")).collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    words = Counter()
    for r in out.collect():
        words[r.doc_id] += len(brute.words(r.text))
        assert r.n_chars == len(r.text)
    assert words == Counter({k: v for k, v in taken.items() if v})
    assert mixing.mixed(given.where("doc_id = -1"), F.array("source")).count() == 0


def test_texts_of_one_id_and_length_keep_their_order(documents):
    from pyspark.sql import functions as F

    rows = [(1, f"{a}{b} {b}{a}", "s" if a < "c" else "t" if a < "f" else "u") for a in "abcdefgh" for b in "abcdefgh"]
    runs = []
    for given in (rows, rows[::-1], sorted(rows, key=lambda r: r[1][::-1])):
        out = mixing.mixed(documents(given).repartition(len(runs) + 1), F.array("source"))
        runs.append(sorted((r.text, r.source) for r in out.collect()))
    assert runs[0] == runs[1] == runs[2]
    assert any(len(text) == 2 for text, _ in runs[0])  # one text was cut


def test_too_many_patterns(documents, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(mixing, "MAX_PATTERNS", 2)
    with pytest.raises(ValueError, match="patterns"):
        mixing.mix(documents([(i, "x", str(i)) for i in range(3)]), F.array("source"))


# ---------------------------------------------------------------- sharding


@pytest.mark.parametrize("form", ["null ids", "one id", "equal rows"])
def test_hot_ids_are_spread(documents, form):
    """A third of all rows without an id, with one id, or equal: shards stay alike."""
    hot = {"null ids": lambda i: (None, f"text {i}"), "one id": lambda i: (5, f"text {i}"), "equal rows": lambda i: (5, "one text")}[form]
    rows = [(1000 + i, f"document {i % 100:03}") for i in range(2000)] + [hot(i) for i in range(1000)]
    found = sharding.shard(documents(rows), shards=7, slots=128).collect()
    assert Counter((r.doc_id, r.size) for r in found) == Counter((d, len(t) + 8) for d, t in rows)
    loads = Counter()
    for r in found:
        loads[r.shard] += r.size
    assert max(loads.values()) < 1.1 * min(loads.values())
    for shard in loads:
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(sum(r.shard == shard for r in found)))


def test_sharding(documents, prose):
    rows = [(i, prose(i, i % 70), "s") for i in range(600)] + EDGES
    found = sharding.shard(documents(rows), shards=7, slots=128).collect()
    want = Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, _ in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in found) == want
    by = defaultdict(list)
    for r in found:
        by[r.shard].append(r)
    assert sorted(by) == list(range(7))
    assert all(sorted(r.slot for r in m) == list(range(len(m))) for m in by.values())
    totals = [sum(r["size"] for r in m) for m in by.values()]
    assert max(totals) - min(totals) <= 0.05 * sum(totals) / 7
    assert sharding.shard(documents(rows).where("doc_id = -1")).count() == 0


def test_map_versions(spark, documents, prose, place):
    docs = documents([(i, prose(i, 30), "s") for i in range(500)])
    records = sharding.sized(docs, 256)
    sizes = sharding.slot_bytes(records)
    path = f"{place}/map"
    sharding.shard(docs, 4, 256, path)
    old = sharding.load_map(spark, path)
    sharding.save_map(sharding.grow(old, sizes, 4), path)
    before = {r.vslot: r.shard for r in sharding.load_map(spark, path, 1).collect()}
    after = {r.vslot: r.shard for r in sharding.load_map(spark, path).collect()}
    assert before.keys() == after.keys() == set(range(256))
    moved = {v for v in before if before[v] != after[v]}
    assert moved and all(after[v] == 4 for v in moved)
    load = Counter()
    for r in sizes.collect():
        load[after[r.vslot]] += r.bytes
    assert max(load.values()) - min(load.values()) < 0.2 * sum(load.values()) / 5


# ---------------------------------------------------------------- toxicity


def labelled(spark, n, seed=0):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        sentences = [" ".join(f"w{rng.randrange(300)}" for _ in range(8)) for _ in range(rng.randrange(1, 9))]
        toxic = rng.random() < 0.25
        if toxic:
            at = rng.randrange(len(sentences))
            sentences[at] += rng.choice([" Badword", " nastything", " vileness"])
        rows.append((i, ". ".join(sentences) + ".", "s"))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity(spark, documents):
    rows, labels = labelled(spark, 700)
    given = rows + [(d and d + 10_000, t, s) for d, t, s in EDGES]
    marks = spark.createDataFrame([*labels, (None, 1), (5000, 1), (3, None)], "doc_id long, toxic int")
    found = toxicity.scored(make_documents(spark, given), marks).collect()
    assert len(found) == len(given)
    truth = dict(labels)
    text = {r[0]: r[1] for r in given}
    out = [r for r in found if r.held_out and r.doc_id in truth]
    assert len(out) > 150 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found if r.doc_id is not None)
    assert sum(r.predicted == truth[r.doc_id] for r in out) >= 0.95 * len(out)
    places = []
    for r in found:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
        places += [any(w in text[r.doc_id][s.start:s.end] for w in ("Badword", "nastything", "vileness")) for s in r.offending]
        if not brute.words(text[r.doc_id]):
            assert r.score == 0
    assert sum(places) >= 0.95 * len(places) and sum(places) >= 0.9 * sum(truth.values())


def test_toxicity_without_labels(spark, documents):
    docs = documents([(1, "a b. c"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.scored(docs, none).collect()] == [0.0, 0.0]
    one = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.without_toxic(docs, toxicity.train(docs, one)).count() == 2
    assert toxicity.scored(docs.where("doc_id = 9"), one).count() == 0


def test_noise_of_copies_has_no_weight(spark, documents):
    """A wrongly labelled text with many copies does not make its words toxic."""
    rows, labels = labelled(spark, 400, seed=2)
    rows += [(1000 + i, "rare1 rare2 rare3. rare4 rare5.", "s") for i in range(40)]
    labels += [(1000 + i, 1) for i in range(40)]
    model = toxicity.train(make_documents(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    words = set(model.words.tolist())
    assert zlib.crc32(b"badword") in words and not words & {zlib.crc32(f"rare{i}".encode()) for i in range(1, 6)}


def test_offence_at_the_end_of_long_texts(spark):
    """Training reads whole texts, however long."""
    rows = [(i, f"w{i} " * 20_010 + (". Badword end." if i % 4 == 0 else ". Other end."), "s") for i in range(60)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(60)], "doc_id long, toxic int")
    model = toxicity.train(make_documents(spark, rows), labels)
    assert zlib.crc32(b"badword") in set(model.words.tolist())


def test_equal_sentences_are_merged():
    """Sentences with equal features, once with their number, are fitted like all of them."""
    spelled = [np.array([0, -1, -1, 0, -1, 1, 1, -1]), np.array([1, -1, -1, -1]), np.array([0, 1, -1])]
    merged = [np.array([-1, 0, -2, 1, 1, -1]), np.array([-2, 1, -1]), np.array([0, 1, -1])]
    toxic, least = np.array([True, False, True]), np.arange(3)
    a, b = (toxicity.fit(np.array([5, 9]), d, least, toxic) for d in (spelled, merged))
    assert np.allclose(a.weights, b.weights) and np.isclose(a.bias, b.bias)
    rows = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["x. bad bad! y. Bad bad. bad", None]})
    found = next(toxicity._encode(np.array([zlib.crc32(b"bad")]))(iter([rows]))).to_pylist()
    assert [np.frombuffer(r["words"], "<i4").tolist() for r in found] == [[-2, 0, -1, 0, 0, -2], []]


def test_a_shared_sentence_makes_no_copy(spark):
    """Different documents with a common line are an observation each; only those with equal sentences are one."""
    hashes = toxicity.mix(toxicity.mix(np.array([zlib.crc32(b"c%d" % k) for k in range(5000)], np.uint64)))
    line = f"c{int(np.argmin(hashes))}"  # the least sentence of nearly every document
    rows = [(i, f"{line}. w{i} v{i}. " + ("Badword end." if i % 4 == 0 else "Other end."), "s") for i in range(80)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(80)], "doc_id long, toxic int")
    model = toxicity.train(make_documents(spark, rows), labels)
    assert zlib.crc32(b"badword") in set(model.words.tolist())
    texts = ["the. a b. c", "c! the. A b. the", "the. a b. d", "the", "", "The. the. the"]
    given = pa.RecordBatch.from_pydict({"doc_id": range(6), "toxic": [0] * 6, "text": texts})
    content = [r["content"] for r in next(toxicity._describe(iter([given]))).to_pylist()]
    assert content[0] == content[1] and content[3] == content[5] and len(set(content)) == 4
