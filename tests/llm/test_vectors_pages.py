"""Embeddings, archives and the URL filter."""

import base64
import gzip
import hashlib
import io
from glob import glob

import numpy as np
import pytest
from llm import brute
from pyspark.sql import functions as F

from quadspark.llm import arc
from quadspark.llm.linkgraph import RULES, filter_urls, host_edges, matched, propagate
from quadspark.llm.rotation import bands, encoded, estimates, near_vectors, open_pairs, recomputed, rotation, unit


def vectors(spark, rows):
    return spark.createDataFrame(
        [(v, x, label, "clash", 1) for v, x, label in rows],
        "vec_id long, embedding array<double>, label int, bucket string, n int").repartition(3)


def test_near_vectors(spark, monkeypatch):
    monkeypatch.setattr("quadspark.llm.rotation.BLOCK", 8)
    rng = np.random.default_rng(1)
    rows, n = [], 0
    for group in range(12):  # chains: each vector is near the one before it
        x = rng.standard_normal(16)
        for _ in range(1 + 2 * group):
            rows.append((n, (x * rng.uniform(0.5, 2)).tolist(), group % 3))
            x = x + rng.standard_normal(16) * rng.choice([0.02, 0.12])
            n += 1
    rows += [(n + k, rows[40][1], rows[40][2]) for k in range(30)]  # equal vectors
    nan, inf = float("nan"), float("inf")
    rows += [(500, None, 0), (501, [], 0), (502, [0.0] * 16, 0), (503, [1.0, None] * 8, 0), (504, [nan] * 16, 0),
             (505, [inf] * 16, 0), (506, rows[40][1], None), (None, rows[40][1], rows[40][2]), (507, [1.0, 2.0], 0),
             (508, [2.0, 4.0], 0), (509, [-0.0, 1.0], 0), (510, [0.0, 1.0], 0), (511, [1e-200, 2e-200], 0)]
    found = near_vectors(vectors(spark, rows), 0.98).collect()
    assert sorted(map(tuple, found), key=str) == sorted(brute.near_vectors(rows, 0.98), key=str)


def test_no_vectors(spark):
    assert near_vectors(vectors(spark, [(1, [1.0], 0)]).where("vec_id = 2")).count() == 0


def test_estimates_lose_no_pair():
    """Only pairs near the threshold are left open, and none that reaches it is lost."""
    rng = np.random.default_rng(2)
    for size, n_bits in ((64, 576), (64, 100), (2, 60), (1, 9), (300, 128)):
        x = unit(rng.standard_normal((600, size)))
        near = np.sqrt(0.04 / size) * np.concatenate([np.full(200, 1.0), np.full(200, 3.2)])[:, None]
        x[200:] = unit(np.tile(x[:200], (2, 1)) + rng.standard_normal((400, size)) * near)
        cosine, upper = x @ x.T, np.triu(np.ones((600, 600), bool), 1)
        codes = encoded(x, n_bits)
        pairs = open_pairs(codes, upper, 0.98)
        assert recomputed(x, pairs, 0.98).T.tolist() == np.argwhere(upper & (cosine >= 0.98)).tolist()
        if (size, n_bits) == (64, 576):
            error = (estimates(codes) - cosine)[upper]
            assert abs(error.mean()) < 1e-3 and error.std() < 0.05
            # 400 pairs lie near 0.98, 400 near 0.85 (and theirs), 179,000 near zero.
            assert pairs.shape[1] < 300
    turn = rotation(64, 3)
    assert np.allclose(turn @ turn.T, np.eye(64))


def test_bands_keep_their_recall():
    for n in (1, 1000, 10**6, 10**10):
        bits, count = bands(n)
        agree = (1 - np.arccos(0.98) / np.pi) ** bits
        assert (1 - agree) ** count <= 1e-5


PAGES = [(1, "http://a.example.org/x y", "<p>ä</p>"), (2, "http://b.example.org/", "<p>ä</p>"), (3, None, None),
         (4, "https://c.example.org/?q=WARC/1.1", "WARC/1.1\r\n\r\nhttp://x 0.0.0.0 2 text/html 5\n" * 3), (5, "", ""),
         (6, "http://d/é", "x" * 300_000), (None, "http://n/", "<p>ä</p>"), (7, "http://e/", "only"), (7, "http://e/", "only")]


def pages(spark, rows=PAGES, parts=3):
    return spark.createDataFrame([(*r, "clash", b"raw") for r in rows],
                                 "page_id long, url string, html string, payload string, raw binary").repartition(parts)


def test_archives(spark, place):
    found = arc.archive_pages(pages(spark), f"{place}/arc", f"{place}/warc").collect()
    want, last = [], {}
    for page_id, _, html in PAGES:
        digest = base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()
        last[digest] = max(last.get(digest, -1), -1 if page_id is None else page_id)
        want.append((page_id, len((html or "").encode()), digest))
    want = [(p, n, d, "response" if p == last[d] else "revisit", None if p == last[d] else last[d]) for p, n, d in want]
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found
                  if r.page_id) == sorted(w for w in want if w[0])
    assert len(found) == len(PAGES)
    raw = {gzip.open(f).readlines()[1][:1] for f in glob(f"{place}/arc/*.gz")}
    assert raw == {b"1", b"2"}  # both versions were written and read
    back = {r.page_id: r for r in arc.read_warc(spark, f"{place}/warc").where("record_type = 'response'").collect()}
    assert back[4].payload.decode() == PAGES[3][2] and back[6].payload_bytes == 300_000
    for f in glob(f"{place}/warc/*.gz"):  # the files are archives for others, too
        for header, _ in arc.parse_warc(io.BufferedReader(gzip.open(f))):
            assert header["warc-record-id"].startswith("<urn:uuid:") and "warc-date" in header


def test_no_pages(spark, place):
    assert arc.archive_pages(pages(spark).where("page_id = 99"), f"{place}/a", f"{place}/w").count() == 0


def test_broken_archives():
    v1 = b"filedesc://f 0.0.0.0 20200101000000 text/plain 76\n1 0 o\nURL IP-address Archive-date Content-type Archive-length\n"
    v1 = v1.replace(b" 76\n", f" {len(v1.split(b'\n', 1)[1])}\n".encode())
    good = b"http://a b/ 1.2.3.4 20200102030405 text/html 5\nhello\n"
    records = list(arc.parse_arc(io.BytesIO(v1 + b"\n" + good + good)))
    assert [(h["URL"], c) for h, c in records] == [("http://a b/", b"hello")] * 2
    for bad in (v1 + b"\nhttp://a 1 2\n", v1 + b"\nhttp://a 1.2.3.4 20200102030405 text/html 50\nshort"):
        with pytest.raises(ValueError, match="ARC"):
            list(arc.parse_arc(io.BytesIO(bad)))
    with pytest.raises(ValueError, match="WARC"):
        list(arc.parse_warc(io.BytesIO(b"HTTP/1.1 200 OK\r\n")))


URLS = ["http://WWW.Example.COM/en/1", "https://a.example.com/en/", "https://a.example.com/de/", "http://x.net/es/?q#f",
        "http://x.net/en/", "http://net/fr/", "http://notnet/fr/", "ftp://org", "http://h?x=/en/", "no scheme", "", None,
        "http://com", "http://com/", "a://b://c/d", "http://example.com.org/en/", "://x.com/p"]


def test_rules(spark):
    rows = [(i, u, None) for i, u in enumerate(URLS)] + [(0, URLS[0], "x")]
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    found = filter_urls(pages(spark, rows), rules, rounds=2).collect()
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found}
    assert len(found) == len(rows)
    assert got[0] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert got[1][2:] == ("example.com/en/", "block") and got[2][2:] == ("com/", "allow")
    assert got[3] == ("x.net", "/es/", "net/es/", "block") and got[4][2:] == (None, "allow")
    assert got[5][2] == "net/fr/" and got[6] == ("notnet", "/fr/", None, "allow")
    assert got[7][:2] == ("org", "") and got[8][:2] == ("h", "")
    assert all(got[i][:3] == ("", "", None) for i in (9, 10, 11))
    assert got[12] == ("com", "", None, "allow") and got[13][2] == "com/" and got[14][:2] == ("b:", "//c/d")
    assert got[15][2] is None and got[16][2] == "com/"


def test_many_rules_of_one_host(spark):
    urls = spark.createDataFrame([("a.b.c", "/x/y")], "host string, path string")
    rules = spark.createDataFrame([("c", "/", "allow"), ("b.c", "/x", "block"), ("b.c", "/z", "allow"), ("a.b.c", "", "allow")],
                                  "host string, path string, verdict string")
    assert matched(urls, rules).first().rule == "b.c/x"


def link(*hosts):
    return " ".join(f'<a class="x" HREF="//{h}/p">.</a>' for h in hosts)


def test_propagation(spark):
    """Trust follows links, distrust goes against them; both equal a dense power iteration."""
    rows = [(1, "http://good.com/", link("friend.org", "both.org", "Both.org")), (2, "http://friend.org/", link("both.org", "good.com")),
            (3, "http://bad.net/es/", "<a href='/own'>.</a>"), (4, "http://spam.org/", link("bad.net") + '<a href=https://bad.net/x>'),
            (5, "http://both.org/", link("bad.net")), (6, "http://alone.org/", link("alone.org"))]
    edges = {(r.src, r.dst): r.links for r in host_edges(pages(spark, rows)).collect()}
    assert edges == {("good.com", "friend.org"): 1, ("good.com", "both.org"): 2, ("friend.org", "both.org"): 1,
                     ("friend.org", "good.com"): 1, ("spam.org", "bad.net"): 2, ("both.org", "bad.net"): 1}
    hosts = sorted({h for e in edges for h in e})

    def dense(links, start):
        step = np.zeros((len(hosts), len(hosts)))
        for (a, b), n in links.items():
            step[hosts.index(b), hosts.index(a)] = n / sum(m for (s, _), m in links.items() if s == a)
        seed = np.array([float(h == start) for h in hosts])
        rank = 0.15 * seed
        for _ in range(7):
            rank = 0.85 * step @ rank + 0.15 * seed
        return dict(zip(hosts, rank, strict=True))

    trust = dense(edges, "good.com")
    distrust = dense({(b, a): n for (a, b), n in edges.items()}, "bad.net")
    table = spark.createDataFrame([(*e, n) for e, n in edges.items()], "src string, dst string, links long")
    seeds = spark.createDataFrame([("good.com", 3)], "host string, weight long")
    found = {r.host: r.score for r in propagate(table, seeds, rounds=7).collect()}
    assert all(abs(found.get(h, 0) - x) < 1e-12 for h, x in trust.items())
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    found = {r.host: r for r in filter_urls(pages(spark, rows), rules, rounds=7).collect()}
    assert all(abs(found[h].trust - trust[h]) < 1e-12 and abs(found[h].distrust - distrust[h]) < 1e-12 for h in hosts)
    want = {h: "block" if distrust[h] > trust[h] else "allow" for h in hosts} | {"good.com": "allow", "bad.net": "block"}
    assert {h: r.verdict for h, r in found.items()} == want | {"alone.org": "allow"}
    assert want["spam.org"] == "block" and want["both.org"] == "allow"


def test_verdicts_do_not_depend_on_the_rest_of_the_table(spark):
    """Many other blocked and allowed pages change no host's verdict, and distrust goes far."""
    chain = [(10 + k, f"http://h{k}.org/", link(f"h{k - 1}.org" if k else "bad.net")) for k in range(30)]
    rows = [(1, "http://bad.net/es/1", ""), (2, "http://spam.org/", link("bad.net")), (3, "http://good.com/", link("fine.org", "x.org")),
            (4, "http://fine.org/", link("bad.net")), (5, "http://mixed.org/", link("bad.net", "x.org")), (6, "http://x.org/", "")]
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    few = pages(spark, rows + chain)
    more = spark.range(400_000).select(
        (F.col("id") + 1000).alias("page_id"), F.concat(F.lit("http://big.net/es/"), F.col("id") % 7).alias("url"),
        F.lit("").alias("html")).unionByName(spark.range(5000).select(
            (F.col("id") + 500_000).alias("page_id"), F.lit("http://big.com/").alias("url"), F.lit("").alias("html")))
    many = few.select("page_id", "url", "html").unionByName(more)
    found = [{r.page_id: r.verdict for r in filter_urls(t, rules).where("page_id < 1000").select("page_id", "verdict").collect()}
             for t in (few, many)]
    assert found[0] == found[1]
    assert all(found[0][k] == "block" for k in (1, 2, 5, *range(10, 40))) and found[0][6] == "allow"
