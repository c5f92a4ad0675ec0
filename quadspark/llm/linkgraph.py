"""URL filter by rules and link-graph propagation (operator 5), DataFrame functions only.

Rules judge the urls they fit; the longest wins.  All other urls are judged by
their host.  Hosts most of whose pages a rule allows are the trusted seeds, and
those most of whose pages a rule blocks the blocked ones.  Trust flows along the
links by personalised PageRank, and distrust against them, because who links to
bad hosts is suspect.  Scores are shares of all seed pages; they are judged as
numbers of pages (share times seed pages), so that a host's verdict does not
depend on how many other pages the table has.  A host is blocked if its distrust
reaches ``threshold`` pages and exceeds its trust.

Links are counted per pair of hosts before the first round, so a round joins one
row per host with its edges, and the sums combine before their shuffle.  Each
few rounds end in a table; the last one is where all further rounds together
would add less than a tenth of the threshold.

Defined results: a null url, or one without ``://``, has an empty host and path
and is allowed; null html has no links; links to the own host, and relative ones,
say nothing about others and are dropped; repeated rows are judged one by one;
other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadspark.llm.tables import stored

#: (host, path, verdict)
RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"))
#: The threshold is in pages.
ROUNDS_PER_TABLE, DAMPING, THRESHOLD = 4, 0.85, 1e-6
#: Sum of what all scores may still gain when the rounds end; filter_urls: as a share of the threshold.
SETTLED, SETTLED_SHARE = 1e-9, 0.1
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]*)"""


def host_of(url: Column) -> Column:
    """After the first ``://`` up to the path, query or fragment, A-Z in lower case."""
    after = F.substring_index(_after(url), "/", 1)
    return F.translate(F.substring_index(F.substring_index(after, "?", 1), "#", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to the query or fragment."""
    rest = F.substring_index(F.substring_index(_after(url), "?", 1), "#", 1)
    at = F.instr(rest, "/")
    return F.when(at > 0, F.substring(rest, at, F.length(rest))).otherwise("")


def _after(url: Column) -> Column:
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The longest rule (host, path, verdict) that fits each distinct (host, path), as rule and rule_verdict.

    A rule fits its host and all subdomains, if the path starts with the rule's.
    Of rules of one length that with the greatest text wins.
    """
    known = rules.select(
        F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "verdict",
        F.concat("host", "path").alias("rule")).dropDuplicates(["rule"])
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    # Only the suffixes of a host are looked up, so rules may be many.
    pairs = urls.where("host <> ''").select("host", "path").distinct()
    hit = pairs.withColumn("suffix", F.explode(suffixes)).join(known, F.col("suffix") == F.col("rule_host"))
    hit = hit.where(F.startswith("path", "rule_path"))
    best = F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), "rule"))
    return hit.groupBy("host", "path").agg(best.alias("best")).select(
        "host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("rule_verdict"))


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst and links: the absolute links of all pages between different hosts."""
    found = pages.where("url is not null and html is not null").select(
        host_of(F.col("url")).alias("src"), F.regexp_extract_all("html", F.lit(_LINK), F.lit(1)).alias("links"))
    links = found.where("src <> ''").select("src", F.explode("links").alias("link"))
    scheme = F.when(F.startswith("link", F.lit("//")), F.concat(F.lit("http:"), F.col("link"))).otherwise(F.col("link"))
    edges = links.select("src", host_of(scheme).alias("dst")).where("dst <> '' and dst <> src")
    return edges.groupBy("src", "dst").agg(F.count("*").alias("links"))


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int | None = None, damping: float = DAMPING,
              settled: float = SETTLED) -> DataFrame:
    """Personalised PageRank: (host, score), from seeds (host, weight) along edges (src, dst, links).

    Scores sum to 1 at most; what reaches a host without edges stays there no
    longer than a round.  Rounds end after ``rounds``, if given, or when all
    later ones would add less than ``settled`` to the sum of the scores.
    """
    # A round adds at most ``damping`` of what the last one has added.
    last = rounds if rounds is not None else max(1, math.ceil(math.log(settled) / math.log(damping)))
    total = seeds.groupBy().agg(F.sum("weight").alias("total"))
    start = stored(seeds.crossJoin(F.broadcast(total)).select(  # one row of a sum
        "host", (F.col("weight") / F.col("total")).alias("seed")), "llm-seeds")
    out = edges.groupBy("src").agg(F.sum("links").alias("out"))
    share = stored(edges.join(out, "src").select("src", "dst", (F.col("links") / F.col("out")).alias("share")), "llm-shares")
    ranks = before = start.select("host", ((1 - damping) * F.col("seed")).alias("score"))
    for number in range(1, last + 1):
        flow = ranks.join(share, ranks.host == share.src).select(
            F.col("dst").alias("host"), (damping * F.col("score") * F.col("share")).alias("score"))
        base = start.select("host", ((1 - damping) * F.col("seed")).alias("score"))
        ranks = flow.unionByName(base).groupBy("host").agg(F.sum("score").alias("score"))
        if number % ROUNDS_PER_TABLE == 0 or number == last:
            ranks = stored(ranks, "llm-ranks")
            both = ranks.unionByName(before.select("host", (-F.col("score")).alias("score")))
            change = both.groupBy("host").agg(F.abs(F.sum("score")).alias("change")).agg(F.sum("change")).first()[0]
            if (change or 0) * damping / (1 - damping) < settled:
                break
            before = ranks
    return ranks


def filter_urls(pages: DataFrame, rules: DataFrame, rounds: int | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Per page page_id, host, path, rule, verdict, trust and distrust."""
    url = F.col("url").cast("string")
    urls = pages.select("page_id", F.coalesce(host_of(url), F.lit("")).alias("host"),
                        F.coalesce(path_of(url), F.lit("")).alias("path"))
    counts = stored(urls.groupBy("host", "path").count(), "llm-urls")
    hits = stored(matched(counts, rules), "llm-hits")
    share = [F.sum(F.when(F.col("rule_verdict") == v, F.col("count")).otherwise(0)).alias(v) for v in ("allow", "block")]
    ruled = stored(counts.join(hits, ["host", "path"], "left").groupBy("host").agg(
        *share, F.sum("count").alias("pages")), "llm-ruled")
    edges = stored(host_edges(pages.select(url.alias("url"), F.col("html").cast("string"))), "llm-edges")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "links")
    seeds = {v: ruled.where(f"2 * {v} > pages").select("host", F.col(v).alias("weight")) for v in ("allow", "block")}
    total = {v: seeds[v].agg(F.sum("weight")).first()[0] or 0 for v in seeds}
    settled = SETTLED_SHARE * threshold / max(1, *total.values())
    trust = propagate(edges, seeds["allow"], rounds, settled=settled)
    distrust = propagate(back, seeds["block"], rounds, settled=settled)
    scores = trust.select("host", F.col("score").alias("trust"), F.lit(0.0).alias("distrust")).unionByName(
        distrust.select("host", F.lit(0.0).alias("trust"), F.col("score").alias("distrust")))
    scores = stored(scores.groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")), "llm-scores")
    judged = urls.join(hits, ["host", "path"], "left").join(scores, "host", "left").fillna(0.0, ["trust", "distrust"])
    suspect = F.col("distrust") * F.lit(float(total["block"]))
    bad = (suspect >= threshold) & (suspect > F.col("trust") * F.lit(float(total["allow"])))
    return judged.select(
        "page_id", "host", "path", "rule",
        F.coalesce("rule_verdict", F.when(bad, "block").otherwise("allow")).alias("verdict"), "trust", "distrust")
