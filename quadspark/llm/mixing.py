"""Mixing overlapping sources to target weights by min-cost flow (operator 10).

Documents with the same set of sources form a *membership pattern*.  Spark sums
the words of each pattern; the flow then routes them to the sources' quotas:
each further repetition of a pattern opens its capacity anew at a higher cost,
so nothing is repeated while first readings can fill a quota.  As the costs lie
on the patterns alone, opening one repetition after the other and augmenting
each time is the min-cost flow.  Spark selects the documents: those of a
pattern stand in a seeded order on a line of words, and the flow takes a prefix
of the line, over and over if it is longer than the line.

Only patterns reach the driver, at most ``MAX_PATTERNS`` (else an error). The
line of a pattern is cut into 65,536 buckets of hashes: sums per bucket combine
before their shuffle, and documents are ordered within a bucket only.  Texts of
one id and length stand in the order of their digests.

Defined results: a null text has no words, a null source is the last source, a
document without words or sources is not taken; repeated rows have places of
their own on the line; other columns are ignored.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadspark.llm.tables import WORD, n_words, stored

WEIGHTS = (5, 2, 1)
#: Words taken in all, and at most from one document or source, as shares of the words there are.
TOTAL, REPEATS = 1.5, 2
MAX_PATTERNS = 10_000
BUCKET_DIGITS = 4  # of a hexadecimal hash


def targets(sizes: Sequence[int], weights: Sequence[float] = WEIGHTS, total: float = TOTAL,
            repeats: float = REPEATS) -> list[float]:
    """Words wanted of each source: shares by weight, none above its limit.

    The excess of sources above their limit goes to the others by weight, again
    and again until none is above.
    """
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    out = [0.0] * len(sizes)
    left, active = total * sum(sizes), set(range(len(sizes)))
    while active:
        unit = left / sum(weight[i] for i in active)
        above = sorted(i for i in active if weight[i] * unit > repeats * sizes[i])
        if not above:
            for i in active:
                out[i] = weight[i] * unit
            break
        for i in above:
            out[i] = float(repeats * sizes[i])
            left -= out[i]
            active.discard(i)
    return out


def route(capacity: Sequence[int], members: Sequence[Sequence[int]], quota: Sequence[int],
          repeats: int = REPEATS) -> list[dict[int, int]]:
    """Words that each pattern gives to each of its sources, at least total repetition.

    capacity: words of a pattern; members: the sources of a pattern; quota:
    words wanted of a source.
    """
    given: list[dict[int, int]] = [dict.fromkeys(m, 0) for m in members]
    users: list[set[int]] = [set() for _ in quota]
    for p, m in enumerate(members):
        for s in m:
            users[s].add(p)
    free, need = [0] * len(capacity), list(quota)
    for _ in range(repeats):
        free = [f + c for f, c in zip(free, capacity, strict=True)]
        while True:
            # Breadth-first from patterns with free words to a source in need.
            came: dict[tuple[str, int], tuple[str, int] | None] = {("p", p): None for p, f in enumerate(free) if f}
            queue, end = deque(came), None
            while queue and end is None:
                kind, x = queue.popleft()
                following = [("s", s) for s in members[x]] if kind == "p" else [
                    ("p", p) for p in sorted(users[x]) if given[p][x]]
                for node in following:
                    if node not in came:
                        came[node] = (kind, x)
                        queue.append(node)
                        if node[0] == "s" and need[node[1]]:
                            end = node
                            break
            if end is None:
                break
            path = [end]
            while (before := came[path[-1]]) is not None:
                path.append(before)
            path.reverse()
            steps = list(zip(path, path[1:], strict=False))
            most = min([free[path[0][1]], need[end[1]], *(given[b[1]][a[1]] for a, b in steps if a[0] == "s")])
            for a, b in steps:
                if a[0] == "p":
                    given[a[1]][b[1]] += most
                else:
                    given[b[1]][a[1]] -= most
            free[path[0][1]] -= most
            need[end[1]] -= most
    return given


def mix(documents: DataFrame, sources: Column, weights: Sequence[float] = WEIGHTS, total: float = TOTAL,
        repeats: int = REPEATS, seed: int = 0, carry: bool = False) -> DataFrame:
    """What the mix takes of each document.

    ``sources``: array column of the sources that a document belongs to; a null
    element is a source of its own.  Returns doc_id, sources, size, taken and
    takes (source, words), which sums to taken.  Reruns agree.  With ``carry``,
    the column ``row`` holds all columns of the document.
    """
    spark = documents.sparkSession
    digest = F.md5(F.concat_ws(":", F.lit(seed).cast("string"), F.col("doc_id").cast("string"),
                               F.coalesce(F.length("text"), F.lit(0)).cast("string")))
    whole = [F.struct("*").alias("row")] if carry else []
    sized = documents.select(
        *whole, F.col("doc_id").cast("long"), F.array_sort(F.array_distinct(sources)).alias("sources"),
        n_words(F.col("text").cast("string")).alias("size"), digest.alias("digest"),
        F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")).alias("text_digest"))
    sized = sized.withColumns({"pattern": F.to_json("sources"), "bucket": F.left("digest", F.lit(BUCKET_DIGITS))})
    if not carry:
        sized = stored(sized, "llm-sized")
    parts = stored(sized.groupBy("pattern", "bucket").agg(
        F.sum("size").alias("words"), F.first("sources").alias("sources")), "llm-parts")
    found = parts.groupBy("pattern").agg(
        F.sum("words").alias("words"), F.first("sources").alias("sources")).orderBy("pattern").take(MAX_PATTERNS + 1)
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    found = [r for r in found if r.sources]
    # Code point order, null last.
    names = sorted({s for r in found for s in r.sources}, key=lambda s: (s is None, s or ""))
    place = {s: i for i, s in enumerate(names)}
    size = [0] * len(names)
    for r in found:
        for s in r.sources:
            size[place[s]] += r.words
    want = targets(size, weights, total, repeats)
    given = route([r.words for r in found], [[place[s] for s in r.sources] for r in found],
                  [round(t) for t in want], repeats)
    rows = []
    for r, flow in zip(found, given, strict=True):
        end, segments = 0, []
        for s in sorted(flow):
            segments.append((names[s], size[s], want[s], end, end + flow[s]))
            end += flow[s]
        rows.append((r.pattern, r.words, segments))
    plan = spark.createDataFrame(
        rows, "pattern string, line long, segments array<struct<source:string,source_size:long,target:double,"
              "begin:long,end:long>>")

    before = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("pattern", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset"))
    inner = Window.partitionBy("pattern", "bucket").orderBy("digest", "doc_id", "text_digest")
    placed = sized.withColumn("within", F.sum("size").over(
        inner.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size"))
    # At most MAX_PATTERNS rows.
    placed = placed.join(offsets, ["pattern", "bucket"]).join(F.broadcast(plan), "pattern", "left")
    places = F.expr(f"transform(sequence(0, {repeats - 1}), r -> r * line + offset + within)")
    takes = F.transform("segments", lambda g: F.struct(
        g["source"].alias("source"), g["source_size"].alias("source_size"), g["target"].alias("target"),
        F.aggregate(places, F.lit(0).cast("long"), lambda n, x: n + F.greatest(
            F.lit(0).cast("long"),
            F.least(g["end"], x + F.col("size")) - F.greatest(g["begin"], x))).alias("words")))
    row = ["row"] if carry else []
    out = placed.select(*row, "doc_id", "sources", "size", F.coalesce(takes, F.array()).alias("takes"))
    taken = F.aggregate("takes", F.lit(0).cast("long"), lambda n, t: n + t["words"])
    return out.select(*row, "doc_id", "sources", "size", taken.alias("taken"), "takes")


def mixed(documents: DataFrame, sources: Column, weights: Sequence[float] = WEIGHTS, total: float = TOTAL,
          repeats: int = REPEATS, seed: int = 0) -> DataFrame:
    """The documents as the mix takes them: whole ones once or more, and the first words of those it cuts.

    Columns are those of the documents; ``n_chars``, if there is one, follows the text.
    """
    found = mix(documents, sources, weights, total, repeats, seed, carry=True).where("taken > 0")
    text = F.col("row.text").cast("string")
    rest = F.col("taken") % F.col("size")
    head = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.lit(1), rest.cast("int")), " ")
    copies = F.array_repeat(text, F.floor(F.col("taken") / F.col("size")).cast("int"))
    texts = F.when(rest > 0, F.concat(copies, F.array(head))).otherwise(copies)
    rows = found.select("row", F.explode(texts).alias("part"))
    changed = {"text": F.col("part"), "n_chars": F.length("part").cast("long")}
    return rows.select(*(changed[c].alias(c) if c in changed else F.col("row").getField(c).alias(c) for c in documents.columns))
