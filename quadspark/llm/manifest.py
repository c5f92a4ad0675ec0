"""Merkle manifest of a dataset (operator 11).

Every document is a leaf; sixteen neighbours of a source make a node, up to the
source's root, and the sources' roots make a tree of the same kind.  All nodes
are computed by time-forward processing: a node's label is the place of the
last leaf below it and its level, so children come before parents, and a queue
ordered by label delivers digests to parents.  A reversed sweep over the labels
delivers to every child the siblings it needs and its parent's, up to the root.

The queue is external: messages between blocks of 4,096 leaves are tables that
Spark's shuffle brings into the order of labels, and the part that belongs to
one block is a heap in its task.  A round climbs three levels, so a source of
2**36 documents takes three.  A source's leaves are numbered by range-partitioned
files with a running sum over the files' counts, so no source meets in a task.

Defined results: a null source is a source of its own, before the others; null
ids come first in their source; rows with equal ids are ordered by their
digests, and equal rows are leaves one by one; null columns are ``-``; an empty
table has no root and no rows; columns other than the five are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadspark.llm.tables import ship, stored

FAN = 16
#: Levels that a round climbs: blocks have FAN**LEVELS nodes.
LEVELS = 3
#: Proofs that are held at once on their way out of a task.
ROWS_OUT = 512
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_NODE = "tree string, pos long, n long, digest string"
_MESSAGE = "tree string, block long, path string, subroot string"
_PROOF = "doc_id long, source string, leaf string, subroot string, proof string, folded string"


def digest(joined: str) -> str:
    return sha256(joined.encode()).hexdigest()


def leaf(**replaced: Column) -> Column:
    """Digest of a document; fields may be replaced."""
    parts = []
    for name in FIELDS:
        value = replaced.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


# --- sweeps within a block ------------------------------------------------------

def levels_above(n: int) -> int:
    """Levels above so many nodes until one remains."""
    return 0 if n <= 1 else 1 + levels_above(-(-n // FAN))


def _label(level: int, index: int, n: int) -> tuple[int, int]:
    """Place of the last leaf below a node, and its level: children come before parents."""
    return min((index + 1) * FAN**level, n) - 1, level


def forward(digests: list[str], height: int) -> list[list[str]]:
    """The digests of all levels; every node gets its children's from the queue."""
    n = len(digests)
    levels: list[list[str]] = [digests, *([] for _ in range(height))]
    queue: list[tuple[tuple[int, int], int, str]] = []
    for at, value in enumerate(digests if height else ()):
        heapq.heappush(queue, (_label(1, at // FAN, n), at, value))
        while queue and queue[0][0][0] <= at:  # the last leaf below the node has come
            label, children = queue[0][0], []
            while queue and queue[0][0] == label:
                children.append(heapq.heappop(queue)[2])
            level, index = label[1], len(levels[label[1]])
            levels[level].append(digest("".join(children)))
            if level < height:
                heapq.heappush(queue, (_label(level + 1, index // FAN, n), index, levels[level][-1]))
    return levels


def backward(levels: list[list[str]], path: str) -> list[str]:
    """The path of each leaf: for every level up to the root the siblings to the left and right.

    path: that of the block's top node.
    """
    n, height = len(levels[0]), len(levels) - 1
    paths = [path] * n
    queue = [((-(n - 1), -height), 0, path)]
    while queue and height:
        (_, level), index, above = heapq.heappop(queue)
        below = -level - 1
        run = levels[below][index * FAN:(index + 1) * FAN]
        for k in range(len(run)):
            child = index * FAN + k
            own = f"{''.join(run[:k])}|{''.join(run[k + 1:])};{above}"
            if below:
                last, _ = _label(below, child, n)
                heapq.heappush(queue, ((-last, -below), child, own))
            else:
                paths[child] = own
    return paths


def fold(value: str, path: str) -> str:
    """The root that a leaf's digest and its path give."""
    for step in path.split(";")[:-1]:
        left, right = step.split("|")
        value = digest(left + value + right)
    return value


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows that come in the order of (tree, block), one block at a time."""
    rows: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if rows and (rows[0]["tree"], rows[0]["block"]) != (row["tree"], row["block"]):
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _remaining(n: int, climbed: int) -> int:
    """Nodes of a tree that are left so many levels above its leaves."""
    return -(-n // FAN**climbed)


def _climb(climbed: int, levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _blocks(batches):
            first = rows[0]
            height = min(levels, levels_above(_remaining(first["n"], climbed)))
            top = forward([r["digest"] for r in rows], height)[-1][0]
            yield pa.RecordBatch.from_pylist([
                {"tree": first["tree"], "pos": first["block"], "n": first["n"], "digest": top}])

    return run


def _paths(batches: Iterator[pa.RecordBatch], climbed: int, levels: int) -> Iterator[tuple[dict, list[dict], list[str]]]:
    """The message to each block, its nodes and their paths."""
    for message, *rows in _blocks(batches):
        height = min(levels, levels_above(_remaining(rows[0]["n"], climbed)))
        yield message, rows, backward(forward([r["digest"] for r in rows], height), message["path"])


def _descend(climbed: int, levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for message, rows, paths in _paths(batches, climbed, levels):
            yield pa.RecordBatch.from_pydict({
                "tree": pa.array([r["tree"] for r in rows], pa.string()),
                "block": pa.array([r["pos"] for r in rows], pa.int64()),
                "path": pa.array(paths, pa.string()),
                "subroot": pa.array([message["subroot"]] * len(rows), pa.string())})

    return run


def _prove(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for message, rows, paths in _paths(batches, 0, levels):
            for a in range(0, len(rows), ROWS_OUT):
                part, proof = rows[a:a + ROWS_OUT], paths[a:a + ROWS_OUT]
                folded = [fold(r["claim"] or r["digest"], p) for r, p in zip(part, proof, strict=True)]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array([r["doc_id"] for r in part], pa.int64()),
                    "source": pa.array([r["source"] for r in part], pa.string()),
                    "leaf": pa.array([r["digest"] for r in part], pa.string()),
                    "subroot": pa.array([message["subroot"]] * len(part), pa.string()),
                    "proof": pa.array(proof, pa.string()), "folded": pa.array(folded, pa.string())})

    return run


# --- trees ---------------------------------------------------------------------------

def numbered(rows: DataFrame, tree: str, *order: str) -> DataFrame:
    """The rows with their place in their tree (pos) and its size (n).

    Range partitions of the whole order are written as files; the rows of a
    tree before a file are a running sum over the small table of counts.  The
    order has to be total.
    """
    ordered = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    placed = stored(ordered.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row")),
                    "llm-ordered")
    counts = placed.groupBy(tree, "part").agg(F.min("row").alias("first"), F.count("*").alias("here"))
    own = Window.partitionBy(tree)
    before = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored(counts.select(tree, "part", "first", F.coalesce(F.sum("here").over(before), F.lit(0)).alias("before"),
                                  F.sum("here").over(own).alias("n")), "llm-order-counts")
    return placed.join(counts, [tree, "part"]).withColumn("pos", F.expr("before + row - first")).drop(
        "part", "row", "first", "before")


def _left(climbed: int) -> Column:
    """Nodes of a tree that are left so many levels above its leaves."""
    return F.expr(f"(n + {FAN**climbed - 1}L) div {FAN**climbed}L")


def _by_block(rows: DataFrame) -> DataFrame:
    # A block has 4,096 rows and a message at most, so its key cannot be hot.
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")


def climb(leaves: DataFrame, levels: int) -> list[DataFrame]:
    """Nodes (tree, pos, n, digest) of each round; the first are the leaves."""
    most = leaves.agg(F.max("n")).first()[0] or 0
    rounds = [leaves.select("tree", "pos", "n", "digest")]
    while _remaining(most, at := (len(rounds) - 1) * levels) > 1:
        below = rounds[-1].where(_left(at) > 1).withColumn("block", F.expr(f"pos div {FAN**levels}"))
        rounds.append(stored(_by_block(below).mapInArrow(_climb(at, levels), _NODE), "llm-nodes"))
    return rounds


def roots(rounds: list[DataFrame], levels: int) -> DataFrame:
    """The single node (tree, n, digest) that each tree ends in."""
    found = rounds[0].where("n = 1")
    for number, nodes in enumerate(rounds[1:], 1):
        found = found.unionByName(nodes.where(_left(number * levels) == 1))
    return found.select("tree", "n", "digest")


def _with_messages(nodes: DataFrame, messages: DataFrame, levels: int) -> DataFrame:
    """The nodes of each block behind the message to the block."""
    blocks = nodes.withColumn("block", F.expr(f"pos div {FAN**levels}"))
    letters = messages.withColumn("pos", F.lit(-1).cast("long"))
    return _by_block(blocks.unionByName(letters, allowMissingColumns=True))


def descend(rounds: list[DataFrame], tops: DataFrame, levels: int) -> DataFrame:
    """Messages (tree, block, path, subroot) to the blocks of leaves.

    tops: tree, n, path and subroot of the trees' roots.
    """
    top = tops.select("tree", "n", F.lit(0).cast("long").alias("block"), "path", "subroot")
    out = None
    for number in range(len(rounds) - 2, 0, -1):
        at = number * levels
        ends_here = top.where((_left(at + levels) == 1) & (_left(at) > 1)).drop("n")
        letters = ends_here if out is None else out.unionByName(ends_here)
        nodes = _with_messages(rounds[number].where(_left(at) > 1), letters, levels)
        out = stored(nodes.mapInArrow(_descend(at, levels), _MESSAGE), "llm-paths")
    low = top.where(_left(levels) == 1).drop("n")
    return low if out is None else out.unionByName(low)


def proofs(documents: DataFrame, claimed: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """doc_id, source, leaf, subroot, root, proof, folded_root of every document.

    proof: for each level up to the root ``left|right;`` with the siblings'
    digests.  folded_root is what the proof makes of the leaf's digest, or of
    ``claimed`` (a digest by the columns of the documents) where that is not null.
    """
    spark = documents.sparkSession
    ship(spark)
    claim = F.lit(None).cast("string") if claimed is None else claimed
    leaves = stored(documents.select(
        F.coalesce(F.concat(F.lit("+"), F.col("source").cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        leaf().alias("digest"), claim.alias("claim"), F.monotonically_increasing_id().alias("tie")), "llm-leaves")
    placed = stored(numbered(leaves, "tree", "doc_id", "digest", "tie").drop("tie"), "llm-placed")
    rounds = climb(placed, levels)
    subroots = stored(roots(rounds, levels), "llm-subroots")
    # The tree above: one leaf for each source, in the order of the sources.
    above = stored(numbered(subroots.select(
        F.lit("").alias("tree"), F.col("tree").alias("source"), F.col("n").alias("below"), "digest"), "tree", "source"), "llm-sources")
    upper = climb(above, levels)
    top = roots(upper, levels).first()
    root = None if top is None else top.digest
    start = above.groupBy("tree").agg(F.max("n").alias("n")).select(
        "tree", "n", F.lit("").alias("path"), F.lit(None).cast("string").alias("subroot"))
    letters = _with_messages(above.select("tree", "pos", "n", "digest"), descend(upper, start, levels), levels)
    paths = letters.mapInArrow(_descend(0, levels), _MESSAGE)
    tops = above.join(paths.select(F.col("block").alias("pos"), "path"), "pos").select(
        F.col("source").alias("tree"), F.col("below").alias("n"), "path", F.col("digest").alias("subroot"))
    tops = stored(tops, "llm-tops")
    found = _with_messages(placed, descend(rounds, tops, levels), levels).mapInArrow(_prove(levels), _PROOF)
    return found.select("doc_id", "source", "leaf", "subroot", F.lit(root).cast("string").alias("root"), "proof",
                        F.col("folded").alias("folded_root"))


def tampered() -> Column:
    """The digest of a document whose text has lost its capitals, for a fifth of the ids by checksum; else null."""
    chosen = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(chosen, leaf(text=lower))
