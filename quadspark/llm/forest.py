"""Near-duplicate documents with an LSH forest over MinHash (operator 6).

A document's set is its distinct word shingles.  Documents with one set are one
*class*, so exact copies cost one row.  Each class has a signature of MinHash
values, and each tree of the forest orders the classes by its own row of them.

* A *region* of a tree holds the classes that share the first ``ROOT`` values.
  The number of trees follows from the threshold: two sets at it share no region
  with a chance of ``MISS`` (20 trees for 0.85, 29 for 0.8).
* Depth adapts to the region: a class is paired with the least class of the
  deepest node that it shares with another one (its neighbour of longest common
  prefix), the least classes of sibling nodes with that of their parent, and so
  on up to the root.  So a region of G classes gives at most G pairs a level.
* Pairs are confirmed on the full sets and joined to components.
* Regions that still hold several components are then treated exactly: all
  their pairs of different components are compared by signature, and those that
  may be links on the full sets.  Blocks of a region meet in cells, which write
  no pairs, only links that connect components.

No bucket is capped.  Minima combine before shuffles and joins on regions have
tables on both sides.

Defined results: null and empty texts have an empty set, are linked with
nothing and are their own component; rows that share a doc_id are one vertex; a
row with a null id has no component and is kept; columns other than ``doc_id``
and ``text`` are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadspark.llm.components import components
from quadspark.llm.tables import doc_texts, release, stored
from quadspark.llm.words import SLICE_BYTES, Words, mix, slices, texts

ROOT, DEPTHS = 5, (8, 6, 5)
#: Chance that a pair at the threshold shares no region.
MISS = 1e-5
#: A pair of similarity t has at least this share of equal signature values but
#: for a chance below one in a million (5.6 standard deviations at 0.85).
SPARE = 5.6
#: Rows of a block where pairs are compared by signature, and by text.
REGION_BLOCK, TEXT_BLOCK = 1024, 512
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingle_sets(documents: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles of all texts, and the index of each text's first."""
    words = Words([d.translate(_LOWER) for d in documents])
    start = words.windows(size)
    end = start + size
    short = np.flatnonzero((words.count > 0) & (words.count < size))
    start = np.concatenate([start, words.first[short]])
    end = np.concatenate([end, words.first[short + 1]])
    shingle, owner = words.runs(start, end), words.text[start]
    order = np.lexsort((shingle, owner))
    shingle, owner = shingle[order], owner[order]
    new = np.ones(len(shingle), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (owner[1:] != owner[:-1])
    shingle, owner = shingle[new], owner[new]
    return shingle, np.searchsorted(owner, np.arange(len(documents) + 1))


def signatures(shingle: np.ndarray, first: np.ndarray, values: int) -> np.ndarray:
    """One row per text with shingles: its least value under each permutation."""
    seeds = mix(np.arange(1, 2 * values + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    some = np.flatnonzero(np.diff(first))
    out = np.zeros((len(first) - 1, values), np.int32)
    for k in range(values if len(some) else 0):
        hashed = (shingle ^ seeds[2 * k]) * (seeds[2 * k + 1] | np.uint64(1))
        out[some, k] = (np.minimum.reduceat(hashed, first[some]) >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def trees_for(percent: int) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - min(percent / 100, 0.999) ** ROOT))


def _describe(size: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            shingle, first = shingle_sets(texts(batch), size)
            count = np.diff(first)
            totals = [np.concatenate([[0], np.cumsum(mix(shingle ^ np.uint64(s)))]).astype(np.uint64) for s in (0, 1)]
            prints = [pa.array((t[first[1:]] - t[first[:-1]]).view(np.int64)) for t in totals]
            values = signatures(shingle, first, width)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "n_shingles": pa.array(count, pa.int64()),
                "print1": prints[0], "print2": prints[1],
                "signature": pa.ListArray.from_arrays(
                    pa.array(np.arange(0, values.size + 1, width, dtype=np.int32)), pa.array(values.ravel()))})

    return run


def _confirm(size: int, percent: int):
    """Pairs whose full sets overlap enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text_a", SLICE_BYTES // 2):
            ours, first = shingle_sets(texts(batch, "text_a"), size)
            theirs, begin = shingle_sets(texts(batch, "text_b"), size)
            keep = []
            for i in range(batch.num_rows):
                a, b = ours[first[i]:first[i + 1]], theirs[begin[i]:begin[i + 1]]
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both) and both > 0)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def confirmed(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    left = docs.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    right = docs.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(
        _confirm(size, percent), "a long, b long")


def _node(tree: Column, depth: int, width: int) -> Column:
    """Key of a tree's node: the tree and the first values in its order."""
    places = [F.expr(f"signature[(tree * {ROOT} + {i}) % {width}]") for i in range(depth)]
    return F.xxhash64(tree, *places)


def _neighbours(active: DataFrame) -> DataFrame:
    """Pairs of each class with the least class of its deepest shared node, level by level."""
    pairs, level = [], active.withColumn("least", F.col("cid"))
    for depth in DEPTHS:
        node = f"node{depth}"
        above = [f"node{d}" for d in DEPTHS if d < depth]
        least = stored(level.groupBy(node, *above).agg(F.min("least").alias("least")), f"llm-{node}")
        pairs.append(level.select(node, F.col("least").alias("b")).join(
            least.select(node, F.col("least").alias("a")), node).where("a < b").select("a", "b"))
        level = least
    out = pairs[0]
    for more in pairs[1:]:
        out = out.unionByName(more)
    return out.distinct()


def _cells(members: DataFrame, block: int) -> DataFrame:
    """Deal the members (key, cid, component) of each key to cells of two blocks.

    Pairs of different components have at least one side outside the key's
    largest component, so blocks of outsiders (side o) meet blocks of all (side m).
    """
    sizes = stored(members.groupBy("key", "component").count(), "llm-sizes")
    main = stored(sizes.groupBy("key").agg(
        F.max_by("component", F.struct("count", "component")).alias("main"), F.sum("count").alias("n"),
        F.max("count").alias("most"), F.count("*").alias("components")).where("components > 1").select(
        "key", "main", F.ceil(F.col("n") / block).cast("int").alias("all_blocks"),
        F.ceil((F.col("n") - F.col("most")) / block).cast("int").alias("out_blocks")), "llm-main")
    known = stored(members.join(main, "key"), "llm-known")
    outside = known.where("component <> main").select(
        "key", "cid", "component", F.lit("o").alias("side"),
        F.pmod(F.xxhash64("cid"), F.col("out_blocks")).cast("int").alias("o"),
        F.explode(F.sequence(F.lit(0), F.col("all_blocks") - 1)).alias("m"))
    every = known.select(
        "key", "cid", "component", F.lit("m").alias("side"),
        F.explode(F.sequence(F.lit(0), F.col("out_blocks") - 1)).alias("o"),
        F.pmod(F.xxhash64("cid", F.lit(1)), F.col("all_blocks")).cast("int").alias("m"))
    return outside.unionByName(every)


def _by_cell(cells: DataFrame, work, result: str) -> DataFrame:
    """Apply ``work`` to the rows of each cell, one after the other."""
    names = ("key", "o", "m")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            cell = np.stack([np.asarray(batch.column(c)) for c in names])
            cuts = [0, *(np.flatnonzero((cell[:, 1:] != cell[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                piece = batch.slice(a, b - a)
                if held and any(held[0].column(c)[0] != piece.column(c)[0] for c in names):
                    yield work(pa.Table.from_batches(held))
                    held = []
                held.append(piece)
        if held:
            yield work(pa.Table.from_batches(held))

    return cells.repartition(*names).sortWithinPartitions(*names).mapInArrow(run, result)


def _candidates(cell: pa.Table, least: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows (outsider, any) of pairs of different components whose signatures and sizes allow a link.

    Pairs come by falling number of equal values.
    """
    side = np.asarray(cell.column("side")) == "o"
    cid, component, n = (np.asarray(cell.column(c)) for c in ("cid", "component", "n_shingles"))
    flat = np.asarray(cell.column("signature").combine_chunks().flatten()).reshape(len(cid), -1)
    out, every = np.flatnonzero(side), np.flatnonzero(~side)
    if not len(out) or not len(every):
        return out[:0], every[:0]
    equal = np.zeros((len(out), len(every)), np.int16)
    for k in range(flat.shape[1]):
        equal += flat[out, k][:, None] == flat[every, k]
    close = (equal >= least) & (component[out][:, None] != component[every])
    sizes = n[out][:, None], n[every]
    close &= 100 * np.minimum(*sizes) >= percent * np.maximum(*sizes)
    i, j = np.nonzero(close)
    order = np.argsort(-equal[i, j], kind="stable")
    return out[i[order]], every[j[order]]


class _Union:
    """Union-find over a few numbers; roots are the least members."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    a, b = zip(*pairs, strict=True) if pairs else ((), ())
    return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _families(least: int, percent: int):
    """A spanning forest of a cell's candidate pairs."""

    def work(cell: pa.Table) -> pa.RecordBatch:
        cid, union, pairs = cell.column("cid").to_pylist(), _Union(), []
        for i, j in zip(*(x.tolist() for x in _candidates(cell, least, percent)), strict=True):
            if union.root(cid[i]) != union.root(cid[j]):
                union.join(cid[i], cid[j])
                pairs.append((cid[i], cid[j]))
        return _links(pairs)

    return work


def _confirmed_links(least: int, size: int, percent: int):
    """Links of a cell that connect components, confirmed on the full sets."""

    def work(cell: pa.Table) -> pa.RecordBatch:
        left, right = _candidates(cell, least, percent)
        used = np.unique(np.concatenate([left, right]))
        column = cell.column("text").combine_chunks().cast(pa.binary())
        shingle, first = shingle_sets(column.take(pa.array(used)).to_pylist(), size)
        sets = {r: shingle[first[k]:first[k + 1]] for k, r in enumerate(used.tolist())}
        cid, component = cell.column("cid").to_pylist(), cell.column("component").to_pylist()
        union, pairs = _Union(), []
        for i, j in zip(left.tolist(), right.tolist(), strict=True):
            if union.root(component[i]) != union.root(component[j]):
                a, b = sets[i], sets[j]
                both = len(np.intersect1d(a, b, assume_unique=True))
                if 100 * both >= percent * (len(a) + len(b) - both):
                    union.join(component[i], component[j])
                    pairs.append((cid[i], cid[j]))
        return _links(pairs)

    return work


def _rest(active: DataFrame, labels: DataFrame, classes: DataFrame, docs: DataFrame, width: int, size: int,
          percent: int) -> DataFrame:
    """The links between components that regions still hold, as far as they connect anything.

    Signatures first: pairs that share a region and may be links make families.
    Then the texts, once for each family and block: pairs of a family that may
    be links are confirmed.  Pairs are never written, only links that connect.
    """
    labels = labels.withColumnRenamed("id", "cid")
    placed = active.select(F.col(f"node{ROOT}").alias("key"), "cid").join(labels, "cid", "left")
    placed = stored(placed.withColumn("component", F.coalesce("component", "cid")), "llm-placed")
    t = percent / 100
    least = int(width * t - SPARE * (width * t * (1 - t)) ** 0.5)
    near = _cells(placed, REGION_BLOCK).join(classes, "cid")
    families = components(stored(_by_cell(near, _families(least, percent), "a long, b long"), "llm-candidates"))
    families = families.select(F.col("component").alias("key"), F.col("id").alias("cid")).join(labels, "cid", "left")
    families = stored(families.withColumn("component", F.coalesce("component", "cid")), "llm-families")
    near = _cells(families, TEXT_BLOCK).join(classes, "cid").join(docs.withColumnRenamed("doc_id", "cid"), "cid")
    return _by_cell(near, _confirmed_links(least, size, percent), "a long, b long")


def near_duplicates(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """Per document doc_id, n_shingles, component_id (least doc_id of its component) and kept.

    ``size``: words of a shingle; ``percent``: least similarity of a link.
    """
    spark = documents.sparkSession
    trees = trees_for(percent)
    width = trees * ROOT
    source = doc_texts(documents)
    described = stored(source.mapInArrow(
        _describe(size, width),
        "doc_id long, n_shingles long, print1 long, print2 long, signature array<int>"), "llm-described")
    prints = ["print1", "print2", "n_shingles"]
    full = described.where("n_shingles > 0 and doc_id is not null")
    least = stored(full.groupBy(*prints).agg(F.min("doc_id").alias("cid")), "llm-classes")
    # A repeated row would be a class twice.
    classes = full.join(least.withColumnRenamed("cid", "doc_id"), [*prints, "doc_id"]).dropDuplicates([*prints, "doc_id"])
    classes = stored(classes.select(F.col("doc_id").alias("cid"), "n_shingles", "signature"), "llm-signatures")
    release(spark)

    leaves = classes.select("cid", "signature", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    root = leaves.select(_node(F.col("tree"), ROOT, width).alias(f"node{ROOT}"), "cid")
    regions = stored(root.groupBy(f"node{ROOT}").agg(
        F.min("cid").alias("least"), F.max("cid").alias("most")).where("least < most").select(f"node{ROOT}"), "llm-regions")
    nodes = leaves.select("cid", *(_node(F.col("tree"), d, width).alias(f"node{d}") for d in DEPTHS))
    active = stored(nodes.join(regions, f"node{ROOT}"), "llm-active")
    release(spark)

    ids = active.select(F.col("cid").alias("doc_id")).distinct()
    docs = stored(source.where("text is not null").join(ids, "doc_id").distinct(), "llm-texts")
    release(spark)
    near = stored(confirmed(_neighbours(active), docs, size, percent), "llm-near")
    rest = stored(_rest(active, components(near), classes, docs, width, size, percent), "llm-rest-links")
    release(spark)
    labels = components(near.unionByName(rest))
    release(spark)
    found = least.join(labels.withColumnRenamed("id", "cid"), "cid", "left")
    found = stored(found.select(*prints, F.coalesce("component", "cid").alias("component_id")), "llm-components")
    rows = described.select("doc_id", *prints).join(found, prints, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return rows.select("doc_id", "n_shingles", component.alias("component_id"),
                       F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
