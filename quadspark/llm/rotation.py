"""Near-duplicate embeddings with randomised-rotation binary codes (operator 4).

A unit vector is turned by several random rotations; the signs of all the
coordinates are its *code*.  A code read backwards is a vector again, and its
inner product with the vector it came from is the *correction factor*: divided
by it, the product of a decoded code with any other vector is an unbiased
estimate of that vector's cosine.  The factor also gives the estimate's spread,
which shrinks as the cosine nears one.  The other vector of an estimate is held
in a byte a coordinate, rounded with a random shift, which keeps the estimate
unbiased.  Codes, bytes and factors are made once and stored; pairs whose upper
bound is below the threshold are done with, and only for the others the vectors
themselves are fetched and multiplied in double precision.

Candidates are vectors of one label whose codes agree in one of several *bands*
of bits.  Bits per band follow the number of vectors, so that unrelated vectors
rarely meet; the number of bands follows from the bits, so that a pair at the
threshold is missed with a chance of ``MISS`` at any size.

Equal vectors are one class with a count.  A bucket of a band is split into
blocks, and each pair of blocks is a *cell* of one task.  Cells are seen twice:
first with codes only, which leaves the vectors that have an open pair, then
with these vectors.  No pair is written, only each vector's number of links and
a spanning forest of the cell.  A pair that meets in several bands is looked at
in the first.

Defined results: a null vector or label, and vectors that are empty, zero or
hold null or non-finite components, link with nothing; vectors of different
length never link; repeated rows count as vectors; a row with a null id links
with nothing, has no component and is kept; other columns are ignored.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadspark.llm.components import components
from quadspark.llm.tables import release, ship, stored

THRESHOLD, MISS, SEED = 0.98, 1e-5, 7
#: Standard deviations of an estimate that the bounds allow for: a chance of about 3e-7 to reject wrongly.
SPREAD = 5.0
#: Vectors of a bucket that are in one block.
BLOCK = 1024
#: Steps on each side of zero that a byte has room for, one kept for the shift.
STEPS = 126
CELL = ("bucket", "low", "high")
CODE = "code binary, levels binary, step double, factor double, spread double"


def bands(n: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """Bits of a band and number of bands for n vectors of the largest label."""
    bits = min(40, max(8, math.ceil(math.log2(4 * max(n, 1)))))
    agree = (1 - math.acos(min(threshold, 1 - 1e-9)) / math.pi) ** bits
    return bits, math.ceil(math.log(MISS) / math.log(1 - agree))


@functools.lru_cache(maxsize=64)
def rotation(size: int, number: int) -> np.ndarray:
    """A random rotation of vectors of a size."""
    q, r = np.linalg.qr(np.random.default_rng([SEED, size, number]).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


@functools.lru_cache(maxsize=64)
def shift(size: int) -> np.ndarray:
    """What is added to each coordinate, in steps, before it is rounded down."""
    return np.random.default_rng([SEED, size]).random(size)


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


class Codes(NamedTuple):
    """What is stored of vectors of one size, a row each."""

    signs: np.ndarray  #: bool, bits of all bands
    levels: np.ndarray  #: int8, the vector in the basis of rotation 0, in steps
    step: np.ndarray
    factor: np.ndarray  #: inner product of vector and decoded code
    spread: np.ndarray  #: length of what the decoded code has beside the vector, as a share of the factor


def decoded(signs: np.ndarray, size: int) -> np.ndarray:
    """The vector that a code stands for, not scaled."""
    out = np.zeros((len(signs), size))
    for turn, at in enumerate(range(0, signs.shape[1], size)):
        some = np.where(signs[:, at:at + size], 1.0, -1.0)
        out += some @ rotation(size, 1 + turn).T[: some.shape[1]]
    return out


def encoded(units: np.ndarray, n_bits: int) -> Codes:
    size = units.shape[1]
    turns = math.ceil(n_bits / size)
    signs = np.concatenate([units @ rotation(size, 1 + t) > 0 for t in range(turns)], axis=1)[:, :n_bits]
    back = decoded(signs, size)
    factor = np.einsum("ij,ij->i", back, units)
    beside = np.sqrt(np.maximum(0, np.einsum("ij,ij->i", back, back) - factor**2))
    turned = units @ rotation(size, 0)
    step = np.abs(turned).max(axis=1) / STEPS
    levels = np.floor(turned / step[:, None] + shift(size)).astype(np.int8)
    return Codes(signs, levels, step, factor, beside / factor)


def estimates(codes: Codes) -> np.ndarray:
    """Unbiased estimate of the cosine of vectors i (as bytes) and j (as code) at [i, j]."""
    size = codes.levels.shape[1]
    vectors = (codes.levels + 0.5 - shift(size)) * codes.step[:, None] @ rotation(size, 0).T
    return vectors @ (decoded(codes.signs, size) / codes.factor[:, None]).T


def open_pairs(codes: Codes, allowed: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """Pairs (i, j) among the allowed ones that may reach the threshold, by both their estimates.

    The code of j lies beside j in a random direction, so an estimate has the
    deviation sqrt(1 - cosine^2) * spread / sqrt(size - 1), and that of the
    rounding.  Of all cosines that reach the threshold, the threshold itself
    has the lowest bound.
    """
    size = codes.levels.shape[1]
    aside = math.sqrt(1 - max(threshold, 0.0) ** 2) / math.sqrt(max(1, size - 1))
    rounding = codes.step[:, None] * np.sqrt((1 + codes.spread**2) / 12)
    least = threshold - 1e-9 - SPREAD * (aside * codes.spread + rounding)
    may = estimates(codes) >= least
    return np.stack(np.nonzero(may & may.T & allowed))


def recomputed(units: np.ndarray, pairs: np.ndarray, threshold: float = THRESHOLD) -> np.ndarray:
    """Those of the pairs whose cosine reaches the threshold."""
    near = np.zeros(pairs.shape[1], bool)
    for at in range(0, len(near), 1 << 16):
        a, b = pairs[:, at:at + (1 << 16)]
        near[at:at + (1 << 16)] = np.einsum("ij,ij->i", units[a], units[b]) >= threshold
    return pairs[:, near]


def roots(n: int, pairs: np.ndarray) -> np.ndarray:
    """Least member of each member's component."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, pairs[0], label[pairs[1]])
        np.minimum.at(new, pairs[1], label[pairs[0]])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _vectors(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten(), np.float64)
    return flat.reshape(len(column), -1)


def _bytes(values: np.ndarray) -> pa.Array:
    """A value of binary per row."""
    width = values.shape[1]
    offsets = pa.array(np.arange(0, values.size + 1, width, dtype=np.int32))
    return pa.Array.from_buffers(pa.binary(), len(values), [
        None, offsets.buffers()[1], pa.py_buffer(np.ascontiguousarray(values))])


def _encode(bits: int, count: int):
    """Codes, and the keys of their bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = np.diff(np.asarray(batch.column("vector").offsets))
            for size in np.unique(lengths):
                some = batch.filter(pa.array(lengths == size))
                codes = encoded(unit(_vectors(some.column("vector"))), bits * count)
                keys = _keys(codes.signs, bits)
                yield pa.RecordBatch.from_pydict({
                    "cid": some.column("cid"), "label": some.column("label"),
                    "size": pa.array(np.full(len(some), size, np.int32)), "times": some.column("times"),
                    "code": _bytes(np.packbits(codes.signs, axis=1)), "levels": _bytes(codes.levels.view(np.uint8)),
                    "step": pa.array(codes.step), "factor": pa.array(codes.factor), "spread": pa.array(codes.spread),
                    "keys": pa.ListArray.from_arrays(
                        pa.array(np.arange(0, keys.size + 1, count, dtype=np.int32)), pa.array(keys.ravel()))})

    return run


def _keys(signs: np.ndarray, bits: int) -> np.ndarray:
    """A key per band."""
    return signs.reshape(len(signs), -1, bits) @ (1 << np.arange(bits, dtype=np.int64))


def _codes(table: pa.Table, n_bits: int) -> Codes:
    def matrix(name: str, kind: type) -> np.ndarray:
        return np.frombuffer(b"".join(table.column(name).to_pylist()), kind).reshape(table.num_rows, -1)

    signs = np.unpackbits(matrix("code", np.uint8), axis=1, count=n_bits).astype(bool)
    return Codes(signs, matrix("levels", np.int8), *(np.asarray(table.column(c)) for c in ("step", "factor", "spread")))


def _candidates(table: pa.Table, bits: int, count: int, threshold: float) -> np.ndarray:
    """Open pairs of a cell that met in no band before; the table is sorted by cid."""
    codes = _codes(table, bits * count)
    allowed = np.triu(np.ones((table.num_rows, table.num_rows), bool), 1)
    block = np.asarray(table.column("block"))
    if len(np.unique(block)) > 1:  # pairs within a block have a cell of their own
        allowed &= block[:, None] != block
    keys = _keys(codes.signs, bits)
    for band in range(table.column("band")[0].as_py()):
        allowed &= keys[:, band, None] != keys[:, band]
    return open_pairs(codes, allowed, threshold)


def _with_open(table: pa.Table, bits: int, count: int, threshold: float) -> pa.Table:
    """Places of the vectors that have an open pair in a cell."""
    some = np.unique(_candidates(table, bits, count, threshold))
    return table.select(["cid", "bucket", "band", "block", "low", "high"]).take(pa.array(some))


def _links(table: pa.Table, bits: int, count: int, threshold: float) -> pa.Table:
    """Links that a cell has: each vector's number of linked vectors, and its root."""
    units = unit(_vectors(table.column("vector").combine_chunks()))
    cid, times = np.asarray(table.column("cid")), np.asarray(table.column("times"))
    pairs = recomputed(units, _candidates(table, bits, count, threshold), threshold)
    links = np.bincount(pairs[0], times[pairs[1]], len(cid)) + np.bincount(pairs[1], times[pairs[0]], len(cid))
    some = np.flatnonzero(links)
    return pa.table({
        "a": pa.array(cid[some]), "b": pa.array(cid[roots(len(cid), pairs)[some]]),
        "n": pa.array(links[some].astype(np.int64))})


def _cells(seen: Callable[..., pa.Table], bits: int, count: int, threshold: float):
    """Rows come sorted by cell; a cell may begin in one batch and end in another."""

    def done(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from seen(pa.Table.from_batches(held).sort_by("cid"), bits, count, threshold).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            cell = np.stack([np.asarray(batch.column(c)) for c in CELL])
            cuts = [0, *(np.flatnonzero((cell[:, 1:] != cell[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                piece = batch.slice(a, b - a)
                if held and any(held[0].column(c)[0] != piece.column(c)[0] for c in CELL):
                    yield from done(held)
                    held = []
                held.append(piece)
        if held:
            yield from done(held)

    return run


def near_vectors(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row vec_id, n_links, component_id and kept."""
    spark = embeddings.sparkSession
    ship(spark)
    vector = F.col("embedding").cast("array<double>")
    rows = embeddings.select(F.col("vec_id").cast("long"), F.col("label").cast("string"), vector.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    good = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite
            & F.exists("vector", lambda x: x != 0))
    prints = [F.xxhash64(F.lit(n), "label", "vector").alias(f"print{n}") for n in (1, 2)]
    rows = rows.select("vec_id", F.coalesce(good, F.lit(False)).alias("good"), "label", "vector", *prints)
    key = ["print1", "print2"]
    least = stored(rows.where("good").groupBy(*key).agg(F.min("vec_id").alias("cid"), F.count("*").alias("times")), "llm-equal")
    members = rows.select("vec_id", "good", *key)
    chosen = rows.where("good").join(least.withColumnRenamed("cid", "vec_id"), [*key, "vec_id"])
    classes = stored(chosen.dropDuplicates([*key]).select(
        F.col("vec_id").alias("cid"), "label", "vector", "times"), "llm-vectors")
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    bits, count = bands(largest, threshold)

    codes = stored(classes.mapInArrow(
        _encode(bits, count), f"cid long, label string, size int, times long, {CODE}, keys array<long>"), "llm-codes")
    placed = codes.select("cid", "label", "size", F.posexplode("keys").alias("band", "key")).select(
        "cid", "band", F.xxhash64("label", "size", "band", "key").alias("bucket"))
    placed = stored(placed, "llm-bands")
    full = stored(placed.groupBy("bucket").agg(
        F.min("cid").alias("least"), F.max("cid").alias("most"), F.count("*").alias("n")).where("least < most").select(
        "bucket", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "llm-buckets")
    release(spark)
    block = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    spread = placed.join(full, "bucket").withColumn("block", block).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.select("cid", "bucket", "band", "block", F.least("block", "other").alias("low"),
                           F.greatest("block", "other").alias("high"))

    def by_cell(places: DataFrame) -> DataFrame:
        return places.repartition(*CELL).sortWithinPartitions(*CELL)

    code = codes.drop("keys")
    # Labels and lengths are told apart again: a bucket is a hash.
    coded = spread.join(code, "cid").withColumn("bucket", F.xxhash64("bucket", "label", "size")).drop("label", "size", "times")
    left = stored(by_cell(coded).mapInArrow(
        _cells(_with_open, bits, count, threshold),
        "cid long, bucket long, band int, block int, low int, high int"), "llm-open")
    release(spark)
    whole = left.join(code.drop("label", "size", "times"), "cid").join(classes.drop("label"), "cid")
    found = stored(by_cell(whole).mapInArrow(
        _cells(_links, bits, count, threshold), "a long, b long, n long"), "llm-found-links")
    release(spark)
    labels = components(found.select("a", "b"))
    links = found.groupBy(F.col("a").alias("cid")).agg(F.sum("n").alias("n"))
    about = least.join(links, "cid", "left").join(labels.withColumnRenamed("id", "cid"), "cid", "left").select(
        *key, (F.col("times") - 1 + F.coalesce("n", F.lit(0))).alias("n"), F.coalesce("component", "cid").alias("component"))
    about = stored(about, "llm-about")
    component = F.when(F.col("good"), F.col("component")).otherwise(F.col("vec_id"))
    return members.join(about, key, "left").select(
        "vec_id", F.when(F.col("good"), F.col("n")).otherwise(F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))
