"""Sharding by fixed virtual slots (operator 8), DataFrame functions only.

Records are hashed by id and text into ``SLOTS`` virtual slots, which never
change; equal records that alone would outgrow a slot are spread over all.  The
bytes of each slot are summed, and a *map* says which shard a slot belongs to.
The first map fills the shards evenly, the largest slots first (so shard sizes
are near equal: the ``bytes`` law); rebalancing edits the map slot by slot and
stores it under the next version, so only the edited slots' records move.

A map has ``SLOTS`` rows at most, whatever the input; it is folded in one
expression, and its size is a proven bound for broadcasting it.

Defined results: a null text has no bytes and size 8; a null id is hashed like
any other; repeated rows are placed one by one; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quadspark.llm.tables import stored
from quadspark.session import scratch_path
from quadspark.sources.storage import path_exists

SLOTS, SHARDS, ROW_BYTES = 8192, 24, 8


def sized(documents: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size, text_crc32 and vslot (the virtual slot) of every record."""
    raw = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "UTF-8")
    doc_id = F.col("doc_id").cast("long")
    return documents.select(
        doc_id, (F.length(raw) + ROW_BYTES).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.pmod(F.xxhash64(doc_id, raw), F.lit(slots)).cast("int").alias("vslot"))


def spread(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Records (a table) of which no group of equal ones holds more than an average slot, but spread over all slots."""
    key = ["doc_id", "size", "text_crc32", "vslot"]
    total = records.count()
    # Fewer groups than slots can have more records than the average slot.
    heavy = records.groupBy(*key).count().where(F.col("count") * slots > F.lit(max(total, 2 * slots))).select(
        *(F.col(k).alias(f"h_{k}") for k in key))
    alike = [F.col(k).eqNullSafe(F.col(f"h_{k}")) for k in key]
    joined = records.join(F.broadcast(heavy), alike, "left")
    # The records are a table, so a row has one number in every run of a task.
    other = F.pmod(F.xxhash64("vslot", F.monotonically_increasing_id()), F.lit(slots)).cast("int")
    return joined.select("doc_id", "size", "text_crc32", F.when(F.col("h_size").isNotNull(), other).otherwise(F.col("vslot")).alias("vslot"))


def slot_bytes(records: DataFrame) -> DataFrame:
    """Bytes and records of each slot."""
    return records.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("records"))


def _filled(slots: Column, loads: Column) -> Column:
    """Shard of each slot (structs, largest first): always the one that is emptiest by then."""
    start = F.struct(loads.alias("loads"), F.array().cast("array<int>").alias("picks"))

    def step(state, slot):
        pick = F.array_position(state["loads"], F.array_min(state["loads"])).cast("int") - 1
        loads = F.transform(state["loads"], lambda x, i: F.when(i == pick, x + slot["bytes"]).otherwise(x))
        return F.struct(loads.alias("loads"), F.concat(state["picks"], F.array(pick)).alias("picks"))

    return F.aggregate(slots, start, step)["picks"]


def first_map(sizes: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Map version 1: vslot, shard and version."""
    slots = F.sort_array(F.collect_list(F.struct("bytes", "vslot")), asc=False)
    loads = F.array_repeat(F.lit(0).cast("long"), shards)
    one = sizes.agg(slots.alias("slots")).withColumn("picks", _filled(F.col("slots"), loads))
    return one.select(F.explode(F.arrays_zip("slots", "picks")).alias("x")).select(
        F.col("x.slots.vslot").alias("vslot"), F.col("x.picks").alias("shard"), F.lit(1).alias("version"))


def grow(slot_map: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """The next version for one more shard: each old shard gives its smallest slots, up to its fair share.

    ``shards``: the number before.  No slot moves between old shards.
    """
    smallest = Window.partitionBy("shard").orderBy("bytes", "vslot").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = slot_map.join(sizes.select("vslot", "bytes"), "vslot", "left").fillna(0, ["bytes"])
    total = known.agg(F.sum("bytes").alias("total"))
    # One row of a sum.
    edited = known.withColumn("given", F.sum("bytes").over(smallest)).crossJoin(F.broadcast(total))
    moves = F.col("given") * (shards * (shards + 1)) <= F.col("total")
    return edited.select("vslot", F.when(moves, F.lit(shards)).otherwise(F.col("shard")).cast("int").alias("shard"),
                         (F.col("version") + 1).alias("version"))


def save_map(slot_map: DataFrame, path: str) -> None:
    """Add a version to the stored maps."""
    slot_map.write.mode("append").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """A stored version, or the latest one."""
    maps = spark.read.schema("vslot int, shard int, version int").parquet(path)
    if version is None:
        version = maps.agg(F.max("version")).first()[0] or 0
    return maps.where(F.col("version") == version)


def place(records: DataFrame, slot_map: DataFrame, sizes: DataFrame) -> DataFrame:
    """The records with their shard and their slot in it, gapless from 0.

    Records are numbered within their virtual slot; the slots' counts add up to
    where each one starts.
    """
    # SLOTS rows at most.
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("records").over(before), F.lit(0)).alias("begin")
    starts = slot_map.join(sizes, "vslot").select("vslot", "shard", start)
    inner = Window.partitionBy("vslot").orderBy("doc_id", "size", "text_crc32")
    numbered = records.withColumn("number", F.row_number().over(inner) - 1)
    return numbered.join(F.broadcast(starts), "vslot").withColumn("slot", F.col("begin") + F.col("number"))


def shard(documents: DataFrame, shards: int = SHARDS, slots: int = SLOTS, map_path: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, vslot, shard and slot of every record.

    The map is stored at ``map_path`` (else in the scratch folder); if there is
    one already, its latest version is used.
    """
    spark = documents.sparkSession
    records = stored(spread(stored(sized(documents, slots), "llm-sized"), slots), "llm-records")
    sizes = stored(slot_bytes(records), "llm-slots")
    path = map_path or scratch_path(spark, "llm-slot-map")
    every = spark.range(slots).select(F.col("id").cast("int").alias("vslot")).join(sizes, "vslot", "left").fillna(0)
    if not path_exists(spark, path):
        save_map(first_map(every, shards), path)
    return place(records, load_map(spark, path), sizes).select("doc_id", "size", "text_crc32", "vslot", "shard", "slot")
