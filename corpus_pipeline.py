"""From raw documents to packed training sequences: one operator after the other."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadspark.llm.forest import near_duplicates
from quadspark.llm.mixing import mixed
from quadspark.llm.packing import packed
from quadspark.llm.queries import tokenizer_path
from quadspark.llm.substring import cut_repeats
from quadspark.llm.tables import read, stored
from quadspark.llm.toxicity import held_out, train, without_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; it is trained on the labels that are not held out."""
    labels = read(spark, sf_dir, "labels")
    return without_toxic(docs, train(docs, labels.where(~held_out(F.col("doc_id")))))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: that with the least id (null last).

    Rows are compared one by one, whatever their ids; a row goes only if a row
    of its own group stays.  Rows without words are copies of nothing and stay.
    """
    rows = stored(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("number")), "pipeline-rows")
    text = F.col("row").getField("text").cast("string").alias("text")
    groups = near_duplicates(rows.select(F.col("number").alias("doc_id"), text)).select(
        F.col("doc_id").alias("number"), F.col("component_id").alias("group"))
    ids = rows.select("number", F.col("row").getField("doc_id").cast("long").alias("id"))
    least = F.min(F.struct(F.col("id").isNull(), "id", "number")).getField("number")
    first = stored(groups.join(ids, "number").groupBy("group").agg(least.alias("number")).select("number"), "pipeline-kept")
    kept = rows.join(first, "number", "left_semi")
    return kept.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that an earlier document has go."""
    cut = cut_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that sources have their target weights."""
    return mixed(docs, F.array("source"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every document's tokens stand in which training sequence."""
    return packed(docs, tokenizer_path())


#: Each is given what its predecessor has kept.
STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("repeated passages", cut_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]
#: Training, MinHash and packing have no SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{number}")
    return docs
