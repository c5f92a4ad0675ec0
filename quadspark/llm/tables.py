"""Tables in the shared scratch folder, and small helpers that all operators use."""

from __future__ import annotations

import gc
import os
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadspark.session import scratch_path

#: Bytes that count as white space between words.
BLANKS = b" \t\n\x0b\x0c\r"
#: A word, for Java's regular expressions.
WORD = r"[^\x20\x09-\x0D]+"


def ship(spark: SparkSession) -> None:
    """Send the package to the executors' Python, once per Spark context."""
    context = spark.sparkContext
    if not getattr(context, "_quadspark_shipped", False):
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        context.addPyFile(shutil.make_archive(f"{tempfile.mkdtemp()}/quadspark", "zip", root, "quadspark"))
        context._quadspark_shipped = True


def doc_texts(documents: DataFrame) -> DataFrame:
    """doc_id and text; the other columns of the documents are dropped."""
    ship(documents.sparkSession)
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    This cuts the lineage: whatever reads it next survives lost executors, and
    joins can split its hot keys, because nothing stands between it and their
    exchange.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished phases.

    It does so once the driver's JVM has collected the objects that stand for
    them; otherwise they wait for a collection that may not come for long.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def n_words(text: Column) -> Column:
    """Number of words of a text; none for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
