"""The registered queries of the operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadspark.llm.arc import archive_pages
from quadspark.llm.forest import near_duplicates
from quadspark.llm.infill import infill, restored
from quadspark.llm.linkgraph import RULES, filter_urls
from quadspark.llm.manifest import proofs, tampered
from quadspark.llm.mixing import mix
from quadspark.llm.oracles import SQL  # noqa: F401
from quadspark.llm.packing import packed
from quadspark.llm.quality import scored as quality_scored
from quadspark.llm.repetition import repetition
from quadspark.llm.rotation import near_vectors
from quadspark.llm.sharding import shard
from quadspark.llm.substring import removed_words, remove_repeats
from quadspark.llm.tables import read
from quadspark.llm.toxicity import scored


def tokenizer_path() -> str:
    """The public tokenizer that the packing query counts with."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", removed_words().alias("n_removed"),
                        F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted", F.size("offending").alias("n_offending"))


def op3_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(read(spark, sf_dir, "pages"))


def op4_rotated_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read(spark, sf_dir, "embeddings"))


def op5_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return filter_urls(read(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


def op6_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"), size=3, percent=85)


def op7_genetic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(read(spark, sf_dir, "documents"), tokenizer_path())


def op8_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "vslot")


def op9_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op10_flow_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    own = F.col("takes")[0]
    return mix(documents, F.array("source")).select(
        "doc_id", "size", own["source_size"].alias("source_size"), F.round(own["target"], 6).alias("target"), "taken")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = proofs(read(spark, sf_dir, "documents"), tampered())
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.translate("proof", "|;", ""), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_quality_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = restored(infill(read(spark, sf_dir, "documents")))
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_arc_to_warc": op3_arc_to_warc,
    "op4_rotated_codes": op4_rotated_codes,
    "op5_link_graph": op5_link_graph,
    "op6_minhash_forest": op6_minhash_forest,
    "op7_genetic_packing": op7_genetic_packing,
    "op8_virtual_slots": op8_virtual_slots,
    "op9_repetition": op9_repetition,
    "op10_flow_mixing": op10_flow_mixing,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_quality_ftrl": op12_quality_ftrl,
    "op13_fill_in_middle": op13_fill_in_middle,
}
