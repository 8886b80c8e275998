"""The registered queries: each applies one operator with production parameters to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.llm import oracles
from monthwise.llm.collocations import collocations
from monthwise.llm.common import new_folder
from monthwise.llm.decontamination import contamination
from monthwise.llm.licences import scan_licences
from monthwise.llm.minhash_dedup import near_duplicates
from monthwise.llm.packing import pack
from monthwise.llm.quality import score_quality
from monthwise.llm.repeat_index import dedup_bytes
from monthwise.llm.spelling_variants import spelling_variants
from monthwise.llm.substring_dedup import dedup_substrings
from monthwise.llm.token_counts import token_counts
from monthwise.llm.topk_products import top_products
from monthwise.llm.toxicity import score_toxicity
from monthwise.llm.warc import archive_pages, read_archive


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_substrings(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "archive")
    archive_pages(table(spark, sf_dir, "pages"), path)
    page = lambda c: F.regexp_extract(c, "^urn:page:(.*)$", 1).try_cast("long")
    return read_archive(spark, path, payload=False, verify=True).select(
        page(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page(F.col("refers_to")).alias("refers_to"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op7_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licences(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_findings", F.array_join("families", ",").alias("families"),
        F.size(F.filter("findings", lambda x: x["confirmed"])).cast("long").alias("n_confirmed"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), typo_every=199)


def op13_repeat_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_bytes(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_benchmark_decontamination": op1_benchmark_decontamination,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_quality": op3_quality,
    "op4_warc": op4_warc,
    "op5_toxicity": op5_toxicity,
    "op6_token_counts": op6_token_counts,
    "op7_licence_scan": op7_licence_scan,
    "op8_packing": op8_packing,
    "op9_exact_topk": op9_exact_topk,
    "op10_minhash_near_dedup": op10_minhash_near_dedup,
    "op11_phrase_collocations": op11_phrase_collocations,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_repeat_index": op13_repeat_index,
}

ORACLE_SQL: dict[str, str] = {
    "op1_benchmark_decontamination": oracles.OP1,
    "op2_substring_dedup": oracles.OP2,
    "op4_warc": oracles.OP4,
    "op9_exact_topk": oracles.OP9,
    "op10_minhash_near_dedup": oracles.OP10,
    "op11_phrase_collocations": oracles.OP11,
    "op12_spelling_variants": oracles.OP12,
    "op13_repeat_index": oracles.OP13,
}
