"""Training-data pipeline over ``documents``: each stage applies one operator to all that its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)``; all but the last return the columns of ``docs``.  Any further columns
travel along under names that no operator uses, so they can't clash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.llm.common import col, written
from monthwise.llm.decontamination import contamination
from monthwise.llm.minhash_dedup import near_duplicates
from monthwise.llm.packing import pack
from monthwise.llm.quality import score_quality
from monthwise.llm.queries import table
from monthwise.llm.substring_dedup import dedup_substrings


def _renamed(docs: DataFrame) -> tuple[DataFrame, tuple[str, ...]]:
    """``docs`` with all columns but ``doc_id`` and ``text`` under neutral names, and those names."""
    names = {c: f"kept_column_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    return docs.select(*[col(c).alias(names.get(c, c)) for c in docs.columns]), tuple(names.values())


def _restored(docs: DataFrame, like: DataFrame) -> DataFrame:
    return docs.select(*[F.col(c if c in ("doc_id", "text") else f"kept_column_{i}").alias(c)
                         for i, c in enumerate(like.columns)])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    rows, kept = _renamed(docs)
    scored = score_quality(rows, table(spark, sf_dir, "labels"), carry=("text", *kept))
    return _restored(scored.where("predicted = 1"), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, and one of rows that repeat it; null ids stay.

    A row is known by its id and a hash of its text, so texts that share an id are decided on their own.
    """
    rows, _ = _renamed(docs)
    known = rows.where("doc_id IS NOT NULL").withColumn("text_hash", F.xxhash64("text"))
    gone = near_duplicates(known, carry=("text_hash",)).where("NOT kept").select("doc_id", "text_hash").distinct()
    left = known.join(gone, ["doc_id", "text_hash"], "left_anti").dropDuplicates(["doc_id", "text_hash"])
    return _restored(left.drop("text_hash").unionByName(rows.where("doc_id IS NULL")), docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages go from all documents but the first; a text that loses words becomes its kept words."""
    rows, kept = _renamed(docs)
    cut = dedup_substrings(rows, carry=("text", *kept))
    out = _restored(cut.withColumn("text", F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))),
                    docs)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else out


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by the benchmark go."""
    rows, kept = _renamed(docs)
    marked = contamination(rows, table(spark, sf_dir, "benchmark"), carry=("text", *kept))
    return _restored(marked.where("NOT contaminated"), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's place in a batch of documents of like length."""
    return pack(docs, by_id=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontaminate", decontaminate),
    ("packing", packing),
]

#: The quality model's scores can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written to the shared folder and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
