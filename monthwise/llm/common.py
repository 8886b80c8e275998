"""Shared pieces of the operators: the shared scratch folder, written intermediates, column passing."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a scratch folder only where it is unset in a local session."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="monthwise-llm-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder that no other run uses."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def col(name: str) -> Column:
    """Column by its exact name (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_bytes(docs: DataFrame, text: str) -> int:
    """UTF-8 bytes of all texts: one narrow aggregate that sizes batches by the data."""
    return docs.agg(F.coalesce(F.sum(F.octet_length(col(text))), F.lit(0)).alias("b")).first()["b"]


def without(carry: tuple[str, ...], *results: str) -> tuple[str, ...]:
    """Columns to carry; where an operator's result has the name of one, the result's column is meant."""
    return tuple(c for c in carry if c not in results)
