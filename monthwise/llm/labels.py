"""Labels and folds shared by the trained document classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthwise.llm.common import col

#: Labels of more rows than this are joined by shuffle instead of broadcast (16 bytes a row).
BROADCAST_LABELS = 4_000_000


def fold(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(id_col.cast("string").cast("binary")) % folds


def labelled_ids(labels: DataFrame, id_col: str, label_col: str, folds: int, held_out: int) -> DataFrame:
    """(id, y) of the rows to learn from: null ids and labels are left out, repeated ids take their mean, 0.5 up."""
    rows = labels.where(col(label_col).isNotNull() & (fold(col(id_col).cast("long"), folds) != held_out))
    return rows.groupBy(col(id_col).cast("long").alias("id")).agg((F.avg(col(label_col)) >= 0.5).cast("int").alias("y"))


def with_labels(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Documents (id, text) that have a label, with it; texts stay where they are while the labels are few."""
    few = ids.count() <= BROADCAST_LABELS
    return docs.join(F.broadcast(ids) if few else ids, "id")


def with_label(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """All documents (id, text), with their label or null."""
    few = ids.count() <= BROADCAST_LABELS
    return docs.join(F.broadcast(ids) if few else ids, "id", "left")


def held_out_column(id_col: str, folds: int, held_out: int) -> Column:
    return F.coalesce(fold(col(id_col), folds) == held_out, F.lit(False)).alias("held_out")
