"""Publishing.

``rebuild`` replaces the whole table.  ``append_month`` replaces only the
months present in the new data (dynamic partition overwrite on ``Month``), so
re-running a month leaves the table unchanged instead of doubling it.  It needs
a target laid out by month: a target that isn't is refused before anything is
written, because a dynamic overwrite of it would replace all its months.  A
table that later runs append to is created with ``by_month=True``.  The target
is a parquet folder or a catalog table.  A failed task is retried by Spark and
the commit protocol only exposes finished files.

``operators.releases`` publishes several tables at once, all or none.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def cast_columns(df: DataFrame, casts: dict[str, str] | None) -> DataFrame:
    """``df`` with the output casts of a published table (column -> SQL type); other columns stay."""
    missing = [c for c in casts or {} if c not in df.columns]
    if missing:
        raise ValueError(f"no such columns to cast: {missing}")
    return df.withColumns({c: F.col(f"`{c}`").cast(t) for c, t in (casts or {}).items()})


def folder_layout(spark: SparkSession, path: str) -> list[str] | None:
    """Names of the columns a parquet folder is partitioned by; None where there is nothing yet."""
    try:
        stored = spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    # The data files' own columns; what the folder names add is the layout.
    plain = spark.read.option("recursiveFileLookup", "true").parquet(path).columns
    return [c for c in stored.columns if c not in plain]


def table_layout(spark: SparkSession, table: str) -> list[str] | None:
    """Names of the columns a catalog table is partitioned by; None where there is no such table."""
    if not spark.catalog.tableExists(table):
        return None
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _require_months(layout: list[str] | None, month_col: str, target: str) -> None:
    if layout is not None and layout != [month_col]:
        raise ValueError(f"{target} is laid out by {layout or 'nothing'}, not by {month_col!r}: appending a month would "
                         "replace its other months.  Rebuild it with by_month=True first.")


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def publish(df: DataFrame, path: str | None = None, mode: str = "rebuild", month_col: str = "Month",
            table: str | None = None, casts: dict[str, str] | None = None, by_month: bool = False) -> None:
    """Write ``df`` to the folder ``path`` or to the catalog table ``table``.

    ``by_month`` lays a rebuilt target out by ``month_col``, so months can be appended to it.
    """
    if mode not in ("rebuild", "append_month"):
        raise ValueError(f"unknown publish mode {mode!r}")
    if (path is None) == (table is None):
        raise ValueError("name either a path or a table")
    spark, df = df.sparkSession, cast_columns(df, casts)
    if mode == "rebuild":
        writer = df.write.mode("overwrite").partitionBy(*[month_col] * by_month)
        if path is not None:
            # Static: the whole folder goes, whatever the session's default and its present layout are.
            writer.option("partitionOverwriteMode", "static").parquet(path)
        else:
            writer.format("parquet").saveAsTable(table)  # options would stay with the table
        return
    layout = folder_layout(spark, path) if path is not None else table_layout(spark, table)
    _require_months(layout, month_col, path or table)
    if table is not None and layout is not None:
        # The table's own partitioning applies; columns go by position.  An insert takes the overwrite mode from the
        # table or the session, not from the writer's options.
        with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
            df.select(*spark.table(table).columns).write.mode("overwrite").insertInto(table)
        return
    writer = df.write.mode("overwrite").partitionBy(month_col)
    if path is not None:
        writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    else:
        writer.format("parquet").saveAsTable(table)


def read_published(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame:
    """A published folder; with ``like`` its columns' types and order, so a month kept as text stays text."""
    return spark.read.parquet(path) if like is None else spark.read.schema(like.schema).parquet(path).select(*like.columns)
