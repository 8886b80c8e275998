"""Stored layout of the fact tables: folders by audit, buckets of the record number.

A reporting run reads the latest audit of some months.  With a folder per audit,
the filtered submissions prune the fact scans at run time (dynamic partition
pruning on the audit, which is a join key everywhere), so the files read follow
the window, not the history.  Within an audit, rows lie in buckets of the record
number: joins and reductions by record need no exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.functions.flags import q
from monthwise.session import join_on_stored_partitioning
from monthwise.sources.tables import SCHEMAS, Sources

RECORD = "RecordNumber"
FACTS = ("referral", "mpi", "empstatus", "socpercirc", "carecontact", "careactivity", "assessments")


def _audit(df: DataFrame) -> str | None:
    return next((c for c in df.columns if c.lower() == "auditid"), None)


def store_by_record(src: Sources, database: str, buckets: int) -> None:
    """Write the tables of ``src`` as catalog tables of ``database``; facts by audit and record bucket.

    ``buckets`` should give files of some 100 MB in an audit's folder, and be the same for all facts.
    """
    for attr, name in Sources._NAMES.items():
        df = getattr(src, attr)
        writer = df.write
        if attr in FACTS:
            audit = _audit(df)
            if RECORD in df.columns:
                # One task holds a bucket's share of an audit: one file for each of the two.
                df = df.repartition(*([F.col(audit)] if audit else []), F.pmod(F.hash(RECORD), F.lit(buckets)))
                writer = df.write.bucketBy(buckets, RECORD).sortBy(RECORD)
            if audit:
                writer = writer.partitionBy(audit)
        writer.format("parquet").mode("overwrite").saveAsTable(f"{database}.{name}")


def stored_sources(spark: SparkSession, database: str) -> Sources:
    """The tables of ``database`` as ``store_by_record`` wrote them."""
    join_on_stored_partitioning(spark)
    tables = {name: spark.table(f"{database}.{name}").selectExpr(*[q(c) for c in SCHEMAS[name].names])
              for name in Sources._NAMES.values()}
    out = Sources.from_tables(tables)
    out.stored_by_record = True
    return out
