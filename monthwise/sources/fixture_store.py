"""The test fixture stored as parquet: inputs of the registered queries, the tests and the bench.

Not part of the library's own path: pipelines read ``Sources`` that their caller opens.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from monthwise.sources.fixture import spark_tables
from monthwise.sources.tables import Sources

# Per application and input folder: the driver tables are fixed, so their projection is written once.
_STORED: dict[tuple[str, str], Sources] = {}

FACT_TABLES = {"IDS101referral", "IDS001mpi", "IDS004empstatus", "IDS011socpercircumstances", "IDS201carecontact",
               "IDS202careactivity", "IDS606codedscoreassessmentrefer"}

# Up to this many order lines the facts are dealt evenly over one file per core.
SMALL_ROWS = 1_000_000


def _root(spark: SparkSession) -> str:
    """The session's shared folder; a scratch folder only where it is unset in a local session (tests, bench)."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set: name a folder that the driver and all executors share")
    return root or tempfile.mkdtemp(prefix="monthwise-fixture-", dir="/tmp")


def fixture_sources(spark: SparkSession, sf_dir: str) -> Sources:
    """Fixture sources for ``sf_dir``, written once per application.

    The pipelines so get real parquet scans with column pruning and filter
    pushdown, as with stored domain tables.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED:
        base = f"{_root(spark)}/fixture-{uuid.uuid4().hex[:12]}"
        # Small fact tables are spread over one file per core so scans run in parallel (stored tables have many files);
        # large ones have many files as they are, and dealing their wide rows again would shuffle most of all bytes.
        # Dimensions are one file.
        files = spark.sparkContext.defaultParallelism
        small = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count() <= SMALL_ROWS

        def write(df: DataFrame, path: str) -> None:
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)

        def keep(name: str, df: DataFrame) -> DataFrame:
            """Joins that several tables start from are made once."""
            write(df, f"{base}/source-{name}")
            return spark.read.schema(df.schema).parquet(f"{base}/source-{name}")

        for name, df in spark_tables(spark, sf_dir, keep).items():
            if name in FACT_TABLES:
                df = df.repartition(files) if small else df
            else:
                df = df.coalesce(1)
            write(df, f"{base}/{name}")
        _STORED[key] = Sources.from_parquet(spark, base)
    return _STORED[key]
