"""Input tables of the pipelines.

``Sources`` bundles the 14 domain tables as lazy DataFrames.  On a cluster they
are read from parquet (one folder per table, ideally partitioned by
``Unique_MonthID`` so the month filter prunes files); in tests they are the
fixture projection of the driver tables.  Schemas are explicit so no file is
sampled for inference.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from monthwise.session import join_on_stored_partitioning
from monthwise.sources.fixture import FIXTURE_TABLES, spark_tables

_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "double": T.DoubleType(),
}

# Input schemas: the columns each pipeline reads.
SCHEMAS: dict[str, T.StructType] = {
    t.name: T.StructType([T.StructField(c, _TYPES[typ], True) for c, typ, _ in t.columns])
    for t in FIXTURE_TABLES
}


@dataclass
class Sources:
    """The domain tables a pipeline run reads."""

    submissions: DataFrame      # IsLatest_SubmissionID
    referral: DataFrame         # IDS101referral
    mpi: DataFrame              # IDS001mpi
    empstatus: DataFrame        # IDS004empstatus
    socpercirc: DataFrame       # IDS011socpercircumstances
    carecontact: DataFrame      # IDS201carecontact
    careactivity: DataFrame     # IDS202careactivity
    assessments: DataFrame      # IDS606codedscoreassessmentrefer
    comm_changes: DataFrame     # ComCodeChanges
    prov_successor: DataFrame   # Provider_Successor
    comm_hierarchy: DataFrame   # Ref_ODS_Commissioner_Hierarchies_ICB
    prov_hierarchy: DataFrame   # Ref_ODS_Provider_Hierarchies_ICB
    deprivation: DataFrame      # Domains_Of_Deprivation_By_LSOA1
    sites: DataFrame            # REFERENCE_ODS_All_Sites
    # Whether the fact tables are stored in equally many buckets of the record number (``sources.layout``).
    stored_by_record: bool = False

    _NAMES = {
        "submissions": "IsLatest_SubmissionID",
        "referral": "IDS101referral",
        "mpi": "IDS001mpi",
        "empstatus": "IDS004empstatus",
        "socpercirc": "IDS011socpercircumstances",
        "carecontact": "IDS201carecontact",
        "careactivity": "IDS202careactivity",
        "assessments": "IDS606codedscoreassessmentrefer",
        "comm_changes": "ComCodeChanges",
        "prov_successor": "Provider_Successor",
        "comm_hierarchy": "Ref_ODS_Commissioner_Hierarchies_ICB",
        "prov_hierarchy": "Ref_ODS_Provider_Hierarchies_ICB",
        "deprivation": "Domains_Of_Deprivation_By_LSOA1",
        "sites": "REFERENCE_ODS_All_Sites",
    }

    @classmethod
    def from_tables(cls, tables: dict[str, DataFrame]) -> "Sources":
        return cls(**{attr: tables[name] for attr, name in cls._NAMES.items()})

    @classmethod
    def from_fixture(cls, spark: SparkSession, sf_dir: str) -> "Sources":
        """Domain tables projected from the driver tables in ``sf_dir``."""
        return cls.from_tables(spark_tables(spark, sf_dir))

    @classmethod
    def from_parquet(cls, spark: SparkSession, base_dir: str) -> "Sources":
        """Domain tables stored as ``{base_dir}/{table}/`` parquet folders."""
        join_on_stored_partitioning(spark)
        return cls.from_tables({
            name: spark.read.schema(SCHEMAS[name]).parquet(f"{base_dir}/{name}")
            for name in cls._NAMES.values()
        })

