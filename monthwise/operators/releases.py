"""All-or-nothing releases of published tables.

A run writes each of its tables into a folder that only it uses.  When all are
written, one file appended to the release log names, for every table, the
folders its rows now come from: whole tables, or single months of them.  Readers
follow the newest entry of the log, so they see all tables of a run or none; a
run that is lost half-way leaves files that nobody reads.  Months that a run
doesn't write keep pointing to the run that wrote them, whichever mode wrote
them, so creating a table and appending to it later loses nothing.

The log holds one row per table and month of each release: small, and the only
thing collected.  One run writes to a root at a time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from monthwise.operators.publish import cast_columns

LOG = "release long, run string, table string, month string, columns string"
#: Months as text, in the folders' names only: the month column itself keeps its type in the files.
KEY = "release_month"


@dataclass(frozen=True)
class Part:
    """Where rows of a table are: the run that wrote them, and their month (None: null months)."""

    run: str
    month: str | None
    columns: str


class Releases:
    """The published tables under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _log(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(LOG).parquet(f"{self.root}/release_log")
        except AnalysisException as e:
            if e.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def current(self, release: int | None = None) -> tuple[int, dict[str, list[Part]]]:
        """Number and parts of the newest release, or of an earlier one; 0 and nothing before the first."""
        log = self._log()
        if log is None:
            return 0, {}
        if release is None:
            release = log.agg(F.max("release").alias("r")).first()["r"] or 0
        parts: dict[str, list[Part]] = {}
        for row in log.where(F.col("release") == release).collect():
            parts.setdefault(row["table"], []).append(Part(row["run"], row["month"], row["columns"]))
        return release, parts

    def _folder(self, run: str, table: str) -> str:
        return f"{self.root}/release_data/{run}/{table}"

    def begin(self) -> "Run":
        return Run(self, uuid.uuid4().hex)

    def read(self, table: str, release: int | None = None) -> DataFrame:
        """A table as the newest release (or an earlier one) has it."""
        _, parts = self.current(release)
        if table not in parts:
            raise ValueError(f"no release under {self.root} has a table {table!r}")
        frames = []
        for run in dict.fromkeys(p.run for p in parts[table]):
            own = [p for p in parts[table] if p.run == run]
            schema = StructType.fromJson(_parsed(own[0].columns))
            # The month is in the folder's name: other months' files aren't listed into the scan.
            df = self.spark.read.schema(schema.add(KEY, "string")).parquet(self._folder(run, table))
            months = [p.month for p in own if p.month is not None]
            wanted = F.col(KEY).isin(months) if months else F.lit(False)
            if len(months) < len(own):
                wanted = wanted | F.col(KEY).isNull()
            frames.append(df.where(wanted).drop(KEY))
        return reduce(DataFrame.unionByName, frames)

    def register(self, database: str, tables: list[str] | None = None) -> None:
        """Catalog views ``database.table`` over the newest release."""
        _, parts = self.current()
        for table in tables or sorted(parts):
            selects = []
            for run in dict.fromkeys(p.run for p in parts[table]):
                months = [p.month for p in parts[table] if p.run == run]
                schema = StructType.fromJson(_parsed(next(p.columns for p in parts[table] if p.run == run)))
                named = ", ".join("'" + m.replace("\\", "\\\\").replace("'", "\\'") + "'" for m in months if m is not None)
                wanted = [f"{KEY} IN ({named})"] * bool(named) + [f"{KEY} IS NULL"] * (None in months)
                columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema)
                selects.append(f"SELECT {columns} FROM parquet.`{self._folder(run, table)}` WHERE {' OR '.join(wanted)}")
            self.spark.sql(f"CREATE OR REPLACE VIEW {database}.{table} AS " + " UNION ALL ".join(selects))


class Run:
    """One run's tables, released together by ``commit``."""

    def __init__(self, releases: Releases, name: str):
        self.releases, self.name = releases, name
        self.written: dict[str, tuple[bool, list[Part], list[str | None]]] = {}
        self.metrics: dict[str, dict] = {}

    def write(self, table: str, df: DataFrame, mode: str = "rebuild", month_col: str = "Month",
              casts: dict[str, str] | None = None, replaces: list | None = None, measures: dict | None = None) -> None:
        """Stage a table.  ``rebuild`` replaces all of it on commit, ``append_month`` the months written and those in
        ``replaces`` (a month that has no rows left goes).

        ``measures`` (name -> aggregate Column) are taken in the write's own pass; row counts always are.
        """
        if mode not in ("rebuild", "append_month"):
            raise ValueError(f"unknown publish mode {mode!r}")
        if month_col not in df.columns:
            raise ValueError(f"{table} has no column {month_col!r} to be released by")
        spark, df = self.releases.spark, cast_columns(df, casts)
        key = F.col(f"`{month_col}`").cast("string")
        seen = Observation()
        folder = self.releases._folder(self.name, table)
        (df.observe(seen, F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in (measures or {}).items()])
           .withColumn(KEY, key).write.partitionBy(KEY).parquet(folder))
        self.metrics[table] = seen.get
        columns = df.schema.json()
        # Distinct values of a partition column: read from the folder's names.
        stored = spark.read.schema(StructType.fromJson(_parsed(columns)).add(KEY, "string")).parquet(folder)
        months = [r[0] for r in stored.select(KEY).distinct().collect()]
        parts = [Part(self.name, m, columns) for m in months]
        gone = [None if m is None else str(m) for m in replaces or []] + months
        self.written[table] = (mode == "rebuild", parts, gone)

    def commit(self) -> int:
        """Make this run's tables the current ones, all at once; returns the release's number."""
        release, parts = self.releases.current()
        for table, (whole, new, gone) in self.written.items():
            kept = [] if whole else [p for p in parts.get(table, []) if p.month not in gone]
            parts[table] = kept + new
        rows = [(release + 1, p.run, t, p.month, p.columns) for t, own in parts.items() for p in own]
        # One task writes one file, which the job's commit renames into place.
        (self.releases.spark.createDataFrame(rows, LOG).coalesce(1)
         .write.mode("append").parquet(f"{self.releases.root}/release_log"))
        return release + 1


def _parsed(text: str) -> dict:
    import json
    return json.loads(text)
