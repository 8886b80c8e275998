"""Reporting period selection (O1 reporting_window, O2 slice_period)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_FLOOR = dt.date(2020, 9, 1)


@dataclass(frozen=True)
class Period:
    """The reporting month a run publishes, plus the back-series floor."""

    start: dt.date
    end: dt.date
    floor: dt.date | None = None


def reporting_window(submissions: DataFrame, offset: int = -1, floor: dt.date | None = None,
                     start_col: str = "ReportingPeriodStartDate",
                     end_col: str = "ReportingPeriodEndDate") -> DataFrame:
    """O1: one row ``(period_start, period_end, floor)``.

    ``period_start`` is the newest submitted period start moved by ``offset``
    months; ``period_end`` is the last day of the newest period end moved the
    same way.  All submissions count, latest or not.
    """
    return submissions.agg(
        F.add_months(F.max(start_col), offset).alias("period_start"),
        F.last_day(F.add_months(F.max(end_col), offset)).alias("period_end"),
    ).select("period_start", "period_end", F.lit(floor).cast("date").alias("floor"))


def resolve_period(submissions: DataFrame, offset: int = -1, floor: dt.date | None = DEFAULT_FLOOR) -> Period:
    """Evaluate O1 once on the driver (a single row) so later filters are literals
    that reach the parquet scan and prune row groups."""
    row = reporting_window(submissions, offset, floor).first()
    return Period(row["period_start"], row["period_end"], row["floor"])


def slice_period(df: DataFrame, start_col: str, lo, hi) -> DataFrame:
    """O2: rows whose period start lies in ``[lo, hi]`` (inclusive).

    ``lo == hi`` gives one month; ``lo = floor`` gives the whole back series.
    """
    return df.where(period_bounds_sql(start_col, lo, hi))


def period_bounds_sql(start_col: str, lo, hi) -> str:
    """Inclusive literal bounds, so the filter reaches the parquet scan."""
    return f"`{start_col}` BETWEEN DATE '{lo}' AND DATE '{hi}'"
