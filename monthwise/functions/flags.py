"""0/1 flag expressions (O17 in_period_flag, O18 condition_flag, O19 days_open_bands,
O21 same_value_flags, O23 open_caseload).

Flags are INT 0/1 so that every published measure is a plain SUM; NULL in any
condition gives 0, as a searched CASE does.

Conditions are Spark SQL boolean expressions (strings).  Each flag becomes one
``CASE`` expression; the ``*_sql`` helpers return the text (for ``selectExpr``)
and the plain names return a Column (``F.expr``), so building a plan with
dozens of flags costs one client call per flag rather than one per operator.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PERIOD_START = "ReportingPeriodStartDate"
PERIOD_END = "ReportingPeriodEndDate"

# FIXED VALUES: days-open bands (inclusive), as published.
DAYS_OPEN_BANDS = [
    ("LessThan61Days", None, 60),
    ("61-90Days", 61, 90),
    ("91-120Days", 91, 120),
    ("Over120days", 121, None),
]


def q(name: str) -> str:
    """Quote a column name for Spark SQL."""
    return "`" + name.replace("`", "``") + "`"


def true_sql(col: str) -> str:
    """Boolean-like text flag; ``'True'`` and ``'true'`` both count (case folded)."""
    return f"lower({q(col)}) = 'true'"


def is_true(col: str) -> Column:
    return F.expr(true_sql(col))


def flag_sql(*conditions: str) -> str:
    """O18 as text: 1 when every condition is true, else 0 (NULL counts as false)."""
    body = " AND ".join(f"({c})" for c in conditions) if conditions else "true"
    return f"CASE WHEN {body} THEN 1 ELSE 0 END"


def condition_flag(*conditions: str) -> Column:
    """1 when every condition is true, else 0."""
    return F.expr(flag_sql(*conditions))


def in_period_sql(date: str, start: str = PERIOD_START, end: str = PERIOD_END) -> str:
    return f"{q(date)} BETWEEN {q(start)} AND {q(end)}"


def in_period(date: str, start: str = PERIOD_START, end: str = PERIOD_END) -> Column:
    return F.expr(in_period_sql(date, start, end))


def in_period_flag_sql(date: str, *conditions: str, start: str = PERIOD_START, end: str = PERIOD_END,
                       require: str | None = "PathwayID") -> str:
    """O17 as text: ``date`` in the row's own reporting period, every extra
    condition true, and ``require`` (default PathwayID) not NULL."""
    conds = [in_period_sql(date, start, end), *conditions]
    if require is not None:
        conds.append(f"{q(require)} IS NOT NULL")
    return flag_sql(*conds)


def in_period_flag(date: str, *conditions: str, start: str = PERIOD_START, end: str = PERIOD_END,
                   require: str | None = "PathwayID") -> Column:
    """0/1 flag for an event inside the row's own reporting period."""
    return F.expr(in_period_flag_sql(date, *conditions, start=start, end=end, require=require))


def _band_sql(days: str, lo, hi) -> str:
    if lo is None:
        return f"{days} < {hi + 1}"
    if hi is None:
        return f"{days} > {lo - 1}"
    return f"{days} BETWEEN {lo} AND {hi}"


def days_open_bands_sql(from_date: str, prefix: str, suffix: str, *, still_open: str, extra=(),
                        end: str = PERIOD_END, require: str | None = "PathwayID") -> dict[str, str]:
    """O19 as text: four 0/1 flags for an open referral by whole days from
    ``from_date`` to the period end: <61, 61-90, 91-120, >120.  Only rows with
    ``from_date`` on or before the period end count; ``still_open`` and
    ``extra`` must hold too."""
    d, e = q(from_date), q(end)
    days = f"datediff({e}, {d})"
    base = [still_open, *extra, f"{d} <= {e}"]
    out = {}
    for name, lo, hi in DAYS_OPEN_BANDS:
        conds = [*base, _band_sql(days, lo, hi)]
        if require is not None:
            conds.append(f"{q(require)} IS NOT NULL")
        out[f"{prefix}{name}{suffix}"] = flag_sql(*conds)
    return out


def days_open_bands(from_date: str, prefix: str, suffix: str, *, still_open: str, extra=(),
                    end: str = PERIOD_END, require: str | None = "PathwayID") -> dict[str, Column]:
    """The four days-open flags as Columns."""
    return {k: F.expr(v) for k, v in days_open_bands_sql(from_date, prefix, suffix, still_open=still_open,
                                                         extra=extra, end=end, require=require).items()}


def same_value_flags_sql(pairs: dict[str, tuple]) -> dict[str, str]:
    """O21 as text: ``{out: (first_col, last_col)}`` -> 1 when equal (NULL gives 0)."""
    return {out: flag_sql(f"{q(a)} = {q(b)}") for out, (a, b) in pairs.items()}


def same_value_flags(pairs: dict[str, tuple]) -> dict[str, Column]:
    return {k: F.expr(v) for k, v in same_value_flags_sql(pairs).items()}


def open_caseload_sql(discharge: str = "ServDischDate", referral: str = "ReferralRequestReceivedDate",
                      start: str = PERIOD_START, end: str = PERIOD_END) -> str:
    """O23 as text: open at period end (no discharge, referred by the end) or
    discharged within the period."""
    d = q(discharge)
    return (f"(({d} IS NULL AND {q(referral)} <= {q(end)}) OR {d} BETWEEN {q(start)} AND {q(end)})")


def open_caseload(discharge: str = "ServDischDate", referral: str = "ReferralRequestReceivedDate",
                  start: str = PERIOD_START, end: str = PERIOD_END) -> Column:
    return F.expr(open_caseload_sql(discharge, referral, start, end))
