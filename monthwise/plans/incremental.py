"""T1-T3 by touched months: the back series without recomputing what can't have changed.

A release keeps a snapshot of the latest audits it was made from.  A later run
compares: audits that became latest, or stopped being it, touch the pathways
with referral rows in them (their contacts and status rows belong to the same
audits).  The months those pathways have in the back series, under any audit,
are recomputed from all rows of all pathways of these months, so ranks and pairs
that reach across months stay whole, and replace the released ones; months that
entered the window are added.  People and dimension tables carry no audit: after
a change of those, release with ``incremental=False``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.functions.flags import true_sql
from monthwise.operators.membership import MemberFilter
from monthwise.operators.periods import Period, period_bounds_sql
from monthwise.operators.submissions import latest_submissions
from monthwise.plans import status
from monthwise.plans.common import RunParams, contact_counts, period_for, used_referrals
from monthwise.sources.tables import Sources

SNAPSHOT = "LatestAudits"
START = "ReportingPeriodStartDate"


def audit_snapshot(src: Sources, p: Period) -> DataFrame:
    """Latest audits of all submissions, with the window of the run that reads them."""
    return latest_submissions(src.submissions).selectExpr(
        "UniqueSubmissionID", "AuditId", START, f"DATE '{p.floor}' AS window_floor", f"DATE '{p.start}' AS window_start")


def touched_pathways(src: Sources, before: DataFrame) -> DataFrame:
    """Pathways with referral rows in an audit that became latest, or stopped being it, since ``before``."""
    keys = ["UniqueSubmissionID", "AuditId"]
    now, then = latest_submissions(src.submissions).select(*keys), before.select(*keys)
    flipped = now.subtract(then).unionByName(then.subtract(now))
    return src.referral.join(flipped, keys, "left_semi").select("PathwayID")


def _base_months(src: Sources, p: Period) -> DataFrame:
    """(PathwayID, month) of referral rows that are, or under another audit were, in the status base."""
    periods = src.submissions.where(period_bounds_sql(START, p.floor, p.start)).selectExpr(
        "UniqueSubmissionID", "AuditId", START)
    return (used_referrals(src).where(true_sql("CompletedTreatment_Flag"))
            .select("PathwayID", "UniqueSubmissionID", "AuditId")
            .join(periods, ["UniqueSubmissionID", "AuditId"]).select("PathwayID", START))


def touched_months(src: Sources, before: DataFrame, p: Period) -> list[dt.date] | None:
    """Months of the window [floor, start] to recompute; None where all must be (another floor, no snapshot)."""
    was = before.select("window_floor", "window_start").first()
    if was is None or was["window_floor"] != p.floor or was["window_start"] > p.start:
        return None
    touched = MemberFilter(touched_pathways(src, before), "PathwayID").keep(_base_months(src, p), "PathwayID")
    entered = src.submissions.where(F.col(START) > F.lit(was["window_start"])).where(
        period_bounds_sql(START, p.floor, p.start))
    months = touched.select(START).unionByName(entered.select(START)).distinct().collect()  # one row a month at most
    return sorted(r[0] for r in months)


def status_tables(src: Sources, params: RunParams, months: list[dt.date]) -> dict[str, tuple[DataFrame, list]]:
    """T1-T3 of ``months``: table -> (rows, values of its month column that they replace)."""
    p = period_for(src, params)
    wanted = F.col(START).isin(months)
    pathways = _base_months(src, p).where(wanted).select("PathwayID")
    counts = contact_counts(src, pathways)
    base = status.status_base(src, params, counts, pathways=pathways)
    labels = [m.strftime("%B %Y") for m in months]
    firsts = [m.replace(day=1) for m in months]
    return {
        "FirstAndLastEmp": (status.first_and_last_status(src, params, base=base).where(F.col("Month").isin(labels)), labels),
        "Benefits": (status.benefits(src, params, base=base).where(F.col("Month").isin(firsts)), firsts),
        "FinishedTreatmentAndEmpSupp": (status.finished_treatment(src, params, base=base)
                                        .where(F.col("Month").isin(labels)), labels),
    }
