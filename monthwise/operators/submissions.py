"""Latest-submission filtering (O3 latest_submission, O9 latest_audit_rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.operators.periods import period_bounds_sql

SUBMISSION_KEYS = ["UniqueSubmissionID", "AuditId"]


def latest_submissions(submissions: DataFrame, lo=None, hi=None,
                       start_col: str = "ReportingPeriodStartDate") -> DataFrame:
    """Latest audit of each submission, optionally limited to period starts in [lo, hi]."""
    s = submissions.where("IsLatest = 1")
    if lo is not None:
        s = s.where(period_bounds_sql(start_col, lo, hi))
    return s


def latest_submission(facts: DataFrame, submissions: DataFrame, lo=None, hi=None,
                      keep=("IsLatest", "ReportingPeriodStartDate", "ReportingPeriodEndDate")) -> DataFrame:
    """O3: facts of the latest audit of each submission, with the period columns.

    Inner join on ``(UniqueSubmissionID, AuditId)``; the submissions side is
    filtered first (IsLatest = 1, period bounds as literals), so it is small
    enough for Spark to broadcast in all but the longest back series.
    """
    s = latest_submissions(submissions, lo, hi).selectExpr("UniqueSubmissionID AS __sid", "AuditId AS __aid", *keep)
    j = facts.join(s, F.expr("UniqueSubmissionID = __sid AND AuditId = __aid"))
    return j.drop("__sid", "__aid")


def keep_latest_audits(facts: DataFrame, submissions: DataFrame, lo=None, hi=None,
                       keys=("AuditId",)) -> DataFrame:
    """Drop fact rows whose audit is not a latest audit (optionally of periods
    in [lo, hi]) before they are shuffled.

    Used where a fact table is joined on the audit id of already-filtered
    referrals, so rows outside this small set can never match: a broadcast
    left-semi join prunes them at the scan, e.g. one month's status rows
    instead of the whole history.
    """
    s = latest_submissions(submissions, lo, hi).selectExpr(
        *[f"{k} AS __a{i}" for i, k in enumerate(keys)])
    cond = " AND ".join(f"{k} = __a{i}" for i, k in enumerate(keys))
    return facts.join(s, F.expr(cond), "left_semi")


def latest_audit_rows(answers: DataFrame, submissions: DataFrame,
                      answer_keys=("AssToolCompDate", "PathwayID", "Unique_ServiceRequestID", "AssToolCompTime"),
                      group_extra=("OrgID_Provider",), audit: str = "AuditId") -> DataFrame:
    """Keep each answer only at its newest audit.

    The newest audit is the grouped maximum over latest submissions, grouped by
    the answer key plus ``group_extra`` (which is grouped but not selected); rows
    join back on the answer key and audit with plain equality, so an answer
    with a NULL key part never matches and is dropped.  The join back is a
    left-semi join: it only filters and never multiplies rows.
    """
    keys = list(answer_keys)
    newest = (latest_submission(answers, submissions, keep=())
              .groupBy(*keys, *group_extra)
              .agg(F.max(audit).alias("__audit"))
              .select(*[F.col(k).alias(f"__{k}") for k in keys], "__audit")
              .distinct())
    cond = F.col(audit) == F.col("__audit")
    for k in keys:
        cond = cond & (F.col(k) == F.col(f"__{k}"))
    return answers.join(newest, cond, "left_semi")
