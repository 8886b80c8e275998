"""Qualifying support-contact count per pathway.

A contact qualifies when it belongs to the latest audit of its submission, was
attended (codes 5/6) or unplanned, and meets one of three branches:

* A: not a follow-up (AppType <> 6), on or after referral, up to discharge (or
  period end when not discharged), with the support activity code;
* B: follow-up (AppType = 6) after discharge, with the support activity code;
* C: a support appointment (AppType 10, or the activity code with AppType 6),
  on or after referral, up to the support discharge (or period end when none).

The count is the number of distinct qualifying contacts dated in the
submission's own period; it may be 0.

Scale: the records of the referrals are built into one bounded bit filter
(``operators.membership``) that prunes the three fact scans before anything is
shuffled.  What is left of each fact table is exchanged once, by record number;
every join and reduction has the record among its keys and uses that
partitioning (none at all where the tables are stored in buckets of the record
number, ``sources.layout``).  Care activities and status rows only answer yes/no
questions per contact or per record, so they are reduced to one row per key
before the join (``has_code``; earliest/latest support discharge) and the
contact-activity-status product never fans out.  Numeric-looking codes are
compared with ``try_cast`` so a non-numeric code is NULL and never qualifies.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.functions.labels import SUPPORT_ACTIVITY_CODE
from monthwise.operators.membership import MemberFilter
from monthwise.operators.submissions import keep_latest_audits, latest_submission


def by_record(df: DataFrame, stored: bool = False, key: str = "RecordNumber") -> DataFrame:
    """``df`` partitioned by its record number, unless its table is ``stored`` that way."""
    return df if stored else df.repartition(key)


def qualifying_contact_count(referrals: DataFrame, submissions: DataFrame, contacts: DataFrame,
                             activities: DataFrame, status: DataFrame, stored_by_record: bool = False) -> DataFrame:
    """``(PathwayID, Count_EmpSupp)`` for pathways with a qualifying contact.

    ``stored_by_record``: the fact tables come in equally many buckets of the record number.
    """
    ref = latest_submission(
        referrals.selectExpr("PathwayID", "RecordNumber", "UniqueSubmissionID", "AuditId",
                             "ReferralRequestReceivedDate", "ServDischDate"),
        submissions, keep=("ReportingPeriodStartDate", "ReportingPeriodEndDate"))

    # Contacts, activities and status rows of stale audits can never join a
    # latest referral: drop them before any shuffle.
    contacts = keep_latest_audits(contacts, submissions, keys=("UniqueSubmissionID", "AuditId"))
    activities = keep_latest_audits(activities, submissions)
    status = keep_latest_audits(status, submissions)
    # Neither can rows of other records than the referrals'.
    records = MemberFilter(ref, "RecordNumber")
    contacts, activities, status = (records.keep(t, "RecordNumber") for t in (contacts, activities, status))
    con = by_record(contacts
                    .where("try_cast(AttendOrDNACode AS INT) IN (5, 6) OR PlannedCareContIndicator = 'N'")
                    .selectExpr("RecordNumber AS c_rec", "UniqueSubmissionID AS c_sid", "AuditId AS c_aid",
                                "PathwayID AS c_path", "CareContactID", "CareContDate", "try_cast(AppType AS INT) AS app"),
                    stored_by_record, "c_rec")

    # One row per contact key with an activity that carries the support code;
    # no such activity and no activity at all mean the same in every branch.
    act = (by_record(activities.where(f"CodeProcAndProcStatus = '{SUPPORT_ACTIVITY_CODE}'")
                     .selectExpr("PathwayID AS a_path", "RecordNumber AS a_rec", "CareContactID AS a_cid",
                                 "AuditId AS a_aid"), stored_by_record, "a_rec")
           .distinct().withColumn("has_code", F.lit(1)))

    # One row per (record, audit): the latest support discharge, and whether any
    # status row has none (NULL discharge lets the period end bound the contact).
    st = (by_record(status.selectExpr(
              "RecordNumber AS e_rec", "AuditId AS e_aid", "EmpSupportDischargeDate AS disch",
              "CASE WHEN EmpSupportDischargeDate IS NULL THEN 1 ELSE 0 END AS open"), stored_by_record, "e_rec")
          .groupBy("e_rec", "e_aid").agg(F.expr("max(disch) AS max_disch"), F.expr("max(open) AS open_disch")))

    j = (by_record(ref, stored_by_record)
         .join(con, F.expr("RecordNumber = c_rec AND UniqueSubmissionID = c_sid AND AuditId = c_aid"))
         .join(act, F.expr("c_path = a_path AND c_rec = a_rec AND CareContactID = a_cid AND c_aid = a_aid"), "left")
         .join(st, F.expr("RecordNumber = e_rec AND AuditId = e_aid"), "left"))

    d, end, disch = "CareContDate", "ReportingPeriodEndDate", "ServDischDate"
    code, referred = "has_code = 1", f"ReferralRequestReceivedDate <= {d}"
    branch_a = f"app <> 6 AND {referred} AND ({d} <= {disch} OR ({disch} IS NULL AND {d} <= {end})) AND {code}"
    branch_b = f"app = 6 AND {d} > {disch} AND {code}"
    # No status row at all behaves like a NULL support discharge.
    support_ok = f"({d} <= max_disch OR ((e_rec IS NULL OR open_disch = 1) AND {d} <= {end}))"
    branch_c = f"(app = 10 OR ({code} AND app = 6)) AND {referred} AND {support_ok}"
    in_period = f"{d} BETWEEN ReportingPeriodStartDate AND {end}"
    return (j.where(f"({branch_a}) OR ({branch_b}) OR ({branch_c})")
             .groupBy("PathwayID")
             .agg(F.expr(f"count(DISTINCT CASE WHEN {in_period} THEN CareContactID END) AS Count_EmpSupp")))
