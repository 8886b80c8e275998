"""Referrals, treatment and outcomes of students per provider site."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.functions.flags import in_period_flag_sql, q, true_sql
from monthwise.operators.contacts import by_record
from monthwise.operators.lookups import current_lookup, remap_successor
from monthwise.operators.ranking import pick_first
from monthwise.operators.submissions import keep_latest_audits, latest_submission
from monthwise.plans.common import RunParams, join_mpi, period_for, used_referrals
from monthwise.sources.tables import Sources

SITE_COLUMNS = {"Postcode": "Postcode1", "GridRef": "Grid Reference", "Eastings": "X (easting)",
                "Northings": "Y (northing)", "Lat": "Latitude", "Long": "Longitude", "City": "Address4"}
REFERRAL_FLAGS = ["TotalReferrals", "StudentReferralsTotal", "StudentReferrals1825", "StudentReferrals25Plus",
                  "TotalEnteringTreatment", "StudentEnteringTreatmentTotal", "StudentEnteringTreatment1825",
                  "StudentEnteringTreatment25Plus"]
OUTCOME_FLAGS = ["RecoveredTotal", "FinishingTreatmentTotal", "NotCasenessTotal", "RecoveredStudent",
                 "FinishingTreatmentStudent", "NotCasenessStudent", "Reliable Improvement STUDENT",
                 "Reliable Improvement"]
STUDENT_CODE = "03"


def site_postcodes(src: Sources) -> DataFrame:
    """One postcode per site: the alphabetically first (rank 1 of O4, as the least row of the site)."""
    fields = ["Postcode1", "Grid Reference", "X (easting)", "Y (northing)", "Latitude", "Longitude", "Address4"]
    first = src.sites.groupBy("SiteCode").agg(F.min(F.struct(*[F.col(q(c)) for c in fields])).alias("site"))
    return first.selectExpr("SiteCode AS __site", *[f"site.{q(src_col)} AS {out}" for out, src_col in SITE_COLUMNS.items()])


def latest_status(src: Sources, lo=None, hi=None) -> DataFrame:
    """Newest status row per (record, audit, month) (O5): date, then status id.

    With bounds, only status rows of latest audits of those periods are ranked
    (a rank partition holds one audit, so the kept partitions are unchanged).
    """
    e = src.empstatus if lo is None else keep_latest_audits(src.empstatus, src.submissions, lo, hi)
    e = by_record(e.select("RecordNumber", "AuditId", "Unique_MonthID", "EmployStatusRecDate", "UniqueID_IDS004",
                           "EmployStatus"), src.stored_by_record)
    return pick_first(e, ["RecordNumber", "AuditId", "Unique_MonthID"],
                      [F.col("EmployStatusRecDate"), F.col("UniqueID_IDS004")])


def student_base(src: Sources, params: RunParams) -> DataFrame:
    p = period_for(src, params)
    r = latest_submission(used_referrals(src), src.submissions, p.start, p.start)
    r = join_mpi(by_record(r, src.stored_by_record), src)
    e = latest_status(src, p.start, p.start).selectExpr("RecordNumber AS __e_rec", "AuditId AS __e_aid", "EmployStatus")
    j = r.join(e, F.expr("RecordNumber = __e_rec AND AuditId = __e_aid"), "left")
    j = remap_successor(j, "OrgID_Provider", src.prov_successor, "Prov_original", "Prov_Successor", "__prov")
    j = current_lookup(j, "__prov", src.prov_hierarchy, "Organisation_Code",
                       {"__ph_code": "Organisation_Code", "__ph_name": "Organisation_Name"}, default=None)
    # The site is matched on the provider's hierarchy code itself (NULL when unmatched).
    sites = site_postcodes(src)
    j = j.join(sites, F.expr("__ph_code = __site"), "left")

    st, n2 = f"EmployStatus = '{STUDENT_CODE}'", "TreatmentCareContact_Count >= 2"
    a1825, a25 = "Age_RP_EndDate BETWEEN 18 AND 25", "Age_RP_EndDate > 25"
    referred, entered, disch = "ReferralRequestReceivedDate", "TherapySession_FirstDate", "ServDischDate"
    rec, nc = true_sql("Recovery_Flag"), true_sql("NotCaseness_Flag")
    ri, done = true_sql("ReliableImprovement_Flag"), true_sql("CompletedTreatment_Flag")
    flags = {
        "TotalReferrals": in_period_flag_sql(referred),
        "StudentReferralsTotal": in_period_flag_sql(referred, st),
        "StudentReferrals1825": in_period_flag_sql(referred, st, a1825),
        "StudentReferrals25Plus": in_period_flag_sql(referred, st, a25),
        "TotalEnteringTreatment": in_period_flag_sql(entered),
        "StudentEnteringTreatmentTotal": in_period_flag_sql(entered, st),
        "StudentEnteringTreatment1825": in_period_flag_sql(entered, st, a1825),
        "StudentEnteringTreatment25Plus": in_period_flag_sql(entered, st, a25),
        "RecoveredTotal": in_period_flag_sql(disch, rec),
        "FinishingTreatmentTotal": in_period_flag_sql(disch, n2),
        "NotCasenessTotal": in_period_flag_sql(disch, n2, nc),
        "RecoveredStudent": in_period_flag_sql(disch, n2, st, rec),
        "FinishingTreatmentStudent": in_period_flag_sql(disch, n2, st, done),
        "NotCasenessStudent": in_period_flag_sql(disch, n2, nc, st),
        "Reliable Improvement STUDENT": in_period_flag_sql(disch, n2, ri, st),
        "Reliable Improvement": in_period_flag_sql(disch, n2, ri),
    }
    return j.selectExpr(
        "trunc(ReportingPeriodStartDate, 'MM') AS Month", "PathwayID",
        "coalesce(__ph_code, 'Other') AS `Provider Code`", "coalesce(__ph_name, 'Other') AS `Provider Name`",
        *[f"{flags[f]} AS {q(f)}" for f in REFERRAL_FLAGS],
        *SITE_COLUMNS,
        *[f"{flags[f]} AS {q(f)}" for f in OUTCOME_FLAGS],
    ).distinct()


def student(src: Sources, params: RunParams) -> DataFrame:
    """16 sums per month x provider x site, tagged 'Refresh' / 'England'."""
    base = student_base(src, params)
    keys = ["Month", "Provider Code", "Provider Name", *SITE_COLUMNS]
    out = base.groupBy(*keys).agg(*[F.expr(f"sum({q(f)}) AS {q(f)}") for f in [*REFERRAL_FLAGS, *OUTCOME_FLAGS]])
    return out.selectExpr("Month", "'Refresh' AS DataSource", "'England' AS GroupType", "`Provider Code`",
                          "`Provider Name`", *REFERRAL_FLAGS, *SITE_COLUMNS, *[q(f) for f in OUTCOME_FLAGS])
