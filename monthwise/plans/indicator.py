"""Employment-support indicator (month x 4 organisation levels)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.functions.flags import flag_sql, in_period_sql, q, true_sql
from monthwise.operators.contacts import by_record
from monthwise.operators.rollup import org_rollup
from monthwise.operators.submissions import keep_latest_audits, latest_submission
from monthwise.plans.common import RunParams, contact_counts, period_for, used_referrals, with_contact_count, \
    with_geography
from monthwise.sources.tables import Sources

GEOGRAPHY = ["Sub-ICBCode", "Sub-ICBName", "ICBCode", "ICBName", "RegionNameComm", "RegionCodeComm",
             "ProviderCode", "ProviderName", "RegionNameProv", "RegionCodeProv"]
MEASURES = ["FinishedTreatEmpSuppFirstAppAndEmpSuppIndYes", "FinishedTreatEmpSuppIndYes",
            "EmpSuppFirstAppAndEmpSuppIndYes", "EmpSuppIndYes"]


def indicator_base(src: Sources, params: RunParams, counts: DataFrame | None = None) -> DataFrame:
    """Discharged-in-month referrals of the reporting month with a status row
    marking them eligible for support (DISTINCT rows)."""
    p = period_for(src, params)
    r = latest_submission(used_referrals(src), src.submissions, p.start, p.start)
    r = r.where(in_period_sql("ServDischDate"))
    emp = by_record(keep_latest_audits(src.empstatus, src.submissions, p.start, p.start).where("EmpSupportInd = 'Y'")
                    .selectExpr("RecordNumber AS __e_rec", "AuditId AS __e_aid", "EmpSupportInd"),
                    src.stored_by_record, "__e_rec")
    if counts is None:
        counts = contact_counts(src, r)
    r = by_record(with_contact_count(r, counts, "Count_EmpSupp"))
    j = r.join(emp, F.expr("RecordNumber = __e_rec AND AuditId = __e_aid"))
    j = with_geography(j, src)
    eligible, has_contact = "EmpSupportInd = 'Y'", "Count_EmpSupp > 0"
    done, path = true_sql("CompletedTreatment_Flag"), "PathwayID IS NOT NULL"
    return j.selectExpr(
        f"date_format(ReportingPeriodStartDate, 'MMMM yyyy') AS Month", "Person_ID", "PathwayID",
        "__e_rec AS RecordNumber",
        f"{flag_sql(done, eligible, path)} AS FinishedTreatEmpSuppIndYes",
        f"{flag_sql(done, eligible, has_contact, path)} AS FinishedTreatEmpSuppFirstAppAndEmpSuppIndYes",
        f"{flag_sql(eligible, path)} AS EmpSuppIndYes",
        f"{flag_sql(eligible, has_contact, path)} AS EmpSuppFirstAppAndEmpSuppIndYes",
        *[q(c) for c in GEOGRAPHY],
    ).distinct()


def indicator(src: Sources, params: RunParams, counts: DataFrame | None = None) -> DataFrame:
    """The four indicator sums at Provider, Sub-ICB, ICB and National level."""
    base = indicator_base(src, params, counts)
    out = org_rollup(base, ["Month"], {m: m for m in MEASURES})
    return out.selectExpr("Month", "OrgType", "OrgCode", "OrgName", "Region", *MEASURES)
