"""Clinical base of the reporting month and its three published tables.

The clinical base has one DISTINCT row per referral of the month and each
distinct (support referral date, support discharge date) of its status rows
(several status rows stay separate where those dates differ).  T6 publishes
every organisation level x category x appointment scope cell from ONE
aggregate over it (see ``operators.rollup``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.functions.flags import days_open_bands_sql, flag_sql, in_period_flag_sql, q, true_sql
from monthwise.functions.recode import protected_characteristics_sql, sql_str
from monthwise.operators.contacts import by_record
from monthwise.operators.membership import MemberFilter
from monthwise.operators.rollup import Scope, category_rollup, org_rollup
from monthwise.operators.submissions import latest_submission
from monthwise.plans.common import (RunParams, contact_counts, join_mpi, period_for, used_referrals,
                                    with_contact_count, with_deprivation, with_geography, with_sexual_orientation)
from monthwise.sources.tables import Sources

CLIN_GEOGRAPHY = ["Sub-ICBCode", "Sub-ICBName", "ICBCode", "ICBName", "RegionNameComm", "RegionCodeComm",
                  "ProviderCode", "ProviderName", "RegionNameProv"]
CLIN_PROVIDER = {"ProviderCode": "Organisation_Code", "ProviderName": "Organisation_Name", "RegionNameProv": "Region_Name"}
CATEGORIES = {
    "Gender": "GenderDesc",
    "Problem Descriptor": "ProblemDescriptor",
    "Ethnicity": "EthnicityDesc",
    "Age": "AgeGroups",
    "Deprivation": "IMD_Decile",
    "Gender Identity": "GenderIdentityDesc",
    "Sexual Orientation": "SexualOrientationDesc",
}
DISCHARGE_FLAG = "EmpSupportDischargeDatePresent"


def clinical_base(src: Sources, params: RunParams, counts: DataFrame | None = None) -> DataFrame:
    p = period_for(src, params)
    r = latest_submission(used_referrals(src), src.submissions, p.start, p.start)
    # Only the two support dates of the status rows reach the output, so the
    # status side is reduced to its distinct (record, dates) before the join;
    # the DISTINCT of the base would collapse the rest anyway.
    # Records outside the month go first, before the shuffle by record that the
    # DISTINCT and the joins share.
    emp = MemberFilter(r, "RecordNumber").keep(src.empstatus, "RecordNumber").selectExpr(
        "RecordNumber AS __e_rec", "EmpSupportReferral", "EmpSupportDischargeDate")
    emp = by_record(emp, src.stored_by_record, "__e_rec").distinct()
    if counts is None:
        counts = contact_counts(src, r)
    r = by_record(with_contact_count(r, counts, "AllEmploymentSupport_Count"))
    j = r.join(emp, F.expr("RecordNumber = __e_rec"), "left")
    j = join_mpi(j, src)
    j = with_sexual_orientation(j, src, p.start, p.start)
    j = with_deprivation(j, src)
    j = with_geography(j, src, provider_cols=CLIN_PROVIDER)

    open_ref = "ServDischDate IS NULL"
    done = true_sql("CompletedTreatment_Flag")
    chars = protected_characteristics_sql()

    def bands(from_date, prefix, suffix, extra=()):
        return [f"{v} AS {q(k)}" for k, v in days_open_bands_sql(from_date, prefix, suffix, still_open=open_ref,
                                                                  extra=extra).items()]
    cols = [
        "trunc(ReportingPeriodStartDate, 'MM') AS Month",
        "PathwayID", "Person_ID", "RecordNumber", "UniqueSubmissionID", "Unique_MonthID", "EFFECTIVE_FROM",
        "ReferralRequestReceivedDate",
        f"{in_period_flag_sql('ReferralRequestReceivedDate')} AS AllReferrals",
        "EmpSupportReferral",
        f"{in_period_flag_sql('EmpSupportReferral')} AS EmpReferrals",
        "TherapySession_LastDate",
        *bands("TherapySession_LastDate", "AllOpenReferral", "TimeSinceLastContact"),
        "EmpSupport_LastDate",
        *bands("EmpSupport_LastDate", "EmpOpenReferral", "TimeSinceLastContact"),
        *bands("ReferralRequestReceivedDate", "AllOpenReferral", "ReferraltoReportingPeriodEnd",
               ["TherapySession_FirstDate IS NULL"]),
        *bands("EmpSupportReferral", "EmpOpenReferral", "ReferraltoReportingPeriodEnd",
               ["EmpSupport_FirstDate IS NULL"]),
        "TherapySession_FirstDate",
        f"{in_period_flag_sql('TherapySession_FirstDate')} AS AllAccess",
        "EmpSupport_FirstDate",
        f"{in_period_flag_sql('EmpSupport_FirstDate')} AS EmpAccess",
        "CompletedTreatment_Flag", "ServDischDate",
        f"{in_period_flag_sql('ServDischDate', done)} AS AllFinishedTreatment",
        "EmpSupportDischargeDate",
        f"{flag_sql('EmpSupportDischargeDate IS NOT NULL')} AS {DISCHARGE_FLAG}",
        "Recovery_Flag", "NotCaseness_Flag", "ReliableImprovement_Flag", "ReliableDeterioration_Flag",
        f"{in_period_flag_sql('ServDischDate', done, true_sql('Recovery_Flag'))} AS AllCompTreatFlagRecFlag",
        f"{in_period_flag_sql('ServDischDate', done, true_sql('NotCaseness_Flag'))} AS AllNotCaseness",
        f"{in_period_flag_sql('ServDischDate', done, true_sql('ReliableImprovement_Flag'))} "
        "AS AllCompTreatFlagRelImpFlag",
        f"{in_period_flag_sql('ServDischDate', done, true_sql('ReliableDeterioration_Flag'))} "
        "AS AllCompTreatFlagRelDetFlag",
        "TreatmentCareContact_Count AS AllTreatmentCareContact_Count",
        "AllEmploymentSupport_Count",
        *[q(c) for c in CLIN_GEOGRAPHY],
        f"{chars['GenderDesc']} AS GenderDesc",
        f"{chars['EthnicityDesc']} AS EthnicityDesc",
        f"{chars['GenderIdentityDesc']} AS GenderIdentityDesc",
        "IMD_Decile",
        f"{chars['AgeGroups']} AS AgeGroups",
        f"{chars['ProblemDescriptor']} AS ProblemDescriptor",
        "SexualOrientationDesc",
    ]
    return j.selectExpr(*cols).distinct()


def active_providers(src: Sources, params: RunParams, counts: DataFrame | None = None,
                     base: DataFrame | None = None) -> DataFrame:
    """T4: providers with at least one record with a support contact, per month.

    Without a ready base only what the list depends on is joined: referrals of the month with a count, of known
    people, and their providers.
    """
    if base is None:
        p = period_for(src, params)
        r = latest_submission(used_referrals(src), src.submissions, p.start, p.start).selectExpr(
            "PathwayID", "RecordNumber", "OrgID_Provider", "trunc(ReportingPeriodStartDate, 'MM') AS Month")
        counts = counts if counts is not None else contact_counts(src, r)
        known = MemberFilter(r, "RecordNumber").keep(src.mpi, "RecordNumber").selectExpr("RecordNumber AS __m_rec")
        supported = (with_contact_count(r, counts, "AllEmploymentSupport_Count").where("AllEmploymentSupport_Count > 0")
                     .join(known, F.expr("RecordNumber = __m_rec"), "left_semi")
                     .select("OrgID_Provider", "Month").distinct())
        base = with_geography(supported, src, commissioner=False, provider_cols=CLIN_PROVIDER)
    else:
        base = base.where("AllEmploymentSupport_Count > 0")
    return base.selectExpr("ProviderCode AS OrgID_Provider", "ProviderName AS Prov_Name",
                           "RegionNameProv AS Prov_Region", "Month").distinct()


NO_CONTACT = ["OpenReferralLessThan61DaysReferraltoReportingPeriodEnd",
              "OpenReferral61-90DaysReferraltoReportingPeriodEnd",
              "OpenReferral91-120DaysReferraltoReportingPeriodEnd",
              "OpenReferralOver120daysReferraltoReportingPeriodEnd"]


def open_refs_no_contact(src: Sources, params: RunParams, counts: DataFrame | None = None,
                         base: DataFrame | None = None) -> DataFrame:
    """T5: open referrals without a first contact, by days since referral, for the
    support scope (split by discharge flag) and any appointment type ('NA')."""
    base = base if base is not None else clinical_base(src, params, counts)

    def struct(scope, flag, prefix):
        fields = [f"'AppointmentType', {sql_str(scope)}", f"{sql_str(DISCHARGE_FLAG)}, {flag}",
                  *[f"{sql_str(m)}, {q(prefix + m)}" for m in NO_CONTACT]]
        return "named_struct(" + ", ".join(fields) + ")"
    scopes = (f"explode(array({struct('Employment Support', f'CAST({DISCHARGE_FLAG} AS STRING)', 'Emp')}, "
              f"{struct('Any Appointment Type', sql_str('NA'), 'All')})) AS __sc")
    levels = ["RegionNameProv", "ProviderCode", "ProviderName", "RegionNameComm", "Sub-ICBCode", "Sub-ICBName",
              "ICBCode", "ICBName"]
    scoped = base.selectExpr("Month", *[q(c) for c in levels], scopes).selectExpr(
        "*", *[f"__sc.{q(c)} AS {q(c)}" for c in ("AppointmentType", DISCHARGE_FLAG, *NO_CONTACT)])
    out = org_rollup(scoped, ["Month", "AppointmentType", DISCHARGE_FLAG], {m: m for m in NO_CONTACT})
    return out.selectExpr("Month", "OrgType", "OrgName", "OrgCode", "Region", "AppointmentType", DISCHARGE_FLAG,
                          *[q(m) for m in NO_CONTACT])


OUTCOME_MEASURES = ["Referrals", "OpenReferralLessThan61DaysTimeSinceLastContact",
                    "OpenReferral61-90DaysTimeSinceLastContact", "OpenReferral91-120DaysTimeSinceLastContact",
                    "OpenReferralOver120daysTimeSinceLastContact", "Access", "FinishedTreatment", "RecoveryFlag",
                    "NotCasenessFlag", "ReliableImprovementFlag", "ReliableDeteriorationFlag"]
_SHARED = {"FinishedTreatment": "AllFinishedTreatment", "RecoveryFlag": "AllCompTreatFlagRecFlag",
           "NotCasenessFlag": "AllNotCaseness", "ReliableImprovementFlag": "AllCompTreatFlagRelImpFlag",
           "ReliableDeteriorationFlag": "AllCompTreatFlagRelDetFlag"}


def _scope_measures(prefix: str) -> dict:
    m = {"Referrals": f"{prefix}Referrals"}
    for name in OUTCOME_MEASURES[1:5]:
        m[name] = prefix + name
    m["Access"] = f"{prefix}Access"
    m.update(_SHARED)
    return m


def outcome_scopes() -> list[Scope]:
    """The three appointment scopes of the clinical outcomes table."""
    return [
        Scope("Employment Support", "AllEmploymentSupport_Count > 0", "AllEmploymentSupport_Count", True,
              _scope_measures("Emp")),
        Scope("Any Appointment Type", None, "AllTreatmentCareContact_Count", False, _scope_measures("All")),
        Scope("Any Appointment Type except Employment Support", "AllEmploymentSupport_Count = 0",
              "AllTreatmentCareContact_Count", False, _scope_measures("All")),
    ]


def clinical_outcomes(src: Sources, params: RunParams, counts: DataFrame | None = None,
                      base: DataFrame | None = None) -> DataFrame:
    """11 sums for 4 levels x 7 categories x 3 scopes x dosage x discharge flag.

    The real discharge flag stays a grouping key in every scope, so the 'NA'
    scopes can show two rows for one visible key (as published).
    """
    base = base if base is not None else clinical_base(src, params, counts)
    return category_rollup(base, ["Month"], CATEGORIES, outcome_scopes(), hidden=[DISCHARGE_FLAG])
