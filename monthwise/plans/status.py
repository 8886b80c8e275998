"""Employment-status outcomes of referrals that finished treatment.

The status base holds one row per (referral, status record) for completed
treatments discharged in their own month, over the whole back series
[floor, report month].  Each row carries its ascending and descending rank by
status date within (person, pathway, record).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.functions.flags import flag_sql, in_period_sql, q, same_value_flags_sql, true_sql
from monthwise.functions import labels as L
from monthwise.functions.recode import protected_characteristics_sql, status_recodes
from monthwise.operators.contacts import by_record
from monthwise.operators.membership import MemberFilter
from monthwise.operators.pairing import pair_first_last
from monthwise.operators.ranking import first_last_ranks
from monthwise.operators.rollup import org_rollup
from monthwise.operators.submissions import keep_latest_audits, latest_submission
from monthwise.plans.common import (RunParams, contact_counts, join_mpi, period_for, used_referrals,
                                    with_contact_count, with_deprivation, with_geography, with_sexual_orientation)
from monthwise.sources.tables import Sources

STATUS_FIELDS = ["EmployStatus", "WeekHoursWorked", "SelfEmployInd", "SickAbsenceInd", "SSPInd", "BenefitRecInd",
                 "ESAInd", "UCInd", "PIPInd", "EmpSupportInd"]
CHARACTERISTICS = ["GenderDesc", "EthnicityDesc", "GenderIdentityDesc", "IMD_Decile", "AgeGroups",
                   "ProblemDescriptor", "SexualOrientationDesc"]
GEOGRAPHY = ["Sub-ICBCode", "Sub-ICBName", "ICBCode", "ICBName", "RegionNameComm", "RegionCodeComm",
             "ProviderCode", "ProviderName", "RegionNameProv", "RegionCodeProv"]
BASE_COLUMNS = ["Month", "Person_ID", "PathwayID", "RecordNumber", "UniqueID_IDS004", "EmployStatusRecDate",
                *STATUS_FIELDS, "GeneralBenefitReceived", *CHARACTERISTICS, *GEOGRAPHY, "Count_EmpSupp",
                "EmpSupportDischargeDatePresent"]
RANK_KEYS = ["Person_ID", "PathwayID", "RecordNumber"]
# Unique tiebreak for equal status dates: the status id, then every other column
# (status labels by their code, see ``Recode``).
RANK_TIEBREAK = [c for c in BASE_COLUMNS if c not in (*RANK_KEYS, "EmployStatusRecDate")]


def status_base(src: Sources, params: RunParams, counts: DataFrame | None = None,
                pathways: DataFrame | None = None) -> DataFrame:
    """DISTINCT status rows with labels, characteristics and geography, ranked
    (``EmpFirstRecord`` ascending, ``EmpLastRecord`` descending by date).

    With ``pathways``, all rows of these pathways, and maybe those of others."""
    p = period_for(src, params)
    r = used_referrals(src).where(true_sql("CompletedTreatment_Flag"))
    if pathways is not None:
        r = MemberFilter(pathways, "PathwayID").keep(r, "PathwayID")
    r = latest_submission(r, src.submissions, p.floor, p.start).where(in_period_sql("ServDischDate"))
    # The eleven status labels travel as integer codes (see ``Recode``) from the scan on and are decoded on the
    # published rows.
    codes = status_recodes()
    emp = by_record(keep_latest_audits(src.empstatus, src.submissions, p.floor, p.start).selectExpr(
        "RecordNumber AS __e_rec", "AuditId AS __e_aid", "UniqueID_IDS004", "EmployStatusRecDate",
        *[f"{codes[c].code_sql()} AS {c}" for c in [*STATUS_FIELDS, "GeneralBenefitReceived"]],
        "EmpSupportDischargeDate"), src.stored_by_record, "__e_rec")
    if counts is None:
        counts = contact_counts(src, r)
    # The count is the only join on the pathway; after it everything is partitioned by record, up to the rank
    # window and T1's pairing (their keys contain the record).
    r = by_record(with_contact_count(r, counts, "Count_EmpSupp"))
    j = r.join(emp, F.expr("RecordNumber = __e_rec AND AuditId = __e_aid"))
    j = join_mpi(j, src)
    j = with_sexual_orientation(j, src, p.floor, p.start)
    j = with_deprivation(j, src)
    j = with_geography(j, src)
    chars = protected_characteristics_sql()
    base = j.selectExpr(
        "date_format(ReportingPeriodStartDate, 'MMMM yyyy') AS Month",
        "Person_ID", "PathwayID", "__e_rec AS RecordNumber", "UniqueID_IDS004", "EmployStatusRecDate",
        *STATUS_FIELDS, "GeneralBenefitReceived",
        *[f"{chars[c]} AS {c}" if c in chars else q(c) for c in CHARACTERISTICS],
        *[q(c) for c in GEOGRAPHY],
        "Count_EmpSupp",
        f"{flag_sql('EmpSupportDischargeDate IS NOT NULL')} AS EmpSupportDischargeDatePresent",
    ).distinct()
    return first_last_ranks(base, RANK_KEYS, "EmployStatusRecDate", RANK_TIEBREAK,
                            "EmpFirstRecord", "EmpLastRecord")


FIRST_LAST_COLUMNS = ["Month", "Person_ID", "PathwayID", "RecordNumber", "GenderDesc", "EthnicityDesc",
                      "GenderIdentityDesc", "IMD_Decile", "AgeGroups", "ProblemDescriptor", "SexualOrientationDesc",
                      "Sub-ICBName", "Sub-ICBCode", "ICBName", "ICBCode", "RegionNameComm", "RegionCodeComm",
                      "ProviderName", "ProviderCode", "RegionNameProv", "RegionCodeProv"]
SAME_FLAGS = {
    "EmployStatusSameFlag": "EmployStatus",
    "EmpSupportIndSameFlag": "EmpSupportInd",
    "WeekHoursWorkedSameFlag": "WeekHoursWorked",
    "SelfEmployIndSameFlag": "SelfEmployInd",
    "SickAbsenceSameFlag": "SickAbsenceInd",
    "SSPIndSameFlag": "SSPInd",
    "BenefitRecIndSameFlag": "BenefitRecInd",
    "ESAIndSameFlag": "ESAInd",
    "UCIndSameFlag": "UCInd",
    "PIPIndSameFlag": "PIPInd",
}


def _side(suffix: str) -> dict:
    cols = {}
    for f in STATUS_FIELDS:
        cols[f + suffix] = f
        if f == "EmployStatus":
            cols["EmployStatusRecDate" + suffix] = "EmployStatusRecDate"
    return cols


def first_and_last_status(src: Sources, params: RunParams, counts: DataFrame | None = None,
                          base: DataFrame | None = None) -> DataFrame:
    """First and last status side by side for records with two or more
    dated status rows, with ten same-value flags (DISTINCT rows)."""
    base = base if base is not None else status_base(src, params, counts)
    first_cols = {c: c for c in FIRST_LAST_COLUMNS}
    first_cols["EmploymentSupport_Count"] = "Count_EmpSupp"
    first_cols.update(_side("First"))
    first_cols.update({"EmpFirstRecord": "EmpFirstRecord", "EmpLastRecord": "EmpLastRecord"})
    last_cols = _side("Last")
    last_cols["__last_flag"] = "EmpSupportDischargeDatePresent"
    pairs = pair_first_last(base, ["PathwayID", "RecordNumber"], "EmpFirstRecord", "EmpLastRecord",
                            first_cols, last_cols)
    # Equal codes <=> equal labels, so the flags compare codes.
    flags = same_value_flags_sql({out: (f + "First", f + "Last") for out, f in SAME_FLAGS.items()})
    codes = status_recodes()

    def out_col(c):
        field = c[:-5] if c.endswith("First") else c[:-4] if c.endswith("Last") else None
        if field in codes:
            return f"{codes[field].decode_sql(c)} AS {q(c)}"
        return q(c)
    ordered = [*FIRST_LAST_COLUMNS, "EmploymentSupport_Count", *_side("First"), *_side("Last")]
    return pairs.selectExpr(*[out_col(c) for c in ordered], *[f"{v} AS {k}" for k, v in flags.items()],
                            "EmpFirstRecord", "EmpLastRecord",
                            "__last_flag AS EmpSupportDischargeDatePresent").distinct()


def benefits(src: Sources, params: RunParams, counts: DataFrame | None = None,
             base: DataFrame | None = None) -> DataFrame:
    """Finished courses (first status row) per month x 4 levels x discharge
    flag x any-benefit group; ``COUNT(PathwayID)``."""
    base = base if base is not None else status_base(src, params, counts)
    first = base.where("EmpFirstRecord = 1").withColumns({"MonthDate": F.expr("to_date(Month, 'MMMM yyyy')")})
    out = org_rollup(first, ["MonthDate", "EmpSupportDischargeDatePresent", "GeneralBenefitReceived"],
                     {"NumberFinishingCourseOfTreatment": "PathwayID"},
                     names=("OrganisationType", "Region", "OrganisationCode", "OrganisationName"), count=True)
    benefit = status_recodes()["GeneralBenefitReceived"]
    return out.selectExpr("MonthDate AS Month", "OrganisationType", "Region", "OrganisationCode",
                          "OrganisationName", "EmpSupportDischargeDatePresent",
                          f"{benefit.decode_sql('GeneralBenefitReceived')} AS GeneralBenefitReceived",
                          "NumberFinishingCourseOfTreatment")


COMPLETENESS = ["FinishedTreatmentOneEmpStatus", "FinishedTreatmentTwoEmpStatus", "FinishedTreatmentOneSickAbsence",
                "FinishedTreatmentTwoSickAbsence", "FinishedTreatment"]


def completeness_flags(base: DataFrame) -> DataFrame:
    """Status base plus the five recording-completeness flags."""
    dated = "EmployStatusRecDate IS NOT NULL"
    codes = status_recodes()
    stated = f"EmployStatus <> {codes['EmployStatus'].code_of(L.UNSPECIFIED)}"
    sick = f"SickAbsenceInd <> {codes['SickAbsenceInd'].code_of(L.UNSPECIFIED)}"
    return base.selectExpr(
        "*",
        f"{flag_sql('EmpFirstRecord = 1', dated, stated)} AS FinishedTreatmentOneEmpStatus",
        f"{flag_sql('EmpFirstRecord = 2', dated, stated)} AS FinishedTreatmentTwoEmpStatus",
        f"{flag_sql('EmpFirstRecord = 1', dated, sick)} AS FinishedTreatmentOneSickAbsence",
        f"{flag_sql('EmpFirstRecord = 2', dated, sick)} AS FinishedTreatmentTwoSickAbsence",
        f"{flag_sql('EmpFirstRecord IN (0, 1)')} AS FinishedTreatment")


def finished_treatment(src: Sources, params: RunParams, counts: DataFrame | None = None,
                       base: DataFrame | None = None) -> DataFrame:
    """National completeness sums per month for two scopes (any appointment;
    records with a support contact) in one aggregate."""
    base = base if base is not None else status_base(src, params, counts)
    scope = ("explode(filter(array('Any Appointment Type', "
             "CASE WHEN Count_EmpSupp > 0 THEN 'Employment Support' END), x -> x IS NOT NULL)) AS AppointmentType")
    scoped = completeness_flags(base).selectExpr("Month", *COMPLETENESS, scope)
    out = scoped.groupBy("Month", "AppointmentType").agg(*[F.expr(f"sum({c}) AS {c}") for c in COMPLETENESS])
    return out.selectExpr("Month", "'National' AS OrgType", "'All Regions' AS Region", "'England' AS OrgName",
                          "AppointmentType", *COMPLETENESS)


__all__ = ["status_base", "first_and_last_status", "benefits", "finished_treatment"]
