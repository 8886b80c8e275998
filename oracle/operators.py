"""Oracle SQL for the operator-level queries."""

from __future__ import annotations

from oracle import values as L
from oracle.common import (EC_CTE, GEO_COMM, GEO_PROV, GEO_PROV_CODE, case_codes, geo_joins, level_union, lit,
                           problem_sql, quoted as _q, status_label_sql, with_fixture)
from oracle.pipelines import P_IN, _assessment_ctes, _clinical, _pairs_cte, clinical_outcomes

OM = ("om AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_orderdate AS DATE) AS OrderDate, "
      "CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS ReportingPeriodStartDate, "
      "CAST(last_day(CAST(o_orderdate AS DATE)) AS DATE) AS ReportingPeriodEndDate FROM orders)")
OM_PS = "(SELECT CAST(max(ReportingPeriodStartDate) - INTERVAL 1 MONTH AS DATE) FROM om)"


def reporting_window() -> str:
    return (f"WITH {OM} SELECT CAST(max(ReportingPeriodStartDate) - INTERVAL 1 MONTH AS DATE) AS period_start, "
            "CAST(last_day(CAST(max(ReportingPeriodEndDate) - INTERVAL 1 MONTH AS DATE)) AS DATE) AS period_end, "
            "DATE '2020-09-01' AS floor FROM om")


def period_slice_month() -> str:
    return f"WITH {OM} SELECT * FROM om WHERE ReportingPeriodStartDate BETWEEN {OM_PS} AND {OM_PS}"


def period_slice_series() -> str:
    return f"WITH {OM} SELECT * FROM om WHERE ReportingPeriodStartDate BETWEEN DATE '1998-01-01' AND {OM_PS}"


def latest_submission() -> str:
    return with_fixture() + (
        "SELECT r.RecordNumber, r.PathwayID, r.UniqueSubmissionID, r.AuditId, r.ReferralRequestReceivedDate, "
        "1 AS IsLatest, opens AS ReportingPeriodStartDate, closes AS ReportingPeriodEndDate FROM live r")


def rank_within_key() -> str:
    return ("SELECT event_id, user_id, ts, event_type, ROW_NUMBER() OVER (PARTITION BY user_id "
            "ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS EventRank FROM events")


def pick_latest_left_join() -> str:
    return ("SELECT c.c_custkey, c.c_name, o.o_orderkey, o.o_orderdate, o.o_totalprice FROM customer c "
            "LEFT JOIN (SELECT * FROM (SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice, "
            "ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, "
            "o_orderkey DESC NULLS LAST, o_totalprice DESC NULLS LAST) AS rn FROM orders) q WHERE rn = 1) o "
            "ON c.c_custkey = o.o_custkey")


def latest_by_date_then_priority() -> str:
    tiers = [["R"], ["A"], ["N"]]
    allowed = ", ".join(lit(c) for t in tiers for c in t)
    tier = " ".join(f"WHEN l_returnflag IN ({', '.join(lit(c) for c in t)}) THEN {i}"
                    for i, t in enumerate(tiers, start=1))
    rest = ["l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate", "l_quantity", "FlagTier"]
    order = ", ".join(["l_shipdate DESC NULLS LAST", "FlagTier ASC", "l_linenumber DESC NULLS LAST"]
                      + [f"{c} DESC NULLS LAST" for c in rest])
    return (f"WITH li AS (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, "
            f"CAST(l_shipdate AS DATE) AS l_shipdate, l_quantity FROM lineitem WHERE l_returnflag IN ({allowed})), "
            f"pr AS (SELECT *, CASE {tier} END AS FlagTier FROM li) "
            f"SELECT l_orderkey, {', '.join(rest)} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey "
            f"ORDER BY {order}) AS rn FROM pr) q WHERE rn = 1")


def _ranked_emp(cols: str) -> str:
    return (f"rk AS (SELECT {cols}, "
            "CAST(CASE WHEN EmployStatusRecDate IS NOT NULL THEN ROW_NUMBER() OVER (PARTITION BY RecordNumber "
            "ORDER BY EmployStatusRecDate ASC NULLS FIRST, UniqueID_IDS004 ASC NULLS FIRST) ELSE 0 END AS BIGINT) "
            "AS FirstRank, "
            "CAST(CASE WHEN EmployStatusRecDate IS NOT NULL THEN ROW_NUMBER() OVER (PARTITION BY RecordNumber "
            "ORDER BY EmployStatusRecDate DESC NULLS LAST, UniqueID_IDS004 DESC NULLS LAST) ELSE 0 END AS BIGINT) "
            "AS LastRank FROM emp)")


def first_last_ranks_null_dates() -> str:
    return with_fixture(_ranked_emp("RecordNumber, UniqueID_IDS004, EmployStatusRecDate")) + "SELECT * FROM rk"


def latest_audit_rows() -> str:
    """Answers whose audit is the newest of a group of equal answers of one provider."""
    key = ["AssToolCompDate", "PathwayID", "Unique_ServiceRequestID", "AssToolCompTime"]
    newest = (f"newest AS (SELECT {', '.join(key)}, max(AuditId) AS audit FROM ass, seen "
              f"WHERE UniqueSubmissionID = sid AND AuditId = aid GROUP BY {', '.join(key)}, OrgID_Provider)")
    same = " AND ".join(f"n.{c} = a.{c}" for c in key)
    return with_fixture(newest) + (
        f"SELECT a.* FROM ass a WHERE EXISTS (SELECT 1 FROM newest n WHERE n.audit = a.AuditId AND {same})")


def successor_remap() -> str:
    return with_fixture() + (
        "SELECT r.RecordNumber, r.AuditId, r.OrgID_Provider, COALESCE(ps.Prov_Successor, r.OrgID_Provider) "
        "AS ProviderCodeMapped FROM ref r LEFT JOIN psu ps ON r.OrgID_Provider = ps.Prov_original")


def current_lookup_other() -> str:
    return with_fixture() + (
        "SELECT r.RecordNumber, r.AuditId, r.OrgID_Provider, COALESCE(ph.Organisation_Name, 'Other') AS ProviderName, "
        "COALESCE(ph.Region_Name, 'Other') AS RegionNameProv FROM ref r "
        "LEFT JOIN phi ph ON r.OrgID_Provider = ph.Organisation_Code AND ph.Effective_To IS NULL")


def snapshot_lookup_null() -> str:
    return with_fixture() + (
        "SELECT m.RecordNumber, m.LSOA, i.IMD_Decile FROM mpi m LEFT JOIN imd i ON m.LSOA = i.LSOA_Code "
        "AND i.Effective_Snapshot_Date = DATE '2019-12-31'")


def recode_codes() -> str:
    """Each map on its own column: status maps on status rows, personal ones on people and their answers."""
    status = ", ".join(f"{e} AS {n}" for n, e in status_label_sql("").items())
    none = ", ".join(f"NULL AS {n}" for n in status_label_sql(""))
    people = [("Gender", L.GENDER, "GenderDesc"), ("Validated_EthnicCategory", L.ETHNICITY, "EthnicityDesc"),
              ("GenderIdentity", L.GENDER_IDENTITY, "GenderIdentityDesc")]
    empty = ", ".join(f"NULL AS {n}" for _, _, n in people)
    return with_fixture() + (
        f"SELECT RecordNumber, CAST(UniqueID_IDS004 AS VARCHAR) AS id, {status}, {empty}, NULL AS SexualOrientationDesc FROM emp UNION ALL "
        f"SELECT RecordNumber, NULL, {none}, {', '.join(f'{case_codes(c, m)} AS {n}' for c, m, n in people)}, NULL "
        f"FROM mpi UNION ALL SELECT RecordNumber, CAST(UniqueID_IDS011 AS VARCHAR), {none}, {empty}, "
        f"{case_codes('SocPerCircumstance', L.SEXUAL_ORIENTATION)} FROM spc")


def recode_rules() -> str:
    return with_fixture() + (
        f"SELECT r.RecordNumber, r.AuditId, {problem_sql('r.')} AS ProblemDescriptor, "
        "CASE WHEN r.PresentingComplaintHigherCategory = 'Depression' THEN 'Depression' ELSE 'Not depression' END "
        "AS DepressionGroup FROM ref r")


def bands() -> str:
    return ("SELECT p_partkey, p_size, CASE WHEN p_size <= 17 THEN 'Under 18' WHEN p_size BETWEEN 18 AND 25 THEN '18-25' "
            "WHEN p_size BETWEEN 26 AND 64 THEN '26-64' WHEN p_size >= 65 THEN '65+' ELSE 'Unspecified' END AS AgeGroups, "
            "CASE WHEN p_size <= 10 THEN 'Small' WHEN p_size BETWEEN 11 AND 25 THEN 'Medium' "
            "WHEN p_size >= 26 THEN 'Large' ELSE 'Unspecified' END AS SizeBand FROM part")


def month_text_and_date() -> str:
    return ("SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%B %Y') AS Month, "
            "CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS MonthDate FROM orders")


def in_period_flags() -> str:
    def f(date, *c):
        cond = " AND ".join([f"r.{date} {P_IN}", *c, "r.PathwayID IS NOT NULL"])
        return f"CASE WHEN {cond} THEN 1 ELSE 0 END"
    done = "lower(r.CompletedTreatment_Flag) = 'true'"
    return with_fixture() + (
        f"SELECT r.RecordNumber, r.AuditId, {f('ReferralRequestReceivedDate')} AS AllReferrals, "
        f"{f('TherapySession_FirstDate')} AS AllAccess, {f('EmpSupport_FirstDate')} AS EmpAccess, "
        f"{f('ServDischDate', done)} AS AllFinishedTreatment, "
        f"{f('ServDischDate', done, 'lower(r.Recovery_Flag) = ' + lit('true'))} AS AllCompTreatFlagRecFlag, "
        f"{f('ServDischDate', done, 'lower(r.NotCaseness_Flag) = ' + lit('true'))} AS AllNotCaseness "
        "FROM live r")


def condition_flags() -> str:
    return with_fixture() + (
        "SELECT RecordNumber, UniqueID_IDS004, CASE WHEN EmpSupportInd = 'Y' THEN 1 ELSE 0 END AS EmpSuppIndYes, "
        "CASE WHEN EmpSupportDischargeDate IS NOT NULL THEN 1 ELSE 0 END AS EmpSupportDischargeDatePresent, "
        "CASE WHEN EmpSupportInd = 'Y' AND EmployStatus = '03' THEN 1 ELSE 0 END AS EligibleStudent FROM emp")


def days_open_bands() -> str:
    bands = [("LessThan61Days", "< 61"), ("61-90Days", "BETWEEN 61 AND 90"), ("91-120Days", "BETWEEN 91 AND 120"),
             ("Over120days", "> 120")]
    cols = ", ".join(
        f"CASE WHEN o_orderstatus = 'P' AND OrderDate <= pe AND datediff('day', OrderDate, pe) {c} "
        f"AND o_orderkey IS NOT NULL THEN 1 ELSE 0 END AS {_q('Open' + n + 'SinceOrder')}" for n, c in bands)
    return (f"WITH {OM}, e AS (SELECT CAST(last_day(max(OrderDate)) AS DATE) AS pe FROM om) "
            f"SELECT o_orderkey, {cols} FROM om CROSS JOIN e")


def _pairs_sql() -> str:
    return with_fixture(_ranked_emp("RecordNumber, UniqueID_IDS004, EmployStatusRecDate, EmployStatus, SSPInd"), (
        "pr AS (SELECT e1.RecordNumber, e1.EmployStatus AS EmployStatusFirst, "
        "e1.EmployStatusRecDate AS EmployStatusRecDateFirst, e1.SSPInd AS SSPIndFirst, "
        "e2.EmployStatus AS EmployStatusLast, e2.EmployStatusRecDate AS EmployStatusRecDateLast, "
        "e2.SSPInd AS SSPIndLast, e2.FirstRank AS LastRankOfFirst "
        "FROM rk e1 JOIN rk e2 ON e1.RecordNumber = e2.RecordNumber AND e1.FirstRank <> e2.FirstRank "
        "WHERE e1.FirstRank = 1 AND e2.LastRank = 1)"))


def pair_first_last() -> str:
    return _pairs_sql() + "SELECT * FROM pr"


def same_value_flags() -> str:
    return _pairs_sql() + (
        "SELECT RecordNumber, CASE WHEN EmployStatusFirst = EmployStatusLast THEN 1 ELSE 0 END AS EmployStatusSameFlag, "
        "CASE WHEN SSPIndFirst = SSPIndLast THEN 1 ELSE 0 END AS SSPIndSameFlag FROM pr")


def pair_first_last_by_type() -> str:
    return with_fixture(*_assessment_ctes(), _pairs_cte()) + "SELECT * FROM pq"


def qualifying_contact_count() -> str:
    return with_fixture(EC_CTE) + "SELECT * FROM ec"


def open_caseload() -> str:
    return with_fixture() + (
        "SELECT r.RecordNumber, r.AuditId, opens AS ReportingPeriodStartDate FROM live r "
        "WHERE (r.ServDischDate IS NULL AND r.ReferralRequestReceivedDate <= closes) "
        f"OR r.ServDischDate {P_IN}")


def org_rollup() -> str:
    base = (f"ob AS (SELECT CAST(date_trunc('month', opens) AS DATE) AS Month, "
            f"CASE WHEN r.ReferralRequestReceivedDate {P_IN} AND r.PathwayID IS NOT NULL THEN 1 ELSE 0 END AS Referrals, "
            f"CASE WHEN r.ServDischDate {P_IN} AND r.PathwayID IS NOT NULL THEN 1 ELSE 0 END AS Discharges, "
            f"{GEO_COMM}, {GEO_PROV}, {GEO_PROV_CODE} FROM live r {geo_joins()})")
    tpl = ("SELECT Month, {otype} AS OrgType, {region} AS Region, {code} AS OrgCode, {name} AS OrgName, "
           "CAST(SUM(Referrals) AS BIGINT) AS Referrals, CAST(SUM(Discharges) AS BIGINT) AS Discharges "
           "FROM ob GROUP BY Month{group}")
    return with_fixture(base) + level_union(tpl)


_ALL_OUT = ["Referrals", "OpenReferralLessThan61DaysTimeSinceLastContact", "OpenReferral61-90DaysTimeSinceLastContact",
            "OpenReferral91-120DaysTimeSinceLastContact", "OpenReferralOver120daysTimeSinceLastContact", "Access"]
_LAST5 = [("AllFinishedTreatment", "FinishedTreatment"), ("AllCompTreatFlagRecFlag", "RecoveryFlag"),
          ("AllNotCaseness", "NotCasenessFlag"), ("AllCompTreatFlagRelImpFlag", "ReliableImprovementFlag"),
          ("AllCompTreatFlagRelDetFlag", "ReliableDeteriorationFlag")]


def appointment_scopes() -> str:
    def part(scope, prefix, dosage, where):
        ms = [f"{_q(prefix + o)} AS {_q(o)}" for o in _ALL_OUT] + [f"{s} AS {o}" for s, o in _LAST5]
        return (f"SELECT Month, PathwayID, '{scope}' AS AppointmentType, CAST({dosage} AS BIGINT) AS Dosage, "
                f"{', '.join(ms)} FROM cbase {where}")
    return _clinical("\nUNION ALL\n".join([
        part("Employment Support", "Emp", "AllEmploymentSupport_Count", "WHERE AllEmploymentSupport_Count > 0"),
        part("Any Appointment Type", "All", "AllTreatmentCareContact_Count", ""),
        part("Any Appointment Type except Employment Support", "All", "AllTreatmentCareContact_Count",
             "WHERE AllEmploymentSupport_Count = 0")]))


def score_distribution() -> str:
    parts = [f"SELECT CodedAssToolType, '{st}' AS ScoreType, {st} AS Score, COUNT(DISTINCT PathwayID) AS Count_Referrals "
             f"FROM pq GROUP BY CodedAssToolType, {st}" for st in ("FirstPersScore", "LastPersScore")]
    return with_fixture(*_assessment_ctes(), _pairs_cte()) + "\nUNION ALL\n".join(parts)


OPERATOR_ORACLE = {
    "reporting_window": reporting_window,
    "period_slice_month": period_slice_month,
    "period_slice_series": period_slice_series,
    "latest_submission": latest_submission,
    "rank_within_key": rank_within_key,
    "pick_latest_left_join": pick_latest_left_join,
    "latest_by_date_then_priority": latest_by_date_then_priority,
    "first_last_ranks_null_dates": first_last_ranks_null_dates,
    "latest_audit_rows": latest_audit_rows,
    "successor_remap": successor_remap,
    "current_lookup_other": current_lookup_other,
    "snapshot_lookup_null": snapshot_lookup_null,
    "recode_codes": recode_codes,
    "recode_rules": recode_rules,
    "bands": bands,
    "month_text_and_date": month_text_and_date,
    "in_period_flags": in_period_flags,
    "condition_flags": condition_flags,
    "days_open_bands": days_open_bands,
    "pair_first_last": pair_first_last,
    "same_value_flags": same_value_flags,
    "pair_first_last_by_type": pair_first_last_by_type,
    "qualifying_contact_count": qualifying_contact_count,
    "open_caseload": open_caseload,
    "org_rollup": org_rollup,
    "category_rollup": clinical_outcomes,
    "appointment_scopes": appointment_scopes,
    "score_distribution": score_distribution,
}
