"""Presenteeism assessment questions 7, 8 and 9.

Answers are kept at their newest audit (O9), tagged with the current provider,
then T8 pairs each pathway's first and last answer per question and counts
pathways per score; T9 bands the number of answers of each referral open or
discharged in its month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.functions.flags import open_caseload_sql
from monthwise.functions.labels import PRESENTEEISM_QUESTIONS
from monthwise.functions.recode import coverage_band_sql
from monthwise.operators.lookups import provider_geography
from monthwise.operators.pairing import pair_first_last_answers, score_distribution
from monthwise.operators.submissions import latest_audit_rows, latest_submission
from monthwise.plans.common import RunParams, period_for, used_referrals
from monthwise.sources.tables import Sources

PROVIDER = {"ProviderCode": "Organisation_Code", "ProviderName": "Organisation_Name",
            "RegionNameProv": "Region_Name"}


def newest_answers(src: Sources) -> DataFrame:
    """Answers to the three questions at their newest audit."""
    codes = ", ".join(f"'{c}'" for c in PRESENTEEISM_QUESTIONS)
    return latest_audit_rows(src.assessments.where(f"CodedAssToolType IN ({codes})"), src.submissions)


def coded_assessments(src: Sources) -> DataFrame:
    """The newest answers with provider labels (one row per current provider row)."""
    return provider_geography(newest_answers(src), src.prov_successor, src.prov_hierarchy, cols=PROVIDER)


def presenteeism_pairs(src: Sources, params: RunParams) -> DataFrame:
    """First and last answer per pathway and question; last dated in [floor, month].

    Answers are paired before the provider is looked up, so a code with two
    current provider rows repeats the pair but never makes one of a single answer.
    """
    p = period_for(src, params)
    pairs = pair_first_last_answers(
        newest_answers(src), ["PathwayID", "CodedAssToolType"], "AssToolCompDate", "AssToolCompTime",
        "UniqueID_IDS606", carry=["PersScore", "OrgID_Provider", "AuditId", "AssToolCompDate"], lo=p.floor, hi=p.start)
    pairs = provider_geography(pairs, src.prov_successor, src.prov_hierarchy, key="FirstOrgID_Provider",
                               cols=PROVIDER)
    return pairs.selectExpr(
        "PathwayID", "ProviderName AS `Provider Name`", "ProviderCode AS `Provider Code`",
        "RegionNameProv AS `Region Name`", "CodedAssToolType", "FirstPersScore", "LastPersScore",
        "LastAuditId AS AuditID", "date_format(LastAssToolCompDate, 'MMMM yyyy') AS Month",
        "FirstAssToolCompDate AS FirstDate", "LastAssToolCompDate AS LastDate")


def assessment_counts(src: Sources, params: RunParams) -> DataFrame:
    """Distinct pathways per question x first/last x score x month x provider."""
    out = score_distribution(presenteeism_pairs(src, params),
                             {"FirstPersScore": "FirstPersScore", "LastPersScore": "LastPersScore"},
                             keys=["CodedAssToolType", "Month", "Provider Name", "Provider Code", "Region Name"])
    return out.selectExpr("CodedAssToolType", "ScoreType", "Score", "Count_Referrals", "Month",
                          "`Provider Name`", "`Provider Code`", "`Region Name`")


def assessment_coverage(src: Sources, params: RunParams) -> DataFrame:
    """Referrals open or discharged in their month by number of answers
    (all time) per question: none / one / two or more."""
    p = period_for(src, params)
    n_answers = (coded_assessments(src).groupBy("PathwayID", "CodedAssToolType")
                 .agg(F.expr("count(AssToolCompDate) AS NumberOfPresenteeismAssessments"))
                 .withColumnRenamed("PathwayID", "__a_path"))
    r = latest_submission(used_referrals(src), src.submissions, p.floor, p.start).where(open_caseload_sql())
    j = r.join(n_answers, F.expr("PathwayID = __a_path"), "left")
    j = provider_geography(j, src.prov_successor, src.prov_hierarchy, cols=PROVIDER)
    base = j.selectExpr("trunc(ReportingPeriodStartDate, 'MM') AS Month", "PathwayID", "ProviderCode",
                        "ProviderName", "RegionNameProv", f"{coverage_band_sql()} AS PresenteeismCoverage",
                        "CodedAssToolType").distinct()
    keys = ["Month", "ProviderName", "ProviderCode", "RegionNameProv", "PresenteeismCoverage", "CodedAssToolType"]
    return base.groupBy(*keys).agg(F.expr("count(PathwayID) AS NumberOfReferrals"))
