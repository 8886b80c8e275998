"""Shared pieces of the publishing pipelines."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.functions import labels as L
from monthwise.functions.flags import true_sql
from monthwise.functions.recode import sexual_orientation_sql
from monthwise.operators.contacts import by_record, qualifying_contact_count
from monthwise.operators.lookups import (COMMISSIONER_COLS, PROVIDER_COLS, commissioner_geography,
                                         provider_geography, snapshot_lookup)
from monthwise.operators.membership import MemberFilter
from monthwise.operators.periods import DEFAULT_FLOOR, Period, resolve_period
from monthwise.operators.ranking import latest_by_date_then_priority
from monthwise.operators.submissions import keep_latest_audits
from monthwise.sources.tables import Sources


@dataclass(frozen=True)
class RunParams:
    """``offset`` months back from the newest submission; ``floor`` starts the back series."""

    offset: int = -1
    floor: dt.date = DEFAULT_FLOOR
    period: Period | None = None    # set by a run that has resolved it already


# The fixture's months run 1995-01 to 2001-12 and thin out at the end, so the
# fixture runs report 2001-06 with the whole fixture history as back series.
FIXTURE_PARAMS = RunParams(offset=-6, floor=dt.date(1995, 1, 1))

def period_for(src: Sources, params: RunParams) -> Period:
    """O1 on the submissions as they are now, unless the run passes its period: the only driver-side collect."""
    return params.period or resolve_period(src.submissions, params.offset, params.floor)


def used_referrals(src: Sources) -> DataFrame:
    return src.referral.where(true_sql("UsePathway_Flag"))


def contact_counts(src: Sources, pathways: DataFrame | None = None) -> DataFrame:
    """O22, optionally only for ``pathways`` (the count of a pathway depends on
    that pathway's rows alone, so restricting first gives the same numbers).

    The restriction is a filter that may let others pass; their counts are right too."""
    ref = src.referral
    if pathways is not None:
        ref = MemberFilter(pathways, "PathwayID").keep(ref, "PathwayID")
    return qualifying_contact_count(ref, src.submissions, src.carecontact, src.careactivity, src.empstatus,
                                    src.stored_by_record)


def with_contact_count(df: DataFrame, counts: DataFrame, out: str) -> DataFrame:
    """Left join the count on PathwayID; no qualifying contact gives 0."""
    c = counts.selectExpr("PathwayID AS __ec_path", "Count_EmpSupp AS __ec")
    return (df.join(c, F.expr("PathwayID = __ec_path"), "left")
              .withColumns({out: F.expr("CAST(coalesce(__ec, 0) AS BIGINT)")})
              .drop("__ec_path", "__ec"))


def sexual_orientation_latest(src: Sources, lo, hi) -> DataFrame:
    """Newest sexual-orientation answer per (person, record, audit, submission), of the latest audits of the periods
    in [lo, hi]: other audits can't meet a referral of these periods, and whole ranking partitions go."""
    # Only the columns the pick orders by or returns; the DISTINCT and the pick
    # see the same rows for these columns.
    answers = keep_latest_audits(src.socpercirc, src.submissions, lo, hi, keys=("UniqueSubmissionID", "AuditId"))
    answers = by_record(answers.select("Person_ID", "RecordNumber", "AuditID", "UniqueSubmissionID",
                                       "SocPerCircumstanceRecDate", "SocPerCircumstance", "UniqueID_IDS011"),
                        src.stored_by_record)
    return latest_by_date_then_priority(
        answers, ["Person_ID", "RecordNumber", "AuditID", "UniqueSubmissionID"],
        date="SocPerCircumstanceRecDate", code="SocPerCircumstance", tiers=L.SEXUAL_ORIENTATION_TIERS,
        tiebreak="UniqueID_IDS011", priority_name="SocPerCircumstanceRank")


def with_sexual_orientation(df: DataFrame, src: Sources, lo, hi) -> DataFrame:
    spc = sexual_orientation_latest(src, lo, hi).selectExpr(
        "RecordNumber AS __s_rec", "AuditID AS __s_aid", "UniqueSubmissionID AS __s_sid",
        f"{sexual_orientation_sql('SocPerCircumstance')} AS __s_desc")
    j = df.join(spc, F.expr("RecordNumber = __s_rec AND AuditId = __s_aid AND UniqueSubmissionID = __s_sid"), "left")
    # No answer at all is 'Unspecified' too.
    return (j.withColumns({"SexualOrientationDesc": F.expr(f"coalesce(__s_desc, '{L.UNSPECIFIED}')")})
             .drop("__s_rec", "__s_aid", "__s_sid", "__s_desc"))


def with_deprivation(df: DataFrame, src: Sources) -> DataFrame:
    """IMD decile from the 2019-12-31 snapshot; unmatched stays NULL."""
    return snapshot_lookup(df, "LSOA", src.deprivation, "LSOA_Code", {"IMD_Decile": "IMD_Decile"},
                           "Effective_Snapshot_Date", "2019-12-31")


def with_geography(df: DataFrame, src: Sources, commissioner: bool = True, provider: bool = True,
                   provider_cols: dict | None = None) -> DataFrame:
    """Organisations of rows that come from the referrals of ``src``, looked up once per code that these use."""
    if commissioner:
        df = commissioner_geography(df, src.comm_changes, src.comm_hierarchy, cols=COMMISSIONER_COLS, facts=src.referral)
    if provider:
        df = provider_geography(df, src.prov_successor, src.prov_hierarchy, cols=provider_cols or PROVIDER_COLS,
                                facts=src.referral)
    return df


def mpi_columns(src: Sources) -> DataFrame:
    return by_record(src.mpi.selectExpr("RecordNumber AS __m_rec", "Gender", "GenderIdentity",
                                        "Validated_EthnicCategory", "LSOA", "Age_RP_EndDate"),
                     src.stored_by_record, "__m_rec")


def join_mpi(df: DataFrame, src: Sources) -> DataFrame:
    """People of the records of ``df``, which is partitioned by record."""
    return df.join(mpi_columns(src), F.expr("RecordNumber = __m_rec")).drop("__m_rec")
