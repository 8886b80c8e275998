"""One registered query per operator, on the driver tables
or on the fixture projection of them.  Each returns a DataFrame over the whole
input; nothing is sampled or capped.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.functions import labels as L
from monthwise.functions.dates import month_date, month_label
from monthwise.functions.flags import (condition_flag, days_open_bands, in_period_flag, open_caseload,
                                       same_value_flags, true_sql)
from monthwise.functions.recode import (band, problem_descriptor, protected_characteristics_sql, recode,
                                        sexual_orientation_sql, status_labels_sql)
from monthwise.operators.contacts import qualifying_contact_count
from monthwise.operators.distinct import distinct_counts, distinct_partials, merge_partials
from monthwise.operators.lookups import current_lookup, duplicate_current_codes, remap_successor, snapshot_lookup
from monthwise.operators.pairing import pair_first_last, score_distribution
from monthwise.operators.periods import reporting_window, resolve_period, slice_period
from monthwise.operators.publish import publish, read_published
from monthwise.operators.ranking import first_last_ranks, latest_by_date_then_priority, pick_first, rank_in_shares, rank_within
from monthwise.operators.releases import Releases
from monthwise.operators.rollup import appointment_scope, category_rollup, org_rollup
from monthwise.operators.submissions import latest_audit_rows, latest_submission
from monthwise.plans import assessments, clinical, incremental, indicator, status
from monthwise.plans.common import FIXTURE_PARAMS, period_for, with_geography
from monthwise.session import checkpoint_dir
from monthwise.sources.fixture_store import fixture_sources

# Fixed parameter of the back-series slice over order months.
SERIES_FLOOR = dt.date(1998, 1, 1)
# Return-flag preference tiers (most informative first) for the O7 query.
RETURN_FLAG_TIERS = [["R"], ["A"], ["N"]]
# Part-size bands for the O15 query (inclusive edges).
SIZE_BANDS = [(None, 10, "Small"), (11, 25, "Medium"), (26, None, "Large")]


def _read(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*cols)


def _src(spark, sf_dir):
    return fixture_sources(spark, sf_dir)


def _order_months(spark, sf_dir) -> DataFrame:
    """Orders as monthly 'submissions': period start/end of the order month."""
    o = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    d = F.col("o_orderdate").cast("date")
    return o.select("o_orderkey", "o_custkey", "o_orderstatus", d.alias("OrderDate"),
                    month_date(d).alias("ReportingPeriodStartDate"), F.last_day(d).alias("ReportingPeriodEndDate"))


# --- O1 / O2 -----------------------------------------------------------------
def q_reporting_window(spark, sf_dir):
    return reporting_window(_order_months(spark, sf_dir), offset=-1, floor=dt.date(2020, 9, 1))


def q_period_slice_month(spark, sf_dir):
    om = _order_months(spark, sf_dir)
    p = resolve_period(om, offset=-1)
    return slice_period(om, "ReportingPeriodStartDate", p.start, p.start)


def q_period_slice_series(spark, sf_dir):
    om = _order_months(spark, sf_dir)
    p = resolve_period(om, offset=-1)
    return slice_period(om, "ReportingPeriodStartDate", SERIES_FLOOR, p.start)


# --- O3 ------------------------------------------------------------------------
def q_latest_submission(spark, sf_dir):
    s = _src(spark, sf_dir)
    r = s.referral.select("RecordNumber", "PathwayID", "UniqueSubmissionID", "AuditId", "ReferralRequestReceivedDate")
    return latest_submission(r, s.submissions)


# --- O4 / O5 -------------------------------------------------------------------
def q_rank_within_key(spark, sf_dir):
    e = _read(spark, sf_dir, "events", "event_id", "user_id", "ts", "event_type")
    return rank_within(e, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()], "EventRank")


def q_rank_hot_key(spark, sf_dir):
    """Three keys, each with a large share of all rows: ranked in shares with counted offsets."""
    li = _read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    return rank_in_shares(li, ["l_returnflag"], [F.col("l_extendedprice").desc(), F.col("l_orderkey").asc(),
                                                 F.col("l_linenumber").asc()], "PriceRank")


def q_pick_latest_left_join(spark, sf_dir):
    c = _read(spark, sf_dir, "customer", "c_custkey", "c_name")
    o = _read(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    newest = pick_first(o, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")])
    return (c.join(newest, c.c_custkey == newest.o_custkey, "left")
             .select("c_custkey", "c_name", "o_orderkey", "o_orderdate", "o_totalprice"))


# --- O6 / O7 -------------------------------------------------------------------
def q_latest_by_date_then_priority(spark, sf_dir):
    li = _read(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
               "l_shipdate", "l_quantity").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    return latest_by_date_then_priority(li, ["l_orderkey"], "l_shipdate", "l_returnflag", RETURN_FLAG_TIERS,
                                        "l_linenumber", priority_name="FlagTier")


# --- O8 ------------------------------------------------------------------------
def q_first_last_ranks_null_dates(spark, sf_dir):
    e = _src(spark, sf_dir).empstatus.select("RecordNumber", "UniqueID_IDS004", "EmployStatusRecDate")
    return first_last_ranks(e, ["RecordNumber"], "EmployStatusRecDate", ["UniqueID_IDS004"],
                            "FirstRank", "LastRank")


# --- O9 ------------------------------------------------------------------------
def q_latest_audit_rows(spark, sf_dir):
    s = _src(spark, sf_dir)
    return latest_audit_rows(s.assessments, s.submissions)


# --- O10 / O11 / O12 -----------------------------------------------------------
def q_successor_remap(spark, sf_dir):
    s = _src(spark, sf_dir)
    r = s.referral.select("RecordNumber", "AuditId", "OrgID_Provider")
    return remap_successor(r, "OrgID_Provider", s.prov_successor, "Prov_original", "Prov_Successor",
                           "ProviderCodeMapped")


def q_current_lookup_other(spark, sf_dir):
    s = _src(spark, sf_dir)
    r = s.referral.select("RecordNumber", "AuditId", "OrgID_Provider")
    return current_lookup(r, "OrgID_Provider", s.prov_hierarchy, "Organisation_Code",
                          {"ProviderName": "Organisation_Name", "RegionNameProv": "Region_Name"})


def q_snapshot_lookup_null(spark, sf_dir):
    s = _src(spark, sf_dir)
    m = s.mpi.select("RecordNumber", "LSOA")
    return snapshot_lookup(m, "LSOA", s.deprivation, "LSOA_Code", {"IMD_Decile": "IMD_Decile"},
                           "Effective_Snapshot_Date", "2019-12-31")


# --- O13 / O14 / O15 -------------------------------------------------------------
def q_recode_codes(spark, sf_dir):
    """All 13 maps: the status ones on status rows, the personal ones on people and on their answers."""
    s = _src(spark, sf_dir)
    traits = protected_characteristics_sql()
    personal = {k: traits[k] for k in ("GenderDesc", "EthnicityDesc", "GenderIdentityDesc")}
    status = status_labels_sql()

    def part(df, uid, **columns):
        names = [*status, *personal, "SexualOrientationDesc"]
        return df.selectExpr("RecordNumber", f"CAST({uid} AS STRING) AS id", *[
            f"{columns.get(n, 'CAST(NULL AS STRING)')} AS {n}" for n in names])
    return (part(s.empstatus, "UniqueID_IDS004", **status)
            .unionByName(part(s.mpi, "NULL", **personal))
            .unionByName(part(s.socpercirc, "UniqueID_IDS011", SexualOrientationDesc=sexual_orientation_sql())))


def q_recode_rules(spark, sf_dir):
    s = _src(spark, sf_dir)
    return s.referral.select("RecordNumber", "AuditId", problem_descriptor().alias("ProblemDescriptor"),
                             recode("PresentingComplaintHigherCategory", {"Depression": "Depression"},
                                    "Not depression").alias("DepressionGroup"))


def q_bands(spark, sf_dir):
    p = _read(spark, sf_dir, "part", "p_partkey", "p_size")
    return p.select("p_partkey", "p_size", band("p_size", L.AGE_BANDS).alias("AgeGroups"),
                    band("p_size", SIZE_BANDS).alias("SizeBand"))


# --- O16 ---------------------------------------------------------------------------
def q_month_text_and_date(spark, sf_dir):
    o = _read(spark, sf_dir, "orders", "o_orderkey", "o_orderdate")
    d = F.col("o_orderdate").cast("date")
    return o.select("o_orderkey", month_label(d).alias("Month"), month_date(d).alias("MonthDate"))


# --- O17 / O18 -----------------------------------------------------------------------
def q_in_period_flags(spark, sf_dir):
    s = _src(spark, sf_dir)
    r = latest_submission(s.referral, s.submissions)
    done = true_sql("CompletedTreatment_Flag")
    return r.select("RecordNumber", "AuditId",
                    in_period_flag("ReferralRequestReceivedDate").alias("AllReferrals"),
                    in_period_flag("TherapySession_FirstDate").alias("AllAccess"),
                    in_period_flag("EmpSupport_FirstDate").alias("EmpAccess"),
                    in_period_flag("ServDischDate", done).alias("AllFinishedTreatment"),
                    in_period_flag("ServDischDate", done, true_sql("Recovery_Flag")).alias("AllCompTreatFlagRecFlag"),
                    in_period_flag("ServDischDate", done, true_sql("NotCaseness_Flag")).alias("AllNotCaseness"))


def q_condition_flags(spark, sf_dir):
    s = _src(spark, sf_dir)
    e = s.empstatus
    eligible = "EmpSupportInd = 'Y'"
    return e.select("RecordNumber", "UniqueID_IDS004",
                    condition_flag(eligible).alias("EmpSuppIndYes"),
                    condition_flag("EmpSupportDischargeDate IS NOT NULL").alias("EmpSupportDischargeDatePresent"),
                    condition_flag(eligible, "EmployStatus = '03'").alias("EligibleStudent"))


# --- O19 -----------------------------------------------------------------------------
def q_days_open_bands(spark, sf_dir):
    om = _order_months(spark, sf_dir)
    # The period end is a one-row aggregate, evaluated once like O1, so it is a literal in the plan.
    end = om.agg(F.last_day(F.max("OrderDate")).alias("end")).first()["end"]
    o = om.select("o_orderkey", "o_orderstatus", "OrderDate", F.lit(end).alias("ReportingPeriodEndDate"))
    flags = days_open_bands("OrderDate", "Open", "SinceOrder", still_open="o_orderstatus = 'P'",
                            require="o_orderkey")
    return o.select("o_orderkey", *[v.alias(k) for k, v in flags.items()])


# --- O20 / O21 -------------------------------------------------------------------------
def q_pair_first_last(spark, sf_dir):
    s = _src(spark, sf_dir)
    e = s.empstatus.select("RecordNumber", "UniqueID_IDS004", "EmployStatusRecDate", "EmployStatus", "SSPInd")
    ranked = first_last_ranks(e, ["RecordNumber"], "EmployStatusRecDate", ["UniqueID_IDS004"], "FirstRank",
                              "LastRank")
    return pair_first_last(ranked, ["RecordNumber"], "FirstRank", "LastRank",
                           {"RecordNumber": "RecordNumber", "EmployStatusFirst": "EmployStatus",
                            "EmployStatusRecDateFirst": "EmployStatusRecDate", "SSPIndFirst": "SSPInd"},
                           {"EmployStatusLast": "EmployStatus", "EmployStatusRecDateLast": "EmployStatusRecDate",
                            "SSPIndLast": "SSPInd", "LastRankOfFirst": "FirstRank"})


def q_same_value_flags(spark, sf_dir):
    pairs = q_pair_first_last(spark, sf_dir)
    flags = same_value_flags({"EmployStatusSameFlag": ("EmployStatusFirst", "EmployStatusLast"),
                              "SSPIndSameFlag": ("SSPIndFirst", "SSPIndLast")})
    return pairs.select("RecordNumber", *[v.alias(k) for k, v in flags.items()])


def q_pair_first_last_by_type(spark, sf_dir):
    return assessments.presenteeism_pairs(_src(spark, sf_dir), FIXTURE_PARAMS)


# --- O22 / O23 ---------------------------------------------------------------------------
def q_qualifying_contact_count(spark, sf_dir):
    s = _src(spark, sf_dir)
    return qualifying_contact_count(s.referral, s.submissions, s.carecontact, s.careactivity, s.empstatus)


def q_open_caseload(spark, sf_dir):
    s = _src(spark, sf_dir)
    r = latest_submission(s.referral, s.submissions).where(open_caseload())
    return r.select("RecordNumber", "AuditId", "ReportingPeriodStartDate")


# --- O24 / O25 / O26 / O27 ----------------------------------------------------------------
def q_org_rollup(spark, sf_dir):
    """Referrals received and discharged, per submission month, at every level."""
    s = _src(spark, sf_dir)
    r = latest_submission(s.referral, s.submissions)
    r = with_geography(r, s)
    r = r.select("*", month_date("ReportingPeriodStartDate").alias("Month"),
                 in_period_flag("ReferralRequestReceivedDate").alias("Referrals"),
                 in_period_flag("ServDischDate").alias("Discharges"))
    return org_rollup(r, ["Month"], {"Referrals": "Referrals", "Discharges": "Discharges"})


def q_category_rollup(spark, sf_dir):
    """The clinical-outcomes roll-up: four levels x seven categories x three scopes."""
    base = clinical.clinical_base(_src(spark, sf_dir), FIXTURE_PARAMS)
    return category_rollup(base, ["Month"], clinical.CATEGORIES, clinical.outcome_scopes(),
                           hidden=[clinical.DISCHARGE_FLAG])


def q_appointment_scopes(spark, sf_dir):
    """Row-level projection of every clinical-base row into each scope it belongs to."""
    s = _src(spark, sf_dir)
    base = clinical.clinical_base(s, FIXTURE_PARAMS)
    parts = [appointment_scope(base, sc, ["Month", "PathwayID"]) for sc in clinical.outcome_scopes()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_score_distribution(spark, sf_dir):
    """Distinct pathways per question x first/last x score, nationally."""
    pairs = assessments.presenteeism_pairs(_src(spark, sf_dir), FIXTURE_PARAMS)
    return score_distribution(pairs, {"FirstPersScore": "FirstPersScore", "LastPersScore": "LastPersScore"},
                              keys=["CodedAssToolType"])


# --- O28 / checks --------------------------------------------------------------------------
def q_publish_indicator(spark, sf_dir):
    """T7 published twice by month to the shared folder, then read back: replayed months don't double."""
    out = indicator.indicator(_src(spark, sf_dir), FIXTURE_PARAMS)
    path = f"{checkpoint_dir(spark)}/published-{uuid.uuid4().hex[:12]}"
    for _ in range(2):
        publish(out, path, "append_month")
    return read_published(spark, path, like=out)


def _month_totals(spark, sf_dir) -> DataFrame:
    om = _order_months(spark, sf_dir).withColumnRenamed("ReportingPeriodStartDate", "Month")
    return om.groupBy("Month", "o_orderstatus").agg(F.count("*").alias("Orders"), F.countDistinct("o_custkey").alias("Customers"))


def q_publish_created_then_appended(spark, sf_dir):
    """A month table created with all months before the newest, then that month appended, then the first ones again."""
    totals = _month_totals(spark, sf_dir)
    newest = resolve_period(_order_months(spark, sf_dir), offset=0).start
    path = f"{checkpoint_dir(spark)}/published-{uuid.uuid4().hex[:12]}"
    older = totals.where(F.col("Month") < F.lit(newest))
    publish(older, path, "rebuild", by_month=True)
    publish(totals.where(F.col("Month") == F.lit(newest)), path, "append_month")
    publish(older.where(F.col("Month") < F.lit(SERIES_FLOOR)), path, "append_month")
    return read_published(spark, path, like=totals)


def q_release_months(spark, sf_dir):
    """Two tables released together, the months before SERIES_FLOOR first, the others by a later run; then joined."""
    totals = _month_totals(spark, sf_dir)
    old = F.col("Month") < F.lit(SERIES_FLOOR)
    releases = Releases(spark, f"{checkpoint_dir(spark)}/releases-{uuid.uuid4().hex[:12]}")
    for part in (totals.where(old), totals.where(~old)):
        run = releases.begin()
        run.write("Orders", part.select("Month", "o_orderstatus", "Orders"), "append_month")
        run.write("Customers", part.select("Month", "o_orderstatus", "Customers"), "append_month")
        run.commit()
    return releases.read("Orders").join(releases.read("Customers"), ["Month", "o_orderstatus"])


def q_benefits_by_touched_months(spark, sf_dir):
    """T2 released for the month before, then brought to the report month by its touched months alone."""
    src = _src(spark, sf_dir)
    releases = Releases(spark, f"{checkpoint_dir(spark)}/series-{uuid.uuid4().hex[:12]}")
    before = replace(FIXTURE_PARAMS, offset=FIXTURE_PARAMS.offset - 1)
    run = releases.begin()
    run.write("Benefits", status.benefits(src, before))
    run.write(incremental.SNAPSHOT, incremental.audit_snapshot(src, period_for(src, before)),
              month_col="ReportingPeriodStartDate")
    run.commit()
    months = incremental.touched_months(src, releases.read(incremental.SNAPSHOT), period_for(src, FIXTURE_PARAMS))
    rows, replaced = incremental.status_tables(src, FIXTURE_PARAMS, months)["Benefits"]
    run = releases.begin()
    run.write("Benefits", rows, "append_month", replaces=replaced)
    run.commit()
    return releases.read("Benefits")


def q_distinct_over_months(spark, sf_dir):
    """Customers per order status and priority: one partial table a year, merged, then counted; some ids are no numbers."""
    o = _read(spark, sf_dir, "orders", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate").selectExpr(
        "o_orderstatus", "o_orderpriority", "year(o_orderdate) AS y",
        "CASE WHEN o_custkey % 11 = 0 THEN 'C' || o_custkey ELSE CAST(o_custkey AS STRING) END AS id")
    keys = ["o_orderstatus", "o_orderpriority"]
    parts = [distinct_partials(o.where(years), keys, "id") for years in ("y < 1994", "y BETWEEN 1994 AND 1996", "y > 1996")]
    return distinct_counts(merge_partials(parts, keys), keys, "Customers")


def q_duplicate_current_codes(spark, sf_dir):
    """Order customers as a dimension keyed by nation: every nation with several current rows is reported."""
    dim = _read(spark, sf_dir, "customer", "c_nationkey", "c_acctbal").withColumn(
        "Effective_To", F.expr("CASE WHEN c_acctbal < 0 THEN DATE '2000-01-01' END"))
    return duplicate_current_codes(dim, "c_nationkey")


OPERATOR_QUERIES = {
    "publish_indicator": q_publish_indicator,
    "publish_created_then_appended": q_publish_created_then_appended,
    "release_months": q_release_months,
    "distinct_over_months": q_distinct_over_months,
    "benefits_by_touched_months": q_benefits_by_touched_months,
    "rank_hot_key": q_rank_hot_key,
    "duplicate_current_codes": q_duplicate_current_codes,
    "reporting_window": q_reporting_window,
    "period_slice_month": q_period_slice_month,
    "period_slice_series": q_period_slice_series,
    "latest_submission": q_latest_submission,
    "rank_within_key": q_rank_within_key,
    "pick_latest_left_join": q_pick_latest_left_join,
    "latest_by_date_then_priority": q_latest_by_date_then_priority,
    "first_last_ranks_null_dates": q_first_last_ranks_null_dates,
    "latest_audit_rows": q_latest_audit_rows,
    "successor_remap": q_successor_remap,
    "current_lookup_other": q_current_lookup_other,
    "snapshot_lookup_null": q_snapshot_lookup_null,
    "recode_codes": q_recode_codes,
    "recode_rules": q_recode_rules,
    "bands": q_bands,
    "month_text_and_date": q_month_text_and_date,
    "in_period_flags": q_in_period_flags,
    "condition_flags": q_condition_flags,
    "days_open_bands": q_days_open_bands,
    "pair_first_last": q_pair_first_last,
    "same_value_flags": q_same_value_flags,
    "pair_first_last_by_type": q_pair_first_last_by_type,
    "qualifying_contact_count": q_qualifying_contact_count,
    "open_caseload": q_open_caseload,
    "org_rollup": q_org_rollup,
    "category_rollup": q_category_rollup,
    "appointment_scopes": q_appointment_scopes,
    "score_distribution": q_score_distribution,
}

__all__ = ["OPERATOR_QUERIES"]
