"""Operators on small hand-written frames (the quirk register of SURVEY 1.4)."""

import datetime as dt
import os

import pytest

from pyspark.sql import functions as F

from monthwise.operators.contacts import qualifying_contact_count
from monthwise.operators.lookups import current_lookup, remap_successor, snapshot_lookup
from monthwise.operators.pairing import pair_first_last_answers
from monthwise.operators.periods import reporting_window, resolve_period
from monthwise.operators.publish import publish
from monthwise.operators.ranking import first_last_ranks, pick_first, rank_within
from monthwise.operators.rollup import LEVELS, Scope, category_rollup, org_rollup
from monthwise.operators.submissions import latest_audit_rows, latest_submission

D = dt.date

SUBS = [(1, 10, 0, D(2001, 5, 1), D(2001, 5, 31)), (1, 11, 1, D(2001, 5, 1), D(2001, 5, 31)),
        (2, 20, 1, D(2001, 6, 1), D(2001, 6, 30))]
SUB_SCHEMA = "UniqueSubmissionID int, AuditId int, IsLatest int, ReportingPeriodStartDate date, ReportingPeriodEndDate date"


def test_reporting_window_offset_and_month_end(spark):
    subs = spark.createDataFrame(SUBS, SUB_SCHEMA)
    row = reporting_window(subs, offset=-1, floor=D(2020, 9, 1)).first()
    assert (row.period_start, row.period_end, row.floor) == (D(2001, 5, 1), D(2001, 5, 31), D(2020, 9, 1))
    p = resolve_period(subs, offset=0)
    assert (p.start, p.end) == (D(2001, 6, 1), D(2001, 6, 30))


def test_latest_submission_keeps_latest_audit_only(spark):
    subs = spark.createDataFrame(SUBS, SUB_SCHEMA)
    facts = spark.createDataFrame([(1, 1, 10), (1, 1, 11), (2, 2, 20)], "RecordNumber long, UniqueSubmissionID int, AuditId int")
    got = sorted((r.AuditId, r.ReportingPeriodStartDate) for r in latest_submission(facts, subs).collect())
    assert got == [(11, D(2001, 5, 1)), (20, D(2001, 6, 1))]
    sliced = latest_submission(facts, subs, D(2001, 6, 1), D(2001, 6, 1)).collect()
    assert [r.AuditId for r in sliced] == [20]


def test_first_last_ranks_null_date_takes_first_position(spark):
    # Q1: a NULL-dated row sorts first, gets 0, and no row is ranked 1 ascending.
    rows = [(1, "a", None), (1, "b", D(2001, 1, 1)), (1, "c", D(2001, 2, 1)),
            (2, "d", D(2001, 1, 1)), (2, "e", D(2001, 1, 1))]  # Q2: tie broken by id
    df = spark.createDataFrame(rows, "k long, uid string, d date")
    got = {r.uid: (r.First, r.Last) for r in first_last_ranks(df, ["k"], "d", ["uid"], "First", "Last").collect()}
    assert got == {"a": (0, 0), "b": (2, 2), "c": (3, 1), "d": (1, 2), "e": (2, 1)}


def test_rank_within_and_pick_first_agree_on_a_hot_key(spark):
    # One key holds most rows; pick_first is an aggregate, so it is combined per task.
    rows = [(0, i, i % 97) for i in range(3000)] + [(k, k, k) for k in range(1, 50)]
    df = spark.createDataFrame(rows, "k int, id int, v int").repartition(8)
    ranked = rank_within(df, ["k"], [F.col("v").desc(), F.col("id").desc()], "rn").where("rn = 1").drop("rn")
    picked = pick_first(df, ["k"], [F.col("v"), F.col("id")])
    assert sorted(map(tuple, ranked.collect())) == sorted(map(tuple, picked.collect()))
    assert picked.where("k = 0").first().v == 96


def test_lookups_other_fanout_and_snapshot(spark):
    facts = spark.createDataFrame([("A",), ("B",), ("C",), (None,)], "code string")
    succ = spark.createDataFrame([("A", "A2")], "old string, new string")
    remapped = remap_successor(facts, "code", succ, "old", "new", "mapped")
    assert sorted((r.code or "-", r.mapped or "-") for r in remapped.collect()) == \
        [("-", "-"), ("A", "A2"), ("B", "B"), ("C", "C")]
    dim = spark.createDataFrame([("A2", "Alpha", None), ("B", "Beta", D(2000, 1, 1)), ("C", "Gamma", None),
                                 ("C", "Gamma bis", None)], "Organisation_Code string, Organisation_Name string, "
                                                            "Effective_To date")
    looked = current_lookup(remapped, "mapped", dim, "Organisation_Code", {"Name": "Organisation_Name"})
    # Q23: unmatched and non-current -> 'Other'; Q24: two current rows fan out.
    assert sorted(r.Name for r in looked.collect()) == ["Alpha", "Gamma", "Gamma bis", "Other", "Other"]
    imd = spark.createDataFrame([("A", 3, D(2019, 12, 31)), ("A", 9, D(2015, 12, 31)), ("B", 4, D(2015, 12, 31))],
                                "LSOA_Code string, IMD_Decile int, Effective_Snapshot_Date date")
    snap = snapshot_lookup(facts, "code", imd, "LSOA_Code", {"IMD_Decile": "IMD_Decile"}, "Effective_Snapshot_Date",
                           "2019-12-31")
    # Q22: unmatched stays NULL (no default).
    assert sorted((r.code or "-", r.IMD_Decile) for r in snap.collect()) == \
        [("-", None), ("A", 3), ("B", None), ("C", None)]


def test_latest_audit_rows_null_time_and_duplicates(spark):
    subs = spark.createDataFrame([(5, 50, 0, D(2001, 1, 1), D(2001, 1, 31)), (5, 51, 1, D(2001, 1, 1), D(2001, 1, 31))],
                                 SUB_SCHEMA)
    cols = ("AuditId int, UniqueSubmissionID int, PathwayID long, Unique_ServiceRequestID long, AssToolCompDate date, "
            "AssToolCompTime string, OrgID_Provider string, PersScore string")
    rows = [(50, 5, 1, 1, D(2001, 1, 3), "10:00", "S1", "4"),   # stale audit -> dropped
            (51, 5, 1, 1, D(2001, 1, 3), "10:00", "S1", "5"),   # newest audit -> kept
            (51, 5, 1, 1, D(2001, 1, 3), "10:00", "S1", "5"),   # Q7: exact duplicate -> kept
            (51, 5, 2, 2, D(2001, 1, 4), None, "S1", "1")]      # Q26: NULL time never matches -> dropped
    got = latest_audit_rows(spark.createDataFrame(rows, cols), subs).collect()
    assert sorted((r.AuditId, r.PersScore) for r in got) == [(51, "5"), (51, "5")]


def test_pair_first_last_answers_window_boundary(spark):
    # Q16: the last answer counts when dated on the period start, not the day after.
    cols = "PathwayID long, q string, d date, t string, uid long, s string"
    rows = [(1, "Q", D(2001, 1, 1), "09:00", 1, "a"), (1, "Q", D(2001, 6, 1), "09:00", 2, "b"),
            (2, "Q", D(2001, 1, 1), "09:00", 3, "c"), (2, "Q", D(2001, 6, 2), "09:00", 4, "d"),
            (3, "Q", D(2001, 2, 1), "09:00", 5, "e")]   # a single answer never pairs
    df = spark.createDataFrame(rows, cols)
    got = pair_first_last_answers(df, ["PathwayID", "q"], "d", "t", "uid", ["s"], D(1995, 1, 1), D(2001, 6, 1))
    assert [(r.PathwayID, r.Firsts, r.Lasts) for r in got.collect()] == [(1, "a", "b")]


def test_qualifying_contact_count_rules(spark):
    subs = spark.createDataFrame([(1, 11, 1, D(2001, 6, 1), D(2001, 6, 30))], SUB_SCHEMA)
    ref = spark.createDataFrame([(7, 7, 1, 11, D(2001, 5, 1), None)],
                                "PathwayID long, RecordNumber long, UniqueSubmissionID int, AuditId int, "
                                "ReferralRequestReceivedDate date, ServDischDate date")
    ccols = ("RecordNumber long, PathwayID long, UniqueSubmissionID int, AuditId int, CareContactID string, "
             "CareContDate date, AttendOrDNACode string, PlannedCareContIndicator string, AppType string")
    contacts = spark.createDataFrame([
        (7, 7, 1, 11, "a", D(2001, 6, 5), "5", "Y", "01"),    # A with activity code -> counts
        (7, 7, 1, 11, "b", D(2001, 6, 6), "5", "Y", "10"),    # C support appointment, no activity -> counts
        (7, 7, 1, 11, "c", D(2001, 6, 7), "3", "Y", "10"),    # not attended, planned -> no
        (7, 7, 1, 11, "d", D(2001, 6, 8), "5", "Y", "XX"),    # Q4: non-numeric app type -> no
        (7, 7, 1, 11, "e", D(2001, 5, 20), "6", "Y", "10"),   # qualifies but outside the period -> not counted
    ], ccols)
    acts = spark.createDataFrame([(7, 7, "a", 11, "1098051000000103"), (7, 7, "d", 11, "1098051000000103")],
                                 "PathwayID long, RecordNumber long, CareContactID string, AuditId int, "
                                 "CodeProcAndProcStatus string")
    status = spark.createDataFrame([(7, 11, None)], "RecordNumber long, AuditId int, EmpSupportDischargeDate date")
    got = qualifying_contact_count(ref, subs, contacts, acts, status).collect()
    assert [(r.PathwayID, r.Count_EmpSupp) for r in got] == [(7, 2)]


def test_org_rollup_levels_and_totals(spark):
    rows = [("P1", "RP", "S1", "SN1", "I1", "IN1", "RC", 1), ("P1", "RP", "S2", "SN2", "I1", "IN1", "RC", 1),
            ("Other", "Other", "Other", "Other", "Other", "Other", "Other", 1)]
    df = spark.createDataFrame(rows, "ProviderCode string, RegionNameProv string, `Sub-ICBCode` string, "
                                     "`Sub-ICBName` string, ICBCode string, ICBName string, RegionNameComm string, "
                                     "x int").withColumn("ProviderName", F.col("ProviderCode"))
    out = org_rollup(df, [], {"n": "x"})
    totals = {}
    for r in out.collect():
        totals[r.OrgType] = totals.get(r.OrgType, 0) + r.n
    assert totals == {"Provider": 3, "Sub-ICB": 3, "ICB": 3, "National": 3}
    nat = out.where("OrgType = 'National'").first()
    assert (nat.Region, nat.OrgCode, nat.OrgName) == ("All Regions", "ENG", "England")


def test_category_rollup_keeps_hidden_flag_rows(spark):
    # Q8: the 'NA' scope prints the same visible key twice when the hidden flag differs.
    rows = [(D(2001, 6, 1), "M", 2, 1, 0, 1), (D(2001, 6, 1), "M", 2, 1, 1, 1), (D(2001, 6, 1), "F", 2, 0, 0, 1)]
    df = spark.createDataFrame(rows, "Month date, GenderDesc string, dose int, cnt long, flag int, m int")
    for c in ("ProviderCode", "ProviderName", "RegionNameProv", "Sub-ICBCode", "Sub-ICBName", "ICBCode", "ICBName",
              "RegionNameComm"):
        df = df.withColumn(c, F.lit("X"))
    scopes = [Scope("Support", "cnt > 0", "cnt", True, {"m": "m"}),
              Scope("Any", None, "dose", False, {"m": "m"})]
    out = category_rollup(df, ["Month"], {"Gender": "GenderDesc"}, scopes, hidden=["flag"], levels=LEVELS[3:],
                          flag_col="flag")
    anyrows = sorted((r.Variable, r.flag, r.m) for r in out.where("AppointmentType = 'Any'").collect())
    assert anyrows == [("F", "NA", 1), ("M", "NA", 1), ("M", "NA", 1)]
    sup = sorted((r.Variable, r.flag, r.m) for r in out.where("AppointmentType = 'Support'").collect())
    assert sup == [("M", "0", 1), ("M", "1", 1)]


def test_publish_append_month_is_idempotent(spark, tmp_path):
    # Q21: re-running a month replaces it instead of doubling it.
    path = os.path.join(str(tmp_path), "t")
    june = spark.createDataFrame([(D(2001, 6, 1), "a", 1), (D(2001, 6, 1), "b", 2)], "Month date, k string, v int")
    july = spark.createDataFrame([(D(2001, 7, 1), "a", 3)], "Month date, k string, v int")
    publish(june, path, "append_month")
    publish(july, path, "append_month")
    publish(june, path, "append_month")
    assert spark.read.parquet(path).count() == 3
    publish(july, path, "rebuild")
    assert spark.read.parquet(path).count() == 1


def test_keep_latest_audits_prunes_only_unreachable_rows(spark):
    from monthwise.operators.submissions import keep_latest_audits
    subs = spark.createDataFrame(SUBS, SUB_SCHEMA)   # latest audits: 11 (May), 20 (June)
    facts = spark.createDataFrame([(1, 10), (2, 11), (3, 20), (4, 99)], "RecordNumber long, AuditId int")
    assert sorted(r.RecordNumber for r in keep_latest_audits(facts, subs).collect()) == [2, 3]
    june = keep_latest_audits(facts, subs, D(2001, 6, 1), D(2001, 6, 1))
    assert [r.RecordNumber for r in june.collect()] == [3]
    two_keys = spark.createDataFrame([(1, 1, 11), (2, 2, 11), (3, 2, 20)],
                                     "RecordNumber long, UniqueSubmissionID int, AuditId int")
    kept = keep_latest_audits(two_keys, subs, keys=("UniqueSubmissionID", "AuditId"))
    assert sorted(r.RecordNumber for r in kept.collect()) == [1, 3]


def test_a_second_month_is_seen_in_the_same_session(spark, tmp_path):
    from monthwise.operators.submissions import keep_latest_audits
    path = str(tmp_path / "subs")
    facts = spark.createDataFrame([(1, 11), (2, 20)], "RecordNumber long, AuditId int")
    may, june = (spark.createDataFrame([r for r in SUBS if (r in SUBS[-1:]) == late], SUB_SCHEMA) for late in (False, True))
    may.write.parquet(path)
    read = lambda: sorted(r.RecordNumber for r in keep_latest_audits(facts, spark.read.parquet(path)).collect())
    first = read()
    june.write.mode("append").parquet(path)
    assert first != read() == [1, 2]


def test_period_follows_the_submissions(spark, tmp_path):
    from monthwise.plans.common import RunParams, period_for
    from types import SimpleNamespace
    path = str(tmp_path / "subs")
    schema = "ReportingPeriodStartDate date, ReportingPeriodEndDate date"
    month = lambda m: spark.createDataFrame([(D(2001, m, 1), D(2001, m, 28))], schema)
    month(5).write.parquet(path)
    src = SimpleNamespace(submissions=spark.read.schema(schema).parquet(path))
    assert period_for(src, RunParams(offset=0)).start == D(2001, 5, 1)
    month(6).write.mode("append").parquet(path)
    src = SimpleNamespace(submissions=spark.read.schema(schema).parquet(path))
    assert period_for(src, RunParams(offset=0)).start == D(2001, 6, 1)


def test_session_keeps_what_is_set(spark):
    from monthwise.session import checkpoint_dir, get_session
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "400")
    try:
        assert get_session().conf.get("spark.sql.shuffle.partitions") == "400"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)

    class Bare:
        conf = type("C", (), {"get": staticmethod(lambda key, default=None: default)})
        sparkContext = type("S", (), {"getCheckpointDir": staticmethod(lambda: None)})
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Bare())


def test_duplicate_current_codes(spark):
    from monthwise.operators.lookups import duplicate_current_codes
    dim = spark.createDataFrame([("A", None), ("A", None), ("B", None), ("B", D(2000, 1, 1)), ("C", D(2000, 1, 1))],
                                "code string, Effective_To date")
    assert [tuple(r) for r in duplicate_current_codes(dim, "code").collect()] == [("A", 2)]


def test_a_single_answer_makes_no_pair_under_two_current_providers(spark):
    from types import SimpleNamespace
    from monthwise.functions.labels import PRESENTEEISM_QUESTIONS
    from monthwise.operators.periods import Period
    from monthwise.plans.assessments import presenteeism_pairs
    from monthwise.plans.common import RunParams
    question = PRESENTEEISM_QUESTIONS[0]
    row = lambda path, uid, day: (question, D(2001, 6, day), None, path, "sr", "P1", 11, 1, uid, 5)
    answers = spark.createDataFrame(
        [row("one", 1, 1), row("two", 2, 1), row("two", 3, 2)],
        "CodedAssToolType string, AssToolCompDate date, AssToolCompTime string, PathwayID string, "
        "Unique_ServiceRequestID string, OrgID_Provider string, AuditId int, UniqueSubmissionID int, "
        "UniqueID_IDS606 long, PersScore int").fillna({"AssToolCompTime": "10:00"})
    src = SimpleNamespace(
        assessments=answers,
        submissions=spark.createDataFrame([(1, 11, 1)], "UniqueSubmissionID int, AuditId int, IsLatest int"),
        prov_successor=spark.createDataFrame([], "Prov_original string, Prov_Successor string"),
        prov_hierarchy=spark.createDataFrame([("P1", "Name", "R", None), ("P1", "Other name", "R", None)],
                                             "Organisation_Code string, Organisation_Name string, Region_Name string, "
                                             "Effective_To date"))
    pairs = presenteeism_pairs(src, RunParams(period=Period(D(2001, 6, 30), D(2001, 6, 30), D(2001, 1, 1)))).collect()
    assert sorted((r.PathwayID, r["Provider Name"]) for r in pairs) == [("two", "Name"), ("two", "Other name")]


def test_first_last_pairs_of_a_record_shared_by_two_people(spark):
    from monthwise.operators.pairing import pair_first_last
    rows = spark.createDataFrame([("r", "p", 1, 2, "a1"), ("r", "p", 2, 1, "a2"), ("r", "q", 1, 2, "b1"),
                                  ("r", "q", 2, 1, "b2"), ("s", "p", 1, 1, "c"), (None, "p", 1, 2, "d"),
                                  (None, "p", 2, 1, "e")], "rec string, person string, f int, l int, v string")
    got = pair_first_last(rows, ["rec"], "f", "l", {"rec": "rec", "first": "v"}, {"last": "v"}).collect()
    assert sorted(map(tuple, got)) == [("r", a, b) for a in ("a1", "b1") for b in ("a2", "b2")]


def test_publish_to_a_catalog_table_with_casts(spark):
    june = spark.createDataFrame([("June 2001", 1.0), ("May 2001", 2.0)], "Month string, v double")
    spark.sql("DROP TABLE IF EXISTS published_test")
    publish(june, mode="append_month", table="published_test", casts={"v": "int"})
    publish(june.where("v = 1"), mode="append_month", table="published_test", casts={"v": "int"})
    assert sorted((r.Month, r.v) for r in spark.table("published_test").collect()) == [("June 2001", 1), ("May 2001", 2)]
    assert dict(spark.table("published_test").dtypes) == {"v": "int", "Month": "string"}
    spark.sql("DROP TABLE published_test")
