"""Forms of the operators for large data: bounded filters, one exchange a fact, pruned scans, split keys, added counts."""

import datetime as dt
import random
import re
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from monthwise.operators import distinct as D
from monthwise.operators.contacts import qualifying_contact_count
from monthwise.operators.lookups import by_code, current_lookup, remap_successor
from monthwise.operators.membership import MemberFilter
from monthwise.operators.pairing import pair_first_last_answers
from monthwise.operators.ranking import range_shares, rank_in_shares, rank_within
from monthwise.operators.releases import Releases
from monthwise.plans import clinical, incremental, refresh, status
from monthwise.plans.common import FIXTURE_PARAMS, contact_counts
from monthwise.sources import fixture, fixture_store
from monthwise.sources.fixture_store import fixture_sources
from monthwise.sources.layout import store_by_record, stored_sources

from conftest import SMALL


def rows(df):
    return sorted(map(repr, df.collect()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- bounded membership filter ---------------------------------------------------------------------------------------

@pytest.mark.parametrize("bits", [64, 1 << 16])
def test_member_filter_loses_no_member_and_stays_bounded(spark, bits):
    rng = random.Random(bits)
    members = spark.createDataFrame([(rng.randrange(10 ** 9),) for _ in range(300)] + [(None,), (-5,)], "k long")
    facts = members.selectExpr("CAST(k AS STRING) AS id").unionByName(
        spark.range(5000).selectExpr("CAST(id + 2000000000 AS STRING) AS id"))
    f = MemberFilter(members, "k", bits)
    assert f.words.count() <= bits // 64
    kept = f.keep(facts, "id")
    assert set(r.k for r in members.collect() if r.k is not None) <= {int(r.id) for r in kept.collect()}
    assert kept.where("id IS NULL").isEmpty()
    if bits > 64:
        assert kept.count() < 400
    assert MemberFilter(members.limit(0), "k").keep(facts, "id").isEmpty()


# --- one exchange a fact ---------------------------------------------------------------------------------------------

FACTS = {"IDS101referral": 1, "IDS201carecontact": 1, "IDS202careactivity": 1, "IDS004empstatus": 1}


def test_contact_count_exchanges_each_fact_once(spark):
    """With merge joins between facts, as on large data, and dimensions broadcast."""
    src = fixture_sources(spark, SMALL)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        dims = replace(src, submissions=F.broadcast(src.submissions.where("IsLatest = 1")))
        text = plan(qualifying_contact_count(dims.referral, dims.submissions, dims.carecontact, dims.careactivity,
                                             dims.empstatus))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(re.findall("REPARTITION_BY_COL", text)) == len(FACTS)
    # Beside those only the filter's words (one exchange, used three times) and the two steps of the distinct count.
    others = [x for x in re.findall(r"Exchange hashpartitioning\(([^,]*)", text) if not x.startswith("__word")]
    assert len(others) == len(FACTS) + 2
    assert not re.search(r"SortMergeJoin .*LeftSemi", text)
    assert len(re.findall("SortMergeJoin", text)) == 3


@pytest.fixture(scope="module")
def stored(spark):
    name = f"stored_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    store_by_record(fixture_sources(spark, SMALL), name, 2)
    yield stored_sources(spark, name)
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_stored_facts_are_joined_without_an_exchange(spark, stored):
    src = fixture_sources(spark, SMALL)
    got = contact_counts(stored)
    assert rows(got) == rows(contact_counts(src))
    assert "REPARTITION_BY_COL" not in plan(got)
    one = lambda s: clinical.open_refs_no_contact(s, FIXTURE_PARAMS)
    assert rows(one(stored)) == rows(one(src))


def _files(df):
    """Files read and descriptions of the fact scan of an executed plan."""
    df.collect()
    total, text, todo = 0, "", [df._jdf.queryExecution().executedPlan().executedPlan()]
    while todo:
        leaves = todo.pop().collectLeaves()
        for leaf in [leaves.apply(i) for i in range(leaves.size())]:
            kind = leaf.getClass().getSimpleName()
            if kind == "ResultQueryStageExec":
                todo.append(leaf.plan())
            elif kind == "FileSourceScanExec":
                text += leaf.toString()
                total += leaf.metrics().get("numFiles").get().value()
    return total, text


def test_scans_follow_the_window(spark, stored):
    """Facts by audit: the filtered submissions prune the folders read while the query runs."""
    from monthwise.operators.submissions import latest_submission
    facts = stored.referral.select("RecordNumber", "UniqueSubmissionID", "AuditId")
    sizes = []
    for hi in (dt.date(1995, 3, 1), dt.date(1996, 6, 1), dt.date(2001, 6, 1)):
        n, text = _files(latest_submission(facts, stored.submissions, dt.date(1995, 1, 1), hi))
        assert "dynamicpruning" in text
        sizes.append(n)
    assert 0 < sizes[0] < sizes[1] < sizes[2]
    assert sizes[0] * 10 < sizes[2]


# --- T1-T3 by touched months -----------------------------------------------------------------------------------------

def _flipped(src, month):
    """The same tables after the older audit of a month became the latest."""
    hit = F.col("ReportingPeriodStartDate") == F.lit(month)
    return replace(src, submissions=src.submissions.withColumn(
        "IsLatest", F.when(hit, 1 - F.col("IsLatest")).otherwise(F.col("IsLatest"))))


def test_touched_months_equal_a_full_rebuild(spark, tmp_path):
    src, root = fixture_sources(spark, SMALL), str(tmp_path / "root")
    before = replace(FIXTURE_PARAMS, offset=-7)
    refresh.release_monthly(spark, src, before, root)
    month = dt.date(1997, 4, 1)
    later = _flipped(src, month)
    r = Releases(spark, root)
    snapshot = r.read(incremental.SNAPSHOT)
    p = refresh.period_for(later, FIXTURE_PARAMS)
    months = incremental.touched_months(later, snapshot, p)
    assert month in months and p.start in months and len(months) < 20
    assert incremental.touched_months(src, snapshot, refresh.period_for(src, before)) == []
    assert incremental.touched_months(src, snapshot, replace(p, floor=dt.date(1996, 1, 1))) is None
    seen = refresh.release_monthly(spark, later, FIXTURE_PARAMS, root)
    # Observed while writing, without another job: the fixture has one current row a code.
    assert seen["provider hierarchy"]["current_rows"] > 0 and seen["provider hierarchy"]["duplicate_codes"] == 0
    for name, table in (("FirstAndLastEmp", status.first_and_last_status), ("Benefits", status.benefits),
                        ("FinishedTreatmentAndEmpSupp", status.finished_treatment)):
        want = table(later, FIXTURE_PARAMS)
        assert rows(r.read(name).select(*want.columns)) == rows(want)
        assert seen[name]["rows"] < want.count()
    # The same state once more touches nothing.
    assert incremental.touched_months(later, r.read(incremental.SNAPSHOT), p) == []


def test_duplicate_codes_are_observed(spark):
    dim = spark.createDataFrame([("a", None), ("a", None), ("a", None), ("b", None), ("c", dt.date(2000, 1, 1)),
                                 ("c", None), (None, None)], "Organisation_Code string, Effective_To date")
    watched, seen = refresh._observed_lookup(dim, "Organisation_Code")
    assert watched.columns == dim.columns
    watched.where("Effective_To IS NULL").collect()
    assert seen.get == {"current_rows": 6, "duplicate_codes": 1}


# --- O25: finest grain first -----------------------------------------------------------------------------------------

def test_levels_from_the_finest_sums_equal_levels_from_rows(spark):
    from monthwise.operators.rollup import category_rollup
    base = clinical.clinical_base(fixture_sources(spark, SMALL), FIXTURE_PARAMS)
    both = [category_rollup(base, ["Month"], clinical.CATEGORIES, clinical.outcome_scopes(),
                            hidden=[clinical.DISCHARGE_FLAG], finest_first=f) for f in (True, False)]
    assert both[0].dtypes == both[1].dtypes
    assert rows(both[0]) == rows(both[1])


# --- O27: counts that add up -----------------------------------------------------------------------------------------

def test_distinct_partials_add_up(spark, monkeypatch):
    monkeypatch.setattr(D, "DENSE", 40)
    rng = random.Random(2)
    ids = ([str(x) for x in range(300)] + [str(rng.randrange(-10 ** 15, 10 ** 15)) for _ in range(60)]
           + ["007", "7", "x", "", "-0", "1e3", " 5", None, "9223372036854775807", "9223372036854775808", "-5", "0"])
    data = [(rng.choice(["a", "b", None]), rng.choice(ids), part) for part in range(3) for _ in range(500)]
    data += [("only null", None, 0), ("a", str(10 ** 6), 1)]
    df = spark.createDataFrame(data, "k string, id string, part int").withColumn("bits", F.lit(1))
    parts = [D.distinct_partials(df.where(f"part = {i}"), ["k"], "id") for i in range(3)]
    assert max(r.n for r in parts[0].selectExpr("coalesce(size(places), 0) AS n").collect()) <= 40
    assert not parts[0].where("bits IS NOT NULL").isEmpty()
    want = {r.k: r.n for r in df.groupBy("k").agg(F.countDistinct("id").alias("n")).collect()}
    merged = D.merge_partials(parts, ["k"])
    assert {r.k: r.n for r in D.distinct_counts(merged, ["k"], "n").collect()} == want
    # Merging is idempotent and works in any grouping.
    twice = D.merge_partials([D.merge_partials(parts[:2], ["k"]), parts[2], parts[0]], ["k"])
    assert {r.k: r.n for r in D.distinct_counts(twice, ["k"], "n").collect()} == want
    assert D.distinct_counts(D.distinct_partials(df.limit(0), ["k"], "id"), ["k"], "n").isEmpty()


# --- O4: one key in many shares --------------------------------------------------------------------------------------

def test_a_hot_key_is_ranked_in_bounded_shares(spark):
    rng = random.Random(7)
    data = [("hot" if rng.random() < .7 else rng.choice(["a", "b", None]), rng.choice([None, *range(50)]), i)
            for i in range(4000)]
    df = spark.createDataFrame(data, "k string, v long, id long")
    order = [F.col("v").desc(), F.col("id").asc()]
    assert rows(rank_in_shares(df, ["k"], order, "r")) == rows(rank_within(df, ["k"], order, "r"))
    sizes = [r["count"] for r in range_shares(df, ["k"], order, 8).groupBy("__share", "k").count().collect()]
    assert max(sizes) < 2 * 4000 / 8
    assert rank_in_shares(df.limit(0), ["k"], order, "r").isEmpty()


# --- O20 B with text ids ---------------------------------------------------------------------------------------------

def test_pairs_of_answers_with_text_ids(spark):
    rng = random.Random(8)
    data = [(rng.randrange(30), rng.choice([None, dt.date(2001, 5, 1), dt.date(2001, 6, 1)]), rng.choice([None, 1, 2]),
             i, f"{i:05d}", rng.randrange(9)) for i in range(300)]
    df = spark.createDataFrame(data, "p long, d date, t int, n long, s string, score int")
    one = lambda uid: pair_first_last_answers(df, ["p"], "d", "t", uid, ["score", "n"], "2001-05-01", "2001-06-01")
    assert rows(one("s")) == rows(one("n"))


# --- the fixture reaches the rules -----------------------------------------------------------------------------------

def test_every_complaint_rule_and_stale_audits_meet_rows(spark):
    from monthwise.functions import labels as L
    from monthwise.functions.recode import problem_descriptor
    src = fixture_sources(spark, SMALL)
    met = {r[0] for r in src.referral.select(problem_descriptor()).distinct().collect()}
    assert met == {lab for _, lab in [*L.PROBLEM_HIGHER, *L.PROBLEM_ANXIETY_LOWER]} | {L.PROBLEM_NO_CODE, L.PROBLEM_OTHER}
    latest = src.submissions.where("IsLatest = 1").select("AuditId")
    for facts in (src.empstatus, src.carecontact):
        assert not facts.join(latest, "AuditId", "left_anti").isEmpty()


# --- fixture tables and lookups on large tables ----------------------------------------------------------------------

def test_fixture_joins_large_tables_once(spark, tmp_path):
    """What several facts start from is kept, and the facts are read from it without a shuffle of their own."""
    kept = []

    def keep(name, df):
        kept.append(name)
        df.write.parquet(f"{tmp_path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{tmp_path}/{name}")

    tables = fixture.spark_tables(spark, SMALL, keep)
    assert kept == ["r0", "lineitem_r0"]
    plain = fixture.spark_tables(spark, SMALL)
    for name in fixture_store.FACT_TABLES:
        assert not re.search(r"Exchange (hash|range|RoundRobin)", plan(tables[name])), name
        assert rows(tables[name]) == rows(plain[name])


def test_large_fixture_is_written_as_it_is(spark, monkeypatch):
    small = fixture_sources(spark, SMALL)
    monkeypatch.setattr(fixture_store, "_STORED", {})
    monkeypatch.setattr(fixture_store, "SMALL_ROWS", 0)
    monkeypatch.setattr(type(small.referral), "repartition", lambda *_: pytest.fail("dealt again"))
    large = fixture_sources(spark, SMALL)
    for attr in large._NAMES:
        assert rows(getattr(large, attr)) == rows(getattr(small, attr)), attr


def test_lookup_by_code_leaves_facts_where_they_are(spark, tmp_path):
    """A dimension too large to broadcast, few codes on many rows: codes that fan out, unknown ones and null alike."""
    spark.range(20000).selectExpr("'S' || id AS Organisation_Code", "'Provider number ' || id AS Organisation_Name",
                                  "CASE WHEN id % 7 = 0 THEN DATE '2000-01-01' END AS Effective_To").union(
        spark.sql("SELECT 'S2', 'second name', CAST(NULL AS DATE)")).write.parquet(f"{tmp_path}/dim")
    spark.range(20000).where("id % 10 = 3").selectExpr("'S' || id AS old", "'S' || (id + 1) AS new").write.parquet(
        f"{tmp_path}/moved")
    dim, moved = (spark.read.parquet(f"{tmp_path}/{n}") for n in ("dim", "moved"))
    facts = spark.range(3000).selectExpr("id", "CASE WHEN id % 50 = 0 THEN NULL WHEN id % 50 = 1 THEN 'none' "
                                         "ELSE 'S' || (id % 10) END AS org")

    def look_up(df):
        df = remap_successor(df, "org", moved, "old", "new", "to")
        return current_lookup(df, "to", dim, "Organisation_Code", {"name": "Organisation_Name"})

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "8k")
    try:
        got = by_code(facts, "org", facts, look_up)
        text = plan(got)
        assert "SortMergeJoin" in plan(look_up(facts)) and "SortMergeJoin" not in text
        assert not re.search("Exchange hashpartitioning", text)
        assert rows(got) == rows(look_up(facts)) and got.columns == look_up(facts).columns
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_status_rows_are_dealt_as_codes(spark):
    """Status labels are coded before the status rows are dealt by record, and organisations come by broadcast."""
    text = plan(status.status_base(fixture_sources(spark, SMALL), FIXTURE_PARAMS))
    assert "__e_EmployStatus" not in text and "__prov_code" not in text
