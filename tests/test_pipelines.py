"""Pipelines on the fixture: oracle agreement, single-pass equivalence, invariants."""

import collections
import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from monthwise.plans import clinical, indicator
from monthwise.plans.common import FIXTURE_PARAMS
from monthwise.sources.fixture_store import fixture_sources

from conftest import SMALL

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return collections.Counter(tuple(repr(_norm(r[i])) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_registry_is_complete():
    """Every reporting query has its SQL; the optional operators' tests look after theirs."""
    from monthwise.plans.catalog import QUERIES
    from oracle.queries import ORACLE
    assert set(QUERIES) == set(ORACLE) and len(QUERIES) >= 40
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ["indicator", "first_and_last_status", "benefits", "finished_treatment",
                                  "active_providers", "open_refs_no_contact", "clinical_outcomes",
                                  "assessment_counts", "assessment_coverage", "student"])
def test_pipeline_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SMALL)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    srows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(dcols)
    assert _bag(df.columns, srows) == _bag(dcols, drows)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns[:3] == ["Month", "OrgType", "OrgName"]
    assert df.count() > 0


def test_single_pass_equals_84_aggregates(spark):
    """The one-aggregate clinical outcomes equal 84 separate GROUP BYs."""
    src = fixture_sources(spark, SMALL)
    base = clinical.clinical_base(src, FIXTURE_PARAMS).cache()
    single = clinical.clinical_outcomes(src, FIXTURE_PARAMS, base=base)
    levels = [("Provider", "RegionNameProv", "ProviderCode", "ProviderName"),
              ("Sub-ICB", "RegionNameComm", "Sub-ICBCode", "Sub-ICBName"),
              ("ICB", "RegionNameComm", "ICBCode", "ICBName"), ("National", None, None, None)]
    parts = []
    for sc in clinical.outcome_scopes():
        rows = base if sc.where is None else base.where(sc.where)
        for cat, var in clinical.CATEGORIES.items():
            for otype, region, code, name in levels:
                keys = ["Month", clinical.DISCHARGE_FLAG, var, sc.dosage]
                org = [] if code is None else [region, code, name]
                g = rows.groupBy(*[F.col(f"`{k}`") for k in keys + org]).agg(
                    *[F.sum(F.col(f"`{src_col}`")).alias(m) for m, src_col in sc.measures.items()])
                flag = F.col(clinical.DISCHARGE_FLAG).cast("string") if sc.prints_flag else F.lit("NA")
                parts.append(g.select(
                    "Month", F.lit(otype).alias("OrgType"),
                    (F.lit("England") if code is None else F.col(f"`{name}`")).alias("OrgName"),
                    (F.lit("ENG") if code is None else F.col(f"`{code}`")).alias("OrgCode"),
                    (F.lit("All Regions") if code is None else F.col(f"`{region}`")).alias("Region"),
                    F.lit(cat).alias("Category"), F.col(f"`{var}`").cast("string").alias("Variable"),
                    F.lit(sc.name).alias("AppointmentType"), F.col(sc.dosage).cast("bigint").alias("Dosage"),
                    flag.alias(clinical.DISCHARGE_FLAG), *[F.col(f"`{m}`") for m in sc.measures]))
    assert len(parts) == 84
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    a = collections.Counter(tuple(r) for r in single.collect())
    b = collections.Counter(tuple(r) for r in union.select(*single.columns).collect())
    assert a == b
    base.unpersist()


def test_rollup_invariants(spark):
    """Every level sums to the same total; every category too; support + except = any."""
    src = fixture_sources(spark, SMALL)
    t6 = clinical.clinical_outcomes(src, FIXTURE_PARAMS)
    tot = (t6.groupBy("OrgType", "Category", "AppointmentType").agg(F.sum("Referrals").alias("r"),
                                                                     F.sum("FinishedTreatment").alias("f"))
             .collect())
    by_scope = collections.defaultdict(set)
    for r in tot:
        by_scope[r.AppointmentType].add((r.r, r.f))
    for scope, vals in by_scope.items():
        assert len(vals) == 1, scope
    any_f = next(iter(by_scope["Any Appointment Type"]))[1]
    sup_f = next(iter(by_scope["Employment Support"]))[1]
    exc_f = next(iter(by_scope["Any Appointment Type except Employment Support"]))[1]
    assert sup_f + exc_f == any_f
    t7 = indicator.indicator(src, FIXTURE_PARAMS)
    sums = {r.OrgType: r.s for r in t7.groupBy("OrgType").agg(F.sum("EmpSuppIndYes").alias("s")).collect()}
    assert len(set(sums.values())) == 1
