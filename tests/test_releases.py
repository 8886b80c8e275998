"""Months survive every order of creating and appending; runs appear whole or not at all."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from monthwise.operators.publish import publish
from monthwise.operators.releases import Releases
from monthwise.plans import refresh
from monthwise.plans.common import FIXTURE_PARAMS
from monthwise.sources.fixture_store import fixture_sources

from conftest import SMALL


def months(spark, *names):
    return spark.createDataFrame([(i, n) for i, n in enumerate(names)], "v long, Month string")


def target(spark, kind, tmp_path):
    if kind == "path":
        return {"path": str(tmp_path / "t")}, lambda: spark.read.parquet(str(tmp_path / "t"))
    name = f"months_{uuid.uuid4().hex[:10]}"
    return {"table": name}, lambda: spark.table(name)


@pytest.mark.parametrize("kind", ["path", "table"])
def test_rebuild_by_month_then_append_keeps_every_month(spark, tmp_path, kind):
    where, read = target(spark, kind, tmp_path)
    publish(months(spark, "m1", "m2"), mode="rebuild", by_month=True, **where)
    publish(months(spark, "m3"), mode="append_month", **where)
    publish(months(spark, "m2"), mode="append_month", **where)
    assert sorted((r.Month, r.v) for r in read().collect()) == [("m1", 0), ("m2", 0), ("m3", 0)]
    publish(months(spark, "m4"), mode="rebuild", by_month=True, **where)
    assert [r.Month for r in read().collect()] == ["m4"]


@pytest.mark.parametrize("kind", ["path", "table"])
def test_append_to_a_table_that_is_not_laid_out_by_month_is_refused(spark, tmp_path, kind):
    where, read = target(spark, kind, tmp_path)
    publish(months(spark, "m1", "m2"), mode="rebuild", **where)
    with pytest.raises(ValueError, match="by_month"):
        publish(months(spark, "m3"), mode="append_month", **where)
    assert sorted(r.Month for r in read().collect()) == ["m1", "m2"]


@pytest.mark.parametrize("kind", ["path", "table"])
def test_append_then_rebuild_then_append(spark, tmp_path, kind):
    where, read = target(spark, kind, tmp_path)
    publish(months(spark, "m1"), mode="append_month", **where)
    publish(months(spark, "m2"), mode="append_month", **where)
    assert sorted(r.Month for r in read().collect()) == ["m1", "m2"]


def test_releases_point_to_the_newest_run_of_each_month(spark, tmp_path):
    r = Releases(spark, str(tmp_path / "root"))
    assert r.current() == (0, {})
    with pytest.raises(ValueError):
        r.read("A")
    first = r.begin()
    first.write("A", months(spark, "m1", "m2", "it's"), "rebuild", measures={"most": F.max("v")})
    first.write("B", months(spark, None, "x"), "append_month")
    assert first.metrics["A"] == {"rows": 3, "most": 2}
    assert r.current() == (0, {})                       # nothing shows before the commit
    assert first.commit() == 1
    second = r.begin()
    second.write("A", months(spark, "m2", "m3"), "append_month", replaces=["it's"])
    second.write("B", months(spark, None), "append_month")
    assert second.commit() == 2
    assert sorted((x.Month, x.v) for x in r.read("A").collect()) == [("m1", 0), ("m2", 0), ("m3", 1)]
    assert sorted((str(x.Month), x.v) for x in r.read("B").collect()) == [("None", 0), ("x", 1)]
    assert sorted(x.Month for x in r.read("A", release=1).collect()) == ["it's", "m1", "m2"]
    third = r.begin()
    third.write("A", months(spark, "m9"), "rebuild")
    third.commit()
    assert [x.Month for x in r.read("A").collect()] == ["m9"]
    assert r.read("B").count() == 2


def test_released_columns_keep_their_types_and_views_follow(spark, tmp_path):
    r = Releases(spark, str(tmp_path / "root"))
    for month in (dt.date(2001, 5, 1), dt.date(2001, 6, 1)):
        run = r.begin()
        run.write("T", spark.createDataFrame([(month, "1", 2.5)], "Month date, code string, x double"), "append_month")
        run.commit()
        spark.sql("CREATE DATABASE IF NOT EXISTS released")
        r.register("released")
    assert r.read("T").dtypes == spark.table("released.T").dtypes == [("Month", "date"), ("code", "string"), ("x", "double")]
    assert spark.table("released.T").count() == 2
    spark.sql("DROP DATABASE released CASCADE")


def test_a_lost_run_leaves_all_tables_as_they_were(spark, tmp_path, monkeypatch):
    """Ten tables of one release; a later run that fails after five shows none of its own."""
    src, root = fixture_sources(spark, SMALL), str(tmp_path / "root")
    seen = refresh.release_monthly(spark, src, FIXTURE_PARAMS, root)
    assert set(seen) == set(refresh.TABLES) and seen["ClinOutcomes"]["rows"] > 0
    r = Releases(spark, root)
    before = {t: r.read(t).count() for t in refresh.TABLES}
    assert before == {t: m["rows"] for t, m in seen.items()}
    tables, stages = refresh.build_tables(src, FIXTURE_PARAMS)
    broken = {n: df if i < 5 else df.where("raise_error('lost') IS NULL") for i, (n, df) in enumerate(tables.items())}
    monkeypatch.setattr(refresh, "build_tables", lambda *_: ({n: d.limit(0) if i < 3 else d for i, (n, d) in
                                                              enumerate(broken.items())}, stages))
    with pytest.raises(Exception, match="lost"):
        refresh.release_monthly(spark, src, FIXTURE_PARAMS, root)
    assert {t: r.read(t).count() for t in refresh.TABLES} == before and r.current()[0] == 1
    types = {n: dict(r.read(n).dtypes) for n in refresh.TABLES}
    for name, p in refresh.PUBLISHED.items():
        assert {c: types[name][c] for c in p.casts} == p.casts


def test_figures_list_published_tables_and_find_inputs_by_name():
    seen = refresh.Seen({"Student": {"rows": 3}}, {"provider hierarchy": {"current_rows": 2}})
    assert set(seen) == {"Student"} and seen["provider hierarchy"]["current_rows"] == 2
    with pytest.raises(KeyError):
        seen["no such table"]
