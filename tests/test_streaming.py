"""The arrival-triggered monthly refresh publishes all ten tables, idempotently."""

import os
import tempfile

from monthwise.plans.common import FIXTURE_PARAMS
from monthwise.plans.refresh import TABLES
from monthwise.sources.fixture_store import fixture_sources
from monthwise.streaming.refresh import start_monthly_refresh

from conftest import SMALL


def test_monthly_refresh_stream(spark):
    src = fixture_sources(spark, SMALL)
    work = tempfile.mkdtemp(prefix="monthwise-stream-", dir="/tmp")
    landing, out = os.path.join(work, "landing"), os.path.join(work, "out")
    src.submissions.write.parquet(landing)

    q = start_monthly_refresh(spark, landing, lambda: src, out, FIXTURE_PARAMS,
                              checkpoint=os.path.join(work, "ckpt"))
    q.awaitTermination(600)
    assert sorted(os.listdir(out)) == sorted(TABLES)
    first = {t: spark.read.parquet(os.path.join(out, t)).count() for t in TABLES}
    assert first["ClinOutcomes"] > 0 and first["Indicator"] > 0

    # A second landing of the same month re-runs the refresh; month
    # replacement keeps every table unchanged.
    src.submissions.write.mode("append").parquet(landing)
    q = start_monthly_refresh(spark, landing, lambda: src, out, FIXTURE_PARAMS,
                              checkpoint=os.path.join(work, "ckpt"))
    q.awaitTermination(600)
    again = {t: spark.read.parquet(os.path.join(out, t)).count() for t in TABLES}
    assert again == first
