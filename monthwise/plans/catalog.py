"""Registered queries: every operator and pipeline as ``(spark, sf_dir) -> DataFrame``.

Pipelines run on the fixture projection of the driver tables with
``FIXTURE_PARAMS`` (report month 2001-06, back series from 1995-01).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from monthwise.plans import assessments as _assessments
from monthwise.plans import clinical as _clinical
from monthwise.plans import indicator as _indicator
from monthwise.plans import status as _status
from monthwise.plans import student as _student
from monthwise.plans.common import FIXTURE_PARAMS
from monthwise.plans.operator_queries import OPERATOR_QUERIES
from monthwise.sources.fixture_store import fixture_sources


def _pipeline(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(fixture_sources(spark, sf_dir), FIXTURE_PARAMS)
    run.__name__ = fn.__name__
    return run


QUERIES = {
    "indicator": _pipeline(_indicator.indicator),
    "first_and_last_status": _pipeline(_status.first_and_last_status),
    "benefits": _pipeline(_status.benefits),
    "finished_treatment": _pipeline(_status.finished_treatment),
    "active_providers": _pipeline(_clinical.active_providers),
    "open_refs_no_contact": _pipeline(_clinical.open_refs_no_contact),
    "clinical_outcomes": _pipeline(_clinical.clinical_outcomes),
    "assessment_counts": _pipeline(_assessments.assessment_counts),
    "assessment_coverage": _pipeline(_assessments.assessment_coverage),
    "student": _pipeline(_student.student),
}
QUERIES.update(OPERATOR_QUERIES)
