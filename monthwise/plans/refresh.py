"""A whole monthly refresh: all ten tables from shared stages, then published.

``release_monthly`` shows all ten tables at once, or none (``operators.releases``),
and can recompute only the touched months of the back series
(``plans.incremental``).  ``run_monthly`` writes plain folders or catalog tables
one after the other, for consumers that read those.

Stages used by several tables are built once: the qualifying-contact counts
(restricted to the pathways the bases need), the status base (T1-T3) and the
clinical base (T4-T6).  They are persisted with MEMORY_AND_DISK so a lost
executor only recomputes its own partitions; ``publish`` is the only action
on each table.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from monthwise.operators.publish import publish
from monthwise.operators.releases import Releases
from monthwise.operators.submissions import latest_submission
from monthwise.plans import assessments, clinical, incremental as incremental_plan, indicator, status, student
from monthwise.plans.common import RunParams, contact_counts, period_for, used_referrals
from monthwise.sources.tables import Sources



@dataclass(frozen=True)
class Published:
    """How a table is written (rebuilt, or month replaced) and the types its columns are published as."""

    mode: str
    casts: dict = field(default_factory=dict)


# The published types of labels, codes and months; sums and counts keep theirs.
ORG_TEXT = {c: "string" for c in ("OrgType", "OrgName", "OrgCode", "Region")}
FLAG_TEXT = {"AppointmentType": "string", "EmpSupportDischargeDatePresent": "string"}
PUBLISHED = {
    "FirstAndLastEmp": Published("rebuild"),
    "Benefits": Published("rebuild", {"Month": "date", "OrganisationType": "string", "Region": "string",
                                      "OrganisationCode": "string", "OrganisationName": "string"}),
    "FinishedTreatmentAndEmpSupp": Published("rebuild", {"OrgType": "string", "Region": "string", "OrgName": "string",
                                                         "AppointmentType": "string"}),
    "ActiveEAProviders": Published("append_month"),
    "OpenRefsNoContact": Published("append_month", ORG_TEXT | FLAG_TEXT),
    "ClinOutcomes": Published("append_month", ORG_TEXT | FLAG_TEXT | {"Category": "string", "Variable": "string"}),
    "Indicator": Published("append_month", ORG_TEXT),
    "PresenteeismCounts": Published("rebuild"),
    "PresenteeismCoverage": Published("rebuild", {"Month": "date"}),
    "Student": Published("append_month", {"Month": "date"}),
}
TABLES = {name: p.mode for name, p in PUBLISHED.items()}


def build_tables(src: Sources, params: RunParams,
                 back_series: bool = True) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    """The ten published DataFrames (without T1-T3 unless ``back_series``), sharing persisted stages."""
    p = period_for(src, params)
    params = replace(params, period=p)    # one period for all tables of the run
    first = p.floor if back_series else p.start
    refs = latest_submission(used_referrals(src), src.submissions, first, p.start).select("PathwayID")
    counts = contact_counts(src, refs).persist(StorageLevel.MEMORY_AND_DISK)
    cbase = clinical.clinical_base(src, params, counts).persist(StorageLevel.MEMORY_AND_DISK)
    tables, stages = {}, [counts, cbase]
    if back_series:
        sbase = status.status_base(src, params, counts).persist(StorageLevel.MEMORY_AND_DISK)
        stages.append(sbase)
        tables = {
            "FirstAndLastEmp": status.first_and_last_status(src, params, base=sbase),
            "Benefits": status.benefits(src, params, base=sbase),
            "FinishedTreatmentAndEmpSupp": status.finished_treatment(src, params, base=sbase),
        }
    tables |= {
        "ActiveEAProviders": clinical.active_providers(src, params, base=cbase),
        "OpenRefsNoContact": clinical.open_refs_no_contact(src, params, base=cbase),
        "ClinOutcomes": clinical.clinical_outcomes(src, params, base=cbase),
        "Indicator": indicator.indicator(src, params, counts),
        "PresenteeismCounts": assessments.assessment_counts(src, params),
        "PresenteeismCoverage": assessments.assessment_coverage(src, params),
        "Student": student.student(src, params),
    }
    return tables, stages


def run_monthly(src: Sources, params: RunParams, out_dir: str | None = None, database: str | None = None) -> dict[str, str]:
    """Publish all ten tables under the folder ``out_dir`` or in the catalog's ``database``; table -> where.

    One table after the other: a lost run leaves some of them new.  ``release_monthly`` shows all or none.
    """
    if (out_dir is None) == (database is None):
        raise ValueError("name either a folder or a database")
    tables, stages = build_tables(src, params)
    where = {}
    try:
        for name, df in tables.items():
            where[name] = f"{out_dir}/{name}" if out_dir is not None else f"{database}.{name}"
            target = {"path": where[name]} if out_dir is not None else {"table": where[name]}
            publish(df, mode=PUBLISHED[name].mode, casts=PUBLISHED[name].casts, **target)
    finally:
        for s in stages:
            s.unpersist()
    return where


def _observed_lookup(dim: DataFrame, code: str) -> tuple[DataFrame, Observation]:
    """A dimension that reports its current rows and the codes that have several, wherever it is next read."""
    current = "Effective_To IS NULL"
    seen = Observation()
    marked = dim.selectExpr("*", f"{current} AS __current",
                            f"ROW_NUMBER() OVER (PARTITION BY {code}, {current} ORDER BY {code}) AS __copy")
    # A code with several current rows has exactly one second row.
    return marked.observe(seen, F.expr(f"count_if(__current) AS current_rows"),
                          F.expr("count_if(__current AND __copy = 2) AS duplicate_codes")).drop("__current", "__copy"), seen


class Seen(dict):
    """Figures of the published tables written; those of ``inputs`` are found by name, but not listed."""

    def __init__(self, tables: dict[str, dict], inputs: dict[str, dict]):
        super().__init__(tables)
        self.inputs = inputs

    def __missing__(self, name: str) -> dict:
        return self.inputs[name]


def release_monthly(spark: SparkSession, src: Sources, params: RunParams, root: str, database: str | None = None,
                    incremental: bool = True) -> Seen:
    """Release all ten tables under ``root`` together, and as catalog views where ``database`` is named.

    With ``incremental``, T1-T3 of a root that has a release already are recomputed for touched months only
    (``plans.incremental``).  Returns what was observed while the tables were written, without another job: ``rows``
    per published table; by name also those of the audit snapshot, and ``current_rows`` and ``duplicate_codes`` of the two
    hierarchies (a duplicate code repeats rows).
    """
    releases = Releases(spark, root)
    run = releases.begin()
    params = replace(params, period=period_for(src, params))
    p = params.period
    _, parts = releases.current()
    months = None
    if incremental and incremental_plan.SNAPSHOT in parts:
        months = incremental_plan.touched_months(src, releases.read(incremental_plan.SNAPSHOT), p)
    comm, comm_seen = _observed_lookup(src.comm_hierarchy, "Organisation_Code")
    prov, prov_seen = _observed_lookup(src.prov_hierarchy, "Organisation_Code")
    watched = replace(src, comm_hierarchy=comm, prov_hierarchy=prov)
    tables, stages = build_tables(watched, params, months is None)
    try:
        for name, df in tables.items():
            run.write(name, df, PUBLISHED[name].mode, casts=PUBLISHED[name].casts)
        for name, (df, replaced) in (incremental_plan.status_tables(src, params, months) if months else {}).items():
            run.write(name, df, "append_month", casts=PUBLISHED[name].casts, replaces=replaced)
    finally:
        for s in stages:
            s.unpersist()
    run.write(incremental_plan.SNAPSHOT, incremental_plan.audit_snapshot(src, p), month_col="ReportingPeriodStartDate")
    run.commit()
    if database is not None:
        releases.register(database, list(PUBLISHED))
    inputs = {incremental_plan.SNAPSHOT: run.metrics.pop(incremental_plan.SNAPSHOT),
              "commissioner hierarchy": comm_seen.get, "provider hierarchy": prov_seen.get}
    return Seen(run.metrics, inputs)
