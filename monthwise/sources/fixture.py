"""Domain tables as a fixed projection of the driver's TPC-H-ish tables.

The reference reads 14 service-record tables that are not shipped with it.  For
tests and the oracle comparison every domain table is a deterministic SELECT
over the driver tables (see FIXTURES.md section 2).  Each table is described
once as ``FixtureTable`` data: a source relation and a list of
``(column, type, expression)``.  ``spark_tables`` turns the specs into Spark
DataFrames through ``selectExpr``; ``oracle_ctes`` turns the same specs into
DuckDB common table expressions, so both engines see identical inputs.

Everything here is a narrow projection plus, for some tables, one equi-join of
driver tables; Spark prunes the parquet columns to those named below.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from monthwise.functions import labels as L

# Driver columns the projection reads (keeps the parquet scans narrow).
DRIVER_COLUMNS = {
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"],
    "customer": ["c_custkey", "c_nationkey"],
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                 "l_returnflag", "l_linestatus"],
    "events": ["event_id", "ts", "user_id", "event_type"],
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "region": ["r_regionkey", "r_name"],
    "supplier": ["s_suppkey", "s_name", "s_nationkey"],
}

# Shared relation r0: one row per order with its customer's nation and a
# submission month m (order date pushed forward by o_orderkey % 150 days).
R0_COLUMNS = [
    "o_orderkey", "o_custkey",
    "cast(o_orderdate as date) as rd",
    "o_orderstatus", "c_nationkey",
    "cast(date_trunc('month', cast(o_orderdate as date) + cast(o_orderkey%150 as int)) as date) as m",
]
R0_SID = "year(m)*12+month(m) as sid"
# Columns of r0 that tables on order lines use.
LINEITEM_R0_COLUMNS = ["o_orderkey", "rd", "sid"]

CODED_DATE = "date '2001-01-01' + cast((day(ts)-1)*5 as int) as ad"

_UID = ("cast(l_orderkey as string)||'-'||cast(l_linenumber as string)||'-'||"
        "cast(l_partkey as string)||'-'||cast(l_suppkey as string)")


@dataclass(frozen=True)
class FixtureTable:
    name: str
    source: str          # one of the source relations built below
    columns: list = field(default_factory=list)   # (name, type, expression)
    where: str | None = None


# ---------------------------------------------------------------------------
# The projection specs of FIXTURES.md section 2.
# ---------------------------------------------------------------------------
def _cases(key: str, values: list) -> str:
    """``CASE key WHEN 0 THEN first value ...``: the n-th value for remainder n, null for None and beyond."""
    return f"case {key} " + " ".join(f"when {n} then '{v}'" for n, v in enumerate(values) if v is not None) + " end"


FIXTURE_TABLES = [
    FixtureTable("IsLatest_SubmissionID", "months_x_v2", [
        ("UniqueSubmissionID", "int", "sid"),
        ("AuditId", "int", "sid*10+v"),
        ("IsLatest", "int", "v"),
        ("ReportingPeriodStartDate", "date", "m"),
        ("ReportingPeriodEndDate", "date", "last_day(m)"),
    ]),
    FixtureTable("IDS101referral", "r0_x_v2", [
        ("RecordNumber", "bigint", "o_orderkey"),
        ("PathwayID", "bigint", "o_orderkey"),
        ("Person_ID", "bigint", "o_custkey"),
        ("UniqueSubmissionID", "int", "sid"),
        ("AuditId", "int", "sid*10+v"),
        ("Unique_MonthID", "int", "sid"),
        ("EFFECTIVE_FROM", "date", "m"),
        ("OrgIDComm", "string", "'C'||cast(c_nationkey as string)"),
        ("OrgID_Provider", "string", "'S'||cast(o_orderkey%10 as string)"),
        ("ReferralRequestReceivedDate", "date", "rd"),
        ("ServDischDate", "date", "case when o_orderstatus<>'P' then rd + cast(o_orderkey%150 as int) end"),
        ("TherapySession_FirstDate", "date", "case when o_orderkey%4<>0 then rd + cast(o_orderkey%40 as int) end"),
        ("TherapySession_LastDate", "date",
         "case when o_orderkey%4<>0 then rd + cast(o_orderkey%40+(o_orderkey%3)*20 as int) end"),
        ("EmpSupport_FirstDate", "date", "case when o_orderkey%3=0 then rd + cast(o_orderkey%50 as int) end"),
        ("EmpSupport_LastDate", "date",
         "case when o_orderkey%3=0 then rd + cast(o_orderkey%50+(o_orderkey%5)*10 as int) end"),
        ("TreatmentCareContact_Count", "int", "cast(o_orderkey%6 as int)"),
        ("UsePathway_Flag", "string", "case when o_orderkey%20=19 then 'False' else 'True' end"),
        ("CompletedTreatment_Flag", "string", "case when o_orderkey%3<>1 then 'True' else 'False' end"),
        ("Recovery_Flag", "string", "case when o_orderkey%4=1 then 'True' else 'False' end"),
        ("NotCaseness_Flag", "string", "case when o_orderkey%11=0 then 'true' else 'False' end"),
        ("ReliableImprovement_Flag", "string", "case when o_orderkey%5<2 then 'True' else 'False' end"),
        ("ReliableDeterioration_Flag", "string", "case when o_orderkey%7=3 then 'True' else 'False' end"),
        ("Age_ReferralRequest_ReceivedDate", "int",
         "case when o_custkey%29=0 then null else cast(14+o_custkey%70 as int) end"),
        # Every complaint rule meets rows: each higher category, each lower one under anxiety, none, and an unlisted one.
        ("PresentingComplaintHigherCategory", "string", _cases("o_orderkey%9", [
            *(code for code, _ in L.PROBLEM_HIGHER), L.ANXIETY, L.ANXIETY, "F99 - Unlisted"])),
        ("PresentingComplaintLowerCategory", "string", _cases("o_custkey%14", [
            *(code for code, _ in L.PROBLEM_ANXIETY_LOWER), "F99 - Unlisted"])),
        ("PrimaryPresentingComplaint", "string", _cases("o_orderkey%16", [
            None, L.ANXIETY, None, "Other recorded problems", None, "Depression"])),
        ("SecondaryPresentingComplaint", "string", _cases("o_orderkey%13", [
            "F42 - Obsessive-compulsive disorder", None, "F99 - Unlisted", None, None, "F400 - Agoraphobia"])),
    ], where="v=1 or o_orderkey%5=0"),
    FixtureTable("IDS001mpi", "r0", [
        ("RecordNumber", "bigint", "o_orderkey"),
        ("Gender", "string",
         "case o_custkey%6 when 0 then '1' when 1 then '02' when 2 then '9' when 3 then 'X' when 5 then '7' end"),
        ("GenderIdentity", "string",
         "case o_custkey%8 when 0 then '1' when 1 then '02' when 2 then '3' when 3 then '04' when 4 then 'x' "
         "when 5 then 'Z' when 7 then '8' end"),
        ("Validated_EthnicCategory", "string",
         "case o_custkey%8 when 0 then 'A' when 1 then 'D' when 2 then 'H' when 3 then 'M' when 4 then 'R' "
         "when 5 then '99' when 7 then 'Q' end"),
        ("LSOA", "string", "'E'||cast(o_custkey%50 as string)"),
        ("Age_RP_EndDate", "int", "cast(14+o_custkey%70 as int)"),
    ]),
    FixtureTable("IDS004empstatus", "lineitem_r0", [
        ("RecordNumber", "bigint", "o_orderkey"),
        ("AuditId", "int", "sid*10+case when (l_orderkey+l_linenumber)%17=0 then 0 else 1 end"),
        ("Unique_MonthID", "int", "sid"),
        ("UniqueID_IDS004", "string", _UID),
        ("EmployStatusRecDate", "date", "case when l_linenumber<>7 then rd + cast(l_quantity as int) end"),
        ("EmployStatus", "string",
         "case l_partkey%10 when 0 then '01' when 1 then '02' when 2 then '03' when 3 then '04' when 4 then '05' "
         "when 5 then '06' when 6 then '07' when 7 then '08' when 8 then 'ZZ' end"),
        ("WeekHoursWorked", "string",
         "case l_partkey%8 when 0 then '01' when 1 then '02' when 2 then '03' when 3 then '04' when 4 then '97' "
         "when 5 then '98' when 6 then '99' end"),
        ("SelfEmployInd", "string",
         "case l_partkey%6 when 0 then 'Y' when 1 then 'N' when 2 then '8' when 3 then 'Z' when 4 then 'X' end"),
        ("SickAbsenceInd", "string",
         "case l_linenumber%6 when 0 then 'Y' when 1 then 'N' when 2 then '8' when 3 then 'Z' when 4 then 'X' end"),
        ("SSPInd", "string", "case l_suppkey%4 when 0 then 'Y' when 1 then 'N' when 2 then 'U' end"),
        ("BenefitRecInd", "string",
         "case l_partkey%5 when 0 then 'Y' when 1 then 'N' when 2 then 'U' when 3 then 'Z' end"),
        ("ESAInd", "string", "case l_suppkey%5 when 0 then 'Y' when 1 then 'N' when 2 then 'U' when 3 then 'Z' end"),
        ("UCInd", "string",
         "case (l_partkey+l_suppkey)%5 when 0 then 'Y' when 1 then 'N' when 2 then 'U' when 3 then 'Z' end"),
        ("PIPInd", "string",
         "case l_linenumber%5 when 0 then 'Y' when 1 then 'N' when 2 then 'U' when 3 then 'Z' end"),
        ("EmpSupportInd", "string", "case l_linenumber%4 when 0 then 'Y' when 1 then 'N' when 2 then 'NA' end"),
        ("EmpSupportReferral", "date", "case when o_orderkey%2=0 then rd + 5 end"),
        ("EmpSupportDischargeDate", "date", "case when l_returnflag='R' then rd + 60 end"),
    ]),
    FixtureTable("IDS011socpercircumstances", "r0_x_v3", [
        ("AuditID", "int", "sid*10+1"),
        ("SocPerCircumstance", "string",
         "case (o_orderkey+v*3)%11 when 0 then '20430005' when 1 then '89217008' when 2 then '76102007' "
         "when 3 then '38628009' when 4 then '42035005' when 5 then '1064711000000100' when 6 then '699042003' "
         "when 7 then '765288000' when 8 then '440583007' when 9 then '766822004' when 10 then '999' end"),
        ("SocPerCircumstanceRecDate", "date", "case when v=2 then rd else rd + 1 end"),
        ("Person_ID", "bigint", "o_custkey"),
        ("RecordNumber", "bigint", "o_orderkey"),
        ("UniqueID_IDS011", "bigint", "o_orderkey*10+v"),
        ("OrgID_Provider", "string", "'S'||cast(o_orderkey%10 as string)"),
        ("UniqueSubmissionID", "int", "sid"),
        ("Unique_MonthID", "int", "sid"),
        ("EFFECTIVE_FROM", "date", "m"),
    ]),
    FixtureTable("IDS201carecontact", "lineitem_r0", [
        ("RecordNumber", "bigint", "o_orderkey"),
        ("PathwayID", "bigint", "o_orderkey"),
        ("UniqueSubmissionID", "int", "sid"),
        ("AuditId", "int", "sid*10+case when l_orderkey%19=0 then 0 else 1 end"),
        ("CareContactID", "string", _UID),
        ("CareContDate", "date", "rd + cast(l_quantity as int)*3"),
        ("AttendOrDNACode", "string", "cast(1+l_linenumber%7 as string)"),
        ("PlannedCareContIndicator", "string", "case when l_returnflag='N' then 'N' else 'Y' end"),
        ("AppType", "string", "lpad(cast(1+l_partkey%11 as string),2,'0')"),
    ]),
    FixtureTable("IDS202careactivity", "lineitem_r0", [
        ("PathwayID", "bigint", "o_orderkey"),
        ("RecordNumber", "bigint", "o_orderkey"),
        ("CareContactID", "string", _UID),
        ("AuditId", "int", "sid*10+1"),
        ("CodeProcAndProcStatus", "string", "case when l_partkey%3<>0 then '1098051000000103' else '1' end"),
    ], where="l_linestatus='O'"),
    FixtureTable("IDS606codedscoreassessmentrefer", "events_x_v2", [
        ("AuditId", "int", "(year(ad)*12+month(ad))*10+v"),
        ("UniqueSubmissionID", "int", "(year(ad)*12+month(ad))"),
        ("PathwayID", "bigint", "user_id*7+event_id%7"),
        ("Unique_ServiceRequestID", "bigint", "user_id*7+event_id%7"),
        ("AssToolCompDate", "date", "ad"),
        ("AssToolCompTime", "string",
         "case when event_id%50<>0 then lpad(cast(hour(ts) as string),2,'0')||':'||"
         "lpad(cast(minute(ts) as string),2,'0') end"),
        ("CodedAssToolType", "string",
         "case event_type when 'click' then '748161000000109' when 'view' then '760741000000102' "
         "when 'purchase' then '761051000000105' else '999' end"),
        ("PersScore", "string", "cast(event_id%11 as string)"),
        ("UniqueID_IDS606", "bigint", "event_id"),
        ("OrgID_Provider", "string", "'S'||cast(user_id%10 as string)"),
    ], where="v=1 or event_id%6=0"),
    FixtureTable("ComCodeChanges", "nation", [
        ("Org_Code", "string", "'C'||cast(n_nationkey as string)"),
        ("New_Code", "string", "'C'||cast((n_nationkey+1)%25 as string)"),
    ], where="n_nationkey%10=4"),
    FixtureTable("Provider_Successor", "supplier", [
        ("Prov_original", "string", "'S'||cast(s_suppkey as string)"),
        ("Prov_Successor", "string", "'S'||cast(s_suppkey+1 as string)"),
    ], where="s_suppkey%10=3"),
    FixtureTable("Ref_ODS_Commissioner_Hierarchies_ICB", "nation_region", [
        ("Organisation_Code", "string", "'C'||cast(n_nationkey as string)"),
        ("Organisation_Name", "string", "n_name"),
        ("STP_Code", "string", "'I'||cast(n_regionkey*10+n_nationkey%2 as string)"),
        ("STP_Name", "string", "'ICB '||cast(n_regionkey*10+n_nationkey%2 as string)"),
        ("Region_Code", "string", "'R'||cast(r_regionkey as string)"),
        ("Region_Name", "string", "r_name"),
        ("Effective_To", "date", "case when n_nationkey%6=0 then date '2000-01-01' end"),
    ]),
    FixtureTable("Ref_ODS_Provider_Hierarchies_ICB", "supplier_nation_region", [
        ("Organisation_Code", "string", "'S'||cast(s_suppkey as string)"),
        ("Organisation_Name", "string", "s_name"),
        ("Region_Code", "string", "'R'||cast(r_regionkey as string)"),
        ("Region_Name", "string", "r_name"),
        ("Effective_To", "date", "case when s_suppkey%7=0 then date '2000-01-01' end"),
    ]),
    FixtureTable("Domains_Of_Deprivation_By_LSOA1", "nation_x_v2", [
        ("LSOA_Code", "string", "'E'||cast(n_nationkey as string)"),
        ("IMD_Decile", "int", "1+(n_nationkey+v)%10"),
        ("Effective_Snapshot_Date", "date",
         "case when v=1 then date '2019-12-31' else date '2015-12-31' end"),
    ]),
    FixtureTable("REFERENCE_ODS_All_Sites", "supplier_x_v2", [
        ("SiteCode", "string", "'S'||cast(s_suppkey as string)"),
        ("Postcode1", "string", "'P'||cast((s_suppkey*7+v*3)%100 as string)"),
        ("Grid Reference", "string", "'G'||cast(s_suppkey as string)"),
        ("X (easting)", "bigint", "s_suppkey*100+v"),
        ("Y (northing)", "bigint", "s_suppkey*200+v"),
        ("Latitude", "double", "cast(50+s_suppkey%5 as double)"),
        ("Longitude", "double", "cast(-(s_suppkey%4) as double)"),
        ("Address4", "string", "'Town '||cast(s_suppkey%20 as string)"),
    ]),
]

FIXTURE_BY_NAME = {t.name: t for t in FIXTURE_TABLES}


def _quote(name: str, dialect: str) -> str:
    if name.replace("_", "").isalnum():
        return name
    return f"`{name}`" if dialect == "spark" else f'"{name}"'


def _select_list(table: FixtureTable, dialect: str) -> list[str]:
    return [f"CAST({expr} AS {typ}) AS {_quote(col, dialect)}" for col, typ, expr in table.columns]


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------
def _vv(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).select(F.col("id").cast("int").alias("v"))


def _driver(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*DRIVER_COLUMNS[name])


def _as_is(name: str, df: DataFrame) -> DataFrame:
    return df


def spark_sources(spark: SparkSession, sf_dir: str, keep: Callable[[str, DataFrame], DataFrame] = _as_is
                  ) -> dict[str, DataFrame]:
    """Source relations the specs refer to, as lazy DataFrames.

    ``keep`` gets the name and rows of each join of large tables that several specs start from; what it returns is used.
    """
    orders = _driver(spark, sf_dir, "orders")
    customer = _driver(spark, sf_dir, "customer")
    lineitem = _driver(spark, sf_dir, "lineitem")
    events = _driver(spark, sf_dir, "events")
    nation = _driver(spark, sf_dir, "nation")
    region = _driver(spark, sf_dir, "region")
    supplier = _driver(spark, sf_dir, "supplier")

    r0 = (orders.join(customer, orders.o_custkey == customer.c_custkey)
          .selectExpr(*R0_COLUMNS).selectExpr("*", R0_SID))
    r0 = keep("r0", r0)
    lineitem_r0 = keep("lineitem_r0", lineitem.join(r0, lineitem.l_orderkey == r0.o_orderkey)
                       .select(*DRIVER_COLUMNS["lineitem"], *LINEITEM_R0_COLUMNS))
    # The tiny literal relations (2 or 3 rows) are broadcast; their size is fixed.
    v2, v3 = F.broadcast(_vv(spark, 2)), F.broadcast(_vv(spark, 3))
    return {
        "r0": r0,
        "r0_x_v2": r0.crossJoin(v2),
        "r0_x_v3": r0.crossJoin(v3),
        "months_x_v2": r0.select("sid", "m").distinct().crossJoin(v2),
        "lineitem_r0": lineitem_r0,
        "events_x_v2": events.selectExpr("*", CODED_DATE).crossJoin(v2),
        "nation": nation,
        "nation_x_v2": nation.crossJoin(v2),
        "nation_region": nation.join(region, nation.n_regionkey == region.r_regionkey),
        "supplier": supplier,
        "supplier_x_v2": supplier.crossJoin(v2),
        "supplier_nation_region": supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
                                          .join(region, nation.n_regionkey == region.r_regionkey),
    }


def spark_tables(spark: SparkSession, sf_dir: str, keep: Callable[[str, DataFrame], DataFrame] = _as_is
                 ) -> dict[str, DataFrame]:
    """All 14 domain tables projected from the driver tables at ``sf_dir``; ``keep`` as in ``spark_sources``."""
    src = spark_sources(spark, sf_dir, keep)
    out = {}
    for table in FIXTURE_TABLES:
        df = src[table.source]
        if table.where:
            df = df.where(table.where)
        out[table.name] = df.selectExpr(*_select_list(table, "spark"))
    return out


# ---------------------------------------------------------------------------
# DuckDB oracle side: the same specs as CTEs
# ---------------------------------------------------------------------------
_ORACLE_SOURCES = {
    "r0": "r0",
    "r0_x_v2": "r0 cross join (select 0 as v union all select 1 as v) vv",
    "r0_x_v3": "r0 cross join (select 0 as v union all select 1 as v union all select 2 as v) vv",
    "months_x_v2": "(select distinct sid, m from r0) s cross join (select 0 as v union all select 1 as v) vv",
    "lineitem_r0": "lineitem join r0 on l_orderkey=o_orderkey",
    "events_x_v2": ("(select *, date '2001-01-01' + cast((day(ts)-1)*5 as int) as ad from events) ev "
                    "cross join (select 0 as v union all select 1 as v) vv"),
    "nation": "nation",
    "nation_x_v2": "nation cross join (select 0 as v union all select 1 as v) vv",
    "nation_region": "nation join region on n_regionkey=r_regionkey",
    "supplier": "supplier",
    "supplier_x_v2": "supplier cross join (select 0 as v union all select 1 as v) vv",
    "supplier_nation_region": ("supplier join nation on s_nationkey=n_nationkey "
                               "join region on n_regionkey=r_regionkey"),
}

_ORACLE_R0 = (
    "r0 AS (select *, year(m)*12+month(m) as sid from (select o_orderkey, o_custkey, "
    "cast(o_orderdate as date) as rd, o_orderstatus, c_nationkey, "
    "cast(date_trunc('month', cast(o_orderdate as date) + cast(o_orderkey%150 as int)) as date) as m "
    "from orders join customer on o_custkey=c_custkey) q)"
)

# Short names the oracle SQL uses for the domain tables.
ORACLE_ALIASES = {
    "IsLatest_SubmissionID": "sub",
    "IDS101referral": "ref",
    "IDS001mpi": "mpi",
    "IDS004empstatus": "emp",
    "IDS011socpercircumstances": "spc",
    "IDS201carecontact": "con",
    "IDS202careactivity": "act",
    "IDS606codedscoreassessmentrefer": "ass",
    "ComCodeChanges": "ccc",
    "Provider_Successor": "psu",
    "Ref_ODS_Commissioner_Hierarchies_ICB": "chi",
    "Ref_ODS_Provider_Hierarchies_ICB": "phi",
    "Domains_Of_Deprivation_By_LSOA1": "imd",
    "REFERENCE_ODS_All_Sites": "sites",
}


def oracle_ctes(names: list[str] | None = None) -> str:
    """``WITH`` clause (without the keyword) defining the requested domain tables."""
    wanted = [t for t in FIXTURE_TABLES if names is None or t.name in names]
    parts = [_ORACLE_R0]
    for table in wanted:
        sql = f"SELECT {', '.join(_select_list(table, 'duckdb'))} FROM {_ORACLE_SOURCES[table.source]}"
        if table.where:
            sql += f" WHERE {table.where}"
        parts.append(f"{ORACLE_ALIASES[table.name]} AS ({sql})")
    return ",\n".join(parts)
