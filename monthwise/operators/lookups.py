"""Dimension lookups (O10 remap_successor, O11 current_lookup, O12 snapshot_lookup)
and the organisation geography built from them.

Dimensions (code changes, successors, hierarchies, deprivation, sites) are
small and slowly changing.  They are projected and filtered here and joined
without a hint: Spark broadcasts a side by its size in bytes
(``spark.sql.autoBroadcastJoinThreshold``, also at run time under AQE) and
sorts and merges beyond it.  A large fact table has few codes, each on very many
rows, and its rows must not be dealt by code to meet a large dimension: its
distinct codes are looked up instead (``by_code``).  Nothing is kept between
calls, so a lookup always sees the rows its table has when the query is built.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from monthwise.functions import labels as L
from monthwise.functions.flags import q
from monthwise.session import checkpoint_dir


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def remap_successor(df: DataFrame, key: str, mapping: DataFrame, old: str, new: str, out: str) -> DataFrame:
    """``out = COALESCE(mapping.new, df.key)`` via a left join on ``key = old``.

    Several mapping rows for one code fan the row out (kept, as in the source).
    """
    m = mapping.selectExpr(f"{q(old)} AS __old", f"{q(new)} AS __new")
    j = df.join(m, F.expr(f"{q(key)} = __old"), "left")
    return j.withColumns({out: F.expr(f"coalesce(__new, {q(key)})")}).drop("__old", "__new")


def by_code(df: DataFrame, key: str, facts: DataFrame, look_up: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``look_up(df)`` for a lookup that reads ``key`` alone, made for each distinct code only and joined back.

    ``facts`` holds every code of ``df`` (null among them, if there) and is cheaper to read.  What the codes become is
    written to the shared folder, so Spark knows its size and broadcasts it if small, whatever the size of the dimension;
    it sorts and merges it otherwise.  Codes that fan out do so in the join.
    """
    looked = look_up(facts.select(F.col(key)).distinct())
    path = f"{checkpoint_dir(df.sparkSession)}/codes-{uuid.uuid4().hex}"
    looked.write.parquet(path)
    added = [c for c in looked.columns if c != key]
    stored = df.sparkSession.read.schema(looked.schema).parquet(path).select(F.col(key).alias("__used"), *map(q, added))
    return df.join(stored, F.col(key).eqNullSafe(F.col("__used")), "left").drop("__used")


def current_rows(dim: DataFrame, effective_to: str = "Effective_To") -> DataFrame:
    """Current rows of a type-2 dimension (open-ended validity)."""
    return dim.where(f"{q(effective_to)} IS NULL")


def current_lookup(df: DataFrame, key: str, dim: DataFrame, code: str, cols: dict,
                   effective_to: str = "Effective_To", default: str | None = L.OTHER) -> DataFrame:
    """Left join to the current dimension row; each looked-up column falls
    back to ``default`` (``'Other'``) when there is no match.

    ``cols`` maps output name -> dimension column.  Several current rows for one
    code fan out (kept).
    """
    d = current_rows(dim, effective_to).selectExpr(
        f"{q(code)} AS __code", *[f"{q(c)} AS {q('__' + o)}" for o, c in cols.items()])
    j = df.join(d, F.expr(f"{q(key)} = __code"), "left")
    dflt = f", '{default}'" if default is not None else ""
    looked = {o: F.expr(f"coalesce({q('__' + o)}{dflt})") for o in cols}
    return j.withColumns(looked).drop("__code", *[f"__{o}" for o in cols])


def snapshot_lookup(df: DataFrame, key: str, dim: DataFrame, code: str, cols: dict,
                    snapshot_col: str, snapshot_date: str) -> DataFrame:
    """Left join to one dated snapshot of a dimension; unmatched stays NULL."""
    d = dim.where(f"{q(snapshot_col)} = DATE '{snapshot_date}'").selectExpr(
        f"{q(code)} AS __code", *[f"{q(c)} AS {q('__' + o)}" for o, c in cols.items()])
    j = df.join(d, F.expr(f"{q(key)} = __code"), "left")
    return j.withColumns({o: F.col(f"`__{o}`") for o in cols}).drop("__code", *[f"__{o}" for o in cols])


# ---------------------------------------------------------------------------
# Organisation geography (Sub-ICB / ICB / region, provider / region)
# ---------------------------------------------------------------------------
COMMISSIONER_COLS = {
    "Sub-ICBCode": "Organisation_Code",
    "Sub-ICBName": "Organisation_Name",
    "ICBCode": "STP_Code",
    "ICBName": "STP_Name",
    "RegionNameComm": "Region_Name",
    "RegionCodeComm": "Region_Code",
}
PROVIDER_COLS = {
    "ProviderCode": "Organisation_Code",
    "ProviderName": "Organisation_Name",
    "RegionNameProv": "Region_Name",
    "RegionCodeProv": "Region_Code",
}


def duplicate_current_codes(dim: DataFrame, code: str, effective_to: str = "Effective_To") -> DataFrame:
    """Codes with more than one current row, ``(code, current_rows)``: a lookup of such a code fans out (kept, as
    in the source), so a hierarchy load that overlaps should be seen before it is published."""
    return (current_rows(dim, effective_to).groupBy(F.col(code).alias("code"))
            .agg(F.count("*").alias("current_rows")).where("current_rows > 1"))


def commissioner_geography(df: DataFrame, code_changes: DataFrame, hierarchy: DataFrame,
                           key: str = "OrgIDComm", cols: dict | None = None,
                           facts: DataFrame | None = None) -> DataFrame:
    """Retired commissioner codes remapped, then the current Sub-ICB/ICB/region; with ``facts`` by distinct code."""
    if facts is not None:
        return by_code(df, key, facts, lambda codes: commissioner_geography(codes, code_changes, hierarchy, key, cols))
    out = remap_successor(df, key, code_changes, "Org_Code", "New_Code", "__comm_code")
    out = current_lookup(out, "__comm_code", hierarchy, "Organisation_Code", cols or COMMISSIONER_COLS)
    return out.drop("__comm_code")


def provider_geography(df: DataFrame, successor: DataFrame, hierarchy: DataFrame,
                       key: str = "OrgID_Provider", cols: dict | None = None,
                       facts: DataFrame | None = None) -> DataFrame:
    """Provider codes moved to their successor, then the current provider/region; with ``facts`` by distinct code."""
    if facts is not None:
        return by_code(df, key, facts, lambda codes: provider_geography(codes, successor, hierarchy, key, cols))
    out = remap_successor(df, key, successor, "Prov_original", "Prov_Successor", "__prov_code")
    out = current_lookup(out, "__prov_code", hierarchy, "Organisation_Code", cols or PROVIDER_COLS)
    return out.drop("__prov_code")
