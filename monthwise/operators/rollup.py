"""Multi-level, multi-category roll-ups in one pass (O24 org_rollup,
O25 category_rollup, O26 appointment_scope).

The published tables repeat one aggregate per organisation level, category and
appointment scope (84 separate scans for the clinical outcomes table).  Here
each input row is fanned out in memory to every (level, category, scope) cell
it belongs to with ``explode`` over an array of structs, and ONE ``groupBy``
sums all cells.  All measures are sums of 0/1 flags or counts, so Spark's
partial aggregation combines rows map-side before the single shuffle; the
shuffle carries at most (output groups x tasks) rows however skewed the keys
are (the National level is one hot group per cell by design).

Expressions are Spark SQL text (``selectExpr`` / ``F.expr``), which keeps plan
construction to a handful of client calls.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthwise.functions.flags import q
from monthwise.functions.labels import NATIONAL
from monthwise.functions.recode import sql_str

ORG_NAMES = ("OrgType", "Region", "OrgCode", "OrgName")


@dataclass(frozen=True)
class Level:
    """One organisation level: its type label and the region/code/name columns
    (or constants for National)."""

    org_type: str
    region: str | None
    code: str | None
    name: str | None

    def struct_sql(self, names=ORG_NAMES) -> str:
        if self.code is None:
            _, region, code, name = NATIONAL
            vals = [sql_str(self.org_type), sql_str(region), sql_str(code), sql_str(name)]
        else:
            vals = [sql_str(self.org_type), q(self.region), q(self.code), q(self.name)]
        fields = ", ".join(f"{sql_str(n)}, CAST({v} AS STRING)" for n, v in zip(names, vals))
        return f"named_struct({fields})"


PROVIDER = Level("Provider", "RegionNameProv", "ProviderCode", "ProviderName")
SUB_ICB = Level("Sub-ICB", "RegionNameComm", "Sub-ICBCode", "Sub-ICBName")
ICB = Level("ICB", "RegionNameComm", "ICBCode", "ICBName")
NATIONAL_LEVEL = Level("National", None, None, None)
LEVELS = [PROVIDER, SUB_ICB, ICB, NATIONAL_LEVEL]


def _levels_array(levels, names=ORG_NAMES) -> str:
    return "array(" + ", ".join(lvl.struct_sql(names) for lvl in levels) + ")"


def org_rollup(df: DataFrame, keys: list, measures: dict, levels: list = LEVELS,
               names: tuple = ORG_NAMES, count: bool = False) -> DataFrame:
    """The same measures at every organisation level in one aggregate.

    ``measures`` maps output name -> source column; each is summed (or counted
    non-null when ``count``).  Output: keys, the four level columns named by
    ``names``, then the measures.
    """
    exploded = df.selectExpr(*[q(k) for k in keys], f"explode({_levels_array(levels, names)}) AS __lvl",
                             *[f"{q(src)} AS {q(m)}" for m, src in measures.items()])
    flat = exploded.selectExpr(*[q(k) for k in keys], *[f"__lvl.{q(n)} AS {q(n)}" for n in names],
                               *[q(m) for m in measures])
    agg = "count" if count else "sum"
    out = flat.groupBy(*keys, *names).agg(*[F.expr(f"{agg}({q(m)}) AS {q(m)}") for m in measures])
    return out.selectExpr(*[q(k) for k in keys], *[q(n) for n in names], *[q(m) for m in measures])


@dataclass(frozen=True)
class Scope:
    """An appointment scope: row filter (SQL text, or None for all rows), dosage
    column, whether the real discharge flag is printed (else 'NA'), and the
    measure columns (output name -> base column)."""

    name: str
    where: str | None
    dosage: str
    prints_flag: bool
    measures: dict

    def struct_sql(self, flag_col: str) -> str:
        flag = f"CAST({q(flag_col)} AS STRING)" if self.prints_flag else "'NA'"
        fields = [("AppointmentType", sql_str(self.name)), ("Dosage", f"CAST({q(self.dosage)} AS BIGINT)"),
                  (flag_col, flag), *[(m, f"CAST({q(src)} AS INT)") for m, src in self.measures.items()]]
        s = "named_struct(" + ", ".join(f"{sql_str(n)}, {v}" for n, v in fields) + ")"
        return s if self.where is None else f"CASE WHEN {self.where} THEN {s} END"


def category_rollup(df: DataFrame, keys: list, categories: dict, scopes: list, hidden: list,
                    levels: list = LEVELS, flag_col: str = "EmpSupportDischargeDatePresent",
                    finest_first: bool = True) -> DataFrame:
    """O25 + O26: every level x category x scope cell.

    With ``finest_first`` rows fan out to scopes and categories only and are summed at the finest grain of all levels
    (provider and Sub-ICB together); the levels are rolled up from those sums, not from rows.  Without, rows fan out to
    all cells of one aggregate: one shuffle less, for inputs with hardly any rows a cell.

    ``categories`` maps Category label -> column giving ``Variable``.  Each row
    contributes to every scope whose filter it passes.  ``hidden`` columns are
    grouped but not output (so rows that differ only there stay separate, as
    in the published table).  Measure names must be the same for all scopes.
    """
    measures = list(scopes[0].measures)
    cats = "array(" + ", ".join(f"named_struct('Category', {sql_str(label)}, 'Variable', CAST({q(col)} AS STRING))"
                                for label, col in categories.items()) + ")"
    # Scopes a row is outside of become NULL structs and are dropped by filter().
    scope_arr = "filter(array(" + ", ".join(sc.struct_sql(flag_col) for sc in scopes) + "), x -> x IS NOT NULL)"
    hid = [f"__h{i}" for i in range(len(hidden))]
    base = df.selectExpr(*[q(k) for k in keys], *[f"{q(h)} AS {a}" for h, a in zip(hidden, hid)],
                         f"{cats} AS __cats", f"{_levels_array(levels)} AS __lvls", f"explode({scope_arr}) AS __sc")
    group = [*keys, *ORG_NAMES, "Category", "Variable", "AppointmentType", "Dosage", flag_col, *hid]
    cells = [*[q(k) for k in keys], "__cat.Category AS Category", "__cat.Variable AS Variable",
             "__sc.AppointmentType AS AppointmentType", "__sc.Dosage AS Dosage", f"__sc.{q(flag_col)} AS {q(flag_col)}",
             *hid, *[f"__sc.{q(m)} AS {q(m)}" for m in measures], "__lvls"]
    fanned = base.selectExpr("*", "explode(__cats) AS __cat").selectExpr(*cells)
    if finest_first:
        fine = [c for c in group if c not in ORG_NAMES]
        fanned = fanned.groupBy(*fine, "__lvls").agg(*[F.expr(f"sum({q(m)}) AS {q(m)}") for m in measures])
    flat = fanned.selectExpr("*", "explode(__lvls) AS __lvl").selectExpr(
        *[q(c) for c in group if c not in ORG_NAMES], *[f"__lvl.{n} AS {n}" for n in ORG_NAMES], *[q(m) for m in measures])
    out = flat.groupBy(*group).agg(*[F.expr(f"sum({q(m)}) AS {q(m)}") for m in measures])
    return out.selectExpr(*[q(k) for k in keys], "OrgType", "OrgName", "OrgCode", "Region", "Category",
                          "Variable", "AppointmentType", "Dosage", q(flag_col), *[q(m) for m in measures])


def appointment_scope(df: DataFrame, scope: Scope, keys: list) -> DataFrame:
    """O26 on its own: filter to one scope and project its dosage and measures
    under the scope-independent names."""
    out = df if scope.where is None else df.where(scope.where)
    return out.selectExpr(*[q(k) for k in keys], f"{sql_str(scope.name)} AS AppointmentType",
                          f"{q(scope.dosage)} AS Dosage", *[f"{q(src)} AS {q(m)}" for m, src in scope.measures.items()])
