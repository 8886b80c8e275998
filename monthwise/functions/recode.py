"""Recodes and bands (O13 recode, O14 recode_rules, O15 band).

All of them build one ``CASE WHEN`` column expression, so they run inside
whole-stage codegen with no Python on the data path.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from monthwise.functions import labels as L


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_str(value: str) -> str:
    """A Spark SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_col(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _case_sql(whens: list, default: str | None) -> str:
    tail = f" ELSE {sql_str(default)}" if default is not None else ""
    return "CASE " + " ".join(f"WHEN {c} THEN {sql_str(v)}" for c, v in whens) + tail + " END"


class Recode:
    """A first-match-wins recode as data: ``whens`` are (SQL condition, label).

    ``sql()`` gives the label; ``code_sql()`` gives a small integer code, one
    per distinct label (codes follow first appearance, the default last), and
    ``decode_sql(col)`` turns a code column back into the label.  Carrying the
    code instead of long label text keeps rows narrow through DISTINCT, sorts
    and shuffles; labels are restored on the output rows only.
    """

    def __init__(self, whens: list, default: str | None):
        self.whens, self.default = list(whens), default
        labels = []
        for _, label in self.whens:
            if label not in labels:
                labels.append(label)
        if default is not None and default not in labels:
            labels.append(default)
        self.labels = labels

    def sql(self) -> str:
        return _case_sql(self.whens, self.default)

    def code_sql(self) -> str:
        tail = f" ELSE {self.labels.index(self.default)}" if self.default is not None else ""
        return ("CASE " + " ".join(f"WHEN {c} THEN {self.labels.index(v)}" for c, v in self.whens) + tail + " END")

    def code_of(self, label: str) -> int:
        return self.labels.index(label)

    def decode_sql(self, code_col: str) -> str:
        return f"element_at(array({', '.join(sql_str(v) for v in self.labels)}), {sql_col(code_col)} + 1)"


class MapRecode(Recode):
    """A single-column recode evaluated as a lookup in a constant map.

    Same result as the first-match ``CASE`` (the first rule for a code wins),
    but the generated code is one map lookup instead of one branch per code,
    which keeps wide projections small enough for the JIT to compile.
    """

    def __init__(self, col: str, pairs: list, default: str | None):
        first = {}
        for code, label in pairs:
            first.setdefault(code, label)
        self.col, self.pairs = col, list(first.items())
        super().__init__([(f"{sql_col(col)} = {sql_str(k)}", v) for k, v in self.pairs], default)

    def _lookup(self, values: list) -> str:
        body = ", ".join(f"{sql_str(k)}, {v}" for (k, _), v in zip(self.pairs, values))
        return f"try_element_at(map({body}), {sql_col(self.col)})"

    def sql(self) -> str:
        found = self._lookup([sql_str(v) for _, v in self.pairs])
        return f"coalesce({found}, {sql_str(self.default)})" if self.default is not None else found

    def code_sql(self) -> str:
        found = self._lookup([str(self.labels.index(v)) for _, v in self.pairs])
        return f"coalesce({found}, {self.labels.index(self.default)})" if self.default is not None else found


def _pairs(mapping: dict) -> list:
    pairs = []
    for key, value in mapping.items():
        if isinstance(value, (list, tuple)):
            pairs += [(code, key) for code in value]
        else:
            pairs.append((key, value))
    return pairs


def recode_spec(col: str, mapping: dict, default: str | None = L.UNSPECIFIED) -> Recode:
    return MapRecode(col, _pairs(mapping), default)


def ssp_spec(ssp="SSPInd", sick_absence="SickAbsenceInd") -> Recode:
    s, a = sql_col(ssp), sql_col(sick_absence)
    whens = [(f"{s} = {sql_str(code)}", label) for code, label in L.SSP_IND.items()]
    whens.append((f"{a} = {sql_str(L.SSP_NOT_STATED_SICK_ABSENCE_CODE)}", L.SSP_NOT_STATED))
    return Recode(whens, L.UNSPECIFIED)


def general_benefit_spec(benefit="BenefitRecInd", esa="ESAInd", pip="PIPInd", uc="UCInd") -> Recode:
    cols = [sql_col(c) for c in (benefit, esa, pip, uc)]
    any_y = " OR ".join(f"{c} = 'Y'" for c in cols)
    any_n = " OR ".join(f"{c} = 'N'" for c in cols)
    return Recode([(f"({any_y})", L.BENEFIT_RECEIVED), (f"({any_n})", L.NO_BENEFIT_RECEIVED)], L.BENEFIT_UNKNOWN)


def status_recodes(prefix: str = "") -> dict[str, Recode]:
    """The ten employment-status recodes plus the any-benefit roll-up."""
    c = (lambda n: prefix + n)
    return {
        "EmployStatus": recode_spec(c("EmployStatus"), L.EMPLOY_STATUS),
        "WeekHoursWorked": recode_spec(c("WeekHoursWorked"), L.WEEK_HOURS_WORKED),
        "SelfEmployInd": recode_spec(c("SelfEmployInd"), L.SELF_EMPLOY_IND),
        "SickAbsenceInd": recode_spec(c("SickAbsenceInd"), L.SICK_ABSENCE_IND),
        "SSPInd": ssp_spec(c("SSPInd"), c("SickAbsenceInd")),
        "BenefitRecInd": recode_spec(c("BenefitRecInd"), L.BENEFIT_REC_IND),
        "ESAInd": recode_spec(c("ESAInd"), L.ESA_IND),
        "UCInd": recode_spec(c("UCInd"), L.UC_IND),
        "PIPInd": recode_spec(c("PIPInd"), L.PIP_IND),
        "EmpSupportInd": recode_spec(c("EmpSupportInd"), L.EMP_SUPPORT_IND),
        "GeneralBenefitReceived": general_benefit_spec(c("BenefitRecInd"), c("ESAInd"), c("PIPInd"), c("UCInd")),
    }


def recode_sql(col: str, mapping: dict, default: str | None = L.UNSPECIFIED) -> str:
    """O13 as Spark SQL text (see ``recode``): a constant-map lookup."""
    return recode_spec(col, mapping, default).sql()


def band_sql(col: str, bands: list, default: str | None = L.UNSPECIFIED) -> str:
    """O15 as Spark SQL text (see ``band``)."""
    c = sql_col(col)
    whens = []
    for lo, hi, label in bands:
        conds = ([f"{c} >= {lo}"] if lo is not None else []) + ([f"{c} <= {hi}"] if hi is not None else [])
        whens.append((" AND ".join(conds), label))
    return _case_sql(whens, default)


def recode(col, mapping: dict, default: str | None = L.UNSPECIFIED) -> Column:
    """Single-column code -> label; first match wins.

    ``mapping`` is either ``{code: label}`` or ``{label: [codes]}``.  Codes are
    compared exactly (case matters, as in the published rules).
    """
    if isinstance(col, str):
        return F.expr(recode_sql(col, mapping, default))
    c = _col(col)
    rules = []
    for key, value in mapping.items():
        if isinstance(value, (list, tuple)):
            rules.append((c.isin(list(value)), key))
        else:
            rules.append((c == F.lit(key), value))
    return recode_rules(rules, default)


def recode_rules(rules: list, default: str | None = L.UNSPECIFIED) -> Column:
    """Ordered ``(condition, label)`` rules over any columns; first match wins."""
    expr = None
    for cond, label in rules:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if default is not None else expr


def band(col, bands: list, default: str | None = L.UNSPECIFIED) -> Column:
    """Inclusive numeric bands ``(lo, hi, label)``; ``None`` leaves a side open."""
    if isinstance(col, str):
        return F.expr(band_sql(col, bands, default))
    c = _col(col)
    rules = []
    for lo, hi, label in bands:
        conds = []
        if lo is not None:
            conds.append(c >= lo)
        if hi is not None:
            conds.append(c <= hi)
        rules.append((reduce(lambda a, b: a & b, conds), label))
    return recode_rules(rules, default)


# ---------------------------------------------------------------------------
# The published recodes
# ---------------------------------------------------------------------------
def problem_descriptor(higher="PresentingComplaintHigherCategory", lower="PresentingComplaintLowerCategory",
                       primary="PrimaryPresentingComplaint", secondary="SecondaryPresentingComplaint") -> Column:
    """The 17-rule problem descriptor (first match wins)."""
    return F.expr(problem_descriptor_sql(higher, lower, primary, secondary))


def problem_descriptor_sql(higher="PresentingComplaintHigherCategory", lower="PresentingComplaintLowerCategory",
                           primary="PrimaryPresentingComplaint", secondary="SecondaryPresentingComplaint") -> str:
    """The 17 ordered rules as two position lookups.

    A higher-category rule k matches when the higher category or the primary
    complaint equals its code, so the first matching rule is the smaller of
    the two codes' positions in the rule list (``least`` skips NULL); the
    anxiety rules work the same way on the lower category and the secondary
    complaint.  Same result as the rule-by-rule ``CASE``, with far less
    generated code.
    """
    h, lo, p, s = (sql_col(c) for c in (higher, lower, primary, secondary))

    def position(rules, a, b):
        m = "map(" + ", ".join(f"{sql_str(code)}, {i}" for i, (code, _) in enumerate(rules, start=1)) + ")"
        return f"least(try_element_at({m}, {a}), try_element_at({m}, {b}))"

    def label(rules, pos):
        return f"element_at(array({', '.join(sql_str(lab) for _, lab in rules)}), {pos})"
    hi_pos = position(L.PROBLEM_HIGHER, h, p)
    lo_pos = position(L.PROBLEM_ANXIETY_LOWER, lo, s)
    anxious = f"({h} = {sql_str(L.ANXIETY)} OR {p} = {sql_str(L.ANXIETY)})"
    return (f"CASE WHEN {hi_pos} IS NOT NULL THEN {label(L.PROBLEM_HIGHER, hi_pos)} "
            f"WHEN {anxious} AND {lo_pos} IS NOT NULL THEN {label(L.PROBLEM_ANXIETY_LOWER, lo_pos)} "
            f"WHEN {anxious} AND ({lo} IS NULL OR {s} IS NULL) THEN {sql_str(L.PROBLEM_NO_CODE)} "
            f"ELSE {sql_str(L.PROBLEM_OTHER)} END")


def status_labels_sql(prefix: str = "") -> dict[str, str]:
    """The ten employment-status recodes plus the any-benefit roll-up (SQL text)."""
    return {k: r.sql() for k, r in status_recodes(prefix).items()}


def status_labels(prefix: str = "") -> dict[str, Column]:
    return {k: F.expr(v) for k, v in status_labels_sql(prefix).items()}


def protected_characteristics_sql() -> dict[str, str]:
    """Gender, ethnicity, gender identity, age band and problem descriptor labels (SQL text)."""
    return {
        "GenderDesc": recode_sql("Gender", L.GENDER),
        "EthnicityDesc": recode_sql("Validated_EthnicCategory", L.ETHNICITY),
        "GenderIdentityDesc": recode_sql("GenderIdentity", L.GENDER_IDENTITY),
        "AgeGroups": band_sql("Age_ReferralRequest_ReceivedDate", L.AGE_BANDS),
        "ProblemDescriptor": problem_descriptor_sql(),
    }


def sexual_orientation_sql(col="SocPerCircumstance") -> str:
    return recode_sql(col, L.SEXUAL_ORIENTATION)


def sexual_orientation(col="SocPerCircumstance") -> Column:
    return F.expr(sexual_orientation_sql(col))


def coverage_band(count_col="NumberOfPresenteeismAssessments") -> Column:
    """Assessment count: 0 or NULL / 1 / 2+ (NULL only if negative)."""
    return F.expr(coverage_band_sql(count_col))


def coverage_band_sql(count_col="NumberOfPresenteeismAssessments") -> str:
    c = sql_col(count_col)
    return _case_sql([(f"{c} = 0 OR {c} IS NULL", L.COVERAGE_NONE), (f"{c} = 1", L.COVERAGE_ONE),
                      (f"{c} >= 2", L.COVERAGE_TWO_PLUS)], None)
