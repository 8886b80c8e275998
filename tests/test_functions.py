"""Column-level functions on hand-written frames (labels, recodes, bands, flags)."""

import datetime as dt

from pyspark.sql import functions as F

from monthwise.functions import labels as L
from monthwise.functions.flags import days_open_bands, in_period_flag, is_true, open_caseload
from monthwise.functions.recode import band, coverage_band, problem_descriptor, recode, ssp_spec, status_labels


def test_nbsp_labels_are_byte_exact(spark):
    # Q14: two status labels carry U+00A0 in place of a space.
    assert "homemaker and\u00a0not working" in L.EMPLOY_STATUS["05"]
    assert "voluntary work and\u00a0not working" in L.EMPLOY_STATUS["07"]
    df = spark.createDataFrame([("05",), ("07",), ("99",), (None,)], "EmployStatus string")
    got = [r[0] for r in df.select(recode("EmployStatus", L.EMPLOY_STATUS)).collect()]
    assert got == [L.EMPLOY_STATUS["05"], L.EMPLOY_STATUS["07"], "Unspecified", "Unspecified"]
    # Q13: the leading space of the ethnicity group is kept.
    assert " Other Ethnic Groups" in L.ETHNICITY


def test_age_band_edges(spark):
    ages = [17, 18, 25, 26, 64, 65, None]
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    got = [r[0] for r in df.select(band("age", L.AGE_BANDS)).collect()]
    assert got == ["Under 18", "18-25", "18-25", "26-64", "26-64", "65+", "Unspecified"]


def test_days_open_band_edges(spark):
    end = dt.date(2001, 6, 30)
    days = [60, 61, 90, 91, 120, 121, -1]
    rows = [(1, end - dt.timedelta(days=d), end) for d in days]
    df = spark.createDataFrame(rows, "PathwayID long, LastDate date, ReportingPeriodEndDate date")
    flags = days_open_bands("LastDate", "Open", "", still_open="true")
    got = [tuple(r) for r in df.select(*[v.alias(k) for k, v in flags.items()]).collect()]
    assert got == [(1, 0, 0, 0), (0, 1, 0, 0), (0, 1, 0, 0), (0, 0, 1, 0), (0, 0, 1, 0), (0, 0, 0, 1),
                   (0, 0, 0, 0)]  # a date after the period end never counts


def test_coverage_band_null_zero_one_two(spark):
    df = spark.createDataFrame([(None,), (0,), (1,), (2,), (7,)], "n long")
    got = [r[0] for r in df.select(coverage_band("n")).collect()]
    assert got == [L.COVERAGE_NONE, L.COVERAGE_NONE, L.COVERAGE_ONE, L.COVERAGE_TWO_PLUS, L.COVERAGE_TWO_PLUS]


def test_boolean_like_flags_fold_case(spark):
    # Q3: 'True' and 'true' both count; anything else (and NULL) does not.
    df = spark.createDataFrame([("True",), ("true",), ("TRUE",), ("False",), (None,)], "f string")
    got = [r[0] for r in df.select(F.when(is_true("f"), 1).otherwise(0)).collect()]
    assert got == [1, 1, 1, 0, 0]


def test_ssp_not_stated_reads_sickness_absence(spark):
    # Q12: the 'Not stated' rule tests SickAbsenceInd, not SSPInd.
    df = spark.createDataFrame([("Y", "Z"), (None, "Z"), ("Z", "N"), (None, None)], "SSPInd string, SickAbsenceInd string")
    got = [r[0] for r in df.selectExpr(ssp_spec().sql()).collect()]
    assert got == [L.SSP_IND["Y"], L.SSP_NOT_STATED, "Unspecified", "Unspecified"]


def test_general_benefit_rollup(spark):
    labels = status_labels()
    df = spark.createDataFrame([("N", "Y", "N", "N"), ("N", "U", "Z", None), ("U", "U", None, None)],
                               "BenefitRecInd string, ESAInd string, PIPInd string, UCInd string")
    got = [r[0] for r in df.select(labels["GeneralBenefitReceived"]).collect()]
    assert got == [L.BENEFIT_RECEIVED, L.NO_BENEFIT_RECEIVED, L.BENEFIT_UNKNOWN]


def test_problem_descriptor_rules(spark):
    rows = [
        ("Depression", None, None, None),
        ("Anxiety and stress related disorders (Total)", "F401 - Social phobias", None, "x"),
        ("Anxiety and stress related disorders (Total)", "F402 - Specific (isolated) phobias", None, "x"),
        ("Anxiety and stress related disorders (Total)", None, None, "x"),
        (None, "zzz", "Anxiety and stress related disorders (Total)", "F42 - Obsessive-compulsive disorder"),
        ("Something else", None, None, None),
    ]
    df = spark.createDataFrame(rows, "PresentingComplaintHigherCategory string, PresentingComplaintLowerCategory string, "
                                     "PrimaryPresentingComplaint string, SecondaryPresentingComplaint string")
    got = [r[0] for r in df.select(problem_descriptor()).collect()]
    assert got == ["F32 or F33 - Depression", "F401 - Social Phobias", "F402 care- Specific Phobias", "No Code",
                   "F42 - Obsessive Compulsive", "Other"]


def test_in_period_flag_inclusive_and_needs_pathway(spark):
    s, e = dt.date(2001, 6, 1), dt.date(2001, 6, 30)
    rows = [(1, s), (1, e), (1, dt.date(2001, 7, 1)), (None, s), (1, None)]
    df = spark.createDataFrame([(p, d, s, e) for p, d in rows],
                               "PathwayID long, d date, ReportingPeriodStartDate date, ReportingPeriodEndDate date")
    got = [r[0] for r in df.select(in_period_flag("d")).collect()]
    assert got == [1, 1, 0, 0, 0]


def test_open_caseload(spark):
    s, e = dt.date(2001, 6, 1), dt.date(2001, 6, 30)
    rows = [(None, dt.date(2001, 6, 30)), (None, dt.date(2001, 7, 1)), (dt.date(2001, 6, 15), dt.date(2001, 1, 1)),
            (dt.date(2001, 7, 2), dt.date(2001, 1, 1))]
    df = spark.createDataFrame([(d, r, s, e) for d, r in rows], "ServDischDate date, ReferralRequestReceivedDate date, "
                                                                "ReportingPeriodStartDate date, ReportingPeriodEndDate date")
    assert [r[0] is True for r in df.select(open_caseload()).collect()] == [True, False, True, False]
