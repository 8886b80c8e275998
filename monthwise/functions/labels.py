"""Code -> label maps used by the recodes.

FIXED VALUES.  Every code and label below must equal the published dashboard
text byte for byte, including its quirks: the two employment-status labels
contain U+00A0 (written ``\\u00a0``) in place of a space, ethnicity group
``' Other Ethnic Groups'`` starts with a space, and several problem-descriptor
labels differ from their source code text.  Each map is listed in the order
its rules are tried; the first match wins.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: single-column maps (code -> label), default 'Unspecified'.
# ---------------------------------------------------------------------------
UNSPECIFIED = "Unspecified"

EMPLOY_STATUS = {
    "01": "Employed",
    "02": "Unemployed and actively seeking work",
    "03": "Undertaking full (at least 16 hours per week) or part-time (less than 16 hours per week) "
          "education or training as a student and not working or actively seeking work",
    "04": "Long-term sick or disabled, those receiving government sickness and disability benefits",
    "05": "Looking after the family or home as a homemaker and\u00a0not working or actively seeking work",
    "06": "Not receiving government sickness and disability benefits and not working or actively seeking work",
    "07": "Unpaid voluntary work and\u00a0not working or actively seeking work",
    "08": "Retired",
    "ZZ": "Not Stated (Person asked but declined to provide a response)",
}

WEEK_HOURS_WORKED = {
    "01": "30+ hours",
    "02": "16-29 hours",
    "03": "5-15 hours",
    "04": "1-4 hours",
    "97": "Not Stated (Person asked but declined to provide a response)",
    "98": "Not applicable (Person not employed)",
    "99": "Number of hours worked not known",
}

SELF_EMPLOY_IND = {
    "Y": "Yes - Employed as a self-employed worker",
    "N": "No - Not self employed",
    "8": "Not Applicable (Person is unemployed)",
    "Z": "Not Stated (Person asked but declined to provide a response)",
    "X": "Not Known (Not Recorded)",
}

SICK_ABSENCE_IND = {
    "Y": "Yes - a person in employment is currently unable to work due to sickness",
    "N": "No - a person in employment is not currently unable to work due to sickness",
    "8": "Not Applicable (Person is unemployed)",
    "Z": "Not Stated (Person asked but declined to provide a response)",
    "X": "Not Known (Not Recorded)",
}

# Statutory sick pay: the fourth rule tests the sickness-absence column, not
# the sick-pay column (kept as published).
SSP_IND = {
    "Y": "Yes - the person is currently in receipt of Statutory Sick Pay",
    "N": "No - the person is currently not in receipt of Statutory Sick Pay",
    "U": "Unknown (Person asked and does not know or is not sure)",
}
SSP_NOT_STATED_SICK_ABSENCE_CODE = "Z"
SSP_NOT_STATED = "Not stated (Person asked but declined to provide a response)"

BENEFIT_REC_IND = {
    "Y": "Yes - the patient is currently in receipt of a benefit",
    "N": "No - the patient is not currently in receipt of a benefit",
    "U": "Unknown (Patient asked and does not know or is not sure)",
    "Z": "Not stated (Patient asked but declined to provide a response)",
}

ESA_IND = {
    "Y": "Yes - receiving Employment and Support Allowance",
    "N": "No - not receiving Employment and Support Allowance",
    "U": "Unknown (Patient asked and does not know or is not sure)",
    "Z": "Not stated (Patient asked but declined to provide a response)",
}

UC_IND = {
    "Y": "Yes - receiving Universal Credit",
    "N": "No - not receiving Universal Credit",
    "U": "Unknown (Patient asked and does not know or is not sure)",
    "Z": "Not stated (Patient asked but declined to provide a response)",
}

PIP_IND = {
    "Y": "Yes - receiving Personal Independence Payment",
    "N": "No - not receiving Personal Independence Payment",
    "U": "Unknown (Patient asked and does not know or is not sure)",
    "Z": "Not stated (Patient asked but declined to provide a response)",
}

EMP_SUPPORT_IND = {
    "Y": "Yes - the patient is a suitable candidate for referral to Employment Support",
    "N": "No - the patient is not a suitable candidate for referral to Employment Support",
    "NA": "Not Applicable",
}

# Any-benefit roll-up over BenefitRecInd, ESAInd, PIPInd, UCInd.
BENEFIT_RECEIVED = "Benefit Received"
NO_BENEFIT_RECEIVED = "No Benefit Received"
BENEFIT_UNKNOWN = "Unknown/Not Stated If Benefit Received"

# ---------------------------------------------------------------------------
# FIXED VALUES: code-list maps (label -> codes), default 'Unspecified'.
# ---------------------------------------------------------------------------
GENDER = {
    "Male": ["1", "01"],
    "Female": ["2", "02"],
    "Indeterminate": ["9", "09"],
    "Not Known": ["x", "X"],
}

ETHNICITY = {
    "White": ["A", "B", "C"],
    "Mixed": ["D", "E", "F", "G"],
    "Asian or Asian British": ["H", "J", "K", "L"],
    "Black or Black British": ["M", "N", "P"],
    " Other Ethnic Groups": ["R", "S"],
    "Not known/Not stated/Unspecified/Invalid data supplied": ["99", "Z", "-1", "-3"],
}

GENDER_IDENTITY = {
    "Male (including trans man)": ["1", "01"],
    "Female (including trans woman)": ["2", "02"],
    "Non-binary": ["3", "03"],
    "Other (not listed)": ["4", "04"],
    "Not Known": ["x", "X"],
    "Not Stated": ["z", "Z"],
}

SEXUAL_ORIENTATION = {
    "20430005": "Heterosexual",
    "89217008": "Homosexual (Female)",
    "76102007": "Homosexual (Male)",
    "38628009": "Homosexual (Gender not specified)",
    "42035005": "Bisexual",
    "1064711000000100": "Person asked and does not know or IS not sure",
    "699042003": "Declined",
    "765288000": "Sexually attracted to neither male nor female sex",
    "440583007": "Unknown",
    "766822004": "Confusion",
}

# Sexual-orientation codes by preference tier (1 = most informative).
SEXUAL_ORIENTATION_TIERS = [
    ["20430005", "89217008", "76102007", "42035005", "765288000", "766822004"],
    ["38628009"],
    ["1064711000000100", "699042003", "440583007"],
]

# ---------------------------------------------------------------------------
# FIXED VALUES: age bands (inclusive edges), default 'Unspecified'.
# ---------------------------------------------------------------------------
AGE_BANDS = [
    (None, 17, "Under 18"),
    (18, 25, "18-25"),
    (26, 64, "26-64"),
    (65, None, "65+"),
]

# ---------------------------------------------------------------------------
# FIXED VALUES: problem descriptor.  Higher-category rules are tried first
# (matched on the higher category or the primary complaint), then the anxiety
# rules (higher category or primary complaint is ANXIETY, and lower category or
# secondary complaint matches), then 'No Code', else 'Other'.
# ---------------------------------------------------------------------------
PROBLEM_HIGHER = [
    ("Depression", "F32 or F33 - Depression"),
    ("Unspecified", "Unspecified"),
    ("Other recorded problems", "Other recorded problems"),
    ("Other Mental Health problems", "Other Mental Health problems"),
    ("Invalid Data supplied", "Invalid Data supplied"),
]
ANXIETY = "Anxiety and stress related disorders (Total)"
PROBLEM_ANXIETY_LOWER = [
    ("83482000 Body Dysmorphic Disorder", "83482000 Body Dysmorphic Disorder"),
    ("F400 - Agoraphobia", "F400 - Agoraphobia"),
    ("F401 - Social phobias", "F401 - Social Phobias"),
    ("F402 - Specific (isolated) phobias", "F402 care- Specific Phobias"),
    ("F410 - Panic disorder [episodic paroxysmal anxiety", "F410 - Panic Disorder"),
    ("F411 - Generalised Anxiety Disorder", "F411 - Generalised Anxiety"),
    ("F412 - Mixed anxiety and depressive disorder", "F412 - Mixed Anxiety"),
    ("F42 - Obsessive-compulsive disorder", "F42 - Obsessive Compulsive"),
    ("F431 - Post-traumatic stress disorder", "F431 - Post-traumatic Stress"),
    ("F452 Hypochondriacal Disorders", "F452 - Hypochondrial disorder"),
    ("Other F40-F43 code", "Other F40 to 43 - Other Anxiety"),
]
PROBLEM_NO_CODE = "No Code"
PROBLEM_OTHER = "Other"

# ---------------------------------------------------------------------------
# FIXED VALUES: assessment-count bands (presenteeism coverage).
# ---------------------------------------------------------------------------
COVERAGE_NONE = "No Presenteeism Assessments"
COVERAGE_ONE = "One Presenteeism Assessment"
COVERAGE_TWO_PLUS = "Two Or More Presenteeism Assessments"

# Presenteeism questions 7, 8 and 9 (coded assessment tool types).
PRESENTEEISM_QUESTIONS = ["748161000000109", "760741000000102", "761051000000105"]

# Qualifying care-activity code for support contacts.
SUPPORT_ACTIVITY_CODE = "1098051000000103"

# Organisation-level constants.
OTHER = "Other"
NATIONAL = ("National", "All Regions", "ENG", "England")
