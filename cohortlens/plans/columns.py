"""Column lists of the survey tables, shared by the query catalogue and its SQL checks."""

from cohortlens import schema as S

SURVEY_COLUMNS = [f.name for f in S.SURVEY_SCHEMA.fields]
STRING_COLUMNS = [S.GENDER, S.CITY, S.PROFESSION, S.DIET, S.DEGREE, S.SUICIDAL, S.FAMILY_HISTORY]
ROW_FEATURE_COLUMNS = ["stress_index", "sleep_category", "age_group"]
SCALED = ["CGPA_normalized", "Depression_normalized", "stress_index_normalized"]
# Categories of the survey's one-hot column; given, they need no discovery pass.
GENDERS = ["Female", "Male"]
GENDER_DUMMIES = ["Gender_Female", "Gender_Male"]
FEATURE_COLUMNS = SURVEY_COLUMNS + ROW_FEATURE_COLUMNS + SCALED + GENDER_DUMMIES

# Columns the survey's type rule (32-bit int or float) picks from the feature table.
SURVEY_NUMERIC_FEATURES = [S.SLEEP, S.DEPRESSION, *GENDER_DUMMIES]
# The same with the id, which the survey's own schema types as int.
SURVEY_NUMERIC_WITH_ID = [S.ID, *SURVEY_NUMERIC_FEATURES]
# Every numeric column of the feature table, in schema order.
ALL_NUMERIC_FEATURES = [
    S.ID,
    S.AGE,
    S.ACADEMIC_PRESSURE,
    S.WORK_PRESSURE,
    S.CGPA,
    S.STUDY_SATISFACTION,
    S.JOB_SATISFACTION,
    S.SLEEP,
    S.HOURS,
    S.FINANCIAL_STRESS,
    S.DEPRESSION,
    "stress_index",
    *SCALED,
    *GENDER_DUMMIES,
]
# Every numeric column of the cleaned table, in schema order.
ALL_NUMERIC_CLEAN = [c for c in ALL_NUMERIC_FEATURES if c in SURVEY_COLUMNS]
