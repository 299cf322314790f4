"""Declared survey schema and helpers for choosing columns by name or type."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names of the survey table (fixed values: they must equal the
# names of the input file's header for results to line up).
ID = "id"
GENDER = "Gender"
AGE = "Age"
CITY = "City"
PROFESSION = "Profession"
ACADEMIC_PRESSURE = "Academic Pressure"
WORK_PRESSURE = "Work Pressure"
CGPA = "CGPA"
STUDY_SATISFACTION = "Study Satisfaction"
JOB_SATISFACTION = "Job Satisfaction"
SLEEP = "Sleep Duration"
DIET = "Dietary Habits"
DEGREE = "Degree"
SUICIDAL = "Have you ever had suicidal thoughts ?"
HOURS = "Work/Study Hours"
FINANCIAL_STRESS = "Financial Stress"
FAMILY_HISTORY = "Family History of Mental Illness"
DEPRESSION = "Depression"

# Declared schema of the survey CSV: order matters, CSV columns bind by position.
SURVEY_SCHEMA = T.StructType(
    [
        T.StructField(ID, T.IntegerType(), True),
        T.StructField(GENDER, T.StringType(), True),
        T.StructField(AGE, T.DoubleType(), True),
        T.StructField(CITY, T.StringType(), True),
        T.StructField(PROFESSION, T.StringType(), True),
        T.StructField(ACADEMIC_PRESSURE, T.DoubleType(), True),
        T.StructField(WORK_PRESSURE, T.DoubleType(), True),
        T.StructField(CGPA, T.DoubleType(), True),
        T.StructField(STUDY_SATISFACTION, T.DoubleType(), True),
        T.StructField(JOB_SATISFACTION, T.DoubleType(), True),
        T.StructField(SLEEP, T.StringType(), True),
        T.StructField(DIET, T.StringType(), True),
        T.StructField(DEGREE, T.StringType(), True),
        T.StructField(SUICIDAL, T.StringType(), True),
        T.StructField(HOURS, T.DoubleType(), True),
        T.StructField(FINANCIAL_STRESS, T.DoubleType(), True),
        T.StructField(FAMILY_HISTORY, T.StringType(), True),
        T.StructField(DEPRESSION, T.IntegerType(), True),
    ]
)

_TYPE_NAMES = {
    "byte": T.ByteType,
    "short": T.ShortType,
    "int": T.IntegerType,
    "bigint": T.LongType,
    "float": T.FloatType,
    "double": T.DoubleType,
    "decimal": T.DecimalType,
}

# All numeric types; statistics of decimals are computed as doubles.
ALL_NUMERIC = ("byte", "short", "int", "bigint", "float", "double", "decimal")
# The survey code picks "numeric" columns as exactly 32-bit int or 32-bit
# float, so 64-bit doubles and bigints are skipped.
SURVEY_NUMERIC = ("int", "float")


def safe_col(name: str) -> Column:
    """Column by exact name, even when it contains dots, spaces or `?`."""
    return F.col("`" + name.replace("`", "``") + "`")


def columns_of_types(df: DataFrame, types: Iterable[str] = ALL_NUMERIC) -> list[str]:
    """Names of top-level columns whose type is one of ``types``, in schema order."""
    wanted = tuple(_TYPE_NAMES[t] for t in types)
    return [f.name for f in df.schema.fields if type(f.dataType) in wanted]


def require_columns(df: DataFrame, names: Sequence[str]) -> None:
    """Raise early (at plan time) with a readable message when columns are missing."""
    have = set(df.columns)
    missing = [n for n in names if n not in have]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
