"""A survey-shaped table derived row by row from a lineitem table.

The survey pipeline needs one flat respondent table.  The test tables are an
order-line schema, so every survey column is a deterministic expression of one
lineitem row: no join, no shuffle, and nulls where the survey has gaps.
The DuckDB text of the same mapping lives in ``cohortlens.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlens import schema as S
from cohortlens.sqltext import ident, lit

# How the sleep answer is chosen from l_orderkey % 7.
SLEEP_ANSWERS = {
    0: "Less than 5 hours",
    1: "5-6 hours",
    2: " 7-8 Hours ",
    3: "More than 8 hours",
    5: None,
    6: "30-40 hours",
}
# l_orderkey % 7 == 4: "7" on even line numbers, "Others" on odd ones.
DIET_ANSWERS = ("Healthy", "Moderate", "Unhealthy")


def _sleep_case() -> str:
    whens = [f"WHEN {k} THEN {'NULL' if v is None else lit(v)}" for k, v in SLEEP_ANSWERS.items()]
    whens.append("WHEN 4 THEN CASE WHEN l_linenumber % 2 = 0 THEN '7' ELSE 'Others' END")
    return "CAST(CASE l_orderkey % 7 " + " ".join(whens) + " END AS STRING)"


def survey_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Map each lineitem row to one survey row with the 18 survey columns (one projection)."""
    diet = (
        f"CASE l_orderkey % 3 WHEN 0 THEN {lit(DIET_ANSWERS[0])} WHEN 1 THEN {lit(DIET_ANSWERS[1])} "
        f"ELSE {lit(DIET_ANSWERS[2])} END"
    )
    exprs = {
        S.ID: "l_orderkey * 8 + l_linenumber",
        S.GENDER: "CASE WHEN l_linestatus = 'O' THEN 'Male' ELSE 'Female' END",
        S.AGE: "nullif(l_quantity, CAST(13 AS DOUBLE))",
        S.CITY: "concat('City', CAST(l_suppkey % 7 AS STRING))",
        S.PROFESSION: "CASE WHEN l_partkey % 10 = 0 THEN CAST(NULL AS STRING) WHEN l_partkey % 3 = 0 THEN 'Intern' ELSE 'Student' END",
        S.ACADEMIC_PRESSURE: "CAST(l_orderkey % 6 AS DOUBLE)",
        S.WORK_PRESSURE: "CAST(l_partkey % 6 AS DOUBLE)",
        S.CGPA: "CAST(nullif(l_suppkey % 11, 10) AS DOUBLE)",
        S.STUDY_SATISFACTION: "CAST(l_partkey % 5 + 1 AS DOUBLE)",
        S.JOB_SATISFACTION: "CAST(l_suppkey % 5 + 1 AS DOUBLE)",
        S.SLEEP: _sleep_case(),
        S.DIET: diet,
        S.DEGREE: "concat('D', CAST(l_partkey % 5 AS STRING))",
        S.SUICIDAL: "CASE WHEN l_returnflag = 'A' THEN 'Yes' ELSE 'No' END",
        S.HOURS: "CAST(l_partkey % 12 AS DOUBLE)",
        S.FINANCIAL_STRESS: "CAST(l_linenumber + 1 AS DOUBLE)",
        S.FAMILY_HISTORY: "CASE WHEN l_suppkey % 2 = 0 THEN 'Yes' ELSE 'No' END",
        S.DEPRESSION: "CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INT)",
    }
    return lineitem.selectExpr(*[f"{e} AS {ident(name)}" for name, e in exprs.items()])


_LINEITEM_COLUMNS = [
    "l_orderkey",
    "l_partkey",
    "l_suppkey",
    "l_linenumber",
    "l_quantity",
    "l_returnflag",
    "l_linestatus",
]


def read_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey rows over ``<sf_dir>/lineitem.parquet`` (only the 7 needed columns are read)."""
    lineitem = spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet").select(*_LINEITEM_COLUMNS)
    return survey_from_lineitem(lineitem)
