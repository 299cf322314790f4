"""Edge-case columns derived row by row from lineitem, for queries on the branches the survey view never reaches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NAN = "CAST('NaN' AS DOUBLE)"

# Answer texts around two numbers a and b, and the number each
# text means as SQL over a and b (NULL: none).  Valid in Spark and DuckDB.
ANSWERS: tuple[tuple[str, str], ...] = (
    ("{a}-{b} hours", "(a + b) / 2.0"),
    (" {a}-{b} Hours ", "(a + b) / 2.0"),
    ("\t{a}-{b} HOURS\n", "(a + b) / 2.0"),
    ("{a} - {b} hours", "(a + b) / 2.0"),
    ("{a} hours-{b} hours", "(a + b) / 2.0"),
    ("{a}-{b}", "(a + b) / 2.0"),
    ("{a}.5-{b}.25 hours", "(a + 0.5 + b + 0.25) / 2.0"),
    ("{a}.-.5 hours", "(a + 0.5) / 2.0"),
    ("+{a}-{b} hours", "(a + b) / 2.0"),
    ("{a}e1-{b} hours", "(a * 10 + b) / 2.0"),
    ("{a}_0-{b} hours", "(a * 10 + b) / 2.0"),
    ("00{a}-0{b}", "(a + b) / 2.0"),
    ("LESS than 5 hours", "4.0"),
    (" More than 8 hours\t", "9.0"),
    ("{a}-{b}-{a} hours", "NULL"),
    ("{a}--{b} hours", "NULL"),
    ("-{a} hours", "NULL"),
    ("{a}-", "NULL"),
    ("-", "NULL"),
    ("", "NULL"),
    ("{a}", "NULL"),
    ("{a}-x hours", "NULL"),
    ("{a}d-{b} hours", "NULL"),
    ("{a}__0-{b} hours", "NULL"),
    ("about {a}-{b} hours", "NULL"),
    ("less than {b}", "NULL"),
)


def answers(lineitem: DataFrame) -> DataFrame:
    """(id, raw): one of ANSWERS for every row, its numbers taken from the row."""
    texts = F.array(*[F.lit(text) for text, _ in ANSWERS])
    raw = texts[F.pmod(F.col("l_orderkey") + F.col("l_partkey"), F.lit(len(ANSWERS))).cast("int")]
    raw = F.replace(raw, F.lit("{a}"), F.col("l_linenumber").cast("string"))
    raw = F.replace(raw, F.lit("{b}"), (F.col("l_partkey") % 50).cast("string"))
    return lineitem.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("id"), raw.alias("raw"))


# SQL that both engines read: constant, missing, NaN, wide and masked columns.
CONSTANT = {"flat": "CAST(0.1 AS DOUBLE)", "part": "CAST(l_partkey % 97 AS DOUBLE)", "quantity": "CAST(l_quantity AS DOUBLE)"}
MASKED = {
    "a": "CAST(l_partkey % 97 AS DOUBLE)",
    "b": "CASE WHEN l_linenumber = 3 THEN NULL ELSE CAST(l_partkey % 97 * 2 + l_suppkey % 5 AS DOUBLE) END",
    "outlier": "CASE WHEN l_linenumber = 3 THEN CAST(1000000000 AS DOUBLE) ELSE CAST(l_partkey % 97 + l_suppkey % 3 AS DOUBLE) END",
    "not_number": f"CASE WHEN l_linenumber = 3 THEN {NAN} ELSE CAST(l_quantity AS DOUBLE) END",
    "nothing": "CAST(NULL AS DOUBLE)",
}
RANGES = {
    "flat": "CAST(7 AS INTEGER)",
    "nothing": "CAST(NULL AS DOUBLE)",
    "not_number": f"CASE WHEN l_linenumber = 3 THEN {NAN} ELSE CAST(l_quantity AS DOUBLE) END",
    "wide": "CAST(CASE l_linenumber WHEN 1 THEN -2000000000 WHEN 2 THEN 2000000000 ELSE l_linenumber END AS INTEGER)",
}
# A column of few values with a gap, one that grows with the table and has a value of two sevenths of the rows.
CATEGORIES = {
    "status": "CASE WHEN l_linenumber = 5 THEN NULL ELSE l_returnflag END",
    "part": "CASE WHEN l_linenumber <= 2 THEN 'none' ELSE CAST(l_partkey AS STRING) END",
    "order_no": "CAST(l_orderkey AS STRING)",
}


def columns_sql(columns: dict[str, str]) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in columns.items()]


def view(lineitem: DataFrame, columns: dict[str, str]) -> DataFrame:
    return lineitem.selectExpr("l_orderkey * 8 + l_linenumber AS id", *columns_sql(columns))
