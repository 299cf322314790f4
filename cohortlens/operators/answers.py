"""Parsing each distinct answer of a text column once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.schema import require_columns, safe_col

#: Distinct answers that are parsed apart from their rows, and bytes of one: together they bound what is broadcast (64 MB).
MAX_ANSWERS = 1 << 18
ANSWER_BYTES = 256
_ANSWER = "__cohortlens_answer"


def distinct_answers(df: DataFrame, column: str, max_answers: int | None = None) -> tuple[list[str], bool] | None:
    """The distinct answers of at most ANSWER_BYTES bytes, and whether there are longer ones; None above ``max_answers`` (default MAX_ANSWERS).

    One scan of the column with partial aggregation; nulls are left out.
    """
    most = MAX_ANSWERS if max_answers is None else max_answers
    text = safe_col(column)
    short = F.when(F.octet_length(text) <= ANSWER_BYTES, text)  # null stands for all longer ones
    found = df.where(text.isNotNull()).select(short.alias(_ANSWER)).distinct().limit(most + 2).collect()
    answers = [r[0] for r in found if r[0] is not None]
    return None if len(answers) > most else (answers, len(answers) < len(found))


def parse_once(
    df: DataFrame, column: str, parse: Callable[[Column], Column], name: str, max_answers: int | None = None
) -> DataFrame:
    """``df`` with ``name`` = ``parse(column)``, the distinct answers parsed once and looked up by a broadcast join.

    Survey answers repeat: a table has few distinct ones however many rows it
    has.  They are gathered by one job over the column alone when this is
    called; longer ones than ANSWER_BYTES are parsed with their row.  Above
    ``max_answers`` distinct answers every row is parsed where it is, without a
    join, so free text shuffles nothing and a hot answer never meets its copies.
    The result is the same in all cases.  ``parse`` must give null for null.
    """
    require_columns(df, [column])
    known = distinct_answers(df, column, max_answers)
    others = [safe_col(c) for c in df.columns if c != name]
    if known is None:
        return df.select(*others, parse(safe_col(column)).alias(name))
    answers, longer = known
    spark = df.sparkSession
    table = spark.createDataFrame([(a,) for a in answers], f"{_ANSWER} string").select(
        _ANSWER, parse(F.col(_ANSWER)).alias(_PARSED)
    )
    value = F.col(_PARSED)
    if longer:
        value = F.when(F.octet_length(safe_col(column)) > ANSWER_BYTES, parse(safe_col(column))).otherwise(value)
    joined = df.join(F.broadcast(table), safe_col(column) == F.col(_ANSWER), "left")
    return joined.select(*others, value.alias(name))


_PARSED = "__cohortlens_answer_value"
