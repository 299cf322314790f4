"""Row cleaning: required fields, sleep text to number, range checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens import schema as S
from cohortlens.functions.text import text_range_to_number, try_float
from cohortlens.operators.answers import parse_once
from cohortlens.schema import require_columns, safe_col


def drop_null_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with a null, or a floating NaN, in any of ``subset``; the null tests reach a Parquet scan."""
    require_columns(df, subset)
    types = dict(df.dtypes)
    for c in subset:
        df = df.where(safe_col(c).isNotNull())
        if types[c] in ("float", "double"):
            df = df.where(~F.isnan(safe_col(c)))
    return df


def clean_survey(
    df: DataFrame,
    mode: str = "ranges",
    sleep: str = S.SLEEP,
    age: str = S.AGE,
    sleep_range: tuple[float, float] = (0.0, 24.0),
    min_age: float = 0.0,
    max_answers: int | None = None,
) -> DataFrame:
    """Clean survey rows.

    1. drop rows where ``sleep`` or ``age`` is null;
    2. replace ``sleep`` by a float: ``mode="ranges"`` parses answers such as
       ``"5-6 hours"`` (``text_range_to_number``), ``mode="numeric"`` casts
       the text (``"7"`` → 7.0, anything else null);
    3. keep ``lo <= sleep <= hi`` (null and NaN are dropped) and ``age > min_age``.

    The null and age tests reach the Parquet/CSV scan as pushed filters.  Ranges
    are parsed once per distinct answer (``parse_once``, which reads the column
    when this is called; ``max_answers=0`` parses with each row and reads
    nothing); only the range test runs after the parse.
    """
    require_columns(df, [sleep, age])
    if mode not in ("ranges", "numeric"):
        raise ValueError(f"mode must be 'ranges' or 'numeric', not {mode!r}")
    lo, hi = sleep_range
    base = drop_null_rows(df, [sleep, age]).where(safe_col(age) > F.lit(min_age))
    if mode == "numeric":
        bound = bind_once(base, try_float(sleep), _PARSED)
    elif max_answers == 0:
        bound = bind_once(base, text_range_to_number(sleep), _PARSED)
    else:
        bound = bind_once(parse_once(base, sleep, text_range_to_number, _ANSWER, max_answers), F.col(_ANSWER), _PARSED)
    kept = bound.where((F.col(_PARSED) >= F.lit(lo)) & (F.col(_PARSED) <= F.lit(hi)))
    return kept.select(*[F.col(_PARSED).alias(c) if c == sleep else safe_col(c) for c in df.columns])


_PARSED = "__cohortlens_parsed"
_ANSWER = "__cohortlens_answered"


def bind_once(df: DataFrame, value: Column, name: str) -> DataFrame:
    """Add ``value`` as column ``name``, evaluated exactly once per row.

    A filter on a plain projected column is pushed below the projection by
    copying the expression into the filter, so an expensive expression runs
    once per use.  The value is computed in a projection (where generated
    code shares common subexpressions) and passed through a one-element
    ``explode``: predicates on the generator's output stay above it, while
    predicates on other columns still reach the scan.  It also keeps a join's
    lookup and the range test out of one generated method, which with many
    computed columns grows beyond what the JVM compiles.
    """
    computed = df.withColumn(name, value)
    others = [safe_col(c) for c in df.columns if c != name]
    return computed.select(*others, F.explode(F.array(F.col(name))).alias(name))
