"""Data-quality profile: null counts, typed describe, value counts — each one pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.schema import ALL_NUMERIC, SURVEY_NUMERIC, columns_of_types, safe_col
from cohortlens.sqltext import ident, lit


def _long_form(row_df: DataFrame, structs: list[str]) -> DataFrame:
    """Unpivot a one-row aggregate into rows with ``inline`` (no shuffle)."""
    return row_df.selectExpr(f"inline(array({', '.join(structs)}))")


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, n_null) for every column, computed in a single aggregate."""
    cols = list(columns or df.columns)
    agg = df.selectExpr(*[f"count_if({ident(c)} IS NULL) AS n{i}" for i, c in enumerate(cols)])
    return _long_form(agg, [f"named_struct('column', {lit(c)}, 'n_null', n{i})" for i, c in enumerate(cols)])


def _numeric_stats(i: int, c: str) -> list[str]:
    x = f"CAST({ident(c)} AS DOUBLE)"
    return [
        f"count({x}) AS c{i}",
        f"avg({x}) AS a{i}",
        f"stddev_samp({x}) AS s{i}",
        f"min({x}) AS lo{i}",
        f"max({x}) AS hi{i}",
    ]


def _numeric_struct(i: int, c: str, n_null: bool = False) -> str:
    nn = f"'n_null', n{i}, " if n_null else ""
    return (
        f"named_struct('column', {lit(c)}, {nn}'count', c{i}, 'mean', a{i}, 'stddev', s{i}, "
        f"'min', lo{i}, 'max', hi{i})"
    )


def describe_numeric(
    df: DataFrame, columns: Sequence[str] | None = None, types: Sequence[str] = SURVEY_NUMERIC
) -> DataFrame:
    """Typed ``describe``: (column, count, mean, stddev, min, max) as numbers, one pass.

    By default only 32-bit int and float columns are described, as the survey
    report does; pass ``types=ALL_NUMERIC`` or ``columns`` to widen it.
    Sample standard deviation; null for fewer than two values.
    """
    cols = list(columns) if columns is not None else columns_of_types(df, types)
    if not cols:
        return df.sparkSession.createDataFrame(
            [], "column string, count bigint, mean double, stddev double, min double, max double"
        )
    agg = df.selectExpr(*[e for i, c in enumerate(cols) for e in _numeric_stats(i, c)])
    return _long_form(agg, [_numeric_struct(i, c) for i, c in enumerate(cols)])


def quality_profile(df: DataFrame, types: Sequence[str] = ALL_NUMERIC) -> DataFrame:
    """Null counts for every column plus numeric stats for numeric ones, from one scan.

    Rows: (column, n_null, count, mean, stddev, min, max); the stats are null
    for non-numeric columns.
    """
    numeric = set(columns_of_types(df, types))
    aggs, structs = [], []
    for i, c in enumerate(df.columns):
        aggs.append(f"count_if({ident(c)} IS NULL) AS n{i}")
        if c in numeric:
            aggs.extend(_numeric_stats(i, c))
            structs.append(_numeric_struct(i, c, n_null=True))
        else:
            structs.append(
                f"named_struct('column', {lit(c)}, 'n_null', n{i}, 'count', CAST(NULL AS BIGINT), "
                "'mean', CAST(NULL AS DOUBLE), 'stddev', CAST(NULL AS DOUBLE), "
                "'min', CAST(NULL AS DOUBLE), 'max', CAST(NULL AS DOUBLE))"
            )
    return _long_form(df.selectExpr(*aggs), structs)


def value_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, value, count) for the given columns (default: every string column).

    All columns are counted in one shuffle: rows are expanded to
    (column, value) pairs and partially aggregated before the exchange, so a
    hot value costs one partial row per task.  Null values form their own group.
    """
    cols = list(columns) if columns is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)
    ]
    if not cols:
        return df.sparkSession.createDataFrame([], "column string, value string, count bigint")
    pairs = df.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), safe_col(c).cast("string").alias("value")) for c in cols])
        ).alias("p")
    ).select("p.column", "p.value")
    return pairs.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
