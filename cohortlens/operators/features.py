"""Feature derivation: row-level indices and buckets, min-max scaling, one-hot columns."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from cohortlens import schema as S
from cohortlens.functions.columns import (
    AGE_INTERVALS,
    AGE_OTHERWISE,
    SLEEP_BOUNDS,
    SLEEP_LABELS,
    interval_bucket,
    mean_of,
    ordered_bucket,
)
from cohortlens.schema import require_columns, safe_col

# Inputs of the stress index and the columns that are scaled.
STRESS_INPUTS = (S.ACADEMIC_PRESSURE, S.WORK_PRESSURE, S.FINANCIAL_STRESS)
SCALED_COLUMNS = (S.CGPA, S.DEPRESSION, "stress_index")


def add_row_features(
    df: DataFrame,
    stress_inputs: Sequence[str] = STRESS_INPUTS,
    stress_weights: Sequence[float] | None = None,
    sleep: str = S.SLEEP,
    age: str = S.AGE,
    sleep_bounds: tuple[float, float] = SLEEP_BOUNDS,
    age_intervals=AGE_INTERVALS,
) -> DataFrame:
    """Add ``stress_index`` (mean of the stress inputs), ``sleep_category`` and ``age_group``."""
    require_columns(df, [*stress_inputs, sleep, age])
    return df.withColumns(
        {
            "stress_index": mean_of(list(stress_inputs), stress_weights),
            "sleep_category": ordered_bucket(sleep, sleep_bounds, SLEEP_LABELS),
            "age_group": interval_bucket(age, age_intervals, AGE_OTHERWISE),
        }
    )


def column_ranges(df: DataFrame, cols: Sequence[str]) -> Column:
    """Lazy scalar subquery holding min and max of every column (fields ``min{i}``, ``max{i}``).

    It is one global aggregate (partial per task, one final row), run once
    before the query that uses it; nothing is collected.
    """
    fields = []
    for i, c in enumerate(cols):
        x = safe_col(c).cast("double")  # the width of an integer range may not fit the integer type
        fields += [F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}")]
    return df.agg(F.struct(*fields).alias("ranges")).scalar()


def scaled(x: Column, lo: Column, hi: Column) -> Column:
    """``(x - lo) / (hi - lo)``; 0.0 for every row when lo equals hi or both are null.

    NaN bounds are never "equal", so a column holding NaN scales to NaN.
    """
    same = lo.eqNullSafe(hi) & ~F.coalesce(F.isnan(lo), F.lit(False))
    return F.when(same, F.lit(0.0)).otherwise((x - lo) / (hi - lo))


_RANGES = "__cohortlens_ranges"


class ObservedRanges:
    """Min and max of columns, gathered while some action runs over the observed table."""

    def __init__(self, cols: Sequence[str]):
        self.cols, self._seen = list(cols), Observation(f"ranges-{uuid.uuid4().hex}")

    def watch(self, df: DataFrame) -> DataFrame:
        """``df``, observed: the next action on it (a write) gathers the ranges on the way."""
        require_columns(df, self.cols)
        metrics = []
        for i, c in enumerate(self.cols):
            x = safe_col(c).cast("double")
            metrics += [F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}")]
        return df.observe(self._seen, *metrics)

    def get(self) -> dict[str, tuple[float | None, float | None]]:
        """Column → (min, max), null without values; waits for the action."""
        found = self._seen.get
        return {c: (found.get(f"min{i}"), found.get(f"max{i}")) for i, c in enumerate(self.cols)}


def minmax_scale(
    df: DataFrame,
    cols: Sequence[str] = SCALED_COLUMNS,
    suffix: str = "_normalized",
    ranges: Mapping[str, tuple[float | None, float | None]] | None = None,
) -> DataFrame:
    """Add ``<c><suffix>`` = min-max scaled ``c`` for each column, from one extra aggregate pass.

    The ranges are attached once as a struct column, so the plan holds the
    stats subquery once however many columns use it.  ``ranges`` (column →
    (min, max), as ``ObservedRanges`` gathers them while a table is written)
    saves that pass.
    """
    cols = list(cols)
    require_columns(df, cols)
    if ranges is not None:
        given = {c: [F.lit(v).cast("double") for v in ranges[c]] for c in cols}
        return df.withColumns({f"{c}{suffix}": scaled(safe_col(c).cast("double"), *given[c]) for c in cols})
    with_ranges = df.withColumn(_RANGES, column_ranges(df, cols))
    r = F.col(_RANGES)
    return with_ranges.withColumns(
        {
            f"{c}{suffix}": scaled(safe_col(c).cast("double"), r[f"min{i}"], r[f"max{i}"])
            for i, c in enumerate(cols)
        }
    ).drop(_RANGES)


def distinct_categories(df: DataFrame, col: str, max_categories: int = 1000) -> list:
    """Sorted distinct values of ``col`` (null last), read with a bounded result.

    Raises when there are more than ``max_categories`` values, so an
    unexpectedly wide column cannot flood the driver or the schema.
    """
    found = [r[0] for r in df.select(safe_col(col)).distinct().limit(max_categories + 1).collect()]
    if len(found) > max_categories:
        raise ValueError(f"{col!r} has more than {max_categories} distinct values; pass categories explicitly")
    return sorted((v for v in found if v is not None), key=str) + ([None] if None in found else [])


def one_hot(
    df: DataFrame,
    col: str,
    categories: Sequence | None = None,
    prefix: str | None = None,
    null_category: bool = False,
    max_categories: int = 1000,
) -> DataFrame:
    """Add one int 0/1 column ``<prefix>_<value>`` per category of ``col``.

    Categories are taken as given, or discovered with one bounded distinct
    query.  A null value matches no category (all zeros); the always-zero
    ``<prefix>_None`` column is only added with ``null_category=True``.
    Names that would collide, in any case, with each other or with a column of
    ``df`` raise.  ``max_categories`` bounds discovery only; for a column with
    more values give ``categories``.
    """
    require_columns(df, [col])
    prefix = col if prefix is None else prefix
    cats = list(categories) if categories is not None else distinct_categories(df, col, max_categories)
    if not null_category:
        cats = [c for c in cats if c is not None]
    names = [f"{prefix}_{c}" for c in cats]
    seen: dict[str, str] = {c.lower(): c for c in df.columns}
    for n in names:
        if n.lower() in seen:
            raise ValueError(f"one-hot columns {seen[n.lower()]!r} and {n!r} collide (names are case-insensitive)")
        seen[n.lower()] = n
    x = safe_col(col)
    return df.withColumns(
        {
            n: F.when(x == F.lit(c), F.lit(1)).otherwise(F.lit(0)) if c is not None else F.lit(0)
            for n, c in zip(names, cats)
        }
    )


def engineer_features(
    df: DataFrame,
    scale_columns: Sequence[str] = SCALED_COLUMNS,
    one_hot_column: str = S.GENDER,
    categories: Sequence | None = None,
    null_category: bool = False,
    ranges: Mapping[str, tuple[float | None, float | None]] | None = None,
) -> DataFrame:
    """All survey features: stress index, buckets, min-max scaled columns (by ``ranges`` if given) and one-hot gender."""
    out = add_row_features(df)
    out = minmax_scale(out, scale_columns, ranges=ranges)
    return one_hot(out, one_hot_column, categories=categories, null_category=null_category)
