"""Grouped summaries of the feature table.

Every summary is one hash aggregate: partial aggregation in each task, then a
shuffle of at most (tasks × groups) partial rows, so a group holding a third
of all rows costs no more than any other group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens import schema as S
from cohortlens.schema import require_columns, safe_col

_AGGS = {
    "avg": F.avg,
    "mean": F.avg,
    "stddev": F.stddev_samp,
    "stddev_samp": F.stddev_samp,
    "stddev_pop": F.stddev_pop,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "count": F.count,
}


def summarize(df: DataFrame, keys: Sequence[str], measures: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``groupBy(keys)`` with named measures ``{out_name: (function, column)}``.

    ``("count", "*")`` counts rows.  Null keys form their own group.
    """
    require_columns(df, list(keys))
    exprs = []
    for out, (fn, col) in measures.items():
        if fn not in _AGGS:
            raise ValueError(f"unknown aggregate {fn!r}; use one of {sorted(_AGGS)}")
        if fn == "count" and col == "*":
            exprs.append(F.count(F.lit(1)).alias(out))
        else:
            exprs.append(_AGGS[fn](safe_col(col)).alias(out))
    return df.groupBy(*[safe_col(k) for k in keys]).agg(*exprs)


# Output name, keys and measures of the five survey summaries.
SURVEY_SUMMARIES = (
    ("depression_by_demographics", ("age_group", S.PROFESSION), {"avg_depression": ("avg", S.DEPRESSION)}),
    ("academic_performance", ("sleep_category",), {"avg_cgpa": ("avg", S.CGPA), "stddev_cgpa": ("stddev", S.CGPA)}),
    (
        "city_degree_stats",
        (S.CITY, S.DEGREE),
        {"avg_depression": ("avg", S.DEPRESSION), "count_students": ("count", "*")},
    ),
    ("demographic_stress", ("age_group", S.GENDER), {"avg_stress_index": ("avg", "stress_index")}),
    (
        "sleep_performance",
        ("sleep_category",),
        {"avg_cgpa": ("avg", S.CGPA), "avg_academic_score": ("avg", S.ACADEMIC_PRESSURE)},
    ),
)


_SPECS = {name: (keys, measures) for name, keys, measures in SURVEY_SUMMARIES}


def _survey_summary(df: DataFrame, name: str) -> DataFrame:
    return summarize(df, *_SPECS[name])


def depression_by_demographics(df: DataFrame) -> DataFrame:
    """Average depression per (age group, profession)."""
    return _survey_summary(df, "depression_by_demographics")


def cgpa_by_sleep(df: DataFrame) -> DataFrame:
    """Average and sample standard deviation of CGPA per sleep category."""
    return _survey_summary(df, "academic_performance")


def city_degree_stats(df: DataFrame) -> DataFrame:
    """Average depression and row count per (city, degree)."""
    return _survey_summary(df, "city_degree_stats")


def stress_by_demographics(df: DataFrame) -> DataFrame:
    """Average stress index per (age group, gender)."""
    return _survey_summary(df, "demographic_stress")


def sleep_performance(df: DataFrame) -> DataFrame:
    """Average CGPA and average academic pressure per sleep category."""
    return _survey_summary(df, "sleep_performance")


def distribution_analysis(df: DataFrame) -> dict[str, DataFrame]:
    return {name: _survey_summary(df, name) for name in ("depression_by_demographics", "academic_performance")}


def aggregations(df: DataFrame) -> dict[str, DataFrame]:
    return {name: _survey_summary(df, name) for name in ("city_degree_stats", "demographic_stress", "sleep_performance")}


def combined_summaries(df: DataFrame, specs=SURVEY_SUMMARIES) -> DataFrame:
    """All summaries of ``specs`` from one scan: a grouping-sets aggregate.

    Rows carry ``grouping_id`` (which key set they belong to); measures of all
    specs are computed for every set and picked apart by ``split_summaries``.
    Materialize the (small) result once before splitting it.
    """
    keys: list[str] = []
    for _, ks, _ in specs:
        keys += [k for k in ks if k not in keys]
    measures: dict[str, Column] = {}
    for _, _, ms in specs:
        for fn, col in ms.values():
            name = f"{fn}({col})"
            if name not in measures:
                expr = F.count(F.lit(1)) if (fn, col) == ("count", "*") else _AGGS[fn](safe_col(col))
                measures[name] = expr.alias(name)
    unique_sets = list(dict.fromkeys(tuple(ks) for _, ks, _ in specs))
    sets = [[safe_col(k) for k in ks] for ks in unique_sets]
    grouped = df.groupingSets(sets, *[safe_col(k) for k in keys])
    return grouped.agg(*measures.values(), F.grouping_id().alias("grouping_id"))


def split_summaries(combined: DataFrame, specs=SURVEY_SUMMARIES) -> dict[str, DataFrame]:
    """Named summaries out of a ``combined_summaries`` result (small; no further scans of the data)."""
    keys: list[str] = []
    for _, ks, _ in specs:
        keys += [k for k in ks if k not in keys]
    out = {}
    for name, ks, ms in specs:
        # grouping_id bit i (from the left, most significant first) is 1 when key i is aggregated away.
        gid = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in ks)
        rows = combined.where(F.col("grouping_id") == gid)
        out[name] = rows.select(*[safe_col(k) for k in ks], *[F.col(f"`{fn}({col})`").alias(m) for m, (fn, col) in ms.items()])
    return out
