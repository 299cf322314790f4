"""Operators: functions from DataFrame to DataFrame (or to named DataFrames)."""

from cohortlens.operators.answers import distinct_answers, parse_once
from cohortlens.operators.clean import clean_survey, drop_null_rows
from cohortlens.operators.correlate import correlation_analysis, correlation_matrix, correlation_pairs, strongest_with
from cohortlens.operators.distributions import gaussian_kde, histogram
from cohortlens.operators.features import (
    ObservedRanges,
    add_row_features,
    distinct_categories,
    engineer_features,
    minmax_scale,
    one_hot,
)
from cohortlens.operators.flags import count_rows, high_risk, risk_rules, with_risk_reasons
from cohortlens.operators.indicators import category_index, sparse_one_hot, top_values
from cohortlens.operators.profile import describe_numeric, null_counts, quality_profile, value_counts
from cohortlens.operators.summaries import (
    aggregations,
    cgpa_by_sleep,
    city_degree_stats,
    depression_by_demographics,
    distribution_analysis,
    sleep_performance,
    stress_by_demographics,
    summarize,
)

__all__ = [
    "ObservedRanges",
    "add_row_features",
    "aggregations",
    "category_index",
    "cgpa_by_sleep",
    "city_degree_stats",
    "clean_survey",
    "correlation_analysis",
    "correlation_matrix",
    "correlation_pairs",
    "count_rows",
    "depression_by_demographics",
    "describe_numeric",
    "distinct_answers",
    "distinct_categories",
    "distribution_analysis",
    "drop_null_rows",
    "engineer_features",
    "gaussian_kde",
    "high_risk",
    "histogram",
    "minmax_scale",
    "null_counts",
    "one_hot",
    "parse_once",
    "quality_profile",
    "risk_rules",
    "sleep_performance",
    "sparse_one_hot",
    "strongest_with",
    "stress_by_demographics",
    "summarize",
    "top_values",
    "value_counts",
    "with_risk_reasons",
]
