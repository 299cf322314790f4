"""Named queries over the test tables: each runs one operator (or a short chain) end to end.

Every query reads ``lineitem`` under ``sf_dir`` through the survey view, so
its work grows with the table.  Floating results that depend on summation
order are rounded to 9 digits so they compare equal with the SQL check.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens import schema as S
from cohortlens.operators import (
    add_row_features,
    category_index,
    cgpa_by_sleep,
    city_degree_stats,
    clean_survey,
    correlation_matrix,
    correlation_pairs,
    count_rows,
    depression_by_demographics,
    describe_numeric,
    engineer_features,
    gaussian_kde,
    high_risk,
    histogram,
    minmax_scale,
    null_counts,
    one_hot,
    parse_once,
    quality_profile,
    sleep_performance,
    sparse_one_hot,
    strongest_with,
    stress_by_demographics,
    top_values,
    value_counts,
    with_risk_reasons,
)
from cohortlens.functions import text_range_to_number
from cohortlens.operators.summaries import SURVEY_SUMMARIES
from cohortlens.plans import columns as C
from cohortlens.plans import edge_views as E
from cohortlens.plans.survey_job import run_survey_job
from cohortlens.schema import ALL_NUMERIC, safe_col
from cohortlens.session import scratch_path
from cohortlens.sources import materialize, preview, published, read_csv, read_csv_inferred, read_survey, write_csv, write_parquet

DIGITS = 9
# Profile statistics cover columns up to ~1e6 in magnitude (ids), where
# summation order already shows in the 9th decimal.
STAT_DIGITS = 6
Query = Callable[[SparkSession, str], DataFrame]


def _round(df: DataFrame, cols: list[str], digits: int = DIGITS) -> DataFrame:
    return df.withColumns({c: F.round(safe_col(c), digits) for c in cols})


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_survey(spark, sf_dir)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_survey(survey(spark, sf_dir))


def row_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return add_row_features(cleaned(spark, sf_dir))


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Ranges and rows each scan the columns they need; row expressions are cheaper than a copy.
    return engineer_features(cleaned(spark, sf_dir), categories=C.GENDERS)


def stress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with the scaled stress index, all that the risk rules need."""
    return minmax_scale(row_features(spark, sf_dir), ["stress_index"])


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return high_risk(features(spark, sf_dir))


def flagged_stress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaled stress of the flagged rows, written once (one column) for summaries that read it twice."""
    return materialize(high_risk(stress(spark, sf_dir)).select("stress_index_normalized"), "risk-stress")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/lineitem.parquet")


def q_survey_load(spark, sf_dir):
    return survey(spark, sf_dir)


def q_text_range_parse(spark, sf_dir):
    s = survey(spark, sf_dir)
    raw = s.select(S.ID, safe_col(S.SLEEP).alias("raw_sleep"))
    return parse_once(raw, "raw_sleep", text_range_to_number, "parsed_sleep")


def q_clean_ranges(spark, sf_dir):
    return cleaned(spark, sf_dir)


def q_clean_numeric(spark, sf_dir):
    return clean_survey(survey(spark, sf_dir), mode="numeric")


def q_row_features(spark, sf_dir):
    return row_features(spark, sf_dir).select(S.ID, *C.ROW_FEATURE_COLUMNS)


def q_minmax_scale(spark, sf_dir):
    cols = [S.CGPA, S.STUDY_SATISFACTION, S.HOURS, S.FINANCIAL_STRESS]
    return minmax_scale(cleaned(spark, sf_dir), cols).select(S.ID, *cols, *[f"{c}_normalized" for c in cols])


def q_one_hot_gender(spark, sf_dir):
    return one_hot(cleaned(spark, sf_dir), S.GENDER).select(S.ID, S.GENDER, *C.GENDER_DUMMIES)


def q_one_hot_city(spark, sf_dir):
    out = one_hot(cleaned(spark, sf_dir), S.CITY)
    return out.select(S.ID, S.CITY, *[f"City_City{i}" for i in range(7)])


def q_features(spark, sf_dir):
    return features(spark, sf_dir)


def q_null_counts(spark, sf_dir):
    return null_counts(survey(spark, sf_dir))


def q_describe_numeric(spark, sf_dir):
    return _round(describe_numeric(cleaned(spark, sf_dir)), ["mean", "stddev"], STAT_DIGITS)


def q_describe_all_numeric(spark, sf_dir):
    return _round(describe_numeric(cleaned(spark, sf_dir), types=ALL_NUMERIC), ["mean", "stddev"], STAT_DIGITS)


def q_quality_profile(spark, sf_dir):
    return _round(quality_profile(cleaned(spark, sf_dir)), ["mean", "stddev"], STAT_DIGITS)


def q_value_counts(spark, sf_dir):
    return value_counts(cleaned(spark, sf_dir))


def q_age_profession(spark, sf_dir):
    return depression_by_demographics(row_features(spark, sf_dir))


def q_sleep_cgpa(spark, sf_dir):
    return _round(cgpa_by_sleep(row_features(spark, sf_dir)), ["stddev_cgpa"])


def q_city_degree(spark, sf_dir):
    return city_degree_stats(row_features(spark, sf_dir))


def q_stress_by_demo(spark, sf_dir):
    return _round(stress_by_demographics(row_features(spark, sf_dir)), ["avg_stress_index"])


def q_sleep_performance(spark, sf_dir):
    return sleep_performance(row_features(spark, sf_dir))


def q_corr_pairs(spark, sf_dir):
    return _round(correlation_pairs(features(spark, sf_dir), C.SURVEY_NUMERIC_WITH_ID), ["correlation"])


def q_corr_top5(spark, sf_dir):
    return _round(strongest_with(correlation_pairs(features(spark, sf_dir), C.SURVEY_NUMERIC_WITH_ID), S.DEPRESSION, 5), ["correlation", "abs_corr"])


def q_corr_pairs_all(spark, sf_dir):
    return _round(correlation_pairs(features(spark, sf_dir), types=ALL_NUMERIC), ["correlation"])


def q_corr_pairs_pairwise(spark, sf_dir):
    return _round(correlation_pairs(features(spark, sf_dir), types=ALL_NUMERIC, nulls="pairwise"), ["correlation"])


def q_corr_matrix(spark, sf_dir):
    m = correlation_matrix(features(spark, sf_dir), C.SURVEY_NUMERIC_WITH_ID)
    return _round(m, sorted(C.SURVEY_NUMERIC_WITH_ID))


def q_high_risk(spark, sf_dir):
    return flagged(spark, sf_dir)


def q_risk_reasons(spark, sf_dir):
    out = with_risk_reasons(stress(spark, sf_dir))
    return out.select(S.ID, F.concat_ws(",", "risk_reasons").alias("risk_reasons"))


def q_risk_histogram(spark, sf_dir):
    return histogram(flagged_stress(spark, sf_dir), "stress_index_normalized", bins=20)


def q_risk_density(spark, sf_dir):
    return _round(gaussian_kde(flagged_stress(spark, sf_dir), "stress_index_normalized", grid_size=200), ["x", "density"])


def q_risk_count(spark, sf_dir):
    return count_rows(high_risk(stress(spark, sf_dir)), "n_high_risk")


def q_csv_declared(spark, sf_dir):
    path = scratch_path(spark, "survey-csv")
    write_csv(survey(spark, sf_dir), path)
    # The view's id is a bigint: an int column would turn large ids into nulls.
    fields = [T.StructField(f.name, T.LongType() if f.name == S.ID else f.dataType) for f in S.SURVEY_SCHEMA.fields]
    return clean_survey(read_csv(spark, path, T.StructType(fields)))


def q_csv_inferred(spark, sf_dir):
    path = scratch_path(spark, "survey-csv")
    write_csv(survey(spark, sf_dir), path)
    return read_csv_inferred(spark, path, f"{path}-schema/columns.json")


def q_parquet_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "features-parquet")
    write_parquet(features(spark, sf_dir), path)
    return spark.read.parquet(path)


def q_parquet_partitioned(spark, sf_dir):
    path = scratch_path(spark, "features-by-gender")
    write_parquet(features(spark, sf_dir), path, partition_by=S.GENDER)
    back = spark.read.parquet(path)
    return back.select(*[safe_col(c) for c in C.FEATURE_COLUMNS])


def q_preview_sorted(spark, sf_dir):
    return preview(cleaned(spark, sf_dir), 20, order_by=C.SURVEY_COLUMNS)


def q_text_range_answers(spark, sf_dir):
    return parse_once(E.answers(lineitem(spark, sf_dir)), "raw", text_range_to_number, "parsed")


def q_corr_constant(spark, sf_dir):
    return _round(correlation_pairs(E.view(lineitem(spark, sf_dir), E.CONSTANT), list(E.CONSTANT)), ["correlation"])


def q_corr_pairwise_masked(spark, sf_dir):
    table = E.view(lineitem(spark, sf_dir), E.MASKED)
    return _round(correlation_pairs(table, list(E.MASKED), nulls="pairwise"), ["correlation"])


def q_minmax_constant(spark, sf_dir):
    out = minmax_scale(E.view(lineitem(spark, sf_dir), E.RANGES), list(E.RANGES))
    return out.select("id", *[f"{c}_normalized" for c in E.RANGES])


def _categories(spark, sf_dir):
    return E.view(lineitem(spark, sf_dir), E.CATEGORIES)


def q_category_index(spark, sf_dir):
    return category_index(_categories(spark, sf_dir), list(E.CATEGORIES))


def q_one_hot_sparse(spark, sf_dir):
    out = sparse_one_hot(_categories(spark, sf_dir), list(E.CATEGORIES))
    places = F.array_join(F.col("indicators.indices").cast("array<string>"), ",")
    return out.select("id", F.col("indicators.size").alias("n_categories"), places.alias("places"))


def q_top_values(spark, sf_dir):
    return top_values(_categories(spark, sf_dir), 7, list(E.CATEGORIES))


def _job_rows(spark: SparkSession, paths: dict[str, str]) -> list[DataFrame]:
    """The job's outputs as rows (output, key1, key2, value1, value2)."""
    read = {name: spark.read.parquet(path) for name, path in paths.items()}
    parts = [(name, read[name], list(keys), [(m, DIGITS) for m in measures]) for name, keys, measures in SURVEY_SUMMARIES]
    pair = ["column1", "column2"]
    parts += [
        ("correlation_matrix", read["correlation_matrix"], pair, [("correlation", DIGITS)]),
        ("depression_correlations", read["depression_correlations"], pair, [("correlation", DIGITS), ("abs_corr", DIGITS)]),
        ("profile", read["profile"], ["column"], [("n_null", DIGITS), ("mean", STAT_DIGITS)]),
        ("value_counts", read["value_counts"], ["column", "value"], [("count", DIGITS)]),
    ]
    # Of the row tables their size and a sum.
    for name, c in (("processed", S.CGPA), ("features", "Gender_Female"), ("high_risk", S.DEPRESSION)):
        parts.append((name, read[name].agg(F.count(F.lit(1)).alias("n"), F.sum(safe_col(c)).alias("s")), [], [("n", DIGITS), ("s", DIGITS)]))
    rows = []
    for name, df, keys, values in parts:
        key = [safe_col(k).cast("string") for k in keys] + [F.lit(None).cast("string")] * 2
        value = [F.round(safe_col(m).cast("double"), d) for m, d in values] + [F.lit(None).cast("double")]
        rows.append(df.select(F.lit(name).alias("output"), key[0].alias("key1"), key[1].alias("key2"), value[0].alias("value1"), value[1].alias("value2")))
    return rows


def q_job_results(spark, sf_dir):
    """All twelve outputs that the batch job published, read back by the manifest in one long table."""
    root = scratch_path(spark, "survey-job")
    run_survey_job(survey(spark, sf_dir), root)
    return reduce(DataFrame.unionByName, _job_rows(spark, published(spark, root)))


def q_job_features_partitioned(spark, sf_dir):
    """The feature table the batch job wrote partitioned by degree, in the features' own types and order."""
    path = run_survey_job(survey(spark, sf_dir), scratch_path(spark, "survey-job"), partition_by=S.DEGREE, outputs=["features"])["features"]
    # The type of a partition column is guessed from its values; degrees are text.
    kinds = spark.read.parquet(path).schema
    schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name == S.DEGREE else f for f in kinds])
    return spark.read.schema(schema).parquet(path).select(*[safe_col(c) for c in C.FEATURE_COLUMNS])


QUERIES: dict[str, Query] = {
    "clean_ranges": q_clean_ranges,
    "sleep_cgpa": q_sleep_cgpa,
    "survey_load": q_survey_load,
    "text_range_parse": q_text_range_parse,
    "clean_numeric": q_clean_numeric,
    "row_features": q_row_features,
    "minmax_scale": q_minmax_scale,
    "one_hot_gender": q_one_hot_gender,
    "one_hot_city": q_one_hot_city,
    "features": q_features,
    "null_counts": q_null_counts,
    "describe_numeric": q_describe_numeric,
    "describe_all_numeric": q_describe_all_numeric,
    "quality_profile": q_quality_profile,
    "value_counts": q_value_counts,
    "age_profession": q_age_profession,
    "city_degree": q_city_degree,
    "stress_by_demo": q_stress_by_demo,
    "sleep_performance": q_sleep_performance,
    "corr_pairs": q_corr_pairs,
    "corr_top5": q_corr_top5,
    "corr_pairs_all": q_corr_pairs_all,
    "corr_pairs_pairwise": q_corr_pairs_pairwise,
    "corr_matrix": q_corr_matrix,
    "high_risk": q_high_risk,
    "risk_reasons": q_risk_reasons,
    "risk_histogram": q_risk_histogram,
    "risk_density": q_risk_density,
    "risk_count": q_risk_count,
    "csv_declared": q_csv_declared,
    "csv_inferred": q_csv_inferred,
    "parquet_roundtrip": q_parquet_roundtrip,
    "parquet_partitioned": q_parquet_partitioned,
    "preview_sorted": q_preview_sorted,
    "text_range_answers": q_text_range_answers,
    "corr_constant": q_corr_constant,
    "corr_pairwise_masked": q_corr_pairwise_masked,
    "minmax_constant": q_minmax_constant,
    "category_index": q_category_index,
    "one_hot_sparse": q_one_hot_sparse,
    "top_values": q_top_values,
    "job_results": q_job_results,
    "job_features_partitioned": q_job_features_partitioned,
}
