"""The survey batch job: clean → profile → features → summaries, correlations, risk → Parquet.

Source passes: one over the raw input (cleaned table written; the ranges of the
columns to scale are observed on the way), one over its sleep answers, then
every later step reads written columnar tables, pruned to the columns it needs:
one aggregate for the profile, one for value counts, one bounded distinct for
categories, one pass writing the feature table, then one grouping-sets aggregate
for all five summaries, one aggregate for all correlation pairs and one filter
for the risk rows.  Writing intermediate tables (instead of caching) also cuts
lineage: a lost executor only costs the tasks of the step that was running.

The outputs of a run appear together when it is published, and a run that
stopped goes on from its last complete step (see ``sources.published``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from cohortlens.operators import (
    ObservedRanges,
    add_row_features,
    clean_survey,
    correlation_pairs,
    distinct_categories,
    engineer_features,
    high_risk,
    quality_profile,
    strongest_with,
    value_counts,
)
from cohortlens.operators.features import SCALED_COLUMNS
from cohortlens.operators.summaries import SURVEY_SUMMARIES, combined_summaries, split_summaries
from cohortlens.schema import DEPRESSION, GENDER, safe_col
from cohortlens.sources import Run, write_parquet

# Output layout (fixed values: relative paths of the job's results).
OUTPUTS = {
    "processed": "processed_data.parquet",
    "profile": "data_quality/profile.parquet",
    "value_counts": "data_quality/value_counts.parquet",
    "features": "feature_engineered_data.parquet",
    "depression_by_demographics": "distributions/depression_by_demographics.parquet",
    "academic_performance": "distributions/academic_performance.parquet",
    "correlation_matrix": "correlations/correlation_matrix.parquet",
    "depression_correlations": "correlations/depression_correlations.parquet",
    "city_degree_stats": "aggregations/city_degree_stats.parquet",
    "demographic_stress": "aggregations/demographic_stress.parquet",
    "sleep_performance": "aggregations/sleep_performance.parquet",
    "high_risk": "risk_analysis/high_risk_students.parquet",
}


_SUMMARIES = [name for name, _, _ in SURVEY_SUMMARIES]


def run_survey_job(
    raw: DataFrame,
    out_root: str,
    clean_mode: str = "ranges",
    categories=None,
    partition_by: str | None = None,
    run_id: str | None = None,
    outputs: Sequence[str] | None = None,
) -> dict[str, str]:
    """Run the survey job on ``raw``, publish its results under ``out_root`` and return output name → path.

    ``partition_by`` partitions the feature and high-risk tables by that column.
    ``outputs`` names the results wanted (default: all); steps that none of them
    needs are left out.  A run started again with the ``run_id`` of one that
    stopped, and the same arguments, reads the steps that run finished.
    """
    wanted = set(outputs or OUTPUTS)
    if unknown := wanted - set(OUTPUTS):
        raise ValueError(f"no such outputs: {sorted(unknown)}")
    spark = raw.sparkSession
    run = Run(spark, out_root, run_id)
    paths = {k: f"{run.folder}/{v}" for k, v in OUTPUTS.items()}

    def write(name: str, frame: Callable[[], DataFrame], **how) -> None:
        if name in wanted:
            run.step(name, lambda: write_parquet(frame(), paths[name], **how))

    def clean() -> dict:
        ranges = ObservedRanges(SCALED_COLUMNS)
        cleaned = clean_survey(raw, mode=clean_mode)
        watched = ranges.watch(add_row_features(cleaned))
        write_parquet(watched.select(*[safe_col(c) for c in cleaned.columns]), paths["processed"])
        return {"ranges": ranges.get()}

    ranges = run.step("processed", clean)["ranges"]
    processed = spark.read.parquet(paths["processed"])
    write("profile", lambda: quality_profile(processed))
    write("value_counts", lambda: value_counts(processed))

    if wanted - {"processed", "profile", "value_counts"}:
        found = run.step("categories", lambda: {"values": list(categories or distinct_categories(processed, GENDER))})
        engineered = engineer_features(processed, categories=found["values"], ranges=ranges)
        run.step("features", lambda: write_parquet(engineered, paths["features"], partition_by=partition_by))
        # Read back with the frame's own types and order: a partition column would come back last, its type guessed.
        feats = spark.read.schema(engineered.schema).parquet(paths["features"])
        feats = feats.select(*[safe_col(c) for c in engineered.columns])

    if wanted & set(_SUMMARIES):
        combined = f"{run.folder}/_work/summaries"
        run.step("summaries", lambda: write_parquet(combined_summaries(feats), combined))
        for name, df in split_summaries(spark.read.parquet(combined), SURVEY_SUMMARIES).items():
            write(name, lambda df=df: df)

    if wanted & {"correlation_matrix", "depression_correlations"}:
        # k(k-1)/2 rows for k columns: one file.
        run.step("correlation_matrix", lambda: write_parquet(correlation_pairs(feats).coalesce(1), paths["correlation_matrix"]))
        write("depression_correlations", lambda: strongest_with(spark.read.parquet(paths["correlation_matrix"]), DEPRESSION, 5))

    write("high_risk", lambda: high_risk(feats), partition_by=partition_by)
    run.publish({name: OUTPUTS[name] for name in OUTPUTS if name in wanted})
    return {name: paths[name] for name in OUTPUTS if name in wanted}
