"""Every registered query against its DuckDB SQL on the smallest test tables, plus plan checks."""

import pytest

import __spark_entry__ as E
from cohortlens.plans.catalog import QUERIES
from cohortlens.plans.oracle import oracle_queries
from tests.conftest import SMALL_SF
from tools.check_oracle import compare

NAMES = sorted(QUERIES)


def test_every_query_has_sql():
    assert set(oracle_queries()) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "risk_reason" in df.columns


@pytest.fixture(scope="module")
def results(spark):
    return compare(spark, SMALL_SF, NAMES, verbose=False)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(results, name):
    r = results[name]
    assert r["rows"] == r["oracle_rows"]
    assert r["cols_match"] and r["values_match"], r


def _plan(df):
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)


def test_no_python_in_plans(spark):
    for name in ["clean_ranges", "features", "high_risk", "sleep_cgpa", "risk_density"]:
        plan = _plan(E.queries()[name](spark, SMALL_SF))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_clean_filters_before_shuffle_and_prunes(spark):
    plan = _plan(E.queries()["clean_ranges"](spark, SMALL_SF))
    assert plan.count("Exchange") == plan.count("BroadcastExchange") == 1  # the parsed answers
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int" in plan
    assert "split_part" not in plan.split("BroadcastExchange")[0]  # no row is parsed, only the distinct answers


def test_clean_pushes_age_filter_into_parquet(spark, tmp_path):
    from cohortlens.operators import clean_survey
    from cohortlens.sources import read_survey, write_parquet

    path = str(tmp_path / "survey")
    write_parquet(read_survey(spark, SMALL_SF), path)
    plan = _plan(clean_survey(spark.read.parquet(path)))
    assert "PushedFilters: [IsNotNull(`Sleep Duration`), IsNotNull(Age), GreaterThan(Age,0.0)]" in plan, plan


def _partial_before_exchange(plan: str) -> bool:
    """Every hash/single-partition exchange in the plan is fed by a partial aggregate."""
    lines = plan.split("\n")
    for n, line in enumerate(lines):
        if "Exchange hashpartitioning" in line or "Exchange SinglePartition" in line:
            below = "\n".join(lines[n + 1 : n + 3])
            if "partial_" not in below:
                return False
    return True


@pytest.mark.parametrize("name", ["sleep_cgpa", "city_degree", "value_counts", "null_counts"])
def test_aggregates_combine_before_shuffle(spark, name):
    """A key holding a third of all rows costs one partial row per task, never a hot reducer input."""
    plan = _plan(E.queries()[name](spark, SMALL_SF))
    assert _partial_before_exchange(plan), plan


def test_no_cross_or_nested_loop_joins(spark):
    for name in NAMES:
        plan = _plan(E.queries()[name](spark, SMALL_SF))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_hot_key_summary(spark):
    """One group with a third of the rows still aggregates exactly."""
    from pyspark.sql import functions as F

    from cohortlens.operators import summarize

    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string"))).alias("k"),
        (F.col("id") % 5).cast("double").alias("v"),
    )
    out = {r["k"]: r for r in summarize(df, ["k"], {"n": ("count", "*"), "s": ("sum", "v")}).collect()}
    assert out["hot"]["n"] == 10000
    assert sum(r["n"] for r in out.values()) == 30000


@pytest.mark.parametrize("name", ["age_profession", "sleep_cgpa", "city_degree", "stress_by_demo", "sleep_performance"])
def test_summaries_scan_once_and_write_nothing(spark, name):
    plan = _plan(QUERIES[name](spark, SMALL_SF))
    assert plan.count("FileScan") == 1 and "lineitem.parquet" in plan and plan.count("Exchange") - plan.count("BroadcastExchange") == 1


def test_no_round_robin_exchange(spark):
    for name in NAMES:
        assert "RoundRobin" not in _plan(QUERIES[name](spark, SMALL_SF)), name
