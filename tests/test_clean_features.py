import math

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from cohortlens.operators import (
    add_row_features,
    clean_survey,
    engineer_features,
    minmax_scale,
    one_hot,
)
from tests.conftest import COHORT, survey_rows


def test_clean_cohort(cohort):
    out = clean_survey(cohort)
    assert dict(out.dtypes)["Sleep Duration"] == "float" and out.columns == cohort.columns
    assert {r["id"]: r["Sleep Duration"] for r in out.collect()} == {11: 4.5, 12: 6.25, 13: 9.0, 14: 4.0, 15: 8.0, 16: 7.0}


def test_clean_modes_on_bare_numbers(spark):
    texts = ["0", "3.25", "24", "24.5", " 9 ", "nine"]
    df = survey_rows(spark, [{**r, "Sleep Duration": t} for r, t in zip(COHORT, texts)])
    assert clean_survey(df, mode="ranges").count() == 0
    assert sorted(r["Sleep Duration"] for r in clean_survey(df, mode="numeric").collect()) == [0.0, 3.25, 9.0, 24.0]


def test_clean_drops_nulls_ranges_and_ages(spark):
    base = COHORT[0]
    variants = [
        {**base, "id": 10, "Sleep Duration": None},
        {**base, "id": 11, "Age": None},
        {**base, "id": 12, "Sleep Duration": "30-40 hours"},
        {**base, "id": 13, "Age": 0.0},
        {**base, "id": 14, "Age": float("nan")},
        {**base, "id": 15, "Sleep Duration": "nan-nan"},
        {**base, "id": 16},
    ]
    kept = sorted(r["id"] for r in clean_survey(survey_rows(spark, variants)).collect())
    # dropna removes NaN as well as null in numeric columns, so a NaN age goes too.
    assert kept == [16]


def test_clean_with_inferred_types(spark):
    """Whole numbers infer as bigint; cleaning keeps them."""
    df = spark.createDataFrame([Row(id=7, Age=40, **{"Sleep Duration": "1-2 hours"}), Row(id=8, Age=-1, **{"Sleep Duration": "3-4 hours"})])
    out = clean_survey(df)
    assert dict(out.dtypes)["Age"] == "bigint" and [tuple(r) for r in out.collect()] == [(7, 40, 1.5)]


def test_features_of_cohort(cohort):
    r = {row["id"]: row for row in engineer_features(clean_survey(cohort)).collect()}
    assert {i: x["stress_index"] for i, x in r.items()} == {11: 4.0, 12: 2.0, 13: 5.0, 14: 4.0, 15: 3.0, 16: 3.0}
    assert [r[i]["sleep_category"] for i in range(11, 17)] == ["Low", "Normal", "High", "Low", "Normal", "Normal"]
    assert [r[i]["age_group"] for i in range(11, 17)] == ["18-21", "18-21", "22-25", "26-30", "26-30", ">30"]
    assert [r[i]["CGPA_normalized"] for i in range(11, 17)] == [0.75, 0.25, 0.5, 1.0, None, 0.0]
    assert [r[i]["Depression_normalized"] for i in range(11, 17)] == [0.0, 1.0, 1.0, 1.0, 0.0, 1.0]
    assert [(r[i]["Gender_Female"], r[i]["Gender_Male"]) for i in (11, 12)] == [(1, 0), (0, 1)]


def test_minmax_of_wide_integers(spark):
    df = spark.createDataFrame([(-(2**31),), (2**31 - 1,), (0,)], "x int")
    assert [r[1] for r in minmax_scale(df, ["x"]).orderBy("x").collect()] == [0.0, pytest.approx(0.5, abs=1e-9), 1.0]


@pytest.mark.parametrize(
    "values, expected",
    [
        ([1.0, 2.0, 3.0], [0.0, 0.5, 1.0]),
        ([5.0, 5.0, None], [0.0, 0.0, 0.0]),
        ([None, None], [0.0, 0.0]),
        ([float("nan"), float("nan")], ["nan", "nan"]),
        ([1.0, float("nan"), 3.0], ["nan", "nan", "nan"]),
        ([1.0, None, 3.0], [0.0, None, 1.0]),
    ],
)
def test_minmax_edge_cases(spark, values, expected):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    got = [r["x_normalized"] for r in minmax_scale(df, ["x"]).orderBy("i").collect()]
    norm = ["nan" if isinstance(v, float) and math.isnan(v) else v for v in got]
    assert norm == expected


def test_age_and_sleep_buckets_edges(spark):
    df = spark.createDataFrame(
        [(1, 17.0, 5.99), (2, 21.5, 6.0), (3, 25.5, 8.0), (4, 30.0, 8.01), (5, None, None), (6, float("nan"), float("nan"))],
        "id int, Age double, sleep double",
    ).withColumn("Academic Pressure", F.lit(1.0)).withColumn("Work Pressure", F.lit(1.0)).withColumn(
        "Financial Stress", F.lit(None).cast("double")
    )
    out = add_row_features(df, sleep="sleep")
    r = {row["id"]: row for row in out.collect()}
    assert [r[i]["age_group"] for i in range(1, 7)] == [">30", ">30", ">30", "26-30", ">30", ">30"]
    assert [r[i]["sleep_category"] for i in range(1, 7)] == ["Low", "Normal", "Normal", "High", "High", "High"]
    assert r[1]["stress_index"] is None


def test_one_hot_discovery_nulls_and_collisions(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "g string")
    out = one_hot(df, "g")
    assert out.columns == ["g", "g_a", "g_b"]
    assert [tuple(r) for r in out.collect()] == [("a", 1, 0), ("b", 0, 1), (None, 0, 0), ("a", 1, 0)]
    assert "g_None" in one_hot(df, "g", null_category=True).columns
    with pytest.raises(ValueError):
        one_hot(spark.createDataFrame([("A",), ("a",)], "g string"), "g")
    with pytest.raises(ValueError):
        one_hot(df, "g", max_categories=1)
    assert one_hot(df, "g", categories=["b"]).columns == ["g", "g_b"]


def test_one_hot_does_not_overwrite(spark):
    with pytest.raises(ValueError):
        one_hot(spark.createDataFrame([("a", "keep")], "g string, G_A string"), "g")


def test_mean_with_weights(spark):
    df = spark.createDataFrame([(1.0, 2.0, 6.0)], "a double, b double, c double")
    out = add_row_features(df.selectExpr("*", "7.0 AS s", "20.0 AS y"), ["a", "b", "c"], [1.0, 2.0, 1.0], sleep="s", age="y")
    assert out.first()["stress_index"] == pytest.approx(2.75)
