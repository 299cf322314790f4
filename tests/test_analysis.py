import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.operators import (
    aggregations,
    clean_survey,
    correlation_matrix,
    correlation_pairs,
    count_rows,
    describe_numeric,
    distribution_analysis,
    engineer_features,
    gaussian_kde,
    high_risk,
    histogram,
    null_counts,
    quality_profile,
    strongest_with,
    value_counts,
    with_risk_reasons,
)
from cohortlens.operators.summaries import combined_summaries, split_summaries


@pytest.fixture
def feats(cohort):
    return engineer_features(clean_survey(cohort))


def rows(df, key):
    return sorted((tuple(r) for r in df.collect()), key=key)


HALF = math.sqrt(0.5)


def test_distributions(feats):
    d = distribution_analysis(feats)
    assert rows(d["depression_by_demographics"], str) == sorted(
        [("18-21", "Tutor", 0.5), ("22-25", "Nurse", 1.0), ("26-30", "Nurse", 1.0), ("26-30", None, 0.0), (">30", "Nurse", 1.0)],
        key=str,
    )
    got = {r[0]: (r[1], r[2]) for r in d["academic_performance"].collect()}
    assert got == {"Low": (8.5, pytest.approx(HALF)), "Normal": (5.5, pytest.approx(HALF)), "High": (7.0, None)}


def test_aggregations(feats):
    a = aggregations(feats)
    city = {(r[0], r[1]): (r[2], r[3]) for r in a["city_degree_stats"].collect()}
    assert city == {("Arden", "BSc"): (pytest.approx(2 / 3), 3), ("Brook", "MSc"): (1.0, 2), ("Brook", "PhD"): (0.0, 1)}
    stress = {(r[0], r[1]): r[2] for r in a["demographic_stress"].collect()}
    assert stress == {("18-21", "Female"): 4.0, ("18-21", "Male"): 2.0, ("22-25", "Female"): 5.0, ("26-30", "Male"): 3.5, (">30", "Female"): 3.0}
    sleep = {r[0]: (r[1], r[2]) for r in a["sleep_performance"].collect()}
    assert sleep == {"Low": (8.5, 1.0), "Normal": (5.5, pytest.approx(8 / 3)), "High": (7.0, 5.0)}


def test_combined_summaries_equal_separate(spark, feats):
    combined = split_summaries(combined_summaries(feats))
    separate = {**distribution_analysis(feats), **aggregations(feats)}
    assert set(combined) == set(separate)
    for name, df in separate.items():
        assert combined[name].columns == df.columns
        assert rows(combined[name], str) == rows(df, str), name


def test_correlation_of_cohort(feats):
    """32-bit int and float columns, against numpy on the values worked out by hand."""
    data = {
        "id": [11, 12, 13, 14, 15, 16],
        "Sleep Duration": [4.5, 6.25, 9, 4, 8, 7],
        "Depression": [0, 1, 1, 1, 0, 1],
        "Gender_Female": [1, 0, 1, 0, 0, 1],
        "Gender_Male": [0, 1, 0, 1, 1, 0],
    }
    pairs = correlation_pairs(feats)
    got = {(r[0], r[1]): r[2] for r in pairs.collect()}
    names = list(data)
    assert set(got) == {(a, b) for i, a in enumerate(names) for b in names[i + 1 :]}
    for (a, b), r in got.items():
        assert r == pytest.approx(np.corrcoef(data[a], data[b])[0, 1], abs=1e-12)
    top = [tuple(r) for r in strongest_with(pairs, "Depression", 3).collect()]
    want = sorted((x for x in got.items() if "Depression" in x[0]), key=lambda x: (-round(abs(x[1]), 9), x[0]))[:3]
    assert [(r[0], r[1]) for r in top] == [k for k, _ in want]


@pytest.mark.parametrize("partitions", [1, 5, 64])
@pytest.mark.parametrize("nulls", ["zero", "pairwise"])
def test_correlation_does_not_depend_on_partitions_or_width(spark, partitions, nulls):
    """A constant that is no binary fraction, NaN and an outlier only where the other column is missing."""
    data = [(0.1, float(i % 7), None if i % 5 == 0 else float(i % 7 + i % 3), 1e9 if i % 5 == 0 else float(i % 11),
             float("nan") if i % 5 == 0 else float(i % 4)) for i in range(55)]
    df = spark.createDataFrame(data, "flat double, x double, y double, far double, odd double").repartition(partitions)
    wide = df.select("*", *[(F.col("x") * k + F.col("far") % (k + 2)).alias(f"w{k}") for k in range(55)])
    narrow = {(r[0], r[1]): r[2] for r in correlation_pairs(df, df.columns, nulls=nulls).collect()}
    many = {(r[0], r[1]): r[2] for r in correlation_pairs(wide, wide.columns, nulls=nulls).collect()}
    assert len(many) == 60 * 59 // 2
    for key, value in narrow.items():
        assert many[key] == pytest.approx(value, abs=1e-12, nan_ok=True) if value is not None else many[key] is None
    assert all(v is None if nulls == "pairwise" else math.isnan(v) for k, v in narrow.items() if "flat" in k and "odd" not in k)
    kept = [r for r in data if r[2] is not None]
    if nulls == "pairwise":
        assert narrow[("y", "far")] == pytest.approx(np.corrcoef([r[2] for r in kept], [r[3] for r in kept])[0, 1], abs=1e-12)
        assert narrow[("y", "odd")] == pytest.approx(np.corrcoef([r[2] for r in kept], [r[4] for r in kept])[0, 1], abs=1e-12)
        assert math.isnan(narrow[("x", "odd")])


def test_correlation_masked_outlier_is_exactly_one(spark):
    df = spark.createDataFrame([(float(i), float(i)) for i in range(100)] + [(1e9, None)], "x double, y double")
    assert correlation_pairs(df, ["x", "y"], nulls="pairwise").first()[2] == pytest.approx(1.0, abs=1e-12)


def test_correlation_of_empty_table(spark):
    df = spark.createDataFrame([], "a double, b double, c double")
    assert all(math.isnan(r[2]) for r in correlation_pairs(df, df.columns).collect())
    assert [r[2] for r in correlation_pairs(df, df.columns, nulls="pairwise").collect()] == [None] * 3


def test_correlation_of_many_dummies(spark):
    df = spark.range(6000).select(*[(F.col("id") % 150 == k).cast("int").alias(f"d{k}") for k in range(150)])
    got = correlation_pairs(df, types=("int",)).agg(F.count("*"), F.min("correlation"), F.max("correlation")).first()
    assert got[0] == 150 * 149 // 2
    assert got[1] == pytest.approx(-1 / 149) and got[2] == pytest.approx(-1 / 149)


def test_correlation_against_numpy(spark):
    rng = np.random.default_rng(7)
    data = rng.normal(size=(500, 6)) * [1, 10, 1e6, 0.1, 2, 1] + [0, 5, 1e9, 3, 7, -1]
    data[:, 1] += data[:, 0]
    data[:, 5] += data[:, 2] * 1e-6
    nulls = rng.random(size=data.shape) < 0.1
    nulls[:, 4:] = False  # two columns without nulls
    pdf_rows = [tuple(None if nulls[i, j] else float(data[i, j]) for j in range(6)) for i in range(500)]
    df = spark.createDataFrame(pdf_rows, "a double, b double, c double, d double, e double, f double")
    zero = np.where(nulls, 0.0, data)
    got = {(r[0], r[1]): r[2] for r in correlation_pairs(df, types=("double",)).collect()}
    names = "abcdef"
    for i in range(6):
        for j in range(i + 1, 6):
            assert got[(names[i], names[j])] == pytest.approx(np.corrcoef(zero[:, i], zero[:, j])[0, 1], abs=1e-9)
    pw = {(r[0], r[1]): r[2] for r in correlation_pairs(df, types=("double",), nulls="pairwise").collect()}
    for i in range(6):
        for j in range(i + 1, 6):
            keep = ~(nulls[:, i] | nulls[:, j])
            want = np.corrcoef(data[keep, i], data[keep, j])[0, 1]
            assert pw[(names[i], names[j])] == pytest.approx(want, abs=1e-9)


def test_correlation_constant_and_tiny(spark):
    df = spark.createDataFrame([(0.1, 1.0), (0.1, 2.0), (0.1, 4.0)], "c double, x double")
    got = correlation_pairs(df, types=("double",)).collect()[0][2]
    assert math.isnan(got)
    assert correlation_pairs(df, types=("double",), nulls="pairwise").collect()[0][2] is None
    one = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert correlation_pairs(one, types=("double",), nulls="pairwise").collect()[0][2] is None
    assert correlation_pairs(one.select("a"), types=("double",)).count() == 0


def test_correlation_matrix(feats):
    m = correlation_matrix(feats)
    labels = sorted(["id", "Sleep Duration", "Depression", "Gender_Female", "Gender_Male"])
    assert m.columns == ["column", *labels]
    got = {r["column"]: r for r in m.collect()}
    for a in labels:
        assert got[a][a] == 1.0
        for b in labels:
            assert got[a][b] == pytest.approx(got[b][a])


def test_risk(feats):
    scaled = {r["id"]: r["stress_index_normalized"] for r in feats.collect()}
    assert scaled == {11: pytest.approx(2 / 3), 12: 0.0, 13: 1.0, 14: pytest.approx(2 / 3), 15: pytest.approx(1 / 3), 16: pytest.approx(1 / 3)}
    flagged = high_risk(feats)
    assert sorted(r["id"] for r in flagged.collect()) == [11, 13, 14]
    reasons = {row["id"]: row["risk_reasons"] for row in with_risk_reasons(feats).collect()}
    assert reasons == {11: ["poor_sleep"], 13: ["high_stress"], 14: ["poor_sleep", "financial_stress"]}
    assert count_rows(flagged).collect()[0][0] == 3


def test_null_in_one_rule_does_not_hide_row(feats):
    df = feats.withColumn("stress_index_normalized", F.lit(None).cast("double")).withColumn(
        "Financial Stress", F.lit(9.0)
    )
    assert high_risk(df).count() == 6


def test_profile(spark):
    df = spark.createDataFrame([(1, 2.0, "a"), (None, 4.0, None), (3, None, "a")], "i int, d double, s string")
    assert {r[0]: r[1] for r in null_counts(df).collect()} == {"i": 1, "d": 1, "s": 1}
    desc = {r["column"]: r for r in describe_numeric(df).collect()}
    assert set(desc) == {"i"}
    assert (desc["i"]["count"], desc["i"]["mean"], desc["i"]["min"], desc["i"]["max"]) == (2, 2.0, 1.0, 3.0)
    assert desc["i"]["stddev"] == pytest.approx(math.sqrt(2.0))
    prof = {r["column"]: r for r in quality_profile(df).collect()}
    assert prof["d"]["mean"] == 3.0 and prof["s"]["mean"] is None and prof["s"]["n_null"] == 1
    vc = sorted(tuple(r) for r in value_counts(df).collect() if r[1] is not None)
    assert vc == [("s", "a", 2)]


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=1000)
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,), (float("nan"),)], "x double")
    got = histogram(df, "x", bins=20).orderBy("bin").collect()
    counts, edges = np.histogram(x, bins=20)
    assert [r["count"] for r in got] == list(counts)
    assert [r["bin_start"] for r in got] == pytest.approx(list(edges[:-1]))
    const = histogram(spark.createDataFrame([(2.0,), (2.0,)], "x double"), "x", bins=4).orderBy("bin").collect()
    assert [r["count"] for r in const] == [0, 0, 2, 0]


def test_kde_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    x = rng.gamma(2.0, size=300)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = gaussian_kde(df, "x", grid_size=50, cut=3.0).orderBy("point").collect()
    h = x.std(ddof=1) * len(x) ** (-0.2)
    grid = np.linspace(x.min() - 3 * h, x.max() + 3 * h, 50)
    want = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(axis=1) / (len(x) * h * math.sqrt(2 * math.pi))
    assert [r["x"] for r in got] == pytest.approx(list(grid))
    assert [r["density"] for r in got] == pytest.approx(list(want), rel=1e-9)


def test_kde_of_narrow_kernels(spark):
    """Values far apart, a fine grid: unreached points are zero, and a value only touches the points around it."""
    x = [0.0, 0.0, 100.0, 250.5, 1000.0]
    df = spark.createDataFrame([(v,) for v in x], "x double")
    got = [r["density"] for r in gaussian_kde(df, "x", grid_size=2001, cut=2.0, bandwidth=0.7).orderBy("point").collect()]
    grid = np.linspace(-1.4, 1001.4, 2001)
    want = np.exp(-0.5 * ((grid[:, None] - x) / 0.7) ** 2).sum(1) / (5 * 0.7 * math.sqrt(2 * math.pi))
    assert got == pytest.approx(list(want), rel=1e-9, abs=1e-300) and min(got) == 0.0
    for values, n in (([2.0, 2.0], 4), ([2.0], 4), ([], 0)):
        got = gaussian_kde(spark.createDataFrame([(v,) for v in values], "x double"), "x", grid_size=4).collect()
        assert [r["density"] for r in got] == [None] * n


def test_correlation_merges_in_two_levels():
    """No group of the first merge, and no number of groups, is above about the square root of twice the tasks."""
    from collections import Counter

    from cohortlens.operators.correlate import merge_group

    for tasks in (1, 2, 10, 1000, 100_000):
        groups = Counter(merge_group(t) for t in range(tasks))
        assert max(groups.values()) <= math.sqrt(2 * tasks) + 1 and len(groups) <= math.sqrt(2 * tasks) + 1


def test_correlation_of_hundreds_of_columns(spark):
    rng = np.random.default_rng(11)
    data = rng.normal(size=(400, 300)) + rng.normal(size=(400, 1))
    gaps = rng.random(size=data.shape) < np.where(np.arange(300) % 3 == 0, 0.1, 0.0)
    rows = [[None if g else float(v) for v, g in zip(*both)] for both in zip(data, gaps)]
    df = spark.createDataFrame(rows, ", ".join(f"c{i} double" for i in range(300))).repartition(12)
    got = {(r[0], r[1]): r[2] for r in correlation_pairs(df, df.columns, nulls="pairwise").collect()}
    assert len(got) == 300 * 299 // 2
    for i, j in [(0, 1), (0, 3), (1, 2), (150, 299), (298, 299)]:
        both = ~(gaps[:, i] | gaps[:, j])
        assert got[(f"c{i}", f"c{j}")] == pytest.approx(np.corrcoef(data[both, i], data[both, j])[0, 1], abs=1e-12)


def test_odd_column_names(spark):
    """Names with dots, spaces, `?` and backticks go through the SQL-text and Column paths."""
    from cohortlens.operators import one_hot, summarize

    df = spark.createDataFrame([("x", 1, 2.0), ("y", 2, 4.0), ("x", 3, 7.0)], "`g.k ?` string, `a``b` int, `c.d` double")
    assert {(r[0], r[1]) for r in summarize(df, ["g.k ?"], {"s": ("sum", "c.d")}).collect()} == {("x", 9.0), ("y", 4.0)}
    want = np.corrcoef([1, 2, 3], [2.0, 4.0, 7.0])[0, 1]
    assert [r[2] for r in correlation_pairs(df, types=("int", "double")).collect()] == [pytest.approx(want)]
    assert one_hot(df, "g.k ?").columns[-2:] == ["g.k ?_x", "g.k ?_y"]
    assert {r["column"] for r in quality_profile(df).collect()} == {"g.k ?", "a`b", "c.d"}


def test_infinities_are_left_out(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("inf"),), (float("-inf"),)], "x double")
    assert [(r["bin_start"], r["count"]) for r in histogram(df, "x", bins=2).orderBy("bin").collect()] == [(1.0, 1), (1.5, 1)]
    assert all(math.isfinite(r["density"]) for r in gaussian_kde(df, "x", grid_size=5).collect())


def test_decimals_are_described(spark):
    df = spark.createDataFrame([("1.5",), ("2.5",)], "s string").selectExpr("CAST(s AS DECIMAL(9,2)) AS d")
    row = quality_profile(df).first()
    assert (row["count"], row["mean"], row["min"], row["max"]) == (2, 2.0, 1.5, 2.5)
