"""Sparse indicators and top values against dense columns and plain counts."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import category_index, indicators, one_hot, sparse_one_hot, top_values


def _index(df, cols):
    return {(r["column"], r["category"]): (r["position"], r["n_rows"]) for r in category_index(df, cols).collect()}


ODD = [(1, "b", 2.5), (2, None, 1.0), (3, "a", None), (4, "b", 2.5), (5, "", 1.0), (6, "é", 1.0), (7, "B", 2.5), (7, "B", 2.5)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "id int, `x.y` string, n double").repartition(3)


def test_index_is_sorted_by_column_and_text(odd):
    expected = [("x.y", v) for v in sorted({r[1] for r in ODD if r[1] is not None})] + [("n", "1.0"), ("n", "2.5")]
    counts = Counter([("x.y", r[1]) for r in ODD] + [("n", str(r[2])) for r in ODD])
    assert _index(odd, ["x.y", "n"]) == {e: (i, counts[e]) for i, e in enumerate(expected)}


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_sparse_equals_dense(odd, monkeypatch, broadcast):
    monkeypatch.setattr(indicators, "BROADCAST_CATEGORIES", broadcast)
    for share in (indicators.HOT_SHARE, 2, 0):  # most categories hot, some, none
        monkeypatch.setattr(indicators, "HOT_SHARE", share)
        out = sparse_one_hot(odd, ["x.y"])
        # Names of dense columns may not differ in case alone.
        dense = one_hot(odd.where("`x.y` is null or `x.y` <> 'B'"), "x.y", categories=["", "a", "b", "é"], prefix="p")
        places = {"": 0, "a": 2, "b": 3, "é": 4}
        rows = {r["id"]: r["indicators"] for r in out.where("id < 7").collect()}
        assert out.count() == len(ODD) and out.columns == ["id", "x.y", "n", "indicators"]
        for r in dense.collect():
            assert rows[r["id"]]["size"] == 5
            assert rows[r["id"]]["indices"] == [at for c, at in places.items() if r[f"p_{c}"]]


@pytest.mark.parametrize("broadcast", [100_000, 0])
def test_several_columns_share_one_vector(odd, monkeypatch, broadcast):
    monkeypatch.setattr(indicators, "BROADCAST_CATEGORIES", broadcast)
    index = _index(odd, ["n", "x.y"])
    for r in sparse_one_hot(odd, ["n", "x.y"]).collect():
        want = [index[c, str(r[c])][0] for c in ("n", "x.y") if r[c] is not None]
        assert r["indicators"]["indices"] == sorted(want)


def test_index_of_other_rows(spark, odd):
    index = category_index(odd, ["x.y"])
    new = spark.createDataFrame([(1, "é"), (2, "unseen"), (3, None)], "id int, `x.y` string")
    got = {r["id"]: r["indicators"] for r in sparse_one_hot(new, ["x.y"], index).collect()}
    assert got[1]["indices"] == [4] and got[2]["indices"] == got[3]["indices"] == []
    assert {g["size"] for g in got.values()} == {5}


def test_empty_and_wrong_input(spark, odd):
    none = odd.limit(0)
    assert category_index(none, ["n"]).count() == 0 and sparse_one_hot(none, ["n"]).count() == 0
    nulls = odd.withColumn("n", F.lit(None).cast("double"))
    assert all(r["indicators"] == (0, []) for r in sparse_one_hot(nulls, ["n"]).collect())
    with pytest.raises(ValueError):
        category_index(odd, ["n", "N"][:1] * 2)
    with pytest.raises(ValueError):
        category_index(odd, ["absent"])
    with pytest.raises(ValueError):
        sparse_one_hot(odd, ["n"], output="ID")


def test_hundred_thousand_categories(spark):
    """A wide column with a third of the rows in one category, without broadcast of the index."""
    n = 150_000
    df = spark.range(0, n, 1, 6).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.format_string("v%06d", "id")).alias("c"))
    values = sorted({"hot"} | {f"v{i:06d}" for i in range(n) if i % 3})
    assert len(values) == 100_001 > indicators.BROADCAST_CATEGORIES
    out = sparse_one_hot(df, ["c"])
    want = {v: i for i, v in enumerate(values)}
    wrong = [r for r in out.collect() if r["indicators"] != (len(values), [want[r["c"]]])]
    assert not wrong and out.count() == n
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def _top(values, k):
    ranked = sorted(Counter(values).items(), key=lambda p: (-p[1], p[0] is None, p[0] or ""))
    return [(v, n, i + 1) for i, (v, n) in enumerate(ranked[:k])]


def _found(df, k, c, **options):
    return [(r["value"], r["count"], r["rank"]) for r in top_values(df, k, [c], **options).orderBy("rank").collect()]


@pytest.mark.parametrize("k", [1, 3, 50])
@pytest.mark.parametrize("buckets", [1, 4, 1 << 14])
def test_top_values_are_exact(spark, k, buckets):
    """Skewed, flat and short columns, whatever the number of buckets."""
    rows = [(f"s{int((i * 7919 % 1009) ** 0.5)}" if i % 11 else None, f"u{i}", "ab"[i % 2]) for i in range(900)]
    df = spark.createDataFrame(rows, "skewed string, flat string, short string").repartition(4)
    for i, c in enumerate(df.columns):
        assert _found(df, k, c, buckets=buckets) == _top([r[i] for r in rows], k)


def test_settled_rows_are_spread_in_the_shuffle_join(spark, monkeypatch):
    """Rows of a hot category and nulls meet the index in many tasks, not in the one of a null key."""
    monkeypatch.setattr(indicators, "BROADCAST_CATEGORIES", 0)
    value = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.format_string("v%d", "id"))
    df = spark.range(0, 6000, 1, 32).select("id", value.alias("c"))
    index = category_index(df, ["c"])
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        out = sparse_one_hot(df, ["c"], index).withColumn("task", F.spark_partition_id())
        tasks = {r["task"]: r["n"] for r in out.where("c is null or c = 'hot'").groupBy("task").agg(F.count("id").alias("n")).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sum(tasks.values()) == 4000 and len(tasks) >= 6 and max(tasks.values()) <= 1200


def test_top_values_without_broadcast(spark, odd, monkeypatch):
    monkeypatch.setattr(indicators, "BROADCAST_CATEGORIES", 0)
    assert _found(odd, 3, "x.y") == _top([r[1] for r in ODD], 3)


def test_top_values_edges(spark, odd):
    assert top_values(odd.limit(0), 3).count() == 0
    assert top_values(odd.select("id"), 3).count() == 0
    assert {r["column"] for r in top_values(odd, 2).collect()} == {"x.y"}
    assert _found(odd, 2, "n") == [("2.5", 4, 1), ("1.0", 3, 2)]
    for k in (0, indicators.MOST_RANKS + 1):
        with pytest.raises(ValueError):
            top_values(odd, k)
