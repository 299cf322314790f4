"""The range parser on texts built from known numbers, so that the value is known by construction."""

import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortlens.operators import distinct_answers, parse_once
from cohortlens.functions import py_strip, text_range_to_number, tolerant_double, try_float

#: How a number may be written: format and the values it stands for.
WRITTEN = [("{}", (0, 3, 12)), ("0{}", (4,)), ("+{}", (5,)), ("{}.", (6,)), ("{}.75", (1.75, 8.75)), ("{}e0", (9,)), ("{}_0", (20, 70))]
SPACES = ["", " ", "\t", "\u3000", " \n"]


def numbers():
    for form, values in WRITTEN:
        for v in values:
            whole = int(v) // 10 if form == "{}_0" else int(v)
            yield form.format(whole), float(v)


def _parse(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "raw string")
    return [r[0] for r in df.select(text_range_to_number("raw")).collect()]


def test_ranges_of_known_numbers(spark):
    texts, want = [], []
    for ((a, x), (b, y)), n in zip(itertools.product(numbers(), repeat=2), itertools.count()):
        space, unit = SPACES[n % 5], ["", " hours", " HOURS", " Hours"][n % 4]
        texts.append(f"{space}{a}{unit if n % 3 == 0 else ''}{space}-{space}{b}{unit}{space}")
        want.append(float(np.float32((x + y) / 2)))
    assert _parse(spark, texts) == want


def test_phrases_and_texts_without_value(spark):
    assert _parse(spark, ["\tLESS THAN 5 HOURS ", "more than 8 hours", "less  than 5 hours", "more than 9 hours"]) == [4.0, 9.0, None, None]
    numbers_ = [a for a, _ in numbers()]
    spoiled = [f"{a}{bad}{b}" for a, b in zip(numbers_, numbers_[1:]) for bad in ("--", " to ", "-x", "-0x", "d-", "- -", "\u2013")]
    spoiled += ["-" + a for a in numbers_] + [a + "-" for a in numbers_] + numbers_ + ["", " ", "-", "hours", "1__0-2", "_1-2", "1e-5-2"]
    assert _parse(spark, [*spoiled, None]) == [None] * (len(spoiled) + 1)


def test_inf_and_nan_parts(spark):
    got = _parse(spark, ["inf-5 hours", "Infinity-1", "nan-2"])
    assert got[:2] == [float("inf"), float("inf")] and np.isnan(got[2])


@pytest.mark.parametrize("digits", ["1" * 100_000, "1_" * 50_000 + "1"])
def test_very_long_numbers(spark, digits):
    """A long number neither recurses nor stops the session, whichever side it is on; it is infinite as a float."""
    assert _parse(spark, [digits + "-5 hours", "5-" + digits, digits + "x-5", "0" * 100_000 + "4-6"]) == [
        float("inf"), float("inf"), None, 5.0,
    ]


def test_result_is_float(spark):
    df = spark.createDataFrame([("1-2 hours",)], "raw string").select(text_range_to_number("raw").alias("v"))
    assert dict(df.dtypes)["v"] == "float"


def test_random_numbers_round_trip(spark):
    """Any two decimals written with random decoration give their midpoint; a third part gives nothing."""
    number = st.decimals(0, 999, places=3).map(str)
    decoration = st.sampled_from(["", " ", "\t", " hours", " hours "])
    samples: list[tuple[str, float | None]] = []

    @settings(max_examples=300, database=None, derandomize=True)
    @given(number, number, decoration, decoration, st.booleans())
    def build(a, b, one, two, third):
        text = f"{a}{one}-{b}{two}" + (f"-{a}" if third else "")
        samples.append((text, None if third else float(np.float32((float(a) + float(b)) / 2))))

    build()
    assert _parse(spark, [t for t, _ in samples]) == [v for _, v in samples]


def test_py_strip_and_tolerant_double(spark):
    df = spark.createDataFrame([(" \t a \n",), ("\x1c b ",)], "s string")
    assert [r[0] for r in df.select(py_strip("s")).collect()] == ["a", "b"]
    nums = spark.createDataFrame([("5",), (" 6.5 ",), ("5d",), ("0x10",), ("inf",), ("abc",)], "s string")
    got = [r[0] for r in nums.select(tolerant_double("s")).collect()]
    assert got[:4] == [5.0, 6.5, None, None] and got[4] == float("inf") and got[5] is None


def test_try_float_never_raises(spark):
    df = spark.createDataFrame([("11",), ("2-3 hours",), (" 4 ",)], "s string")
    assert [r[0] for r in df.select(try_float("s")).collect()] == [11.0, None, 4.0]


def test_empty_separator_rejected(spark):
    with pytest.raises(ValueError):
        text_range_to_number(F.col("x"), sep="")


ANSWERS = ["5-6 hours", " 7-8 Hours ", "Less than 5 hours", "7", "", "a-b", "x" * 300 + "-1", "1" * 300 + "-1", "Café-2", None]


@pytest.mark.parametrize("most", [None, 3, 0])
def test_each_answer_parsed_once(spark, most):
    """Few, too many and very long answers, nulls and a hot answer: the same as parsing each row."""
    rows = [(i, ANSWERS[i % len(ANSWERS)] if i % 3 else ANSWERS[0], "x") for i in range(600)]
    df = spark.createDataFrame(rows, "id int, answer string, parsed string").repartition(3)
    got = parse_once(df, "answer", text_range_to_number, "parsed", most)
    assert got.columns == ["id", "answer", "parsed"]
    want = df.select("id", "answer", text_range_to_number("answer").alias("parsed"))
    assert sorted(got.collect(), key=lambda r: r.id) == sorted(want.collect(), key=lambda r: r.id)
    assert parse_once(df.limit(0), "answer", text_range_to_number, "parsed", most).count() == 0


def test_all_distinct_answers(spark, monkeypatch):
    """Above the bound every row is parsed where it is: no join and no exchange of rows."""
    df = spark.range(5000).selectExpr("id", "concat(id, '-', id + 2, ' hours') AS answer")
    few, many = (parse_once(df, "answer", text_range_to_number, "v", most) for most in (10_000, 100))
    assert [r.v for r in few.orderBy("id").collect()] == [r.v for r in many.orderBy("id").collect()] == [i + 1.0 for i in range(5000)]
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert distinct_answers(df, "answer", 100) is None and len(distinct_answers(df, "answer", 5000)[0]) == 5000
    assert distinct_answers(df, "answer", 4999) is None
