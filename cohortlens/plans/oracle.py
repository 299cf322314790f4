"""DuckDB SQL for every named query, used to check the Spark results.

Written independently of the Spark code: the survey view, the cleaning rule
and each analysis are plain SQL over the pre-registered ``lineitem`` view.
"""

from __future__ import annotations

from cohortlens.operators.summaries import SURVEY_SUMMARIES
from cohortlens.plans import columns as C
from cohortlens.plans import edge_views as E

SURVEY = """
survey AS (
  SELECT
    l_orderkey * 8 + l_linenumber AS "id",
    CASE WHEN l_linestatus = 'O' THEN 'Male' ELSE 'Female' END AS "Gender",
    nullif(l_quantity, 13.0) AS "Age",
    'City' || CAST(l_suppkey % 7 AS VARCHAR) AS "City",
    CASE WHEN l_partkey % 10 = 0 THEN NULL WHEN l_partkey % 3 = 0 THEN 'Intern' ELSE 'Student' END AS "Profession",
    CAST(l_orderkey % 6 AS DOUBLE) AS "Academic Pressure",
    CAST(l_partkey % 6 AS DOUBLE) AS "Work Pressure",
    CAST(nullif(l_suppkey % 11, 10) AS DOUBLE) AS "CGPA",
    CAST(l_partkey % 5 + 1 AS DOUBLE) AS "Study Satisfaction",
    CAST(l_suppkey % 5 + 1 AS DOUBLE) AS "Job Satisfaction",
    CASE l_orderkey % 7
      WHEN 0 THEN 'Less than 5 hours'
      WHEN 1 THEN '5-6 hours'
      WHEN 2 THEN ' 7-8 Hours '
      WHEN 3 THEN 'More than 8 hours'
      WHEN 4 THEN CASE WHEN l_linenumber % 2 = 0 THEN '7' ELSE 'Others' END
      WHEN 6 THEN '30-40 hours'
    END AS "Sleep Duration",
    CASE l_orderkey % 3 WHEN 0 THEN 'Healthy' WHEN 1 THEN 'Moderate' ELSE 'Unhealthy' END AS "Dietary Habits",
    'D' || CAST(l_partkey % 5 AS VARCHAR) AS "Degree",
    CASE WHEN l_returnflag = 'A' THEN 'Yes' ELSE 'No' END AS "Have you ever had suicidal thoughts ?",
    CAST(l_partkey % 12 AS DOUBLE) AS "Work/Study Hours",
    CAST(l_linenumber + 1 AS DOUBLE) AS "Financial Stress",
    CASE WHEN l_suppkey % 2 = 0 THEN 'Yes' ELSE 'No' END AS "Family History of Mental Illness",
    CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INTEGER) AS "Depression"
  FROM lineitem
)"""

# Sleep text → number, for the answers the survey view produces.
_T = "lower(trim(\"Sleep Duration\"))"
_PARTS = f"string_split(replace({_T}, ' hours', ''), '-')"
PARSED_SLEEP = f"""CAST(CASE
      WHEN {_T} = 'less than 5 hours' THEN 4.0
      WHEN {_T} = 'more than 8 hours' THEN 9.0
      WHEN contains({_T}, '-') AND len({_PARTS}) = 2
        THEN (TRY_CAST({_PARTS}[1] AS DOUBLE) + TRY_CAST({_PARTS}[2] AS DOUBLE)) / 2.0
    END AS REAL)"""

CLEAN_RANGES = f"""
clean_ranges AS (
  SELECT * FROM (
    SELECT * REPLACE ({PARSED_SLEEP} AS "Sleep Duration")
    FROM survey WHERE "Sleep Duration" IS NOT NULL AND "Age" IS NOT NULL
  ) WHERE "Sleep Duration" BETWEEN 0 AND 24 AND "Age" > 0
)"""

CLEAN_NUMERIC = """
clean_numeric AS (
  SELECT * FROM (
    SELECT * REPLACE (TRY_CAST("Sleep Duration" AS REAL) AS "Sleep Duration")
    FROM survey WHERE "Sleep Duration" IS NOT NULL AND "Age" IS NOT NULL
  ) WHERE "Sleep Duration" BETWEEN 0 AND 24 AND "Age" > 0
)"""

ROW_FEATURES = """
row_features AS (
  SELECT *,
    ("Academic Pressure" + "Work Pressure" + "Financial Stress") / 3.0 AS stress_index,
    CASE WHEN "Sleep Duration" < 6 THEN 'Low'
         WHEN "Sleep Duration" >= 6 AND "Sleep Duration" <= 8 THEN 'Normal'
         ELSE 'High' END AS sleep_category,
    CASE WHEN "Age" >= 18 AND "Age" <= 21 THEN '18-21'
         WHEN "Age" >= 22 AND "Age" <= 25 THEN '22-25'
         WHEN "Age" >= 26 AND "Age" <= 30 THEN '26-30'
         ELSE '>30' END AS age_group
  FROM clean_ranges
)"""


def _scaled(c: str, alias: str) -> str:
    lo, hi = f"(SELECT min({c}) FROM row_features)", f"(SELECT max({c}) FROM row_features)"
    return (
        f"CASE WHEN {lo} IS NOT DISTINCT FROM {hi} AND NOT coalesce(isnan({lo}), false) THEN 0.0 "
        f"ELSE ({c} - {lo}) / ({hi} - {lo}) END AS {alias}"
    )


FEATURES = f"""
features AS (
  SELECT *,
    {_scaled('"CGPA"', '"CGPA_normalized"')},
    {_scaled('CAST("Depression" AS DOUBLE)', '"Depression_normalized"')},
    {_scaled('stress_index', '"stress_index_normalized"')},
    CAST(CASE WHEN "Gender" = 'Female' THEN 1 ELSE 0 END AS INTEGER) AS "Gender_Female",
    CAST(CASE WHEN "Gender" = 'Male' THEN 1 ELSE 0 END AS INTEGER) AS "Gender_Male"
  FROM row_features
)"""

HIGH_RISK = """
high_risk AS (
  SELECT *, 'Stress or Poor Sleep or High Financial Stress' AS risk_reason
  FROM features
  WHERE stress_index_normalized > 0.7 OR "Sleep Duration" < 5 OR "Financial Stress" > 7
)"""

BASE = [SURVEY, CLEAN_RANGES, CLEAN_NUMERIC, ROW_FEATURES, FEATURES, HIGH_RISK]


def with_base(select: str) -> str:
    """Prefix a SELECT with the survey, cleaning, feature and risk views."""
    return "WITH " + ",".join(BASE) + "\n" + select


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def null_counts_sql() -> str:
    return with_base(
        _union([f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {q(c)} IS NULL) AS n_null FROM survey" for c in C.SURVEY_COLUMNS])
    )


def describe_sql(cols: list[str], table: str) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", count({q(c)}) AS \"count\", round(avg(CAST({q(c)} AS DOUBLE)), 6) AS mean, "
        f"round(stddev_samp(CAST({q(c)} AS DOUBLE)), 6) AS stddev, CAST(min({q(c)}) AS DOUBLE) AS \"min\", "
        f"CAST(max({q(c)}) AS DOUBLE) AS \"max\" FROM {table}"
        for c in cols
    ]
    return with_base(_union(parts))


def quality_profile_sql(all_cols: list[str], numeric: list[str], table: str) -> str:
    parts = []
    for c in all_cols:
        if c in numeric:
            parts.append(
                f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {q(c)} IS NULL) AS n_null, count({q(c)}) AS \"count\", "
                f"round(avg(CAST({q(c)} AS DOUBLE)), 6) AS mean, round(stddev_samp(CAST({q(c)} AS DOUBLE)), 6) AS stddev, "
                f"CAST(min({q(c)}) AS DOUBLE) AS \"min\", CAST(max({q(c)}) AS DOUBLE) AS \"max\" FROM {table}"
            )
        else:
            parts.append(
                f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {q(c)} IS NULL) AS n_null, CAST(NULL AS BIGINT) AS \"count\", "
                f"CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS stddev, CAST(NULL AS DOUBLE) AS \"min\", "
                f"CAST(NULL AS DOUBLE) AS \"max\" FROM {table}"
            )
    return with_base(_union(parts))


def value_counts_sql(cols: list[str], table: str) -> str:
    return with_base(
        _union(
            [
                f"SELECT '{c}' AS \"column\", CAST({q(c)} AS VARCHAR) AS \"value\", count(*) AS \"count\" FROM {table} GROUP BY {q(c)}"
                for c in cols
            ]
        )
    )


def _pairs(cols: list[str]) -> list[tuple[str, str]]:
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]


def _corr_expr(a: str, b: str, nulls: str) -> str:
    if nulls == "zero":
        return f"corr(coalesce(CAST({q(a)} AS DOUBLE), 0.0), coalesce(CAST({q(b)} AS DOUBLE), 0.0))"
    return f"corr(CAST({q(a)} AS DOUBLE), CAST({q(b)} AS DOUBLE))"


def corr_pairs_sql(cols: list[str], nulls: str = "zero", table: str = "features") -> str:
    pairs = _pairs(cols)
    aggs = ", ".join(f"{_corr_expr(a, b, nulls)} AS r{k}" for k, (a, b) in enumerate(pairs))
    rows = _union([f"SELECT '{a}' AS column1, '{b}' AS column2, round(r{k}, 9) AS correlation FROM agg" for k, (a, b) in enumerate(pairs)])
    return with_base(f"SELECT * FROM (WITH agg AS (SELECT {aggs} FROM {table})\n{rows})")


def corr_top_sql(cols: list[str], target: str, k: int, table: str = "features") -> str:
    pairs = [(a, b) for (a, b) in _pairs(cols) if target in (a, b)]
    aggs = ", ".join(f"{_corr_expr(a, b, 'zero')} AS r{n}" for n, (a, b) in enumerate(pairs))
    rows = _union([f"SELECT '{a}' AS column1, '{b}' AS column2, r{n} AS correlation FROM agg" for n, (a, b) in enumerate(pairs)])
    return with_base(
        f"SELECT column1, column2, round(correlation, 9) AS correlation, round(abs(correlation), 9) AS abs_corr FROM "
        f"(WITH agg AS (SELECT {aggs} FROM {table})\n{rows}) ORDER BY round(abs(correlation), 9) DESC NULLS LAST, "
        f"column1, column2 LIMIT {k}"
    )


def corr_matrix_sql(cols: list[str], table: str = "features") -> str:
    labels = sorted(cols)
    pairs = _pairs(cols)
    index = {p: n for n, p in enumerate(pairs)}
    aggs = ", ".join(f"{_corr_expr(a, b, 'zero')} AS r{n}" for n, (a, b) in enumerate(pairs))

    def cell(a: str, b: str) -> str:
        if a == b:
            return "1.0"
        return f"round(r{index.get((a, b), index.get((b, a)))}, 9)"

    rows = _union(
        ["SELECT '" + a + "' AS \"column\", " + ", ".join(f"{cell(a, b)} AS {q(b)}" for b in labels) + " FROM agg" for a in labels]
    )
    return with_base(f"SELECT * FROM (WITH agg AS (SELECT {aggs} FROM {table})\n{rows})")


def _scaled_from(c: str, alias: str, table: str) -> str:
    lo, hi = f"(SELECT min({q(c)}) FROM {table})", f"(SELECT max({q(c)}) FROM {table})"
    return (
        f"CASE WHEN {lo} IS NOT DISTINCT FROM {hi} AND NOT coalesce(isnan({lo}), false) THEN 0.0 "
        f"ELSE ({q(c)} - {lo}) / ({hi} - {lo}) END AS {q(alias)}"
    )


_RISK_DATA = """d AS (
  SELECT x FROM (SELECT CAST(stress_index_normalized AS DOUBLE) AS x FROM high_risk)
  WHERE x IS NOT NULL AND NOT isnan(x)
)"""

HISTOGRAM = f"""SELECT * FROM (WITH {_RISK_DATA},
r AS (
  SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
         CASE WHEN min(x) = max(x) THEN max(x) + 0.5 ELSE max(x) END AS hi
  FROM d
),
c AS (
  SELECT CAST(least(floor((x - lo) / ((hi - lo) / 20.0)), 19) AS INTEGER) AS bin, count(*) AS cnt
  FROM d CROSS JOIN r GROUP BY 1
)
SELECT g.bin AS bin,
       lo + g.bin * ((hi - lo) / 20.0) AS bin_start,
       lo + (g.bin + 1) * ((hi - lo) / 20.0) AS bin_end,
       CAST(coalesce(c.cnt, 0) AS BIGINT) AS "count"
FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(20)) g CROSS JOIN r LEFT JOIN c ON g.bin = c.bin)"""

DENSITY = f"""SELECT * FROM (WITH {_RISK_DATA},
st AS (SELECT min(x) AS lo, max(x) AS hi, stddev_samp(x) AS sd, count(*) AS n FROM d),
p AS (SELECT lo, hi, n, sd * pow(CAST(n AS DOUBLE), -0.2) AS h FROM st),
g AS (SELECT CAST(range AS INTEGER) AS point, lo + range * ((hi - lo) / 199.0) AS gx, h, n FROM range(200) CROSS JOIN p)
SELECT g.point AS point, round(g.gx, 9) AS x,
       round(sum(exp(-0.5 * pow((g.gx - d.x) / g.h, 2))) / (g.n * g.h * sqrt(2 * pi())), 9) AS density
FROM g CROSS JOIN d GROUP BY g.point, g.gx, g.h, g.n)"""

RISK_REASONS = """SELECT "id", concat_ws(',',
    CASE WHEN stress_index_normalized > 0.7 THEN 'high_stress' END,
    CASE WHEN "Sleep Duration" < 5 THEN 'poor_sleep' END,
    CASE WHEN "Financial Stress" > 7 THEN 'financial_stress' END) AS risk_reasons
FROM features
WHERE stress_index_normalized > 0.7 OR "Sleep Duration" < 5 OR "Financial Stress" > 7"""


def _edge_pairs_sql(columns: dict[str, str], zero: bool) -> str:
    """Pairs of edge columns: no spread gives NaN or null, NaN in a pair's rows gives NaN."""
    pairs = _pairs(list(columns))
    parts = []
    for a, b in pairs:
        x, y = (f"coalesce({c}, 0.0)" if zero else c for c in (a, b))
        there = f"FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL)"
        clean = f"FILTER (WHERE {x} IS NOT NULL AND {y} IS NOT NULL AND NOT isnan({x}) AND NOT isnan({y}))"
        parts.append(
            f"SELECT '{a}' AS column1, '{b}' AS column2, round(CASE WHEN count(*) {there} < 2 "
            f"OR min({x}) {there} = max({x}) {there} OR min({y}) {there} = max({y}) {there} "
            f"THEN {E.NAN if zero else 'NULL'} WHEN count(*) {there} > count(*) {clean} THEN {E.NAN} "
            f"ELSE corr({x}, {y}) {clean} END, 9) AS correlation FROM e"
        )
    return f"WITH e AS (SELECT {', '.join(E.columns_sql(columns))} FROM lineitem)\n" + _union(parts)


def _answers_sql() -> str:
    def text(pattern: str) -> str:
        out = "'" + pattern.replace("\t", "' || chr(9) || '").replace("\n", "' || chr(10) || '") + "'"
        return out.replace("{a}", "' || CAST(a AS VARCHAR) || '").replace("{b}", "' || CAST(b AS VARCHAR) || '")

    raw = " ".join(f"WHEN {i} THEN {text(t)}" for i, (t, _) in enumerate(E.ANSWERS))
    value = " ".join(f"WHEN {i} THEN CAST({v} AS REAL)" for i, (_, v) in enumerate(E.ANSWERS))
    return (
        f"WITH e AS (SELECT l_orderkey * 8 + l_linenumber AS id, (l_orderkey + l_partkey) % {len(E.ANSWERS)} AS i, "
        f"l_linenumber AS a, l_partkey % 50 AS b FROM lineitem)\n"
        f"SELECT id, CASE i {raw} END AS raw, CASE i {value} END AS parsed FROM e"
    )


MINMAX_CONSTANT = f"""SELECT l_orderkey * 8 + l_linenumber AS id,
  CAST(0.0 AS DOUBLE) AS flat_normalized, CAST(0.0 AS DOUBLE) AS nothing_normalized, {E.NAN} AS not_number_normalized,
  (CAST({E.RANGES['wide']} AS DOUBLE) + 2000000000.0) / 4000000000.0 AS wide_normalized
FROM lineitem"""


def _job_results_sql() -> str:
    aggregate = {"avg": "avg", "stddev": "stddev_samp", "count": "count"}
    parts = []
    for name, keys, measures in SURVEY_SUMMARIES:
        key = [f"CAST({q(k)} AS VARCHAR)" for k in keys] + ["CAST(NULL AS VARCHAR)"]
        value = [
            f"round(CAST({aggregate[f]}({'*' if c == '*' else q(c)}) AS DOUBLE), 9)" for f, c in measures.values()
        ] + ["CAST(NULL AS DOUBLE)"]
        parts.append(
            f"SELECT '{name}' AS output, {key[0]} AS key1, {key[1]} AS key2, {value[0]} AS value1, {value[1]} AS value2 "
            f"FROM features GROUP BY {', '.join(q(k) for k in keys)}"
        )
    parts += [
        f"SELECT 'correlation_matrix', '{a}', '{b}', round({_corr_expr(a, b, 'zero')}, 9), CAST(NULL AS DOUBLE) FROM features"
        for a, b in _pairs(C.SURVEY_NUMERIC_FEATURES)
    ]
    top = corr_top_sql(C.SURVEY_NUMERIC_FEATURES, "Depression", 5).removeprefix(with_base(""))
    profile = quality_profile_sql(C.SURVEY_COLUMNS, C.ALL_NUMERIC_CLEAN, "clean_ranges").removeprefix(with_base(""))
    counts = value_counts_sql(C.STRING_COLUMNS, "clean_ranges").removeprefix(with_base(""))
    none = "CAST(NULL AS VARCHAR)"
    parts += [
        f"SELECT 'depression_correlations', column1, column2, correlation, abs_corr FROM ({top})",
        f"SELECT 'profile', \"column\", {none}, CAST(n_null AS DOUBLE), mean FROM ({profile})",
        f"SELECT 'value_counts', \"column\", \"value\", CAST(\"count\" AS DOUBLE), CAST(NULL AS DOUBLE) FROM ({counts})",
    ]
    for name, table, c in (("processed", "clean_ranges", "CGPA"), ("features", "features", "Gender_Female"), ("high_risk", "high_risk", "Depression")):
        parts.append(f"SELECT '{name}', {none}, {none}, CAST(count(*) AS DOUBLE), CAST(sum({q(c)}) AS DOUBLE) FROM {table}")
    return with_base(_union(parts))


def _categories_sql(select: str) -> str:
    """``select`` over the categories: edge (the rows), listed (column, value) and numbered (with positions)."""
    listed = " UNION ALL ".join(f"SELECT {i} AS ord, '{c}' AS col, {c} AS val FROM edge" for i, c in enumerate(E.CATEGORIES))
    return f"""
WITH edge AS (SELECT l_orderkey * 8 + l_linenumber AS id, {", ".join(E.columns_sql(E.CATEGORIES))} FROM lineitem),
listed AS ({listed}),
numbered AS (
  SELECT col, val, count(*) AS n, row_number() OVER (ORDER BY ord, val) - 1 AS position
  FROM listed WHERE val IS NOT NULL GROUP BY ord, col, val)
{select}"""


CATEGORY_INDEX = 'SELECT col AS "column", val AS category, position, n AS n_rows FROM numbered'

ONE_HOT_SPARSE = f"""
SELECT id, (SELECT count(*) FROM numbered) AS n_categories,
  concat_ws(',', {", ".join(f"{c}_p.position" for c in E.CATEGORIES)}) AS places
FROM edge
{" ".join(f"LEFT JOIN numbered {c}_p ON {c}_p.col = '{c}' AND {c}_p.val = edge.{c}" for c in E.CATEGORIES)}"""

TOP_VALUES = """
SELECT col AS "column", val AS "value", n AS "count", CAST(rank AS INTEGER) AS rank FROM (
  SELECT col, val, count(*) AS n, row_number() OVER (PARTITION BY col ORDER BY count(*) DESC, val ASC NULLS LAST) AS rank
  FROM listed GROUP BY col, val)
WHERE rank <= 7"""


def oracle_queries() -> dict[str, str]:
    minmax_cols = ["CGPA", "Study Satisfaction", "Work/Study Hours", "Financial Stress"]
    cities = [f"City{i}" for i in range(7)]
    order = ", ".join(f"{q(c)} ASC NULLS FIRST" for c in C.SURVEY_COLUMNS)
    return {
        "clean_ranges": with_base("SELECT * FROM clean_ranges"),
        "sleep_cgpa": with_base(
            'SELECT sleep_category, avg("CGPA") AS avg_cgpa, round(stddev_samp("CGPA"), 9) AS stddev_cgpa '
            "FROM features GROUP BY sleep_category"
        ),
        "survey_load": with_base("SELECT * FROM survey"),
        "text_range_parse": with_base(
            f'SELECT "id", "Sleep Duration" AS raw_sleep, {PARSED_SLEEP} AS parsed_sleep FROM survey'
        ),
        "clean_numeric": with_base("SELECT * FROM clean_numeric"),
        "row_features": with_base('SELECT "id", stress_index, sleep_category, age_group FROM row_features'),
        "minmax_scale": with_base(
            'SELECT "id", '
            + ", ".join(q(c) for c in minmax_cols)
            + ", "
            + ", ".join(_scaled_from(c, f"{c}_normalized", "clean_ranges") for c in minmax_cols)
            + " FROM clean_ranges"
        ),
        "one_hot_gender": with_base('SELECT "id", "Gender", "Gender_Female", "Gender_Male" FROM features'),
        "one_hot_city": with_base(
            'SELECT "id", "City", '
            + ", ".join(f"CAST(CASE WHEN \"City\" = '{c}' THEN 1 ELSE 0 END AS INTEGER) AS {q('City_' + c)}" for c in cities)
            + " FROM clean_ranges"
        ),
        "features": with_base("SELECT * FROM features"),
        "null_counts": null_counts_sql(),
        "describe_numeric": describe_sql(["Sleep Duration", "Depression"], "clean_ranges"),
        "describe_all_numeric": describe_sql(C.ALL_NUMERIC_CLEAN, "clean_ranges"),
        "quality_profile": quality_profile_sql(C.SURVEY_COLUMNS, C.ALL_NUMERIC_CLEAN, "clean_ranges"),
        "value_counts": value_counts_sql(C.STRING_COLUMNS, "clean_ranges"),
        "age_profession": with_base(
            'SELECT age_group, "Profession", avg("Depression") AS avg_depression FROM features GROUP BY age_group, "Profession"'
        ),
        "city_degree": with_base(
            'SELECT "City", "Degree", avg("Depression") AS avg_depression, count(*) AS count_students '
            'FROM features GROUP BY "City", "Degree"'
        ),
        "stress_by_demo": with_base(
            'SELECT age_group, "Gender", round(avg(stress_index), 9) AS avg_stress_index FROM features GROUP BY age_group, "Gender"'
        ),
        "sleep_performance": with_base(
            'SELECT sleep_category, avg("CGPA") AS avg_cgpa, avg("Academic Pressure") AS avg_academic_score '
            "FROM features GROUP BY sleep_category"
        ),
        "corr_pairs": corr_pairs_sql(C.SURVEY_NUMERIC_WITH_ID),
        "corr_top5": corr_top_sql(C.SURVEY_NUMERIC_WITH_ID, "Depression", 5),
        "corr_pairs_all": corr_pairs_sql(C.ALL_NUMERIC_FEATURES),
        "corr_pairs_pairwise": corr_pairs_sql(C.ALL_NUMERIC_FEATURES, nulls="pairwise"),
        "corr_matrix": corr_matrix_sql(C.SURVEY_NUMERIC_WITH_ID),
        "high_risk": with_base("SELECT * FROM high_risk"),
        "risk_reasons": with_base(RISK_REASONS),
        "risk_histogram": with_base(HISTOGRAM),
        "risk_density": with_base(DENSITY),
        "risk_count": with_base("SELECT count(*) AS n_high_risk FROM high_risk"),
        "csv_declared": with_base("SELECT * FROM clean_ranges"),
        # Schema inference types a column of small whole numbers as INT.
        "csv_inferred": with_base('SELECT * REPLACE (CAST("id" AS INTEGER) AS "id") FROM survey'),
        "parquet_roundtrip": with_base("SELECT * FROM features"),
        "parquet_partitioned": with_base("SELECT * FROM features"),
        "text_range_answers": _answers_sql(),
        "corr_constant": _edge_pairs_sql(E.CONSTANT, zero=True),
        "corr_pairwise_masked": _edge_pairs_sql(E.MASKED, zero=False),
        "minmax_constant": MINMAX_CONSTANT,
        "category_index": _categories_sql(CATEGORY_INDEX),
        "one_hot_sparse": _categories_sql(ONE_HOT_SPARSE),
        "top_values": _categories_sql(TOP_VALUES),
        "job_results": _job_results_sql(),
        "job_features_partitioned": with_base("SELECT * FROM features"),
        "preview_sorted": with_base(f"SELECT * FROM clean_ranges ORDER BY {order} LIMIT 20"),
    }
