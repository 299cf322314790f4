"""How filters interact: every order of them, and what each one is worth (operator 13).

Every document has a set of filters that it fails.  For each part of the corpus
all coalitions of filters are tabulated: how many documents a coalition removes,
whatever the order.  What a step of an order removes is the difference of two
coalitions.  A filter's Shapley value is the solution of the constrained least
squares problem over the coalitions: values whose sums over the coalitions are
nearest to the removals, weighted by the Shapley kernel, under the condition
that all values add up to the whole removal.  Its normal equations are solved in
rationals, so values are exact.

Documents are read once; their failure sets, hashes and parts go to a narrow
table.  Counts are summed in the tasks first, at most 32 rows a part.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.llm.common import BROADCAST_ROWS, documents, lookup, pick, ship_package, stage

LETTERS = "ABCDE"
#: The filter that looks beyond its document: copies of a text with a smaller id.
COPY = LETTERS.index("E")
#: Fixed values of the contract: least words, least share of distinct words and most capitals in hundredths.
LEAST_WORDS, DISTINCT_SHARE, CAPITALS_SHARE = 50, 65, 5
MARKS = "[#$%&*|]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SPACE = r"[\x20\x09-\x0D]+"


# --- the game ---------------------------------------------------------------


def removals(counts: np.ndarray) -> np.ndarray:
    """Coalition (a bit mask) → how many documents fail at least one of its filters; ``counts`` by the set failed."""
    masks = np.arange(len(counts))
    return ((masks[:, None] & masks) > 0).astype(np.int64) @ counts


def shapley(worth: list[int]) -> list[Fraction]:
    """Shapley values of the game ``worth`` (by coalition mask, 0 for the empty one), by constrained least squares.

    Minimises the sum over all proper coalitions S of n of the m players of
    k(S) (worth(S) - sum of values in S)^2, with k(S) = (m - 1) / (C(m, |S|) |S| (m - |S|)),
    under: all values add up to the whole worth.
    """
    m = len(worth).bit_length() - 1
    whole = Fraction(worth[-1] - worth[0])
    if m < 2:
        return [whole] * m
    # Normal equations, bordered by the condition and its multiplier.
    rows = [[Fraction(0)] * (m + 2) for _ in range(m + 1)]
    for mask in range(1, len(worth) - 1):
        inside = [i for i in range(m) if mask >> i & 1]
        weight = Fraction(m - 1, comb(m, len(inside)) * len(inside) * (m - len(inside)))
        for i in inside:
            rows[i][m + 1] += weight * (worth[mask] - worth[0])
            for j in inside:
                rows[i][j] += weight
    for i in range(m):
        rows[i][m] = rows[m][i] = Fraction(1)
    rows[m][m + 1] = whole
    for at in range(m + 1):
        pivot = next(r for r in range(at, m + 1) if rows[r][at])
        rows[at], rows[pivot] = rows[pivot], rows[at]
        rows[at] = [x / rows[at][at] for x in rows[at]]
        for r in range(m + 1):
            if r != at and rows[r][at]:
                rows[r] = [x - rows[r][at] * y for x, y in zip(rows[r], rows[at])]
    return [rows[i][m + 1] for i in range(m)]


# --- failures ---------------------------------------------------------------


def alone(text: Column) -> Column:
    """Bit mask of the filters A to D that a text fails by itself."""
    words = F.array_remove(F.split(text, _SPACE), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    fails = [
        n < LEAST_WORDS,
        100 * distinct.cast("long") < DISTINCT_SHARE * n.cast("long"),
        100 * capitals.cast("long") > CAPITALS_SHARE * F.length(text).cast("long"),
        text.rlike(MARKS),
    ]
    mask = F.lit(0)
    for bit, failed in enumerate(fails):
        mask = mask + F.when(failed, 1 << bit).otherwise(0)
    return mask


def _marked(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with good and toxic (0 or 1): whether any label row of the id says 1; rows without id have no label."""
    by_id = (
        labels.filter(F.col("id").isNotNull())
        .groupBy("id")
        .agg(*[F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0))).alias(c) for c in ("good", "toxic")])
        .filter("good + toxic > 0")
    )
    if labels.count() <= BROADCAST_ROWS:
        by_id = F.broadcast(by_id)
    # Rows without id would all meet in one task of a shuffle join.
    joined = rows.filter(F.col("id").isNotNull()).join(by_id, "id", "left")
    rest = rows.filter(F.col("id").isNull()).withColumns({"good": F.lit(0), "toxic": F.lit(0)})
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in ("good", "toxic")}).unionByName(rest)


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: part, failed (bit mask over LETTERS), good, toxic.

    ``docs`` has id, text, part; ``labels`` has id, good, toxic (1 counts).  A null
    text is empty, a null part the empty string.  A text is a copy if a smaller id
    has the same one: rows of the same id and text are no copies of each other, a
    row without id is a copy of any that has one.  An id with several labels is
    good (toxic) if one of them says so.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = docs.select(
        "id", F.coalesce(F.col("part"), F.lit("")).alias("part"), alone(text).alias("alone"), F.unhex(F.sha2(text, 256)).alias("digest")
    )
    rows = stage(narrow, "audit-rows")
    groups = rows.groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    together = lookup(rows, groups, ["digest"], "n", rows.count())
    copy = F.coalesce(F.col("id") > F.col("first"), F.col("first").isNotNull())
    failed = F.col("alone") + F.when(copy, 1 << COPY).otherwise(0)
    return _marked(together.select("id", "part", failed.alias("failed")), labels).select("part", "failed", "good", "toxic")


# --- the audit --------------------------------------------------------------

_COLUMNS = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, "
    "good_lost bigint, toxic_lost bigint, shapley bigint"
)


def audit_part(counts: np.ndarray, letters: str = LETTERS) -> dict[str, np.ndarray | list]:
    """All steps of all orders; ``counts`` has by failure set the documents, the good and the toxic ones (3 x 2^m)."""
    m = len(letters)
    orders = list(permutations(range(m)))
    filters = np.array(orders)
    after = np.cumsum(1 << filters, 1)
    before = after - (1 << filters)
    all_removed, good, toxic = (removals(c) for c in counts)
    total, every = counts[0].sum(), (1 << m) - 1
    removed = all_removed[after] - all_removed[before]
    values = [v * factorial(m) for v in shapley(all_removed.tolist())]
    assert all(v.denominator == 1 for v in values)
    return {
        "filter_order": ["".join(letters[i] for i in o) for o in orders for _ in o],
        "step": np.tile(np.arange(1, m + 1), len(orders)).astype(np.int32),
        "kept": (total - all_removed[after]).ravel(),
        "removed": removed.ravel(),
        "redundant": (all_removed[1 << filters] - removed).ravel(),
        "unique_fails": (all_removed[every] - all_removed[every ^ (1 << filters)]).ravel(),
        "good_lost": (good[after] - good[before]).ravel(),
        "toxic_lost": (toxic[after] - toxic[before]).ravel(),
        "shapley": np.array([int(v) for v in values], np.int64)[filters].ravel(),
    }


def audit(rows: DataFrame) -> DataFrame:
    """For every part, order of the filters and step the counts of the contract; ``rows`` as ``failures`` gives them.

    ``kept`` after the step, ``removed`` by it, ``redundant`` failing its filter but
    removed earlier, ``unique_fails`` failing its filter alone, ``good_lost`` and
    ``toxic_lost`` among the removed, ``shapley`` the filter's removals summed over
    all orders (their number times its Shapley value).  No rows give no parts.
    """
    ship_package(rows.sparkSession)
    counts = rows.groupBy("part", "failed").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").cast("long").alias("good"), F.sum("toxic").cast("long").alias("toxic")
    )
    # At most 2^5 entries a part.
    tables = counts.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("sets"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, sets in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held = np.zeros((3, 1 << len(LETTERS)), np.int64)
                for s in sets:
                    held[:, s["failed"]] = s["n"], s["good"], s["toxic"]
                steps = audit_part(held)
                yield pa.RecordBatch.from_pydict({"part": [part] * len(steps["step"]), **steps})

    return tables.mapInArrow(run, _COLUMNS)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 120 orders of the five filters over every source's documents."""
    docs = pick(documents(spark, sf_dir), id="doc_id", text="text", part="source")
    labels = pick(spark.read.parquet(f"{sf_dir}/labels.parquet"), id="doc_id", good="quality", toxic="toxic")
    return audit(failures(docs, labels))


ORACLE_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
  FROM documents
), marks AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels GROUP BY doc_id
), fails AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN coalesce(doc_id > first_id, first_id IS NOT NULL) THEN 16 ELSE 0 END AS failed
  FROM texts LEFT JOIN marks USING (doc_id)
), counts AS (
  SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM fails GROUP BY part, failed
), letters AS (
  SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS l(letter, bit)
), orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
         [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31
), steps AS (
  SELECT filter_order, step, bits[step] AS bit, CAST(list_sum(bits[1 : step]) AS INTEGER) AS after
  FROM (SELECT filter_order, bits, unnest([1, 2, 3, 4, 5]) AS step FROM orders)
), tallied AS (
  SELECT part, filter_order, step, bit,
         CAST(coalesce(sum(n) FILTER (failed & after = 0), 0) AS BIGINT) AS kept,
         CAST(coalesce(sum(n) FILTER (failed & bit > 0 AND failed & (after - bit) = 0), 0) AS BIGINT) AS removed,
         CAST(coalesce(sum(n) FILTER (failed & bit > 0 AND failed & (after - bit) > 0), 0) AS BIGINT) AS redundant,
         CAST(coalesce(sum(n) FILTER (failed = bit), 0) AS BIGINT) AS unique_fails,
         CAST(coalesce(sum(good) FILTER (failed & bit > 0 AND failed & (after - bit) = 0), 0) AS BIGINT) AS good_lost,
         CAST(coalesce(sum(toxic) FILTER (failed & bit > 0 AND failed & (after - bit) = 0), 0) AS BIGINT) AS toxic_lost
  FROM counts, steps
  GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM tallied
"""
