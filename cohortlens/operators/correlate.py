"""Pearson correlation of all column pairs in one pass, strongest pairs, full matrix."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens import schema as S
from cohortlens.schema import SURVEY_NUMERIC, columns_of_types, require_columns, safe_col
from cohortlens.session import ship_package

PAIR_SCHEMA = "column1 string, column2 string, correlation double"
_PARTIAL = "first int, part int, stats binary"
_ROWS = 4096
# Statistics of a pair over its rows, one line each; pairs i < j in order of i, then j.
_N, _MEAN_X, _MEAN_Y, _M2_X, _M2_Y, _C, _LO_X, _HI_X, _LO_Y, _HI_Y = range(10)


def _columns(df: DataFrame, columns: Sequence[str] | None, types: Sequence[str]) -> list[str]:
    cols = list(columns) if columns is not None else columns_of_types(df, types)
    require_columns(df, cols)
    return cols


def _empty(pairs: int) -> np.ndarray:
    stats = np.zeros((10, pairs))
    stats[[_LO_X, _LO_Y]], stats[[_HI_X, _HI_Y]] = np.inf, -np.inf
    return stats


def _of_complete(values: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Statistics of the pairs (i, j) where every row has every column: one product of matrices."""
    mean = values.mean(0)
    centred = values - mean
    products = centred.T @ centred
    spread = np.diag(products)
    low, high = values.min(0), values.max(0)
    n = np.full(len(i), len(values))
    return np.stack([n, mean[i], mean[j], spread[i], spread[j], products[i, j], low[i], high[i], low[j], high[j]])


def _of_some(values: np.ndarray, present: np.ndarray, i: int, others: np.ndarray) -> np.ndarray:
    """Statistics of column i with ``others``, over the rows where both are present, centred on those rows' means."""
    rows = present[:, i]
    both, y = present[rows][:, others], values[rows][:, others]
    x = values[rows, i : i + 1]
    n = both.sum(0)
    out = _empty(len(others))
    some = np.maximum(n, 1)
    out[_N] = n
    out[_MEAN_X] = np.where(both, x, 0).sum(0) / some
    out[_MEAN_Y] = np.where(both, y, 0).sum(0) / some
    dx, dy = np.where(both, x - out[_MEAN_X], 0), np.where(both, y - out[_MEAN_Y], 0)
    out[_M2_X], out[_M2_Y], out[_C] = (dx * dx).sum(0), (dy * dy).sum(0), (dx * dy).sum(0)
    if len(y):
        out[_LO_X], out[_HI_X] = np.where(both, x, np.inf).min(0), np.where(both, x, -np.inf).max(0)
        out[_LO_Y], out[_HI_Y] = np.where(both, y, np.inf).min(0), np.where(both, y, -np.inf).max(0)
    return out


def _of_rows(values: np.ndarray, present: np.ndarray) -> np.ndarray:
    """Statistics of all pairs over some rows: complete columns together, a pair with a gap in either by itself."""
    k = values.shape[1]
    i, j = np.triu_indices(k, 1)
    if not len(values):
        return _empty(len(i))
    whole = present.all(0)
    if whole.all():
        return _of_complete(values, i, j)
    out = np.empty((10, len(i)))
    done = whole[i] & whole[j]
    place = np.cumsum(whole) - 1  # of a complete column among the complete ones
    if done.any():
        out[:, done] = _of_complete(values[:, whole], place[i[done]], place[j[done]])
    starts = np.searchsorted(i, np.arange(k + 1))
    for c in range(k - 1):
        gaps = starts[c] + np.flatnonzero(~done[starts[c] : starts[c + 1]])
        if len(gaps):
            out[:, gaps] = _of_some(values, present, c, j[gaps])
    return out


def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Statistics of two sets of rows together (pairwise update of means and central moments)."""
    out = np.empty_like(a)
    n = a[_N] + b[_N]
    share = b[_N] / np.maximum(n, 1)
    weight = a[_N] * share
    dx = np.where(a[_N] * b[_N] > 0, b[_MEAN_X] - a[_MEAN_X], 0)
    dy = np.where(a[_N] * b[_N] > 0, b[_MEAN_Y] - a[_MEAN_Y], 0)
    out[_N] = n
    out[_MEAN_X] = np.where(a[_N] > 0, a[_MEAN_X] + dx * share, b[_MEAN_X])
    out[_MEAN_Y] = np.where(a[_N] > 0, a[_MEAN_Y] + dy * share, b[_MEAN_Y])
    out[_M2_X] = a[_M2_X] + b[_M2_X] + dx * dx * weight
    out[_M2_Y] = a[_M2_Y] + b[_M2_Y] + dy * dy * weight
    out[_C] = a[_C] + b[_C] + dx * dy * weight
    for low, high in ((_LO_X, _HI_X), (_LO_Y, _HI_Y)):
        out[low], out[high] = np.minimum(a[low], b[low]), np.maximum(a[high], b[high])
    return out


def merge_group(task: int) -> int:
    """Group of a task's statistics for the first merge: groups of about sqrt(2 tasks), and about as many of them.

    Group g has the tasks from g * g / 2 on, so neither the number of tasks nor
    a shuffle setting need be known.
    """
    return math.isqrt(2 * task)


def _merge_sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(first, part, statistics) merged along rows that come sorted by (first, part): one key is held at a time."""
    held: tuple[int, int, np.ndarray] | None = None
    with np.errstate(invalid="ignore", over="ignore"):
        for batch in batches:
            for first, part, stats in zip(*[c.to_pylist() for c in batch.columns]):
                stats = np.frombuffer(stats).reshape(10, -1)
                if held and held[:2] == (first, part):
                    stats = _merged(held[2], stats)
                elif held:
                    yield held
                held = (first, part, stats)
    if held:
        yield held


def _correlations(stats: np.ndarray, zero: bool) -> list[float | None]:
    """Correlation of each pair; without spread NaN (``zero``) or null, decided exactly by min = max."""
    out: list[float | None] = []
    for s in stats.T:
        flat = s[_LO_X] == s[_HI_X] or s[_LO_Y] == s[_HI_Y]
        if s[_N] < (1 if zero else 2) or flat:
            out.append(float("nan") if zero else None)
            continue
        scale = float(np.sqrt(s[_M2_X]) * np.sqrt(s[_M2_Y]))
        value = float(s[_C]) / scale if scale else float("nan")
        out.append(max(-1.0, min(1.0, value)) if value == value else value)
    return out


def correlation_pairs(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    types: Sequence[str] = SURVEY_NUMERIC,
    nulls: str = "zero",
) -> DataFrame:
    """(column1, column2, correlation) for every pair i < j of the chosen columns.

    Columns default to those of the given ``types`` (32-bit int and float, as
    the survey code picks them), in schema order.

    ``nulls="zero"``: nulls count as 0.0, as ``DataFrame.stat.corr`` did; a
    column whose min equals its max, or an empty table, gives NaN.
    ``nulls="pairwise"``: each pair uses the rows where both are present, as the
    ``corr`` aggregate does; fewer than two rows, or no spread, give null.
    A NaN or infinite value in a pair's rows gives NaN.  Results lie in [-1, 1].

    One method for any number of columns and rows, in one pass: every task keeps,
    for each pair i < j, count, means, central moments, min and max over the
    pair's own rows, merged batch by batch (columns without a gap in a batch by
    one product of matrices).  Each column's statistics are then merged in two
    levels, first by groups of about sqrt(2 tasks) tasks, then all groups, so
    no task gets a row from every input task.
    """
    if nulls not in ("zero", "pairwise"):
        raise ValueError("nulls must be 'zero' or 'pairwise'")
    cols = _columns(df, columns, types)
    spark, k, zero = df.sparkSession, len(cols), nulls == "zero"
    if k < 2:
        return spark.createDataFrame([], PAIR_SCHEMA)
    ship_package(spark)
    base = df.select(*[safe_col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    if zero:
        base = base.select(*[F.coalesce(F.col(f"x{i}"), F.lit(0.0)).alias(f"x{i}") for i in range(k)])

    starts = np.concatenate([[0], np.cumsum(np.arange(k - 1, 0, -1))])

    def rows_of(part: int, stats: np.ndarray) -> Iterator[pa.RecordBatch]:
        for i in range(k - 1):
            one = np.ascontiguousarray(stats[:, starts[i] : starts[i + 1]]).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part], pa.int32()), pa.array([one], pa.binary())], names=["first", "part", "stats"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = _empty(starts[-1])
        with np.errstate(invalid="ignore", over="ignore"):
            for batch in batches:
                for at in range(0, batch.num_rows, _ROWS):
                    some = batch.slice(at, _ROWS)
                    present = np.stack([np.asarray(c.is_valid()) for c in some.columns], 1)
                    values = np.stack([c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in some.columns], 1)
                    held = _merged(held, _of_rows(values, present))
        yield from rows_of(merge_group(TaskContext.get().partitionId()), held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first, part, stats in _merge_sorted(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array([first], pa.int32()), pa.array([0], pa.int32()), pa.array([stats.tobytes()], pa.binary())], ["first", "part", "stats"]
            )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for i, _, stats in _merge_sorted(batches):
            found = _correlations(stats, zero)
            yield pa.RecordBatch.from_arrays(
                [pa.array([i] * len(found), pa.int32()), pa.array(range(i + 1, k), pa.int32()), pa.array(found, pa.float64())],
                ["i", "j", "correlation"],
            )

    # No rows at all still give every pair.
    none = spark.createDataFrame([(i, 0, bytearray(_empty(k - 1 - i).tobytes())) for i in range(k - 1)], _PARTIAL)
    by_group = (
        base.mapInArrow(partial, _PARTIAL).unionByName(none)
        .repartition("first", "part").sortWithinPartitions("first", "part").mapInArrow(merge, _PARTIAL)
    )
    found = (
        by_group.repartition("first").sortWithinPartitions("first", "part")
        .mapInArrow(finish, "i int, j int, correlation double")
    )
    names = F.array(*[F.lit(c) for c in cols])
    return found.select(names[F.col("i")].alias("column1"), names[F.col("j")].alias("column2"), "correlation")


def strongest_with(pairs: DataFrame, target: str = S.DEPRESSION, k: int = 5, digits: int = 9) -> DataFrame:
    """Top ``k`` pairs that involve ``target``, by absolute correlation.

    Adds ``abs_corr``.  NaN sorts first (it is the greatest double), null last.
    Ties are broken by the column names; the sort key is ``abs_corr`` rounded
    to ``digits`` so pairs equal up to float noise order deterministically.
    """
    hit = pairs.where((F.col("column1") == target) | (F.col("column2") == target)).withColumn(
        "abs_corr", F.abs(F.col("correlation"))
    )
    return hit.orderBy(
        F.round(F.col("abs_corr"), digits).desc_nulls_last(), F.col("column1"), F.col("column2")
    ).limit(k)


def correlation_matrix(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    types: Sequence[str] = SURVEY_NUMERIC,
    nulls: str = "zero",
) -> DataFrame:
    """Square correlation matrix: one row per column (sorted by name), one field per column, diagonal 1.0.

    A pivot of the pairs, so of k * k numbers for k columns.
    """
    cols = _columns(df, columns, types)
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], "column string")
    pairs = correlation_pairs(df, cols, nulls=nulls)
    # Every pair both ways from one read, and the diagonal with the pairs of the first column.
    cells = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("column1").alias("column"), F.col("column2").alias("other"), F.col("correlation").alias("r")),
                F.struct(F.col("column2").alias("column"), F.col("column1").alias("other"), F.col("correlation").alias("r")),
                F.struct(F.col("column1").alias("column"), F.col("column1").alias("other"), F.lit(1.0).alias("r")),
                F.struct(F.col("column2").alias("column"), F.col("column2").alias("other"), F.lit(1.0).alias("r")),
            )
        ).alias("cell")
    ).select("cell.*")
    fields = [F.max(F.when(F.col("other") == c, F.col("r"))).alias(c) for c in sorted(cols)]
    return cells.groupBy("column").agg(*fields)


def correlation_analysis(df: DataFrame, target: str = S.DEPRESSION, k: int = 5) -> dict[str, DataFrame]:
    pairs = correlation_pairs(df)
    return {"correlation_matrix": pairs, "depression_correlations": strongest_with(pairs, target, k)}
