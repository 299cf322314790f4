"""Vectors as whole numbers: which rows take part, rounding down, and numpy views of list columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.schema import safe_col

#: Squared lengths stay below this, so that sums of products and of squared differences fit 64 bits.
MAX_SQUARED = 1 << 60
#: Up to this bound on sums of products, double arithmetic on whole numbers is exact.
EXACT_DOUBLE = 1 << 52


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def takes_part(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~bad


def whole_vectors(df: DataFrame, vector_col: str, scale: float, **carry: str) -> DataFrame:
    """Rows that take part, with ``ints`` = floor(scale * component) as array<bigint>, ``squared`` (its squared length) and ``carry`` (name=input column).

    A squared length of MAX_SQUARED or more raises: its products would not fit a long.
    """
    vector = safe_col(vector_col).cast("array<double>")
    scaled = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x))
    squared = F.aggregate(scaled, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
    fits = F.when(squared < F.lit(float(MAX_SQUARED)), squared.cast("long")).otherwise(
        F.raise_error(F.lit("a vector is too long for whole-number products")).cast("long")
    )
    rows = df.filter(takes_part(vector))
    return rows.select(*[safe_col(c).alias(n) for n, c in carry.items()], scaled.alias("ints"), fits.alias("squared"))


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """One row per list of ``column`` (whole numbers); shorter lists are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if len(values) == len(lengths) * width:
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[row, place] = values
    return out


def products(a: np.ndarray, b: np.ndarray, bound: float) -> np.ndarray:
    """All inner products of the rows of two whole-number matrices, exactly; ``bound`` is at least any sum of |products|."""
    if bound < EXACT_DOUBLE:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T
