"""Distribution summaries of one numeric column: fixed-bin histogram and Gaussian KDE."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.schema import require_columns, safe_col
from cohortlens.sqltext import dbl


#: Bandwidths beyond which exp(-z * z / 2) is zero in double precision.
REACH = 39.0


def _finite(df: DataFrame, col: str) -> DataFrame:
    x = safe_col(col).cast("double")
    return df.select(x.alias("x")).where(F.abs("x") < F.lit(float("inf")))


def histogram(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram over [min, max] of ``col``: (bin, bin_start, bin_end, count).

    Nulls, NaN and infinities are left out.  The last bin is closed.  When all values are
    equal the range is widened to value ± 0.5.  Every bin is reported, empty
    ones with count 0.  The data are read twice (range, then counts); the
    counts are one partial aggregate with at most ``bins`` groups.
    """
    require_columns(df, [col])
    if bins < 1:
        raise ValueError("bins must be positive")
    data = _finite(df, col)
    r = data.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi")).alias("r")).scalar()

    def with_edges(frame: DataFrame) -> DataFrame:
        # The range subquery attached once; equal min and max widen to ± 0.5.
        return frame.withColumn("r", r).withColumn(
            "e",
            F.struct(
                F.when(F.col("r.lo") == F.col("r.hi"), F.col("r.lo") - 0.5).otherwise(F.col("r.lo")).alias("lo"),
                F.when(F.col("r.lo") == F.col("r.hi"), F.col("r.hi") + 0.5).otherwise(F.col("r.hi")).alias("hi"),
            ),
        )

    lo, hi = F.col("e.lo"), F.col("e.hi")
    width = (hi - lo) / F.lit(float(bins))
    idx = F.least(F.floor((F.col("x") - lo) / width), F.lit(bins - 1)).cast("int")
    counts = with_edges(data).select(idx.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    # All bins, empty ones included: a grid of ``bins`` rows (bounded by the
    # argument) joined with at most ``bins`` counted rows.
    grid = with_edges(df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")))
    out = grid.join(F.broadcast(counts), "bin", "left")
    return out.select(
        "bin",
        (lo + F.col("bin") * width).alias("bin_start"),
        (lo + (F.col("bin") + 1) * width).alias("bin_end"),
        F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
    )


def gaussian_kde(
    df: DataFrame, col: str, grid_size: int = 200, cut: float = 0.0, bandwidth: float | None = None
) -> DataFrame:
    """Gaussian kernel density of ``col`` on ``grid_size`` evenly spaced points: (point, x, density).

    Bandwidth defaults to Scott's rule, ``stddev_samp · n^(-1/5)``; the grid
    spans [min − cut·h, max + cut·h].  Nulls, NaN and infinities are left out.
    Equal values are counted first, then every distinct value adds its kernel to
    the grid points within ``REACH`` bandwidths inside one generated stage:
    beyond them the kernel is zero in double precision, so the density is exact
    and a value costs as many points as its kernel covers, however fine the grid.
    At most ``grid_size`` partial sums leave a task.  Without a bandwidth (a
    single value, all values equal) the density is null; no values give no points.
    """
    require_columns(df, [col])
    if grid_size < 2:
        raise ValueError("grid_size must be at least 2")
    counted = _finite(df, col).groupBy("x").agg(F.count(F.lit(1)).alias("c"))
    st = _finite(df, col).selectExpr(
        "struct(min(x) AS lo, max(x) AS hi, stddev_samp(x) AS sd, count(1) AS n) AS st"
    ).scalar()
    h = dbl(bandwidth) if bandwidth is not None else "st.sd * pow(CAST(st.n AS DOUBLE), CAST(-0.2 AS DOUBLE))"
    c = dbl(cut)
    # Grid start, step, bandwidth and normalizer as one struct, attached once.
    params = (
        f"named_struct('start', st.lo - {c} * ({h}), "
        f"'step', (st.hi + {c} * ({h}) - (st.lo - {c} * ({h}))) / {dbl(grid_size - 1)}, "
        f"'h', {h}, "
        f"'norm', CAST(st.n AS DOUBLE) * ({h}) * {dbl(math.sqrt(2.0 * math.pi))}) AS p"
    )
    last = grid_size - 1
    # Without a grid step or a bandwidth (equal values, a single one) every point is asked.
    steps = "CASE WHEN p.step > 0 AND p.h > 0 THEN p.step END"
    reached = f"least({dbl(last)}, greatest(0D, %s((x + (%s{dbl(REACH)}) * p.h - p.start) / ({steps}))))"
    low = f"CAST(coalesce({reached % ('floor', '-')}, 0D) AS INT)"
    high = f"CAST(coalesce({reached % ('ceil', '')}, {dbl(last)}) AS INT)"
    at_points = counted.withColumn("st", st).selectExpr("x", "c", params).selectExpr(
        "x", "c", "p", f"explode(sequence({low}, {high})) AS point"
    )
    kernel = "c * exp(CAST(-0.5 AS DOUBLE) * pow(try_divide(p.start + point * p.step - x, p.h), 2))"
    # A point that no kernel reaches has density 0; without any value there are no points.
    grid = df.sparkSession.range(grid_size).withColumn("st", st).where("st.n > 0").selectExpr("CAST(id AS INT) AS point", "0D AS k")
    sums = at_points.selectExpr("point", f"{kernel} AS k").unionByName(grid).groupBy("point").agg(F.sum("k").alias("d"))
    return sums.withColumn("st", st).selectExpr("point", "d", params).selectExpr(
        "point", "p.start + point * p.step AS x", "try_divide(d, p.norm) AS density"
    )
