"""Row-level derived columns: means, ordered buckets, interval buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortlens.schema import safe_col

# The survey's bucket boundaries and labels.
SLEEP_BOUNDS = (6.0, 8.0)
SLEEP_LABELS = ("Low", "Normal", "High")
AGE_INTERVALS = ((18.0, 21.0, "18-21"), (22.0, 25.0, "22-25"), (26.0, 30.0, "26-30"))
AGE_OTHERWISE = ">30"


def _as_col(c: Column | str) -> Column:
    return safe_col(c) if isinstance(c, str) else c


def mean_of(cols: Sequence[Column | str], weights: Sequence[float] | None = None) -> Column:
    """Mean of several columns per row; null when any input is null.

    Without weights this is ``(a + b + ...) / n`` exactly, so results match a
    hand-written sum bit for bit.
    """
    cs = [_as_col(c) for c in cols]
    if not cs:
        raise ValueError("mean_of needs at least one column")
    if weights is None:
        total = cs[0]
        for c in cs[1:]:
            total = total + c
        return total / F.lit(float(len(cs)))
    if len(weights) != len(cs):
        raise ValueError("one weight per column")
    total = cs[0] * F.lit(float(weights[0]))
    for c, w in zip(cs[1:], weights[1:]):
        total = total + c * F.lit(float(w))
    return total / F.lit(float(sum(weights)))


def ordered_bucket(
    c: Column | str,
    bounds: tuple[float, float] = SLEEP_BOUNDS,
    labels: tuple[str, str, str] = SLEEP_LABELS,
) -> Column:
    """Three-way bucket: ``< lo`` → first label, ``lo..hi`` inclusive → second, else third.

    Null and NaN fall to the last label (no comparison with them is true,
    NaN sorts above every number).
    """
    x = _as_col(c)
    lo, hi = bounds
    return (
        F.when(x < F.lit(lo), F.lit(labels[0]))
        .when((x >= F.lit(lo)) & (x <= F.lit(hi)), F.lit(labels[1]))
        .otherwise(F.lit(labels[2]))
    )


def interval_bucket(
    c: Column | str,
    intervals: Sequence[tuple[float, float, str]] = AGE_INTERVALS,
    otherwise: str = AGE_OTHERWISE,
) -> Column:
    """Label of the first closed interval ``[lo, hi]`` holding the value, else ``otherwise``.

    Values in gaps between intervals, below all of them, null or NaN get
    ``otherwise``.
    """
    x = _as_col(c)
    out = None
    for lo, hi, label in intervals:
        cond = (x >= F.lit(lo)) & (x <= F.lit(hi))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    if out is None:
        return F.lit(otherwise)
    return out.otherwise(F.lit(otherwise))
