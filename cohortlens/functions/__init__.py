"""Column expressions used by the operators; all are built-in Spark expressions."""

from cohortlens.functions.columns import interval_bucket, mean_of, ordered_bucket
from cohortlens.functions.text import py_strip, text_range_to_number, tolerant_double, try_float

__all__ = [
    "interval_bucket",
    "mean_of",
    "ordered_bucket",
    "py_strip",
    "text_range_to_number",
    "tolerant_double",
    "try_float",
]
