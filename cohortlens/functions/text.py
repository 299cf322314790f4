"""Text cleaning as native column expressions (no Python worker)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortlens.schema import safe_col

# The characters Python's str.strip() removes (those for which
# str.isspace() is true), in code point order.
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# A Python float() literal after stripping, as far as it can occur in one part
# of a text split on "-": digits with single underscores, optional fraction,
# optional exponent without a minus sign, or inf/infinity/nan.
# Possessive, so a long number is matched by a loop and not by recursion.
_DIGITS = r"[0-9](?:_?[0-9])*+"
PY_FLOAT_PART = rf"^[+]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+]?{_DIGITS})?|inf|infinity|nan)$"

# Phrases of the survey's sleep answers that map to a number.
SLEEP_PHRASES = {"less than 5 hours": 4.0, "more than 8 hours": 9.0}
SLEEP_UNIT = " hours"


def _as_col(c: Column | str) -> Column:
    return safe_col(c) if isinstance(c, str) else c


def py_strip(c: Column | str) -> Column:
    """Remove leading and trailing whitespace the way Python's ``str.strip()`` does.

    Spark's one-argument ``trim`` only removes spaces; this trims the whole
    whitespace set with a character-set trim (no regex).
    """
    return F.trim(_as_col(c), F.lit(PY_WHITESPACE))


def _float_part(part: Column) -> tuple[Column, Column]:
    """(is a float literal, its value) for one already lower-cased part."""
    stripped = py_strip(part)
    return stripped.rlike(PY_FLOAT_PART), F.replace(stripped, F.lit("_"), F.lit("")).try_cast("double")


def tolerant_double(c: Column | str) -> Column:
    """String to double that yields null unless the text is a Python float literal.

    Guarding with a pattern first keeps Spark's extra forms (``"5d"``, hex) out
    and never raises under ANSI mode.
    """
    ok, value = _float_part(F.lower(_as_col(c)))
    return F.when(ok, value)


def text_range_to_number(
    c: Column | str,
    phrases: Mapping[str, float] = SLEEP_PHRASES,
    unit: str = SLEEP_UNIT,
    sep: str = "-",
) -> Column:
    """Turn answers like ``"5-6 hours"`` / ``"Less than 5 hours"`` into a float.

    Whitespace-stripped and lower-cased text is matched against ``phrases``
    first; otherwise, if it holds ``sep``, every ``unit`` is removed and a
    string with exactly two numeric parts gives their midpoint.  Anything else
    (null, no separator, other part counts, non-numbers) is null.  The result
    is a 32-bit float.  Only plain string functions plus one regex test per
    part: the parts come from ``split_part`` and the part count from the
    number of separators.
    """
    if not sep:
        raise ValueError("sep must not be empty")
    text = F.lower(py_strip(c))
    rest = F.replace(text, F.lit(unit), F.lit(""))
    n_sep = (F.length(rest) - F.length(F.replace(rest, F.lit(sep), F.lit("")))) / F.lit(len(sep))
    low_ok, low = _float_part(F.split_part(rest, F.lit(sep), F.lit(1)))
    high_ok, high = _float_part(F.split_part(rest, F.lit(sep), F.lit(2)))
    out = None
    for phrase, value in phrases.items():
        cond = text == F.lit(phrase)
        out = F.when(cond, F.lit(float(value))) if out is None else out.when(cond, F.lit(float(value)))
    ranged = text.contains(sep) & (n_sep == F.lit(1)) & low_ok & high_ok
    midpoint = (low + high) / F.lit(2.0)
    out = F.when(ranged, midpoint) if out is None else out.when(ranged, midpoint)
    return out.cast("float")


def try_float(c: Column | str) -> Column:
    """Plain string to 32-bit float cast that gives null (not an error) for bad text."""
    return _as_col(c).try_cast("float")
