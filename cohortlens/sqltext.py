"""Helpers for writing Spark SQL expression text (used where many similar
expressions are generated: one ``selectExpr`` call instead of thousands of
Column objects built one by one on the driver)."""

from __future__ import annotations


def ident(name: str) -> str:
    """Backtick-quoted identifier, safe for names with spaces, dots, ``/`` or ``?``."""
    return "`" + name.replace("`", "``") + "`"


def lit(value: str) -> str:
    """SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def dbl(value: float) -> str:
    """SQL double literal (never a decimal)."""
    if value != value:
        return "CAST('NaN' AS DOUBLE)"
    return f"CAST({float(value)!r} AS DOUBLE)"
