"""Rule-based flagging of rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens import schema as S
from cohortlens.schema import require_columns, safe_col

# The survey's risk thresholds and the reason text put on flagged rows.
STRESS_ABOVE = 0.7
SLEEP_BELOW = 5.0
FINANCIAL_ABOVE = 7.0
RISK_REASON = "Stress or Poor Sleep or High Financial Stress"


def risk_rules(
    stress_above: float = STRESS_ABOVE,
    sleep_below: float = SLEEP_BELOW,
    financial_above: float = FINANCIAL_ABOVE,
) -> dict[str, Column]:
    """The three survey rules by name, in order."""
    return {
        "high_stress": safe_col("stress_index_normalized") > F.lit(stress_above),
        "poor_sleep": safe_col(S.SLEEP) < F.lit(sleep_below),
        "financial_stress": safe_col(S.FINANCIAL_STRESS) > F.lit(financial_above),
    }


def _any(rules: Mapping[str, Column]) -> Column:
    conds = list(rules.values())
    if not conds:
        raise ValueError("at least one rule is needed")
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out


def high_risk(df: DataFrame, rules: Mapping[str, Column] | None = None, reason: str = RISK_REASON) -> DataFrame:
    """Rows where any rule holds (SQL three-valued OR), with a constant ``risk_reason``.

    A null in one rule does not hide a row that another rule flags.
    """
    if rules is None:
        require_columns(df, ["stress_index_normalized", S.SLEEP, S.FINANCIAL_STRESS])
        rules = risk_rules()
    return df.where(_any(rules)).withColumn("risk_reason", F.lit(reason))


def with_risk_reasons(df: DataFrame, rules: Mapping[str, Column] | None = None, only_flagged: bool = True) -> DataFrame:
    """Add ``risk_reasons``: the names of the rules that hold for the row, in rule order.

    With ``only_flagged`` rows where no rule holds are dropped.
    """
    rules = risk_rules() if rules is None else rules
    fired = F.array_compact(F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()]))
    out = df.withColumn("risk_reasons", fired)
    return out.where(F.size("risk_reasons") > 0) if only_flagged else out


def count_rows(df: DataFrame, name: str = "n_rows") -> DataFrame:
    """One-row frame with the row count, computed on the cluster."""
    return df.agg(F.count(F.lit(1)).alias(name))
