"""Exact money.

Amounts are decimal(14,2); sums are decimal(24,2), which is what Spark's own `sum` of
an amount yields, so group totals of any realistic size stay exact and in range.
"""

from __future__ import annotations

AMOUNT = "decimal(14,2)"
TOTAL = "decimal(24,2)"


def amount(c: str) -> str:
    return f"cast({c} as {AMOUNT})"


def total(c: str) -> str:
    return f"cast(round({c}, 2) as {TOTAL})"


def scaled(c: str, factor: str) -> str:
    """Amount times a decimal factor, rounded to cents without passing through doubles."""
    return amount(f"({c}) * {factor}BD")


def or_zero(c: str) -> str:
    return f"coalesce({c}, 0.00BD)"


def sum_where(condition: str, c: str) -> str:
    """Conditional sum that is 0, not NULL, for a group without a matching row."""
    return f"sum(case when {condition} then {c} else 0.00BD end)"


def ratio(numerator: str, denominator: str) -> str:
    """Double quotient; NULL when the denominator is zero or NULL."""
    return f"try_divide(cast({numerator} as double), cast({denominator} as double))"
