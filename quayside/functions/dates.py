"""Day arithmetic."""

from __future__ import annotations

from datetime import date, datetime


def day(value: date) -> str:
    """A SQL date literal."""
    return f"date'{value.isoformat()}'"


def instant(value: datetime) -> str:
    """A SQL literal of a timestamp without zone."""
    return f"timestamp_ntz'{value.isoformat(sep=' ')}'"


def days_between(start: str, end: str) -> str:
    return f"datediff({end}, {start})"


def plus_days(start: str, n: str) -> str:
    return f"date_add({start}, cast({n} as int))"


def monday_on_or_after(d: str) -> str:
    return f"next_day(date_sub({d}, 1), 'MON')"


def reporting_lag_days(completed: str) -> str:
    """Completion plus one reconciliation day, surfaced in the next Monday report."""
    return days_between(completed, monday_on_or_after(f"date_add({completed}, 1)"))
