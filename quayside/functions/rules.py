"""Row-level business rules, each written once."""

from __future__ import annotations

from datetime import date

from quayside.functions.dates import day, days_between

SETTLED_TOLERANCE = "0.01BD"


def on_time(delivered: str = "actual_delivery_date", committed: str = "committed_delivery_date") -> str:
    """Delivered by the promised day. NULL while undelivered, so open jobs leave the mean."""
    return f"case when {delivered} is not null then {delivered} <= {committed} end"


TRANSIT_VARIANCE = "actual_transit_days - committed_transit_days"
HAS_EXCEPTION = "exception_count > 0"


def post_closure(charge_day: str, completed: str) -> str:
    """Strictly after completion; an open (or unknown) job has no post-closure charges."""
    return f"coalesce({charge_day} > {completed}, false)"


def lifecycle(departed: str, delivered: str, completed: str, as_of: date) -> str:
    """How far a job has come by `as_of`, from its full planned timeline."""
    d = day(as_of)
    return (
        f"case when {departed} > {d} then 'Booked' when {delivered} > {d} then 'In Transit'"
        f" when {completed} > {d} then 'Delivered' else 'Closed' end"
    )


def known_by(c: str, as_of: date) -> str:
    """The date, or NULL while it still lies in the future."""
    return f"case when {c} <= {day(as_of)} then {c} end"


def run_status(failed: str, rejected: str) -> str:
    return f"case when {failed} then 'Failed' when {rejected} > 0 then 'Partial' else 'Success' end"


def balance(total_due: str, received: str) -> str:
    return f"round({total_due} - {received}, 2)"


def is_settled(balance_due: str) -> str:
    return f"({balance_due} <= {SETTLED_TOLERANCE})"


def outstanding(balance_due: str) -> str:
    return f"greatest({balance_due}, 0.00BD)"


def overdue_days(balance_due: str, due: str, as_of: date) -> str:
    """Days past the due date as of the snapshot; 0 when settled, not yet due or undated."""
    return f"case when {is_settled(balance_due)} then 0 else greatest({days_between(due, day(as_of))}, 0) end"


def aging_bucket(balance_due: str, due: str, as_of: date) -> str:
    """Shelf of an invoice. The order of the arms matters: an undated open invoice falls to the last."""
    late = days_between(due, day(as_of))
    return (
        f"case when {is_settled(balance_due)} then 'Settled' when {late} <= 0 then 'Current' when {late} <= 30 then '0-30'"
        f" when {late} <= 60 then '31-60' when {late} <= 90 then '61-90' else '90+' end"
    )
