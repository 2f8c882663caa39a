"""Run parameters: dates, focus cohorts and the tolerance bands of the outcome suite."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime


@dataclass(frozen=True)
class Band:
    """Accepted range of one outcome metric.

    `centre` is what the reported difference is measured from; with `centre=None` the
    difference is the distance to whichever bound was violated. `open_top` makes the
    upper bound exclusive.
    """

    name: str
    low: float
    high: float
    centre: float | None
    digits: int = 4
    open_top: bool = False
    text: str = ""

    @property
    def target(self) -> str:
        return self.text or f"[{self.low}, {self.high}{')' if self.open_top else ']'}"


@dataclass(frozen=True)
class Outage:
    source: str
    start: datetime
    end: datetime
    message: str


# Names and limits of the agreed outcomes.
CASE_STUDY_BANDS = {
    "total_jobs": Band("A1 total shipments", 4500, 4620, 4560, 0, text="[4500, 4620]"),
    "ocean_share": Band("A2 ocean share", 0.635, 0.665, 0.65),
    "otd_before": Band("A3 H1 overall OTD", 0.80, 0.82, 0.81, text="[0.80, 0.82]"),
    "otd_after": Band("A4 Q3-Q4 overall OTD", 0.87, 0.89, 0.88),
    "otd_focus_carrier": Band("A5 AeroSwift 12-mo OTD", 0.65, 0.69, 0.67),
    "otd_carrier": Band("A6 carrier OTD band: ", 0.85, 0.92, None),
    "volume_share": Band("A7 problem customers H1 volume share", 0.21, 0.23, 0.22),
    "margin_share": Band("A8 problem customers H1 margin share", 0.00, 0.04, 0.04, open_top=True, text="[0.00, 0.04)"),
    "billing_lag": Band("A9 mean billing lag (days)", 7, 10, 8.5, 2),
    "reporting_lag": Band("A10 pre-implementation reporting lag (days)", 4.4, 4.8, 4.6, 2),
    "margin_uplift": Band("A11 blended GM% uplift Q4 vs H1", 0.028, 0.036, 0.032),
    "capture_focus": Band("A12 surcharge capture: problem customers", 0.22, 0.37, 0.32),
    "capture_others": Band("A12 surcharge capture: normal customers", 0.83, 0.94, 0.88),
    "orphan_keys": Band("A13 dangling foreign keys", 0, 0, 0, 0, text="0"),
    "unmatched_rate": Band("A13 unmatched invoice-line rate", 0.005, 0.025, 0.015),
}


@dataclass(frozen=True)
class Params:
    as_of: date
    go_live: date
    last_quarter_start: date
    skip_rate: float
    focus_carrier: str
    focus_customers: tuple[str, ...]
    bands: dict[str, Band] = field(default_factory=lambda: dict(CASE_STUDY_BANDS))
    outages: tuple[Outage, ...] = ()
    source_systems: tuple[str, ...] = ()
    now: datetime | None = None
    freshness_warn_hours: int = 2
    freshness_error_hours: int = 4


# The dates, rate and focus codes the published feeds were prepared for.
CASE_STUDY = Params(
    as_of=date(2025, 1, 15),
    go_live=date(2024, 7, 1),
    last_quarter_start=date(2024, 10, 1),
    skip_rate=0.09,
    focus_carrier="ASW",
    focus_customers=("CUST-ARHT", "CUST-TRPL"),
    now=datetime(2025, 1, 15, 23, 59, 59),
    source_systems=("Logi-Sys", "Tally", "Warehouse (dbt)"),
)


def _driver_bands() -> dict[str, Band]:
    """Bands for the TPC-H-shaped tables, set so that both verdicts occur."""
    return {
        "total_jobs": Band("jobs", 4500, 4620, 4560, 0, text="[4500, 4620]"),
        "ocean_share": Band("share of sea freight", 0.45, 0.55, 0.5),
        "otd_before": Band("on time before the change", 0.80, 0.82, 0.81),
        "otd_after": Band("on time since the change", 0.87, 0.89, 0.88),
        "otd_focus_carrier": Band("on time, watched carrier", 0.65, 0.69, 0.67),
        "otd_carrier": Band("on time, carrier ", 0.60, 0.70, None),
        "volume_share": Band("watched customers, share of jobs", 0.21, 0.23, 0.22),
        "margin_share": Band("watched customers, share of margin", 0.00, 0.04, 0.04, open_top=True),
        "billing_lag": Band("days from completion to invoice", 7, 10, 8.5, 2),
        "reporting_lag": Band("days from completion to report", 4.4, 4.8, 4.6, 2),
        "margin_uplift": Band("gain in margin rate", 0.028, 0.036, 0.032),
        "capture_focus": Band("surcharges billed on, watched customers", 0.22, 0.37, 0.32),
        "capture_others": Band("surcharges billed on, other customers", 0.83, 0.94, 0.88),
        "orphan_keys": Band("rows without a parent", 0, 0, 0, 0, text="0"),
        "unmatched_rate": Band("invoice lines without a job", 0.005, 0.03, 0.015),
    }


DRIVER = Params(
    as_of=date(2001, 7, 1),
    go_live=date(1998, 7, 1),
    last_quarter_start=date(2001, 4, 1),
    skip_rate=0.09,
    focus_carrier="CAR-000000000005",
    focus_customers=tuple(f"CUST-{k:012d}" for k in range(0, 108, 9)),
    bands=_driver_bands(),
    outages=(
        Outage("Finance", datetime(2024, 1, 3, 22), datetime(2024, 1, 4, 6), "export held back"),
        Outage("Finance", datetime(2024, 1, 3, 23), datetime(2024, 1, 4, 9), "disk replaced"),
        Outage("Operations", datetime(2024, 1, 18, 2), datetime(2024, 1, 18, 7), "queue paused"),
        Outage("Operations", datetime(2024, 1, 18, 6), datetime(2024, 1, 19, 1), "queue paused"),
    ),
    source_systems=("Operations", "Finance"),
    now=datetime(2024, 1, 31, 2, 0, 0),
)
