"""A hand-made set of feeds holding the edge rows of every rule."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from quayside.params import Params
from quayside.sources.frames import Feeds
from quayside.sources.schemas import DIMS, FEEDS

PARAMS = Params(
    as_of=date(2025, 1, 15),
    go_live=date(2024, 7, 1),
    last_quarter_start=date(2024, 10, 1),
    skip_rate=0.09,
    focus_carrier="SLOW",
    focus_customers=("C-1",),
    source_systems=("Ops", "Fin"),
    now=datetime(2025, 1, 15, 12),
)
D = date.fromisoformat


def job(key, number, completed, *, customer=1, carrier=1, mode=1, booked="2024-03-01", committed="2024-04-01",
        delivered="2024-04-01", status="Closed", actual=20, exceptions=0):
    return {
        "shipment_key": key, "job_number": number, "customer_key": customer, "carrier_key": carrier, "branch_key": 1,
        "mode_key": mode, "origin_port_key": 1, "destination_port_key": 1, "trade_lane": "x", "destination_region": "R",
        "booking_date": D(booked), "committed_delivery_date": D(committed), "planned_etd": D(booked),
        "actual_departure_date": D(booked), "carrier_eta": D(committed),
        "actual_delivery_date": delivered and D(delivered), "job_completion_date": completed and D(completed),
        "shipment_status": status, "commodity": "c", "incoterm": " fob ", "container_count": 2.0, "teu": 4.0,
        "committed_transit_days": 20, "actual_transit_days": None if delivered is None else float(actual),
        "exception_count": exceptions,
    }


JOBS = [
    job(1, " job-1", "2024-04-05", committed="2024-04-01", delivered="2024-04-01", exceptions=2),
    job(2, "JOB-2 ", None, delivered=None, status=" In Transit"),
    job(3, "JOB-3", "2024-04-07", delivered="2024-04-02", actual=21, customer=2),  # a Sunday
    job(4, "JOB-4", "2024-04-08", customer=2, carrier=2),  # a Monday
    job(5, "JOB-5", "2024-11-01", booked="2024-10-02", customer=2, carrier=2, mode=2),
    job(6, "JOB-6", "2024-11-02", booked="2024-10-03", customer=None, carrier=None, mode=2),
]


def charge(key, job_key, number, kind, day, amount):
    return {
        "charge_key": key, "shipment_key": job_key, "job_number": number, "charge_type_key": kind, "customer_key": 1,
        "carrier_key": 1, "branch_key": 1, "mode_key": 1, "charge_date": D(day), "vendor_name": " v ",
        "amount_inr": Decimal(amount),
    }


CHARGES = [
    charge(1, 1, "job-1", 1, "2024-04-05", "100.00"),
    charge(2, 1, "job-1", 2, "2024-04-06", "40.00"),
    charge(3, 2, "job-2", 1, "2024-12-31", "10.00"),
    charge(4, 3, "job-3", 2, "2024-04-01", "5.00"),
    charge(5, 99, "job-99", 1, "2024-04-01", "1.00"),
    charge(6, 1, None, 1, "2024-04-09", "7.00"),
]


def line(key, number, kind, day, ref, amount, *, due="2024-05-05", charge_type=1, text="", customer=1):
    return {
        "invoice_line_key": key, "invoice_number": number, "invoice_type": kind, "invoice_date": D(day),
        "due_date": due and D(due), "customer_key": customer, "job_number": ref, "branch_key": 1, "charge_type_key": charge_type,
        "line_description": text, "line_amount_inr": Decimal(amount), "tax_amount_inr": Decimal("0"),
        "total_amount_inr": Decimal(amount),
    }


LINES = [
    # two Originals of one job on one day: the lower number is first, on all of its lines
    line(1, "INV-B", "ORIGINAL", "2024-04-12", "job-1", "50.00"),
    line(2, "INV-A ", " original", "2024-04-12", "JOB-1", "80.00"),
    line(3, "INV-A", "Original", "2024-04-12", "JOB-1", "20.00", charge_type=2),
    line(4, "SUP-A", "supplementary", "2024-04-02", "JOB-1", "9.00"),
    # a job that is not completed
    line(5, "INV-C", "Original", "2024-04-20", "JOB-2", "30.00"),
    # a mistyped and a missing reference
    line(6, "INV-D", "Original", "2024-04-20", "JOB-1X", "60.00"),
    line(7, "INV-D", "Original", "2024-04-20", None, "1.00"),
    # credit notes: two on one invoice, one on an unknown invoice, one naming none, one with a line break after the target
    line(8, "CN-1", "CN", "2024-05-01", "JOB-1", "-10.00", text="Credit note against INV-A"),
    line(9, "CN-2", " creditnote ", "2024-05-01", "typo", "-5.00", text="Credit note against INV-A"),
    line(10, "CN-3", "Credit Note", "2024-05-01", "JOB-1", "-2.00", text="Credit note against NOPE"),
    line(11, "CN-4", "credit note", "2024-05-01", "JOB-1", "-1.00", text="goodwill"),
    line(12, "CN-5", "cn", "2024-05-01", "JOB-1", "-3.00", text="Credit note against INV-B\n"),
    line(13, "DEB-1", " Debit ", "2024-05-01", "JOB-3", "11.00"),
    # ageing, one invoice per distance from the as-of day
    *[
        line(100 + i, f"AGE-{i}", "Original", "2024-05-01", "JOB-4", "10.00", due=due)
        for i, due in enumerate(
            ["2025-01-15", "2025-01-14", "2024-12-16", "2024-12-15", "2024-11-16", "2024-11-15", "2024-10-17", "2024-10-16", None]
        )
    ],
    line(201, "TOL-1", "Original", "2024-05-01", "JOB-4", "10.00"),
    line(202, "TOL-2", "Original", "2024-05-01", "JOB-4", "10.00"),
    line(203, "OVER", "Original", "2024-05-01", "JOB-4", "10.00"),
]


def receipt(key, number, amount, day="2024-06-01"):
    return {
        "payment_key": key, "receipt_number": f" R{key} ", "invoice_number": number, "customer_key": 1,
        "payment_date": D(day), "amount_inr": Decimal(amount), "payment_mode": "Wire ",
    }


RECEIPTS = [
    receipt(1, " INV-A", "50.00", "2024-06-01"), receipt(2, "INV-A", "20.00", "2024-06-09"),
    receipt(3, "TOL-1", "9.99"), receipt(4, "TOL-2", "9.98"), receipt(5, "OVER", "12.00"), receipt(6, "UNKNOWN", "5.00"),
]
EXCEPTIONS = [
    {
        "exception_key": k, "shipment_key": s, "job_number": f"job-{s}", "exception_type_key": 1, "carrier_key": 1, "customer_key": 1,
        "branch_key": 1, "raised_date": D("2024-03-05"), "resolved_date": None, "delay_days_attributed": 1, "exception_status": " Open",
    }
    for k, s in ((1, 1), (2, 1), (3, 77))
]
RUNS = [
    {
        "run_key": i, "run_timestamp": ts, "run_date": ts.date(), "source_system": src, "pipeline_stage": "Ingest ", "batch_id": f"b{i}",
        "records_processed": 10, "records_rejected": r, "execution_seconds": Decimal("1.25"), "run_status": "Success",
    }
    for i, (src, ts, r) in enumerate(
        [("Ops", datetime(2025, 1, 15, 11), 0), ("Ops", datetime(2025, 1, 15, 9), 1), ("Fin", datetime(2025, 1, 15, 7), 0)]
    )
]
PORT = [{"port_key": 1, "port_code": "p1", "port_name": "Port of Alpha Port — Quay (East)"}]
ROWS = {
    "shipments": JOBS, "job_charges": CHARGES, "invoice_lines": LINES, "payments": RECEIPTS, "exceptions": EXCEPTIONS,
    "pipeline_runs": RUNS,
    "dim_branch": [{"branch_key": 1, "branch_code": "B"}],
    "dim_carrier": [{"carrier_key": 1, "carrier_code": "FAST"}, {"carrier_key": 2, "carrier_code": "SLOW"}],
    "dim_charge_type": [
        {"charge_type_key": 1, "charge_code": "BASE", "charge_category": "Base Cost", "is_passthrough_expected": True},
        {"charge_type_key": 2, "charge_code": "EXTRA", "charge_category": "Surcharge", "is_passthrough_expected": True},
    ],
    "dim_customer": [{"customer_key": 1, "customer_code": "C-1"}, {"customer_key": 2, "customer_code": "C-2"}],
    "dim_destination_port": PORT, "dim_origin_port": PORT,
    "dim_exception_type": [{"exception_type_key": 1, "exception_code": "E"}],
    "dim_mode": [{"mode_key": 1, "mode": "Ocean"}, {"mode_key": 2, "mode": "Air"}],
}


def frame(spark, name, rows):
    empty = spark.createDataFrame([], {**FEEDS, **DIMS}[name])
    return spark.createDataFrame([tuple(r.get(c) for c in empty.columns) for r in rows], empty.schema)


def feeds(spark, **replaced) -> Feeds:
    rows = {**ROWS, **replaced}
    return Feeds(spark, lambda kind, name: frame(spark, name, rows[name]))
