"""Typed, renamed and code-standardised relations; no business rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions import money
from quayside.functions.text import code, voucher_type
from quayside.operators.joins import lookup
from quayside.sources.frames import Feeds, shared


def casts(kind: str, names: str) -> list[str]:
    return [f"cast({name} as {kind}) as {name}" for name in names.split()]


def trims(names: str) -> list[str]:
    return [f"trim({name}) as {name}" for name in names.split()]


def with_loaded_at(df: DataFrame) -> DataFrame:
    """Stamp of when the relation was read. Not a landing time: see `ingest.first_seen_commit`."""
    return df.withColumn("_loaded_at", F.current_timestamp())


@shared
def typed_shipments(feeds: Feeds) -> DataFrame:
    """Job columns of the export itself, typed. Lookups of codes are added by `stg_shipments`."""
    return feeds.shipments.selectExpr(
        *casts("bigint", "shipment_key customer_key carrier_key branch_key mode_key origin_port_key destination_port_key"),
        f"{code('job_number')} as job_number",
        "trade_lane",
        "destination_region",
        *casts(
            "date",
            "booking_date committed_delivery_date planned_etd actual_departure_date carrier_eta actual_delivery_date"
            " job_completion_date",
        ),
        *trims("shipment_status"),
        "commodity",
        f"{code('incoterm')} as incoterm",
        *casts("int", "container_count"),
        *casts("decimal(10,2)", "teu"),
        *casts("decimal(12,2)", "chargeable_weight_kg"),
        *casts("int", "committed_transit_days actual_transit_days exception_count"),
    )


def stg_shipments(feeds: Feeds) -> DataFrame:
    """Typed jobs with the codes behind their five keys."""
    return with_dimensions(feeds, ("customer_code",), ("carrier_code",))


def with_dimensions(feeds: Feeds, customer: tuple[str, ...], carrier: tuple[str, ...]) -> DataFrame:
    """Typed jobs with the chosen customer and carrier columns, one lookup per dimension.

    Customers and carriers are the two dimensions that grow; asking for all of their
    columns at once keeps a large one from being shuffled to twice.
    """
    out = typed_shipments(feeds)
    out = lookup(out, feeds.dim_customer, "customer_key", {c: c for c in customer})
    out = lookup(out, feeds.dim_carrier, "carrier_key", {c: c for c in carrier})
    out = lookup(out, feeds.dim_mode, "mode_key", {"mode": "mode", "service_level": "service_level"})
    out = lookup(out, feeds.dim_origin_port, "origin_port_key", {"port_code": "origin_port_code"}, "port_key")
    out = lookup(out, feeds.dim_destination_port, "destination_port_key", {"port_code": "destination_port_code"}, "port_key")
    codes = ("customer_code", "carrier_code", "origin_port_code", "destination_port_code")
    return out.withColumns({c: F.expr(code(c)) for c in codes})


@shared
def stg_job_charges(feeds: Feeds) -> DataFrame:
    typed = feeds.job_charges.selectExpr(
        *casts("bigint", "charge_key shipment_key charge_type_key customer_key carrier_key branch_key mode_key"),
        f"{code('job_number')} as job_number",
        *casts("date", "charge_date"),
        *trims("vendor_name"),
        *casts(money.AMOUNT, "amount_inr"),
    )
    coded = lookup(typed, feeds.dim_charge_type, "charge_type_key", {c: c for c in ("charge_code", "charge_category")})
    return coded.withColumn("charge_code", F.expr(code("charge_code")))


@shared
def stg_invoice_lines(feeds: Feeds) -> DataFrame:
    """Voucher lines. The job reference keeps its typing errors: matching them is a business step."""
    return feeds.invoice_lines.selectExpr(
        *casts("bigint", "invoice_line_key customer_key branch_key charge_type_key"),
        *trims("invoice_number"),
        f"{voucher_type('invoice_type')} as invoice_type",
        *casts("date", "invoice_date due_date"),
        f"{code('job_number')} as job_number",
        "line_description",
        *casts(money.AMOUNT, "line_amount_inr tax_amount_inr total_amount_inr"),
    )


@shared
def stg_payments(feeds: Feeds) -> DataFrame:
    return feeds.payments.selectExpr(
        *casts("bigint", "payment_key customer_key"),
        *trims("receipt_number invoice_number payment_mode"),
        *casts("date", "payment_date"),
        *casts(money.AMOUNT, "amount_inr"),
    )
