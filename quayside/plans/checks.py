"""The declared checks of the three layers and the foreign-key links of the star."""

from __future__ import annotations

from quayside.operators.quality import Check, Link, accepted, holds, not_null, refers, unique
from quayside.params import Params

# Accepted codes.
STATUSES = ("Booked", "In Transit", "Delivered", "Closed")
CATEGORIES = ("Base Cost", "Surcharge")
VOUCHERS = ("Original", "Supplementary", "Credit Note")
SHELVES = ("Settled", "Current", "0-30", "31-60", "61-90", "90+")
RUN_STATUSES = ("Success", "Failed", "Partial")


def staging_checks() -> list[Check]:
    jobs, charges, lines, receipts = "stg_shipments", "stg_job_charges", "stg_invoice_lines", "stg_payments"
    return [
        unique(jobs, "job_number"),
        not_null(jobs, "job_number"),
        not_null(jobs, "booking_date"),
        not_null(jobs, "customer_code"),
        refers(jobs, "customer_code", "dim_customer", "customer_code"),
        not_null(jobs, "carrier_code"),
        refers(jobs, "carrier_code", "dim_carrier", "carrier_code"),
        accepted(jobs, "mode", "Ocean", "Air"),
        accepted(jobs, "shipment_status", *STATUSES),
        unique(charges, "charge_key"),
        not_null(charges, "charge_key"),
        not_null(charges, "job_number"),
        refers(charges, "job_number", jobs, "job_number"),
        not_null(charges, "amount_inr"),
        accepted(charges, "charge_category", *CATEGORIES),
        unique(lines, "invoice_line_key"),
        not_null(lines, "invoice_line_key"),
        not_null(lines, "invoice_number"),
        not_null(lines, "invoice_date"),
        not_null(lines, "customer_key"),
        refers(lines, "customer_key", "dim_customer", "customer_key"),
        accepted(lines, "invoice_type", *VOUCHERS),
        unique(receipts, "payment_key"),
        not_null(receipts, "payment_key"),
        not_null(receipts, "receipt_number"),
        not_null(receipts, "payment_date"),
        not_null(receipts, "amount_inr"),
        refers(receipts, "invoice_number", lines, "invoice_number"),
    ]


def rule_checks() -> list[Check]:
    jobs, charges, lines = "int_shipments_conformed", "int_charges_classified", "int_invoices_matched"
    profit, settlement = "int_shipment_financials", "int_invoice_settlement"
    return [
        holds(jobs, "transit_variance_days = actual_transit_days - committed_transit_days", "actual_transit_days is not null"),
        not_null(jobs, "is_on_time", "actual_delivery_date is not null"),
        accepted(jobs, "is_on_time", True, False),
        unique(charges, "charge_key"),
        not_null(charges, "charge_key"),
        not_null(charges, "charge_category"),
        accepted(charges, "charge_category", *CATEGORIES),
        unique(lines, "invoice_line_key"),
        not_null(lines, "invoice_line_key"),
        not_null(lines, "is_matched"),
        holds(profit, "gross_margin_inr = revenue_billed_inr - total_cost_inr"),
        holds(profit, "billing_lag_days >= 0", "billing_lag_days is not null"),
        unique(profit, "shipment_key"),
        not_null(profit, "shipment_key"),
        holds(settlement, "outstanding_inr = greatest(round(invoice_total_inr - amount_received_inr, 2), 0.00)"),
        holds(settlement, "is_settled = (round(invoice_total_inr - amount_received_inr, 2) <= 0.01)"),
        unique(settlement, "invoice_number"),
        not_null(settlement, "invoice_number"),
        accepted(settlement, "aging_bucket", *SHELVES),
    ]


def mart_checks(params: Params) -> list[Check]:
    out: list[Check] = []
    for fact, key in (
        ("fact_shipments", "shipment_key"),
        ("fact_charges", "charge_key"),
        ("fact_invoice_lines", "invoice_line_key"),
        ("fact_payments", "payment_key"),
        ("fact_invoice_settlement", "invoice_number"),
        ("fact_shipment_financials", "shipment_key"),
        ("fact_exceptions", "exception_key"),
        ("fact_pipeline_runs", "run_key"),
    ):
        out += [unique(fact, key), not_null(fact, key)]
    return out + [
        refers("fact_shipments", "customer_key", "dim_customer", "customer_key"),
        refers("fact_shipments", "carrier_key", "dim_carrier", "carrier_key"),
        not_null("fact_shipments", "is_on_time", "actual_delivery_date is not null"),
        holds("fact_invoice_settlement", "outstanding_inr >= -1000"),
        not_null("fact_invoice_settlement", "aging_bucket"),
        not_null("fact_shipment_financials", "revenue_billed_inr"),
        holds("fact_shipment_financials", "gross_margin_inr > -500000", "is_fully_billed = true"),
        accepted("fact_pipeline_runs", "source_system", *params.source_systems),
        accepted("fact_pipeline_runs", "run_status", *RUN_STATUSES),
    ]


def declared_checks(params: Params) -> list[Check]:
    return staging_checks() + rule_checks() + mart_checks(params)


# Child column -> parent column of every foreign key of the star.
FOREIGN_KEYS = """
    fact_shipments.customer_key            dim_customer.customer_key
    fact_shipments.carrier_key             dim_carrier.carrier_key
    fact_shipments.branch_key              dim_branch.branch_key
    fact_shipments.mode_key                dim_mode.mode_key
    fact_shipments.origin_port_key         dim_origin_port.port_key
    fact_shipments.destination_port_key    dim_destination_port.port_key
    fact_charges.shipment_key              fact_shipments.shipment_key
    fact_charges.charge_type_key           dim_charge_type.charge_type_key
    fact_charges.customer_key              dim_customer.customer_key
    fact_charges.carrier_key               dim_carrier.carrier_key
    fact_invoice_lines.customer_key        dim_customer.customer_key
    fact_invoice_lines.branch_key          dim_branch.branch_key
    fact_invoice_lines.charge_type_key     dim_charge_type.charge_type_key
    fact_invoice_lines.shipment_key        fact_shipments.shipment_key
    fact_payments.customer_key             dim_customer.customer_key
    fact_payments.invoice_number           fact_invoice_settlement.invoice_number
    fact_invoice_settlement.customer_key   dim_customer.customer_key
    fact_shipment_financials.shipment_key  fact_shipments.shipment_key
    fact_shipment_financials.customer_key  dim_customer.customer_key
    fact_exceptions.shipment_key           fact_shipments.shipment_key
    fact_exceptions.exception_type_key     dim_exception_type.exception_type_key
    fact_exceptions.carrier_key            dim_carrier.carrier_key
"""


def foreign_keys() -> list[Link]:
    links = []
    for child, parent in (line.split() for line in FOREIGN_KEYS.strip().splitlines()):
        links.append(Link(child, *child.split("."), *parent.split(".")))
    return links
