"""The eight published facts: fixed grain and columns, no further logic."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quayside.functions.text import code
from quayside.operators import rules, staging
from quayside.operators.staging import casts, trims
from quayside.params import Params
from quayside.sources.frames import Feeds

# The published columns of each fact, in order.
COLUMNS = {
    "fact_shipments": """shipment_key job_number customer_key carrier_key branch_key mode_key origin_port_key
        destination_port_key trade_lane destination_region booking_date committed_delivery_date planned_etd
        actual_departure_date carrier_eta actual_delivery_date job_completion_date shipment_status commodity incoterm
        container_count teu chargeable_weight_kg committed_transit_days actual_transit_days transit_variance_days
        is_on_time exception_count has_exception""",
    "fact_charges": """charge_key shipment_key job_number charge_type_key customer_key carrier_key branch_key mode_key
        charge_date vendor_name amount_inr is_post_closure""",
    "fact_invoice_lines": """invoice_line_key invoice_number invoice_type invoice_date due_date customer_key
        shipment_key job_number branch_key charge_type_key line_description line_amount_inr tax_amount_inr
        total_amount_inr""",
    "fact_payments": "payment_key receipt_number invoice_number customer_key payment_date amount_inr payment_mode",
    "fact_invoice_settlement": """invoice_number customer_key branch_key invoice_date due_date invoice_total_inr
        amount_received_inr outstanding_inr last_payment_date days_overdue aging_bucket is_settled""",
    "fact_shipment_financials": """shipment_key job_number customer_key carrier_key branch_key mode_key
        job_completion_date first_invoice_date billing_lag_days revenue_billed_inr base_cost_inr surcharge_cost_inr
        surcharge_billed_inr total_cost_inr gross_margin_inr is_fully_billed""",
    "fact_exceptions": """exception_key shipment_key job_number exception_type_key carrier_key customer_key branch_key
        raised_date resolved_date delay_days_attributed exception_status""",
    "fact_pipeline_runs": """run_key run_timestamp run_date source_system pipeline_stage batch_id records_processed
        records_rejected execution_seconds run_status error_message""",
}


def _publish(df: DataFrame, fact: str) -> DataFrame:
    return df.select(*COLUMNS[fact].split())


def fact_shipments(feeds: Feeds) -> DataFrame:
    return _publish(rules.jobs_core(feeds), "fact_shipments")


def fact_charges(feeds: Feeds) -> DataFrame:
    return _publish(rules.charges_classified(feeds), "fact_charges")


def fact_invoice_lines(feeds: Feeds) -> DataFrame:
    return _publish(rules.invoices_matched(feeds), "fact_invoice_lines")


def fact_payments(feeds: Feeds) -> DataFrame:
    return _publish(staging.stg_payments(feeds), "fact_payments")


def fact_invoice_settlement(feeds: Feeds, params: Params) -> DataFrame:
    return _publish(rules.invoice_settlement(feeds, params), "fact_invoice_settlement")


def fact_shipment_financials(feeds: Feeds) -> DataFrame:
    return _publish(rules.shipment_financials(feeds), "fact_shipment_financials")


def fact_exceptions(feeds: Feeds) -> DataFrame:
    """Exception events carry no derivation: cast and trim straight from the feed."""
    return _publish(
        feeds.exceptions.selectExpr(
            *casts("bigint", "exception_key shipment_key exception_type_key carrier_key customer_key branch_key"),
            f"{code('job_number')} as job_number",
            *casts("date", "raised_date resolved_date"),
            *casts("int", "delay_days_attributed"),
            *trims("exception_status"),
        ),
        "fact_exceptions",
    )


def fact_pipeline_runs(feeds: Feeds) -> DataFrame:
    """The run log, cast and trimmed. Row counts are 64-bit: an hour can land more than 2^31 rows."""
    return _publish(
        feeds.pipeline_runs.selectExpr(
            *casts("bigint", "run_key records_processed records_rejected"),
            *casts("timestamp_ntz", "run_timestamp"),
            *casts("date", "run_date"),
            *casts("decimal(10,1)", "execution_seconds"),
            *trims("source_system pipeline_stage batch_id run_status"),
            "error_message",
        ),
        "fact_pipeline_runs",
    )


FACTS = {
    "fact_shipments": lambda feeds, params: fact_shipments(feeds),
    "fact_charges": lambda feeds, params: fact_charges(feeds),
    "fact_invoice_lines": lambda feeds, params: fact_invoice_lines(feeds),
    "fact_payments": lambda feeds, params: fact_payments(feeds),
    "fact_invoice_settlement": fact_invoice_settlement,
    "fact_shipment_financials": lambda feeds, params: fact_shipment_financials(feeds),
    "fact_exceptions": lambda feeds, params: fact_exceptions(feeds),
    "fact_pipeline_runs": lambda feeds, params: fact_pipeline_runs(feeds),
}
DIMENSIONS = (
    "dim_branch", "dim_carrier", "dim_charge_type", "dim_customer", "dim_destination_port", "dim_exception_type",
    "dim_mode", "dim_origin_port",
)
