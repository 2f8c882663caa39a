"""Declared schemas of the raw feeds and dimensions; nothing is inferred at read time."""

from __future__ import annotations

# Column names and types of the feeds.
FEEDS = {
    "shipments": """shipment_key long, job_number string, customer_key long, carrier_key long, branch_key long,
        mode_key long, origin_port_key long, destination_port_key long, trade_lane string,
        destination_region string, booking_date date, committed_delivery_date date, planned_etd date,
        actual_departure_date date, carrier_eta date, actual_delivery_date date, job_completion_date date,
        shipment_status string, commodity string, incoterm string, container_count double, teu double,
        chargeable_weight_kg double, committed_transit_days int, actual_transit_days double,
        transit_variance_days double, is_on_time boolean, exception_count int, has_exception boolean""",
    "job_charges": """charge_key long, shipment_key long, job_number string, charge_type_key long,
        customer_key long, carrier_key long, branch_key long, mode_key long, charge_date date,
        vendor_name string, amount_inr decimal(18,4), is_post_closure boolean""",
    "invoice_lines": """invoice_line_key long, invoice_number string, invoice_type string, invoice_date date,
        due_date date, customer_key long, shipment_key double, job_number string, branch_key long,
        charge_type_key long, line_description string, line_amount_inr decimal(18,4),
        tax_amount_inr decimal(18,4), total_amount_inr decimal(18,4)""",
    "payments": """payment_key long, receipt_number string, invoice_number string, customer_key long,
        payment_date date, amount_inr decimal(18,4), payment_mode string""",
    "exceptions": """exception_key long, shipment_key long, job_number string, exception_type_key long,
        carrier_key long, customer_key long, branch_key long, raised_date date, resolved_date date,
        delay_days_attributed int, exception_status string""",
    "pipeline_runs": """run_key long, run_timestamp timestamp_ntz, run_date date, source_system string,
        pipeline_stage string, batch_id string, records_processed long, records_rejected long,
        execution_seconds decimal(12,2), run_status string, error_message string""",
}

_PORT = """port_key long, port_code string, port_name string, port_type string, city string,
    country string, region string, trade_lane_role string"""

DIMS = {
    "dim_branch": "branch_key long, branch_code string, branch_name string, city string, state string, is_hq boolean",
    "dim_carrier": """carrier_key long, carrier_code string, carrier_name string, carrier_mode string,
        carrier_type string, primary_lanes string, contract_start_date date, is_active boolean""",
    "dim_charge_type": """charge_type_key long, charge_code string, charge_name string, charge_category string,
        applies_to_mode string, is_passthrough_expected boolean""",
    "dim_customer": """customer_key long, customer_code string, tally_ledger_name string, customer_name string,
        industry_segment string, city string, state string, home_branch string, payment_terms_days int,
        credit_limit_inr long, customer_since date, kam_owner string, is_active boolean""",
    "dim_destination_port": _PORT,
    "dim_exception_type": """exception_type_key long, exception_code string, exception_name string,
        severity string, responsible_party string""",
    "dim_mode": "mode_key long, mode string, service_level string, mode_service string, unit_of_measure string",
    "dim_origin_port": _PORT,
}

# File each raw feed is exported to.
FEED_FILES = {
    "shipments": "fact_shipments",
    "job_charges": "fact_charges",
    "invoice_lines": "fact_invoice_lines",
    "payments": "fact_payments",
    "exceptions": "fact_exceptions",
    "pipeline_runs": "fact_pipeline_runs",
}
