"""The business-rule layer: conformed jobs, classified charges, matched invoices, settlement, job profit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.functions import expr

from quayside.functions import money
from quayside.functions import rules as R
from quayside.functions.dates import days_between
from quayside.functions.text import credited_invoice, lane_label
from quayside.operators import staging
from quayside.operators.joins import lookup, match_to_jobs
from quayside.params import Params
from quayside.sources.frames import Feeds, shared


# ------------------------------------------------------------------- jobs --
def with_job_flags(jobs: DataFrame) -> DataFrame:
    return jobs.selectExpr(
        "*",
        f"{R.on_time()} as is_on_time",
        f"{R.TRANSIT_VARIANCE} as transit_variance_days",
        f"{R.HAS_EXCEPTION} as has_exception",
    )


def shipments_conformed(feeds: Feeds) -> DataFrame:
    """Staged jobs with the flags, carrier name and mode, customer name and terms."""
    return with_job_flags(
        staging.with_dimensions(
            feeds,
            ("customer_code", "customer_name", "payment_terms_days"),
            ("carrier_code", "carrier_name", "carrier_mode"),
        )
    )


@shared
def jobs_core(feeds: Feeds) -> DataFrame:
    """Conformed jobs without the dimension lookups.

    Facts and money rules read no looked-up name or code, so their plans hold no
    dimension join. Each dimension key is unique (see the declared checks), hence the
    lookups could neither add nor drop a row.
    """
    return with_job_flags(staging.typed_shipments(feeds))


def trade_lanes(feeds: Feeds) -> DataFrame:
    """Lane label of each job from the full names of its two ports."""
    jobs = staging.typed_shipments(feeds).select("shipment_key", "origin_port_key", "destination_port_key")
    jobs = lookup(jobs, feeds.dim_origin_port, "origin_port_key", {"port_name": "origin_name"}, "port_key")
    jobs = lookup(jobs, feeds.dim_destination_port, "destination_port_key", {"port_name": "destination_name"}, "port_key")
    return jobs.withColumn("trade_lane", expr(lane_label("origin_name", "destination_name")))


# ---------------------------------------------------------------- charges --
@shared
def charges_classified(feeds: Feeds) -> DataFrame:
    """Cost lines with category (joined on the natural code) and post-closure flag."""
    charges = staging.stg_job_charges(feeds).drop("charge_category")
    described = lookup(
        charges,
        feeds.dim_charge_type,
        "charge_code",
        {c: c for c in ("charge_name", "charge_category", "is_passthrough_expected")},
    )
    joined = match_to_jobs(described, "charge_key", jobs_core(feeds).select("job_number", "job_completion_date"))
    flag = expr(R.post_closure("charge_date", "job_completion_date"))
    return joined.withColumn("is_post_closure", flag).drop("job_completion_date")


# --------------------------------------------------------------- invoices --
# Sort key of a voucher: by date, then number, missing ones last.
_VOUCHER_ORDER = """struct(invoice_date is null as undated, invoice_date as day,
                           invoice_number is null as unnumbered, invoice_number as number)"""


def first_originals(lines: DataFrame) -> DataFrame:
    """Earliest (date, number) among the Original vouchers of each job reference, NULL where there is none.

    One `min` per job replaces a dense rank over all of a job's lines: it combines on the
    map side, so a job with a very large share of the lines needs no single large sort.
    The condition sits in the aggregate, which leaves the scan the same as that of the
    lines it is joined to.
    """
    return lines.groupBy("job_number").agg(
        expr(f"min(case when invoice_type = 'Original' then {_VOUCHER_ORDER} end) as first_voucher")
    )


@shared
def invoices_matched(feeds: Feeds) -> DataFrame:
    """Invoice lines matched to jobs on the reference as typed; unmatched lines stay, with NULL job.

    The first voucher of a job is attached to the job row, so the lines are shuffled once.
    """
    lines = staging.stg_invoice_lines(feeds)
    jobs = jobs_core(feeds).select("job_number", "shipment_key", "job_completion_date")
    matched = match_to_jobs(lines, "invoice_line_key", jobs.join(first_originals(lines), "job_number", "left"))
    is_first = f"invoice_type = 'Original' and shipment_key is not null and {_VOUCHER_ORDER} = first_voucher"
    lag = days_between("job_completion_date", "invoice_date")
    return (
        matched.selectExpr(
            *lines.columns, "shipment_key", "job_completion_date",
            "shipment_key is not null as is_matched",
            f"coalesce({is_first}, false) as is_first_original_invoice",
            f"if(is_first_original_invoice, {lag}, null) as billing_lag_days",
        )
    )


# ------------------------------------------------------------- settlement --
def credit_note_netting(lines: DataFrame) -> DataFrame:
    """Credit per target invoice, matched or not; a note naming no known invoice nets nothing."""
    return (
        lines.where("invoice_type = 'Credit Note'")
        .groupBy(expr(credited_invoice("line_description")).alias("invoice_number"))
        .agg(expr("sum(total_amount_inr) as credited_inr"))
    )


def invoice_rollup(lines: DataFrame) -> DataFrame:
    """Receivable invoices (everything but credit notes) at invoice grain."""
    smallest = ("customer_key", "branch_key", "invoice_date", "due_date")
    return (
        lines.where("invoice_type != 'Credit Note'")
        .groupBy("invoice_number")
        .agg(*[expr(f"min({c}) as {c}") for c in smallest], expr("sum(total_amount_inr) as gross_total_inr"))
    )


def payment_rollup(payments: DataFrame) -> DataFrame:
    return payments.groupBy("invoice_number").agg(
        expr("sum(amount_inr) as amount_received_inr"), expr("max(payment_date) as last_payment_date")
    )


def netted_invoices(lines: DataFrame) -> DataFrame:
    """Receivable invoices with the credit notes against them, in one pass over the lines.

    A credit-note line is grouped under the invoice it names and any other line under its
    own, so rolling up and netting take a single scan and shuffle. Groups made of credit
    notes alone name no known invoice and drop out, as does a note naming none.
    """
    target = credited_invoice("line_description")
    smallest = ("customer_key", "branch_key", "invoice_date", "due_date")
    return (
        lines.selectExpr(
            "invoice_type != 'Credit Note' as own",
            f"case when invoice_type = 'Credit Note' then {target} end as target",
            "invoice_number as number",
            *smallest,
            "total_amount_inr",
        )
        .selectExpr("if(own, number, target) as invoice_number", "own", "target", *smallest, "total_amount_inr")
        .groupBy("invoice_number")
        .agg(
            *[expr(f"min(if(own, {c}, null)) as {c}") for c in smallest],
            expr("sum(if(own, total_amount_inr, null)) as gross_total_inr"),
            expr("sum(if(target is not null, total_amount_inr, null)) as credited_inr"),
            expr("max(own) as is_receivable"),
        )
        .where("is_receivable")
        .drop("is_receivable")
    )


@shared
def invoice_settlement(feeds: Feeds, params: Params) -> DataFrame:
    """One row per receivable invoice with balance and ageing.

    Reads the staged lines directly: matching to jobs adds columns that nothing here uses.
    Both inputs are aggregates keyed on the invoice number, so the join adds no shuffle.
    """
    invoices = netted_invoices(staging.stg_invoice_lines(feeds))
    joined = invoices.join(payment_rollup(staging.stg_payments(feeds)), "invoice_number", "left")
    due = R.balance("invoice_total_inr", "amount_received_inr")
    return joined.selectExpr(
        "invoice_number", "customer_key", "branch_key", "invoice_date", "due_date",
        f"{money.total('gross_total_inr + ' + money.or_zero('credited_inr'))} as invoice_total_inr",
        f"{money.total(money.or_zero('amount_received_inr'))} as amount_received_inr",
        "last_payment_date",
    ).selectExpr(
        "*",
        f"{money.total(R.outstanding(due))} as outstanding_inr",
        f"{R.overdue_days(due, 'due_date', params.as_of)} as days_overdue",
        f"{R.aging_bucket(due, 'due_date', params.as_of)} as aging_bucket",
        f"{R.is_settled(due)} as is_settled",
    )


# ------------------------------------------------------------- job profit --
def job_cost_pivot(charges: DataFrame) -> DataFrame:
    """Base and surcharge cost per job, post-closure lines included."""
    return charges.groupBy("shipment_key").agg(
        expr(f"{money.sum_where("charge_category = 'Base Cost'", 'amount_inr')} as base_cost_inr"),
        expr(f"{money.sum_where("charge_category = 'Surcharge'", 'amount_inr')} as surcharge_cost_inr"),
    )


def job_revenue_pivot(lines: DataFrame, charge_types: DataFrame) -> DataFrame:
    """Pre-tax revenue per job reference, credit notes included, with the first Original date.

    Keyed on the reference as typed, so it aggregates before any join to the jobs:
    joining the result to them on `job_number` keeps exactly the matched lines. Lines
    without a reference collapse into one group, which matches no job.
    """
    typed = lookup(lines, charge_types, "charge_type_key", {"charge_category": "billed_as"})
    return typed.groupBy("job_number").agg(
        expr("sum(line_amount_inr) as revenue_billed_inr"),
        expr(f"{money.sum_where("billed_as = 'Surcharge'", 'line_amount_inr')} as surcharge_billed_inr"),
        expr("min(if(invoice_type = 'Original', invoice_date, null)) as first_invoice_date"),
    )


def job_revenue(feeds: Feeds) -> DataFrame:
    """Revenue of every job with at least one matched line, with its billing lag."""
    revenue = job_revenue_pivot(staging.stg_invoice_lines(feeds), feeds.dim_charge_type)
    jobs = jobs_core(feeds).select("job_number", "shipment_key", "job_completion_date")
    return jobs.join(revenue, "job_number").selectExpr(
        "shipment_key",
        f"{money.total('revenue_billed_inr')} as revenue_billed_inr",
        f"{money.total('surcharge_billed_inr')} as surcharge_billed_inr",
        "first_invoice_date",
        f"{days_between('job_completion_date', 'first_invoice_date')} as billing_lag_days",
    )


def classified_costs(feeds: Feeds) -> DataFrame:
    """Cost lines with the category found through the natural code; no join to the jobs."""
    charges = staging.stg_job_charges(feeds).select("shipment_key", "charge_code", "amount_inr")
    return lookup(charges, feeds.dim_charge_type, "charge_code", {"charge_category": "charge_category"})


@shared
def booked_financials(feeds: Feeds) -> DataFrame:
    """One row per completed job: revenue, cost and margin, a missing side counting as zero.

    The first Original voucher is by definition the one with the earliest date, so its lag
    is the earliest Original date minus completion. Both sides are aggregated to job grain
    first and only then joined. The booking date is carried through, which spares the
    metrics a join of the two published facts.
    """
    kept = "shipment_key job_number customer_key carrier_key branch_key mode_key job_completion_date booking_date".split()
    jobs = jobs_core(feeds).where("job_completion_date is not null").select(*kept)
    costs = job_cost_pivot(classified_costs(feeds))
    revenue = job_revenue_pivot(staging.stg_invoice_lines(feeds), feeds.dim_charge_type)
    billed, surcharge_billed, base, surcharge = (
        money.or_zero(c) for c in ("revenue_billed_inr", "surcharge_billed_inr", "base_cost_inr", "surcharge_cost_inr")
    )
    return jobs.join(costs, "shipment_key", "left").join(revenue, "job_number", "left").selectExpr(
        *kept,
        "first_invoice_date",
        f"{days_between('job_completion_date', 'first_invoice_date')} as billing_lag_days",
        f"{money.total(billed)} as revenue_billed_inr",
        f"{money.total(base)} as base_cost_inr",
        f"{money.total(surcharge)} as surcharge_cost_inr",
        f"{money.total(surcharge_billed)} as surcharge_billed_inr",
        f"{money.total(f'{base} + {surcharge}')} as total_cost_inr",
        f"{money.total(f'{billed} - {base} - {surcharge}')} as gross_margin_inr",
        "first_invoice_date is not null as is_fully_billed",
    )


@shared
def shipment_financials(feeds: Feeds) -> DataFrame:
    return booked_financials(feeds).drop("booking_date")
