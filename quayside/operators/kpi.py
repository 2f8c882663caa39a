"""Outcome metrics over the published facts and the assertion suite built on them.

Every metric of one fact comes out of a single aggregation; a query that wants one metric
selects it, and Catalyst prunes the other aggregates with their columns and joins.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import expr

from quayside.functions.dates import day, reporting_lag_days
from quayside.functions.money import ratio
from quayside.functions.text import literal
from quayside.operators.joins import lookup, orphan_keys
from quayside.params import Params


# ---------------------------------------------------------------- cohorts --
def members(dim: DataFrame, key: str, code_column: str, codes: tuple[str, ...]) -> DataFrame:
    """Keys of the listed codes. No hint and no count: adaptive execution picks the join from measured sizes."""
    return dim.where(F.col(code_column).isin(*codes)).select(key).distinct()


def with_membership(df: DataFrame, group: DataFrame, key: str, flag: str) -> DataFrame:
    """Whether the row's key is in the group; NULL for a row without a key."""
    marked = group.withColumn("member", F.lit(True))
    return df.join(marked, key, "left").withColumn(flag, expr(f"if({key} is not null, member is not null, null)")).drop("member")


def with_focus_customers(df: DataFrame, dim_customer: DataFrame, params: Params) -> DataFrame:
    group = members(dim_customer, "customer_key", "customer_code", params.focus_customers)
    return with_membership(df, group, "customer_key", "is_problem")


def booked_financials(financials: DataFrame, shipments: DataFrame) -> DataFrame:
    """Published job profit with the booking date of the job, both keyed on the job."""
    return financials.join(shipments.select("shipment_key", "booking_date"), "shipment_key")


def _share(condition: str) -> str:
    return f"case when {condition} then 1.0D else 0.0D end"


# ---------------------------------------------------------------- metrics --
def shipment_metrics(shipments: DataFrame, dims: Mapping[str, DataFrame], params: Params, names: tuple[str, ...] | None = None) -> DataFrame:
    """One row of the wanted metrics: volume, mix, on-time rates, focus volume share, reporting lag.

    Only the lookups that the wanted metrics read are joined.
    """
    go_live = day(params.go_live)
    before, after = f"booking_date < {go_live}", f"booking_date >= {go_live}"

    def on_time_rate(cohort: str) -> str:
        return f"avg(case when {cohort} and actual_delivery_date is not null then cast(is_on_time as int) end)"

    lag = reporting_lag_days("job_completion_date")
    metrics = {
        "total_jobs": "count(*)",
        "ocean_share": f"avg({_share("mode = 'Ocean'")})",
        "otd_before": on_time_rate(before),
        "otd_after": on_time_rate(after),
        "otd_focus_carrier": on_time_rate("is_focus_carrier"),
        "volume_share": f"avg(case when {before} then {_share('is_problem')} end)",
        "reporting_lag": f"avg(case when job_completion_date < {go_live} then {lag} end) + {params.skip_rate}D * 7",
    }
    wanted = names or tuple(metrics)
    jobs = shipments
    if "ocean_share" in wanted:
        jobs = lookup(jobs, dims["dim_mode"], "mode_key", {"mode": "mode"})
    if "otd_focus_carrier" in wanted:
        carrier = members(dims["dim_carrier"], "carrier_key", "carrier_code", (params.focus_carrier,))
        jobs = with_membership(jobs, carrier, "carrier_key", "is_focus_carrier")
    if "volume_share" in wanted:
        jobs = with_focus_customers(jobs, dims["dim_customer"], params)
    return jobs.agg(*[expr(f"{metrics[n]} as {n}") for n in wanted])


def otd_by_carrier(shipments: DataFrame, dim_carrier: DataFrame, params: Params) -> DataFrame:
    """On-time rate of every carrier but the focus one, over delivered jobs.

    Counted per key before the code is looked up, so the lookup runs at carrier grain.
    A carrier without a code drops out, as does the focus carrier.
    """
    per_key = (
        shipments.where("actual_delivery_date is not null")
        .groupBy("carrier_key")
        .agg(expr("count(is_on_time) as n"), expr("count_if(is_on_time) as hits"))
    )
    return (
        lookup(per_key, dim_carrier, "carrier_key", {"carrier_code": "carrier_code"})
        .where(f"carrier_code != {literal(params.focus_carrier)}")
        .groupBy("carrier_code")
        .agg(expr("sum(n) as delivered_jobs"), expr(f"{ratio('sum(hits)', 'sum(n)')} as otd_rate"))
    )


def margin_metrics(booked: DataFrame, dim_customer: DataFrame, params: Params) -> DataFrame:
    """One row: focus margin share, margin-rate uplift, surcharge capture and billing lag, over billed jobs.

    A job has a billing lag only if it is billed, so the mean lag belongs to the same pass.
    """
    before, quarter = f"booking_date < {day(params.go_live)}", f"booking_date >= {day(params.last_quarter_start)}"
    costed = f"{before} and surcharge_cost_inr > 0"

    def total(c: str, condition: str) -> str:
        return f"sum(case when {condition} then {c} end)"

    def rate(cohort: str) -> str:
        return ratio(total("gross_margin_inr", cohort), total("revenue_billed_inr", cohort))

    def capture(cohort: str) -> str:
        return ratio(total("surcharge_billed_inr", cohort), total("surcharge_cost_inr", cohort))

    focus_margin = "(case when is_problem then gross_margin_inr else 0.00BD end)"
    return with_focus_customers(booked.where("is_fully_billed"), dim_customer, params).agg(
        expr(f"{ratio(total(focus_margin, before), total('gross_margin_inr', before))} as margin_share"),
        expr(f"{rate(quarter)} - {rate(before)} as margin_uplift"),
        expr(f"{capture(f'{costed} and is_problem')} as capture_focus"),
        expr(f"{capture(f'{costed} and not is_problem')} as capture_others"),
        expr("avg(billing_lag_days) as billing_lag"),
    )


def billing_lag(financials: DataFrame) -> DataFrame:
    return financials.agg(expr("avg(billing_lag_days) as billing_lag"))


def orphan_counts(charges: DataFrame, exceptions: DataFrame, payments: DataFrame, shipments: DataFrame, settlement: DataFrame) -> DataFrame:
    """Rows of each child fact whose parent is missing; a row without a key counts as orphan too.

    The two children of the job table share one pass over it.
    """
    charge_keys, exception_keys = (
        df.groupBy("shipment_key").agg(expr("count(*) as row_count")).withColumn("child", F.lit(name))
        for name, df in (("charges", charges), ("exceptions", exceptions))
    )
    lost_jobs = charge_keys.unionByName(exception_keys).join(shipments.select("shipment_key"), "shipment_key", "left_anti")
    lost_receipts = orphan_keys(payments, settlement, "invoice_number").withColumn("child", F.lit("payments"))
    found = (
        lost_jobs.select("child", "row_count")
        .unionByName(lost_receipts.select("child", "row_count"))
        .groupBy("child")
        .agg(expr("sum(row_count) as orphan_rows"))
    )
    names = charges.sparkSession.sql("SELECT * FROM VALUES ('charges'), ('exceptions'), ('payments') AS t(child)")
    return names.join(found, "child", "left").selectExpr("child", "coalesce(orphan_rows, 0L) as orphan_rows")


def unmatched_rate(invoice_lines: DataFrame) -> DataFrame:
    return invoice_lines.agg(expr(f"avg({_share('shipment_key is null')}) as unmatched_rate"))


# ------------------------------------------------------------- assertions --
def _long(row: DataFrame) -> DataFrame:
    """One-row metrics as (metric, subject, actual) rows."""
    pairs = ", ".join(f"'{n}', cast({n} as double)" for n in row.columns)
    return row.selectExpr(f"stack({len(row.columns)}, {pairs}) as (metric, actual)").withColumn("subject", F.lit(""))


def outcome_metrics(facts: Mapping[str, DataFrame], booked: DataFrame, dims: Mapping[str, DataFrame], params: Params) -> DataFrame:
    """All assertion metrics as rows (metric, subject, actual)."""
    shipments = facts["fact_shipments"]
    jobs = shipment_metrics(shipments, dims, params)
    carriers = otd_by_carrier(shipments, dims["dim_carrier"], params).selectExpr(
        "'otd_carrier' as metric", "otd_rate as actual", "carrier_code as subject"
    )
    margins = margin_metrics(booked, dims["dim_customer"], params)
    orphans = orphan_counts(
        facts["fact_charges"], facts["fact_exceptions"], facts["fact_payments"], shipments, facts["fact_invoice_settlement"]
    ).agg(expr("sum(orphan_rows) as orphan_keys"))
    parts = [
        _long(jobs),
        carriers,
        _long(margins),
        _long(orphans),
        _long(unmatched_rate(facts["fact_invoice_lines"])),
    ]
    return reduce(DataFrame.unionByName, parts)


def bands_table(spark: SparkSession, params: Params) -> DataFrame:
    """The bands as an inline relation of fixed, known size."""

    def row(metric: str) -> str:
        b = params.bands[metric]
        centre = "cast(null as double)" if b.centre is None else f"{float(b.centre)}D"
        return f"('{metric}', '{b.name}', '{b.target}', {float(b.low)}D, {float(b.high)}D, {centre}, {b.digits}, {str(b.open_top).lower()})"

    rows = ", ".join(row(m) for m in params.bands)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(metric, name, target, low, high, centre, digits, open_top)")


def outcome_report(metrics: DataFrame, params: Params) -> DataFrame:
    """Every assertion with its verdict: pass, fail, or no_data where the metric is NULL."""
    off = "case when centre is not null then actual - centre when actual < low then actual - low else actual - high end"

    def rounded(c: str) -> str:
        return f"case digits when 0 then round({c}, 0) when 2 then round({c}, 2) else round({c}, 4) end"

    return metrics.join(bands_table(metrics.sparkSession, params), "metric").selectExpr(
        "concat(name, subject) as assertion_name",
        "target",
        f"{rounded('actual')} as actual",
        f"{rounded(off)} as difference",
        """case when actual is null then 'no_data'
                when actual < low or actual > high or (open_top and actual = high) then 'fail' else 'pass' end as verdict""",
    )


def outcome_failures(metrics: DataFrame, params: Params) -> DataFrame:
    """Only the violated assertions; empty means every outcome holds."""
    return outcome_report(metrics, params).where("verdict = 'fail'").drop("verdict")
