from datetime import date
from decimal import Decimal

import pytest

from quayside.operators import ingest, kpi, mart, rules, staging
from quayside.plans import build
from tests.fixtures import JOBS, PARAMS, RECEIPTS, feeds, job, line


@pytest.fixture(scope="module")
def small(spark):
    return feeds(spark)


def by(df, key, *columns):
    return {r[key]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()}


def test_codes_are_trimmed_and_upper_case(small):
    rows = by(staging.stg_shipments(small), "shipment_key", "job_number", "incoterm", "shipment_status", "carrier_code")
    assert rows[1] == ("JOB-1", "FOB", "Closed", "FAST")
    assert rows[2][2] == "In Transit"
    assert rows[6][3] is None


def test_load_stamp_is_opt_in(small):
    assert "_loaded_at" not in staging.stg_payments(small).columns
    assert "_loaded_at" in staging.with_loaded_at(staging.stg_payments(small)).columns


def test_voucher_spellings(small):
    kinds = by(staging.stg_invoice_lines(small), "invoice_line_key", "invoice_type")
    assert [kinds[k] for k in (1, 2, 3, 4)] == ["Original", "Original", "Original", "Supplementary"]
    assert {kinds[k] for k in range(8, 13)} == {"Credit Note"}
    assert kinds[13] == "Debit"


def test_on_time_is_null_until_delivered(small):
    rows = by(rules.shipments_conformed(small), "shipment_key", "is_on_time", "transit_variance_days", "has_exception")
    assert rows[1] == (True, 0, True)
    assert rows[2] == (None, None, False)
    assert rows[3] == (False, 1, False)


def test_post_closure_is_strictly_after_completion(small):
    assert by(rules.charges_classified(small), "charge_key", "is_post_closure") == {
        1: False, 2: True, 3: False, 4: False, 5: False, 6: False,
    }


def test_first_original_covers_all_its_lines(small):
    rows = by(rules.invoices_matched(small), "invoice_line_key", "is_first_original_invoice", "billing_lag_days", "is_matched")
    assert rows[1] == (False, None, True)
    assert rows[2] == rows[3] == (True, 7, True)
    assert rows[4] == (False, None, True)
    assert rows[5] == (True, None, True)
    assert rows[6] == rows[7] == (False, None, False)
    assert len(rows) == len(staging.stg_invoice_lines(small).collect())


def test_credit_notes_net_into_the_invoice_they_name(small):
    totals = by(rules.credit_note_netting(staging.stg_invoice_lines(small)), "invoice_number", "credited_inr")
    assert totals["INV-A"] == Decimal("-15.00")
    assert totals["NOPE"] == Decimal("-2.00")
    assert totals[""] == Decimal("-4.00")  # no target, and a target followed by a line break
    settled = by(rules.invoice_settlement(small, PARAMS), "invoice_number", "invoice_total_inr", "amount_received_inr", "last_payment_date")
    assert settled["INV-A"] == (Decimal("85.00"), Decimal("70.00"), date(2024, 6, 9))
    assert settled["INV-B"][0] == Decimal("50.00")
    assert not {"NOPE", "", "UNKNOWN", "CN-1"} & set(settled)


def test_one_pass_netting_equals_roll_up_and_join(spark, small):
    extra = [
        line(301, None, "Original", "2024-05-01", "JOB-1", "4.00"),
        line(302, "CN-9", "CN", "2024-05-01", "JOB-1", "-4.00", text=None),
        line(303, "ODD", None, "2024-05-01", "JOB-1", "8.00"),
    ]
    from tests.fixtures import LINES

    lines = staging.stg_invoice_lines(feeds(spark, invoice_lines=LINES + extra))
    joined = rules.invoice_rollup(lines).join(rules.credit_note_netting(lines), "invoice_number", "left")
    one_pass = rules.netted_invoices(lines).select(*joined.columns)
    assert sorted(map(str, one_pass.collect())) == sorted(map(str, joined.collect()))


def test_ageing_shelves(small):
    rows = by(rules.invoice_settlement(small, PARAMS), "invoice_number", "aging_bucket", "days_overdue")
    assert [rows[f"AGE-{i}"] for i in range(9)] == [
        ("Current", 0), ("0-30", 1), ("0-30", 30), ("31-60", 31), ("31-60", 60), ("61-90", 61), ("61-90", 90), ("90+", 91), ("90+", 0),
    ]


def test_settlement_tolerance_and_overpayment(small):
    rows = by(rules.invoice_settlement(small, PARAMS), "invoice_number", "is_settled", "outstanding_inr", "days_overdue")
    assert rows["TOL-1"] == (True, Decimal("0.01"), 0)
    assert rows["TOL-2"][:2] == (False, Decimal("0.02"))
    assert rows["OVER"] == (True, Decimal("0.00"), 0)


def test_job_profit(small):
    rows = by(
        rules.shipment_financials(small), "shipment_key", "revenue_billed_inr", "base_cost_inr", "surcharge_cost_inr",
        "surcharge_billed_inr", "gross_margin_inr", "is_fully_billed", "billing_lag_days",
    )
    # 50 + 80 + 20 + 9 less the matched credit notes of 10, 2, 1 and 3
    assert rows[1] == (Decimal("143.00"), Decimal("107.00"), Decimal("40.00"), Decimal("20.00"), Decimal("-4.00"), True, 7)
    assert rows[3][:5] == (Decimal("11.00"), Decimal("0.00"), Decimal("5.00"), Decimal("0.00"), Decimal("6.00"))
    assert rows[3][5] is False
    assert rows[5] == (Decimal("0.00"),) * 5 + (False, None)
    assert 2 not in rows


def test_lag_of_profit_equals_lag_of_first_original_lines(small):
    lines = rules.invoices_matched(small).where("is_first_original_invoice").groupBy("shipment_key").max("billing_lag_days")
    expected = by(lines, "shipment_key", "max(billing_lag_days)")
    assert by(rules.job_revenue(small).where("first_invoice_date is not null"), "shipment_key", "billing_lag_days") == expected


def test_lane_label(small):
    assert {r["trade_lane"] for r in rules.trade_lanes(small).collect()} == {"Port of Alpha Port → Alpha"}


def test_orphans_count_once_each(small):
    rel = build.all_relations(small, PARAMS)
    counts = kpi.orphan_counts(
        rel["fact_charges"], rel["fact_exceptions"], rel["fact_payments"], rel["fact_shipments"], rel["fact_invoice_settlement"]
    )
    assert by(counts, "child", "orphan_rows") == {"charges": 1, "exceptions": 1, "payments": 1}


def test_reporting_lag_from_sunday_and_monday(spark):
    for completed, lag in (("2024-04-07", 1), ("2024-04-08", 7)):
        one = feeds(spark, shipments=[job(1, "J", completed)])
        rel = build.all_relations(one, PARAMS)
        value = kpi.shipment_metrics(rel["fact_shipments"], rel, PARAMS, ("reporting_lag",)).first()[0]
        assert value == pytest.approx(lag + 0.63)


def test_membership_is_null_without_a_key(small):
    flags = by(kpi.with_focus_customers(mart.fact_shipments(small), small.dim_customer, PARAMS), "shipment_key", "is_problem")
    assert flags == {1: True, 2: True, 3: False, 4: False, 5: False, 6: None}


def test_carrier_rates_leave_out_focus_and_unknown(small):
    rates = by(kpi.otd_by_carrier(mart.fact_shipments(small), small.dim_carrier, PARAMS), "carrier_code", "delivered_jobs", "otd_rate")
    assert rates == {"FAST": (2, 0.5)}


def test_metrics_from_published_facts_equal_the_fused_ones(small):
    rel = build.all_relations(small, PARAMS)
    joined = kpi.booked_financials(rel["fact_shipment_financials"], rel["fact_shipments"])
    fused = kpi.margin_metrics(rules.booked_financials(small), small.dim_customer, PARAMS).collect()
    assert kpi.margin_metrics(joined, small.dim_customer, PARAMS).collect() == fused


def test_empty_mart_fails_only_the_count(spark):
    empty = feeds(
        spark, shipments=[], job_charges=[], invoice_lines=[], payments=[], exceptions=[], dim_customer=[], dim_carrier=[],
    )
    rel = build.all_relations(empty, PARAMS)
    metrics = kpi.outcome_metrics(rel, rules.booked_financials(empty), rel, PARAMS)
    verdicts = by(kpi.outcome_report(metrics, PARAMS), "assertion_name", "verdict")
    assert verdicts.pop("A1 total jobs") == "fail"
    assert verdicts.pop("A13 orphan keys") == "pass"
    assert set(verdicts.values()) == {"no_data"}
    assert [r["assertion_name"] for r in kpi.outcome_failures(metrics, PARAMS).collect()] == ["A1 total jobs"]


def test_overdue_and_calendar(small):
    late = ingest.overdue_in_transit(mart.fact_shipments(small), PARAMS).collect()
    assert [(r["shipment_status"], r["overdue_jobs"]) for r in late] == [("In Transit", 1)]
    days = ingest.dim_date(mart.fact_shipments(small)).collect()
    assert len(days) == (date(2024, 10, 3) - date(2024, 3, 1)).days + 1


def test_freshness_levels(small):
    fresh = ingest.source_freshness(mart.fact_pipeline_runs(small), PARAMS.now, 2, 4)
    assert by(fresh, "source_system", "status") == {"Ops": "pass", "Fin": "error"}


def test_settled_receivable_summary(small):
    summary = ingest.ar_summary(rules.invoice_settlement(small, PARAMS)).where("aging_bucket = 'Settled'").collect()
    assert [(r["customer_key"], r["invoices"], r["outstanding_inr"]) for r in summary] == [(1, 2, Decimal("0.01"))]


def test_receipts_without_invoice_do_not_settle(small):
    received = rules.invoice_settlement(small, PARAMS).agg({"amount_received_inr": "sum"}).first()[0]
    assert received == sum(r["amount_inr"] for r in RECEIPTS if r["invoice_number"] != "UNKNOWN")


def test_every_job_is_kept(small):
    assert rules.shipments_conformed(small).count() == len(JOBS)


def test_declared_source_without_runs_is_an_error(spark):
    none = spark.sql("select 'Tally' as source_system, timestamp_ntz'2025-01-01 00:00:00' as run_timestamp").where("false")
    fresh = ingest.source_freshness(none, PARAMS.now, 2, 4, ("Tally", "Finance")).collect()
    assert {(r["source_system"], r["newest_run"], r["status"]) for r in fresh} == {("Tally", None, "error"), ("Finance", None, "error")}
