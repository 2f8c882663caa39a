"""Plain SQL for every query, over the same tables, to compare results with another engine.

Written apart from the Spark code: window functions, correlated subqueries and per-check
statements are used here on purpose where the Spark plans use aggregates and shared passes.
"""

from __future__ import annotations

import re

from quayside.params import DRIVER
from quayside.plans.build import LAYERS
from quayside.plans.checks import declared_checks, foreign_keys
from quayside.sources import tables as T

P = DRIVER
AS_OF = f"date '{P.as_of}'"
GO_LIVE = f"date '{P.go_live}'"
LAST_Q = f"date '{P.last_quarter_start}'"
NOW = f"timestamp '{P.now}'"
FOCUS = "(" + ", ".join(f"'{c}'" for c in P.focus_customers) + ")"
CARRIER = f"'{P.focus_carrier}'"


def _inline(rows: str) -> str:
    """The reference lists of the feeds, in this engine's spelling."""
    body, alias = rows.removeprefix("VALUES").rsplit("AS t", 1)
    return f"select * from (values {re.sub(r'([0-9]+)L', r'cast(\1 as bigint)', body)}) t{alias}"


def _case(values, index: str) -> str:
    return "case " + index + " " + " ".join(f"when {i} then '{v}'" for i, v in enumerate(values)) + " end"


def _job(k: str) -> str:
    return f"(if({k} % 10 = 0, ' job-', 'JOB-') || lpad(cast({k} as varchar), 12, '0') || if({k} % 7 = 0, ' ', ''))"


def _pad(k: str) -> str:
    return f"lpad(cast({k} as varchar), 12, '0')"


def _inv(k: str, s: str) -> str:
    return f"(if({s} = 'S', 'SUP/', 'INV/') || {_pad(k)} || '/' || {s})"


CTES = {
    # ------------------------------------------------------------- feeds --
    "timeline": """
        select k, cust, booking, etd, committed_days, actual_days,
               etd + committed_days as committed, departed, departed + actual_days as delivered,
               departed + actual_days + cast(k % 5 as integer) as completed
        from (select *, etd + cast(k % 3 as integer) as departed,
                     greatest(1, committed_days + shift) as actual_days
              from (select o_orderkey as k, o_custkey as cust, cast(o_orderdate as date) as booking,
                           cast(o_orderdate as date) + cast(2 + o_orderkey % 14 as integer) as etd,
                           cast(3 + (o_orderkey * 13) % 35 as integer) as committed_days,
                           cast((o_orderkey * 17) % 13 - 9 + if(o_orderkey % 9 = 5, 3, 0) as integer) as shift
                    from orders))""",
    "jobs": f"""
        select k, cust, booking, etd, committed_days, actual_days, committed,
               if(departed <= {AS_OF}, departed, null) as departed,
               if(delivered <= {AS_OF}, delivered, null) as delivered,
               if(completed <= {AS_OF}, completed, null) as completed,
               case when completed <= {AS_OF} then 'Closed' when delivered <= {AS_OF} then 'Delivered'
                    when departed <= {AS_OF} then 'In Transit' else 'Booked' end as status
        from timeline""",
    "exceptions_feed": f"""
        select event_id as exception_key, job as shipment_key, {_job('job')} as job_number,
               case event_type when 'click' then 1 when 'error' then 2 when 'purchase' then 3
                               when 'signup' then 4 when 'view' then 5 end as exception_type_key,
               ((job % 9) + 9) % 9 as carrier_key, user_id as customer_key, user_id % 5 as branch_key,
               cast(ts as date) as raised_date,
               if(event_id % 7 = 0, null, cast(ts as date) + cast(1 + event_id % 6 as integer)) as resolved_date,
               cast(floor(value) as bigint) % 10 as delay_days_attributed,
               if(event_id % 7 = 0, ' Open', 'Resolved') as exception_status
        from (select *, if(event_id % 50 = 49, -event_id, event_id - event_id % 3) as job from events)""",
    "charge_base": f"""
        select l.k, l.line, l.cost, l.supplier, j.cust, j.booking, j.completed,
               1 + (l.k + 4 * l.line) % {T.BRANDS} as charge_type,
               j.booking + cast((l.k * 7 + l.line * 11) % 60 as integer) as charge_day
        from (select l_orderkey as k, l_suppkey as supplier,
                     row_number() over (partition by l_orderkey order by {', '.join('l_' + c for c in T.LINE_ORDER)}) as line,
                     cast(cast(l_extendedprice as decimal(14,2)) * cast(0.7 as decimal(2,1)) as decimal(14,2)) as cost
              from lineitem) l
        left join jobs j on j.k = l.k""",
    "billed": f"""
        select *, cast(line_amount + tax_amount as decimal(14,2)) as total_amount,
               invoice_day + if(cust % 9 = 0, 45, 30) as due_day
        from (select *, cast(line_amount * cast(if(charge_type <= 2, 0.05, 0.18) as decimal(3,2)) as decimal(14,2)) as tax_amount
              from (select *, cast(cost * cast(1.2 as decimal(2,1)) as decimal(14,2)) as line_amount,
                           completed + cast(2 + (k * 11) % 14
                               + case series when 'A' then 0 when 'B' then if(k % 2 = 0, 3, 0) else 9 end as integer) as invoice_day
                    from (select *, case when line < 4 then 'A' when line = 4 then 'B' else 'S' end as series
                          from charge_base where completed is not null and cust % 20 <> 0)))
        where invoice_day <= {AS_OF}""",
    "lines_feed": f"""
        select k * {T.LINE_SLOT} + line as invoice_line_key, {_inv('k', 'series')} || if((k * {T.LINE_SLOT} + line) % 13 = 0, ' ', '') as invoice_number,
               case when (k * {T.LINE_SLOT} + line) % 997 = 0 then ' Debit Note '
                    when series = 'S' then if((k * {T.LINE_SLOT} + line) % 3 = 0, ' supplementary', 'Supplementary')
                    else if((k * {T.LINE_SLOT} + line) % 3 = 0, 'ORIGINAL', 'Original ') end as invoice_type,
               invoice_day as invoice_date, due_day as due_date, cust as customer_key,
               case when cast(floor(cost) as bigint) % 211 = 0 then null
                    when (k * {T.LINE_SLOT} + line) % 67 = 0 then 'JOB-' || {_pad('k')} || 'XX' else {_job('k')} end as job_number,
               cust % 5 as branch_key, charge_type as charge_type_key,
               'Line ' || cast(line as varchar) || ' of ' || {_inv('k', 'series')} as line_description,
               line_amount as line_amount_inr, tax_amount as tax_amount_inr, total_amount as total_amount_inr
        from billed
        union all
        select k * {T.LINE_SLOT} + {T.CREDIT_SLOT}, 'CN/' || {_pad('k')}, case k % 3 when 0 then 'cn' when 1 then ' CreditNote' else 'Credit Note' end,
               completed + 30, completed + 30, cust, {_job('k')}, cust % 5, cast(1 as bigint),
               case when k % 11 = 0 then 'Goodwill'
                    else 'Credit note against ' || if(k % 5 = 1, 'OLD/0001', 'INV/' || {_pad('k')} || '/A') end,
               cast(-1000 as decimal(14,2)), cast(-180 as decimal(14,2)), cast(-1180 as decimal(14,2))
        from jobs where completed + 30 <= {AS_OF} and cust % 20 <> 0 and k % 83 = 0""",
    "runs_feed": """
        select epoch_ms(hour) // 3600000 * 2 + if(source = 'Finance', 1, 0) as run_key,
               hour + interval 12 minute as run_timestamp, cast(hour as date) as run_date,
               source as source_system, 'Ingest' as pipeline_stage,
               if(source = 'Finance', 'fin-', 'ops-') || strftime(hour, '%Y%m%d-%H') as batch_id,
               processed as records_processed, rejected as records_rejected,
               cast(seconds as decimal(10,1)) as execution_seconds,
               case when processed % 17 = 0 then 'Failed' when rejected > 0 then 'Partial' else 'Success' end as run_status,
               if(processed % 17 = 0, 'extraction error', null) as error_message
        from (select date_trunc('hour', ts) as hour, if(event_type in ('click', 'view'), 'Operations', 'Finance') as source,
                     count(*) as processed, count(*) filter (where event_type = 'error') as rejected,
                     max(cast(value as decimal(12,2))) as seconds
              from events group by all)""",
    "exports": f"""
        select k as shipment_key, 'JOB-' || {_pad('k')} as job_number,
               'exp-' || strftime(booking + cast(n as integer), '%Y%m%d') as batch_id,
               cast(booking as timestamp) + to_days(cast(n as integer)) + to_hours(k % 24) as loaded_at,
               committed + cast(n * 2 as integer) as committed_delivery_date,
               case n when 0 then 'Booked' when 1 then 'In Transit' else 'Delivered' end as shipment_status
        from timeline join (select unnest([0, 1, 2]) as n) on n <= k % 3""",
    # -------------------------------------------------------- dimensions --
    "dim_mode": f"select * from {T.MODES}",
    "dim_charge_type": T.CHARGE_TYPES.format(part="part"),
    "dim_exception_type": _inline(T.EXCEPTION_TYPES),
    "dim_branch": """
        select cast(r_regionkey as bigint) as branch_key, 'BR-' || r_regionkey as branch_code, r_name as branch_name from region""",
    "dim_carrier": f"""
        select s_suppkey as carrier_key, 'CAR-' || {_pad('s_suppkey')} as carrier_code, s_name as carrier_name,
               if(s_suppkey % 2 = 1, 'Air', 'Ocean') as carrier_mode,
               if(s_suppkey % 2 = 1, 'Airline', 'Vessel operator') as carrier_type,
               'Nation ' || s_nationkey as primary_lanes,
               date '1990-01-01' + cast(s_suppkey % 1000 as integer) as contract_start_date, s_suppkey % 50 <> 49 as is_active
        from supplier""",
    "dim_customer": f"""
        select c_custkey as customer_key, 'CUST-' || {_pad('c_custkey')} as customer_code,
               c_name || ' (Debtors)' as tally_ledger_name, c_name as customer_name,
               upper(left(c_mktsegment, 1)) || lower(substr(c_mktsegment, 2)) as industry_segment,
               'City ' || (c_custkey % 5) as city, 'State ' || c_nationkey as state, 'BR-' || (c_custkey % 5) as home_branch,
               cast(if(c_custkey % 9 = 0, 45, 30) as bigint) as payment_terms_days,
               1000000 + (c_custkey % 10) * 500000 as credit_limit_inr,
               date '1985-01-01' + cast(c_custkey % 3000 as integer) as customer_since,
               'Manager ' || (c_custkey % 7) as kam_owner, c_custkey % 40 <> 39 as is_active
        from customer""",
    "dim_origin_port": """
        select cast(n_nationkey as bigint) as port_key, 'O-' || lpad(cast(n_nationkey as varchar), 3, '0') as port_code,
               n_name || ' — Terminal (North)' as port_name from nation""",
    "dim_destination_port": """
        select cast(n_nationkey as bigint) as port_key, 'D-' || lpad(cast(n_nationkey as varchar), 3, '0') as port_code,
               case n_nationkey % 3 when 0 then 'Port of ' || n_name when 1 then n_name || ' Port'
                    else n_name || ' International Airport' end as port_name from nation""",
    # ----------------------------------------------------------- staging --
    "stg_shipments": f"""
        select j.k as shipment_key, upper(trim({_job('j.k')})) as job_number, j.cust as customer_key, c.customer_code,
               j.k % 9 as carrier_key, v.carrier_code, j.cust % 5 as branch_key, j.k % 4 + 1 as mode_key, m.mode, m.service_level,
               j.k % 25 as origin_port_key, o.port_code as origin_port_code,
               (j.k * 7 + 3) % 25 as destination_port_key, d.port_code as destination_port_code,
               'Nation ' || (j.k % 25) || ' → Nation ' || ((j.k * 7 + 3) % 25) as trade_lane,
               'Region ' || (((j.k * 7 + 3) % 25) % 5) as destination_region,
               j.booking as booking_date, j.committed as committed_delivery_date, j.etd as planned_etd,
               j.departed as actual_departure_date, j.committed + cast(j.k % 5 - 2 as integer) as carrier_eta,
               j.delivered as actual_delivery_date, j.completed as job_completion_date, j.status as shipment_status,
               {_case(T.COMMODITIES, 'j.k % 5')} as commodity, upper(trim({_case(T.INCOTERMS, 'j.k % 4')})) as incoterm,
               if(j.k % 4 < 2, 1 + j.k % 3, null) as container_count,
               cast(if(j.k % 4 < 2, 2 * (1 + j.k % 3), null) as decimal(10,2)) as teu,
               cast(if(j.k % 4 < 2, null, 120 + (j.k * 97) % 7880) as decimal(12,2)) as chargeable_weight_kg,
               cast(j.committed_days as bigint) as committed_transit_days,
               cast(if(j.delivered is null, null, j.actual_days) as bigint) as actual_transit_days,
               coalesce(e.n, 0) as exception_count
        from jobs j
        left join dim_customer c on c.customer_key = j.cust
        left join dim_carrier v on v.carrier_key = j.k % 9
        left join dim_mode m on m.mode_key = j.k % 4 + 1
        left join dim_origin_port o on o.port_key = j.k % 25
        left join dim_destination_port d on d.port_key = (j.k * 7 + 3) % 25
        left join (select shipment_key, count(*) as n from exceptions_feed group by 1) e on e.shipment_key = j.k""",
    "stg_job_charges": f"""
        select b.k * {T.LINE_SLOT} + b.line as charge_key, b.job as shipment_key, upper(trim({_job('b.job')})) as job_number,
               b.charge_type as charge_type_key, t.charge_code, t.charge_category, b.cust as customer_key, b.k % 9 as carrier_key,
               b.cust % 5 as branch_key, b.k % 4 + 1 as mode_key, b.charge_day as charge_date,
               'Vendor ' || b.supplier as vendor_name, b.cost as amount_inr
        from (select *, if((k * {T.LINE_SLOT} + line) % {T.LOST_CHARGES} = 0, -(k * {T.LINE_SLOT} + line), k) as job from charge_base) b
        left join dim_charge_type t on t.charge_type_key = b.charge_type""",
    "stg_invoice_lines": """
        select * replace (trim(invoice_number) as invoice_number, upper(trim(job_number)) as job_number,
                          coalesce(map {'original': 'Original', 'supplementary': 'Supplementary', 'credit note': 'Credit Note',
                                        'creditnote': 'Credit Note', 'cn': 'Credit Note'}[lower(trim(invoice_type))],
                                   trim(invoice_type)) as invoice_type)
        from lines_feed""",
    "stg_payments": f"""
        with due as (select k, series, min(cust) as cust, min(due_day) as due_day, cast(sum(total_amount) as decimal(24,2)) as gross
                     from billed where cust % 31 <> 0 group by k, series),
             parts as (select *, 0 as part, due_day + cast(k % 40 - 5 as integer) as day,
                              cast(if(k % 12 = 0, cast(gross * cast(0.6 as decimal(2,1)) as decimal(14,2)), gross) as decimal(14,2)) as paid
                       from due
                       union all
                       select *, 1, due_day + cast(k % 40 + 15 as integer), cast(gross * cast(0.4 as decimal(2,1)) as decimal(14,2))
                       from due where k % 12 = 0)
        select k * {T.LINE_SLOT} + case series when 'A' then 0 when 'B' then 2 else 4 end + part as payment_key,
               'RCP/' || (k * {T.LINE_SLOT} + case series when 'A' then 0 when 'B' then 2 else 4 end + part) as receipt_number,
               if(cast(floor(gross) as bigint) % 97 = 0, 'ADV/' || {_pad('k')}, {_inv('k', 'series')}) as invoice_number, cust as customer_key,
               day as payment_date, paid as amount_inr,
               case k % 3 when 0 then 'Wire' when 1 then 'Cheque' else 'Transfer' end as payment_mode
        from parts where day <= {AS_OF}""",
    # ------------------------------------------------------------- rules --
    "int_shipments_conformed": """
        select s.*, v.carrier_name, v.carrier_mode, c.customer_name, c.payment_terms_days,
               if(s.actual_delivery_date is null, null, s.actual_delivery_date <= s.committed_delivery_date) as is_on_time,
               s.actual_transit_days - s.committed_transit_days as transit_variance_days, s.exception_count > 0 as has_exception
        from stg_shipments s
        left join dim_carrier v using (carrier_key)
        left join dim_customer c using (customer_key)""",
    "int_charges_classified": """
        select g.* exclude (charge_category), t.charge_name, t.charge_category, t.is_passthrough_expected,
               ifnull(g.charge_date > s.job_completion_date, false) as is_post_closure
        from stg_job_charges g
        left join dim_charge_type t using (charge_code)
        left join stg_shipments s on s.job_number = g.job_number""",
    "job_refs": f"select k as shipment_key, upper(trim({_job('k')})) as job_number, completed as job_completion_date from jobs",
    "int_invoices_matched": """
        select * exclude (is_first), shipment_key is not null as is_matched, is_first as is_first_original_invoice,
               if(is_first, date_diff('day', job_completion_date, invoice_date), null) as billing_lag_days
        from (select l.*, s.shipment_key, s.job_completion_date,
                     s.shipment_key is not null and l.invoice_type = 'Original' and 1 = dense_rank() over (
                         partition by s.shipment_key, l.invoice_type order by l.invoice_date, l.invoice_number) as is_first
              from stg_invoice_lines l left join job_refs s on s.job_number = l.job_number)""",
    "credits": """
        select regexp_extract(line_description, 'against (.+)$', 1) as invoice_number,
               cast(sum(total_amount_inr) as decimal(24,2)) as credited_inr
        from int_invoices_matched where invoice_type = 'Credit Note' group by all""",
    "receivables": """
        select invoice_number, min(customer_key) as customer_key, min(branch_key) as branch_key, min(invoice_date) as invoice_date,
               min(due_date) as due_date, cast(sum(total_amount_inr) as decimal(24,2)) as gross_total_inr
        from int_invoices_matched where invoice_type <> 'Credit Note' group by invoice_number""",
    "receipts": """
        select invoice_number, cast(sum(amount_inr) as decimal(24,2)) as amount_received_inr, max(payment_date) as last_payment_date
        from stg_payments group by invoice_number""",
    "int_invoice_settlement": f"""
        select invoice_number, customer_key, branch_key, invoice_date, due_date, invoice_total_inr, amount_received_inr,
               cast(if(owed > 0, owed, 0) as decimal(24,2)) as outstanding_inr, last_payment_date,
               if(owed > 0.01 and late > 0, late, 0) as days_overdue,
               case when owed <= 0.01 then 'Settled' when late is null or late > 90 then '90+' when late > 60 then '61-90'
                    when late > 30 then '31-60' when late > 0 then '0-30' else 'Current' end as aging_bucket,
               owed <= 0.01 as is_settled
        from (select *, invoice_total_inr - amount_received_inr as owed, date_diff('day', due_date, {AS_OF}) as late
              from (select r.*, cast(r.gross_total_inr + ifnull(c.credited_inr, 0) as decimal(24,2)) as invoice_total_inr,
                           cast(ifnull(p.amount_received_inr, 0) as decimal(24,2)) as amount_received_inr, p.last_payment_date
                    from receivables r left join credits c using (invoice_number) left join receipts p using (invoice_number)))""",
    "job_costs": """
        select shipment_key,
               cast(ifnull(sum(amount_inr) filter (where charge_category = 'Base Cost'), 0) as decimal(24,2)) as base_cost_inr,
               cast(ifnull(sum(amount_inr) filter (where charge_category = 'Surcharge'), 0) as decimal(24,2)) as surcharge_cost_inr
        from int_charges_classified group by shipment_key""",
    "job_revenue": """
        select l.shipment_key, cast(sum(l.line_amount_inr) as decimal(24,2)) as revenue_billed_inr,
               cast(ifnull(sum(l.line_amount_inr) filter (where t.charge_category = 'Surcharge'), 0) as decimal(24,2))
                   as surcharge_billed_inr,
               min(l.invoice_date) filter (where l.invoice_type = 'Original') as first_invoice_date,
               max(l.billing_lag_days) filter (where l.is_first_original_invoice) as billing_lag_days
        from int_invoices_matched l left join dim_charge_type t using (charge_type_key)
        where l.is_matched group by l.shipment_key""",
    "int_shipment_financials": """
        select s.shipment_key, s.job_number, s.customer_key, s.carrier_key, s.branch_key, s.mode_key, s.job_completion_date,
               r.first_invoice_date, r.billing_lag_days,
               cast(ifnull(r.revenue_billed_inr, 0) as decimal(24,2)) as revenue_billed_inr,
               cast(ifnull(c.base_cost_inr, 0) as decimal(24,2)) as base_cost_inr,
               cast(ifnull(c.surcharge_cost_inr, 0) as decimal(24,2)) as surcharge_cost_inr,
               cast(ifnull(r.surcharge_billed_inr, 0) as decimal(24,2)) as surcharge_billed_inr,
               cast(ifnull(c.base_cost_inr + c.surcharge_cost_inr, 0) as decimal(24,2)) as total_cost_inr,
               cast(ifnull(r.revenue_billed_inr, 0) - ifnull(c.base_cost_inr + c.surcharge_cost_inr, 0) as decimal(24,2))
                   as gross_margin_inr,
               r.first_invoice_date is not null as is_fully_billed
        from stg_shipments s left join job_costs c using (shipment_key) left join job_revenue r using (shipment_key)
        where s.job_completion_date is not null""",
    # -------------------------------------------------------------- mart --
    "fact_shipments": """
        select * exclude (customer_code, carrier_code, mode, service_level, origin_port_code, destination_port_code,
                          carrier_name, carrier_mode, customer_name, payment_terms_days) from int_shipments_conformed""",
    "fact_charges": """
        select * exclude (charge_code, charge_name, charge_category, is_passthrough_expected) from int_charges_classified""",
    "fact_invoice_lines": """
        select * exclude (is_matched, job_completion_date, is_first_original_invoice, billing_lag_days) from int_invoices_matched""",
    "fact_payments": "select * from stg_payments",
    "fact_invoice_settlement": "select * from int_invoice_settlement",
    "fact_shipment_financials": "select * from int_shipment_financials",
    "fact_exceptions": """
        select * replace (cast(exception_type_key as bigint) as exception_type_key, upper(trim(job_number)) as job_number,
                          trim(exception_status) as exception_status) from exceptions_feed""",
    "fact_pipeline_runs": "select * from runs_feed",
    # --------------------------------------------------------------- kpi --
    "otd_rates": f"""
        select v.carrier_code, count(*) as delivered_jobs, avg(cast(s.is_on_time as integer)) as otd_rate
        from fact_shipments s join dim_carrier v using (carrier_key)
        where s.actual_delivery_date is not null and v.carrier_code <> {CARRIER} group by 1""",
    "focus": f"select customer_key from dim_customer where customer_code in {FOCUS}",
    "profits": """
        select f.*, s.booking_date, f.customer_key in (select customer_key from focus) as is_problem
        from fact_shipment_financials f join fact_shipments s using (shipment_key) where f.is_fully_billed""",
    "lost": """
        select 'charges' as child, count(*) as orphan_rows from fact_charges c
        where not exists (select 1 from fact_shipments s where s.shipment_key = c.shipment_key)
        union all select 'exceptions', count(*) from fact_exceptions e
        where not exists (select 1 from fact_shipments s where s.shipment_key = e.shipment_key)
        union all select 'payments', count(*) from fact_payments p
        where not exists (select 1 from fact_invoice_settlement i where i.invoice_number = p.invoice_number)""",
}

_METRICS = {
    "total_jobs": "select cast(count(*) as double) from fact_shipments",
    "ocean_share": "select avg(if(m.mode = 'Ocean', 1.0, 0.0)) from fact_shipments s left join dim_mode m using (mode_key)",
    "otd_before": f"""select avg(cast(is_on_time as integer)) from fact_shipments
                      where booking_date < {GO_LIVE} and actual_delivery_date is not null""",
    "otd_after": f"""select avg(cast(is_on_time as integer)) from fact_shipments
                     where booking_date >= {GO_LIVE} and actual_delivery_date is not null""",
    "otd_focus_carrier": f"""select avg(cast(is_on_time as integer)) from fact_shipments join dim_carrier v using (carrier_key)
                             where v.carrier_code = {CARRIER} and actual_delivery_date is not null""",
    "volume_share": f"""select avg(if(customer_key in (select customer_key from focus), 1.0, 0.0)) from fact_shipments
                        where booking_date < {GO_LIVE}""",
    "reporting_lag": f"""select avg(1 + (8 - isodow(job_completion_date + 1)) % 7) + {P.skip_rate} * 7 from fact_shipments
                         where job_completion_date < {GO_LIVE}""",
    "margin_share": f"""select cast(sum(gross_margin_inr) filter (where is_problem) as double) / cast(sum(gross_margin_inr) as double)
                        from profits where booking_date < {GO_LIVE}""",
    "margin_uplift": f"""
        select cast(sum(gross_margin_inr) filter (where booking_date >= {LAST_Q}) as double)
                   / cast(sum(revenue_billed_inr) filter (where booking_date >= {LAST_Q}) as double)
             - cast(sum(gross_margin_inr) filter (where booking_date < {GO_LIVE}) as double)
                   / cast(sum(revenue_billed_inr) filter (where booking_date < {GO_LIVE}) as double) from profits""",
    "capture_focus": f"""select cast(sum(surcharge_billed_inr) as double) / cast(sum(surcharge_cost_inr) as double) from profits
                         where is_problem and booking_date < {GO_LIVE} and surcharge_cost_inr > 0""",
    "capture_others": f"""select cast(sum(surcharge_billed_inr) as double) / cast(sum(surcharge_cost_inr) as double) from profits
                          where not is_problem and booking_date < {GO_LIVE} and surcharge_cost_inr > 0""",
    "billing_lag": "select avg(billing_lag_days) from fact_shipment_financials",
    "orphan_keys": "select cast(sum(orphan_rows) as double) from lost",
    "unmatched_rate": "select avg(if(shipment_key is null, 1.0, 0.0)) from fact_invoice_lines",
}


def _with(body: str) -> str:
    """Prefix a statement with the relations it reads, directly or through others."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b(?:from|join)\s+{name}\b", text):
                needed.add(name)
                visit(CTES[name])

    visit(body)
    parts = [f"{n} as ({sql})" for n, sql in CTES.items() if n in needed]
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + body


def _metrics(*names: str) -> str:
    return "select " + ", ".join(f"round(({_METRICS[n]}), 6) as {n}" for n in names)


def _assertions(keep: str, with_verdict: bool) -> str:
    rows = []
    for metric, b in P.bands.items():
        source = "select otd_rate as actual, carrier_code as subject from otd_rates" if metric == "otd_carrier" else (
            f"select ({_METRICS[metric]}) as actual, '' as subject"
        )
        top = "actual >= " if b.open_top else "actual > "
        off = f"actual - {b.centre}" if b.centre is not None else f"actual - if(actual < {b.low}, {b.low}, {b.high})"
        rows.append(
            f"select '{b.name}' || subject as assertion_name, '{b.target}' as target, round(actual, {b.digits}) as actual, "
            f"round({off}, {b.digits}) as difference, case when actual is null then 'no_data' "
            f"when actual < {b.low} or {top}{b.high} then 'fail' else 'pass' end as verdict from ({source})"
        )
    columns = "*" if with_verdict else "* exclude (verdict)"
    return f"select {columns} from ({' union all '.join(rows)}) where {keep}"


def _check_sql(c) -> str:
    guard = f"({c.where}) and " if c.where else ""
    if c.kind == "unique":
        body = f"from (select {c.column} from {c.relation} where {c.column} is not null group by 1 having count(*) > 1)"
    elif c.kind == "not_null":
        body = f"from {c.relation} where {guard}{c.column} is null"
    elif c.kind == "accepted_values":
        values = ", ".join(str(v).lower() if isinstance(v, bool) else f"'{v}'" for v in c.values)
        body = f"from (select distinct {c.column} as v from {c.relation}) where v not in ({values})"
    elif c.kind == "relationships":
        body = (
            f"from {c.relation} where {c.column} is not null"
            f" and {c.column} not in (select {c.parent_column} from {c.parent} where {c.parent_column} is not null)"
        )
    else:
        body = f"from {c.relation} where {guard}not ({c.expression})"
    name = c.name.replace("'", "''")
    return f"select '{name}' as check_name, count(*) as failures {body}"


def _checks(kind: str | None) -> str:
    return " union all ".join(_check_sql(c) for c in declared_checks(P) if kind in (None, c.kind))


def _links() -> str:
    parts = []
    for f in foreign_keys():
        parts.append(
            f"select '{f.link}' as link, count(*) filter (where p.v is null) as dangling, count(*) as non_null,"
            f" count(*) filter (where p.v is null) = 0 as passed"
            f" from {f.child} c left join (select distinct {f.parent_column} as v from {f.parent}) p on p.v = c.{f.column}"
            f" where c.{f.column} is not null"
        )
    return " union all ".join(parts)


def _outages() -> str:
    rows = ", ".join(f"('{o.source}', timestamp '{o.start}', timestamp '{o.end}', '{o.message}')" for o in P.outages)
    return f"""
        select r.run_key, r.run_timestamp, r.source_system, count(m.a) > 0 as in_outage, string_agg(m.msg, '; ' order by m.a, m.msg) as outage_message
        from fact_pipeline_runs r left join (
          select run_key, w.msg, min(w.a) as a from fact_pipeline_runs q join (values {rows}) w(s, a, b, msg)
            on w.s = q.source_system and q.run_timestamp >= w.a and q.run_timestamp < w.b
          group by 1, 2) m on m.run_key = r.run_key
        group by 1, 2, 3"""


def _dims() -> str:
    keys = {
        "dim_branch": "branch_key, branch_code", "dim_carrier": "carrier_key, carrier_code",
        "dim_charge_type": "charge_type_key, charge_code", "dim_customer": "customer_key, customer_code",
        "dim_destination_port": "port_key, port_code", "dim_exception_type": "exception_type_key, exception_code",
        "dim_mode": "mode_key, mode_service", "dim_origin_port": "port_key, port_code",
    }
    return " union all ".join(
        f"select '{d}' as dim, count(*) as row_count, min({kc.split(', ')[0]}) as first_key, max({kc.split(', ')[0]}) as last_key,"
        f" min({kc.split(', ')[1]}) as first_code, max({kc.split(', ')[1]}) as last_code from {d}"
        for d, kc in keys.items()
    )


_RECEIPTS = """
    (select o_orderkey as receipt_key, 'rcp-' || strftime(o_orderdate, '%Y-%m') as batch_id,
            case when o_orderkey % 53 = 0 then 'n/a' when o_orderkey % 59 = 0 then null
                 else cast(cast(o_totalprice as decimal(14,2)) as varchar) end as amount_text,
            if(o_orderkey % 71 = 0, '2001-13-45', strftime(o_orderdate, '%Y-%m-%d')) as date_text
     from orders)"""
_REJECT = """case when amount_text is null then 'missing amount' when try_cast(amount_text as decimal(14,2)) is null then 'unreadable amount'
                  when try_cast(date_text as date) is null then 'unreadable date' end"""

_STATEMENTS = {
    **{n: f"select * from {n}" for n in ("stg_shipments", "stg_job_charges", "stg_invoice_lines", "stg_payments")},
    **{n: f"select * from {n}" for n in CTES if n.startswith("fact_")},
    **{n: f"select * from {n}" for n in ("dim_customer", "dim_carrier")},
    "shipments_conformed": "select * from int_shipments_conformed",
    "on_time_delivery": """select shipment_key, job_number, committed_delivery_date, actual_delivery_date, carrier_eta, is_on_time
                           from int_shipments_conformed""",
    "transit_variance": """select shipment_key, committed_transit_days, actual_transit_days, transit_variance_days
                           from int_shipments_conformed""",
    "charges_classified": "select * from int_charges_classified",
    "invoices_matched": "select * from int_invoices_matched",
    "first_original_invoice": """select invoice_line_key, shipment_key, invoice_number, invoice_date
                                 from int_invoices_matched where is_first_original_invoice""",
    "billing_lag": """select billing_lag_days, count(*) as invoice_lines, cast(sum(line_amount_inr) as decimal(24,2)) as line_amount_inr
                      from int_invoices_matched where billing_lag_days is not null group by 1""",
    "credit_note_netting": "select * from credits",
    "invoice_rollup": "select * from receivables",
    "payment_rollup": "select * from receipts",
    "invoice_settlement": "select * from int_invoice_settlement",
    "ar_aging": """select aging_bucket, count(*) as invoices, cast(sum(outstanding_inr) as decimal(24,2)) as outstanding_inr,
                          max(days_overdue) as worst_days from int_invoice_settlement group by 1""",
    "job_cost_pivot": "select * from job_costs",
    "job_revenue_pivot": "select * from job_revenue",
    "shipment_financials": "select * from int_shipment_financials",
    "mart_roundtrip": "select * from int_shipment_financials",
    "lifecycle_status": """select k as shipment_key, status as shipment_status, departed as actual_departure_date,
                                  delivered as actual_delivery_date, completed as job_completion_date from jobs""",
    "trade_lane": """
        select j.k as shipment_key,
               split_part(split_part(o.port_name, ' — ', 1), ' (', 1) || ' → '
                   || replace(split_part(split_part(d.port_name, ' Port', 1), ' International', 1), 'Port of ', '') as trade_lane
        from jobs j left join dim_origin_port o on o.port_key = j.k % 25
        left join dim_destination_port d on d.port_key = (j.k * 7 + 3) % 25""",
    "dim_conform": _dims(),
    "kpi_volume_mix": _metrics("total_jobs", "ocean_share").replace(
        "round((select cast(count(*) as double) from fact_shipments), 6)", "(select count(*) from fact_shipments)"
    ),
    "kpi_otd_cohort": _metrics("otd_before", "otd_after"),
    "kpi_otd_focus_carrier": _metrics("otd_focus_carrier"),
    "kpi_volume_share": _metrics("volume_share"),
    "kpi_reporting_lag": _metrics("reporting_lag"),
    "kpi_margin_share": _metrics("margin_share"),
    "kpi_margin_uplift": _metrics("margin_uplift"),
    "kpi_surcharge_capture": _metrics("capture_focus", "capture_others"),
    "kpi_billing_lag": _metrics("billing_lag"),
    "unmatched_rate": _metrics("unmatched_rate"),
    "kpi_otd_by_carrier": "select carrier_code, delivered_jobs, round(otd_rate, 6) as otd_rate from otd_rates",
    "problem_flag": """select shipment_key, customer_key, customer_key in (select customer_key from focus) as is_problem
                       from fact_shipments""",
    "orphan_counts": "select * from lost",
    "run_build": " union all ".join(f"select '{n}' as relation, count(*) as row_count from {n}" for n in LAYERS),
    "outcome_assertions": _assertions("verdict = 'fail'", False),
    "outcome_report": _assertions("true", True),
    "dq_unique": _checks("unique"),
    "dq_not_null": _checks("not_null"),
    "dq_accepted_values": _checks("accepted_values"),
    "dq_relationships": _checks("relationships"),
    "dq_expression": _checks("expression"),
    "dq_suite": f"select *, if(failures = 0, 'pass', 'fail') as status from ({_checks(None)})",
    "fk_audit": _links(),
    "first_seen_commit": """
        select job_number, first(committed_delivery_date order by loaded_at, batch_id) as committed_delivery_date,
               min(loaded_at) as first_loaded_at, count(*) as export_count from exports group by job_number""",
    "latest_snapshot": """
        select * from exports qualify row_number() over (partition by job_number order by loaded_at desc, batch_id desc) = 1""",
    "batch_dedup": """
        select batch_id, source_system, run_timestamp + interval 1 hour as delivered_at, records_processed as row_count,
               if(extract(hour from run_timestamp) % 5 = 0, 2, 1)::bigint as deliveries from runs_feed""",
    "quarantine_split": f"""
        select batch_id, count(*) filter (where why is null) as records_processed, count(why) as records_rejected,
               cast(sum(try_cast(amount_text as decimal(14,2))) filter (where why is null) as decimal(24,2)) as amount_inr
        from (select *, {_REJECT} as why from {_RECEIPTS}) group by 1""",
    "quarantine_rejects": f"select *, {_REJECT} as reject_reason from {_RECEIPTS} where {_REJECT} is not null",
    "hourly_run_log": """
        select date_trunc('hour', run_timestamp) as hour, source_system, count(*) as runs,
               cast(sum(records_processed) as bigint) as records_processed, cast(sum(records_rejected) as bigint) as records_rejected
        from fact_pipeline_runs group by 1, 2""",
    "stream_hourly_counts": """
        select hour, source_system, records_processed as runs, records_processed, records_rejected,
               hour + interval 3 hour > (select max(ts) from events) as is_open
        from (select *, date_trunc('hour', run_timestamp) as hour from runs_feed)""",
    "stream_batch_dedup": "select batch_id, cast(sum(records_processed) as bigint) as deliveries from runs_feed group by batch_id",
    "run_status": """
        select source_system, run_status, count(*) as runs, cast(sum(records_processed) as bigint) as records_processed,
               count(error_message) as errors from fact_pipeline_runs group by 1, 2""",
    "outage_tagging": _outages(),
    "source_freshness": f"""
        select source_system, newest_run, age_seconds,
               case when age_seconds > {P.freshness_error_hours * 3600} then 'error'
                    when age_seconds > {P.freshness_warn_hours * 3600} then 'warn' else 'pass' end as status
        from (select source_system, max(run_timestamp) as newest_run, date_diff('second', max(run_timestamp), {NOW}) as age_seconds
              from fact_pipeline_runs group by 1)""",
    "overdue_in_transit": f"""
        select shipment_status, count(*) as overdue_jobs, max({AS_OF} - committed_delivery_date) as worst_days from fact_shipments
        where actual_delivery_date is null and committed_delivery_date < {AS_OF} group by 1""",
    "ar_summary": """
        select customer_key, aging_bucket, count(*) as invoices, cast(sum(invoice_total_inr) as decimal(24,2)) as invoice_total_inr,
               cast(sum(outstanding_inr) as decimal(24,2)) as outstanding_inr from int_invoice_settlement group by 1, 2""",
    "dim_date": """
        select d as date_day, year(d) as year, quarter(d) as quarter, month(d) as month, day(d) as day_of_month,
               isodow(d) as iso_weekday, weekofyear(d) as iso_week, isodow(d) > 5 as is_weekend
        from (select cast(unnest(generate_series(min(booking_date), max(booking_date), interval 1 day)) as date) as d
              from fact_shipments)""",
}

ORACLES = {name: _with(body) for name, body in _STATEMENTS.items()}
