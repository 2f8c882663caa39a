"""Raw feeds derived from the TPC-H-shaped tables.

Every feed is a pure column expression over whole tables: integer and decimal arithmetic
only, so another SQL engine reproduces the rows exactly. The text is left as untidy as
a real export (spaces, mixed case, spelling variants, missing and mistyped references),
so that staging has work to do.

Only the fixed lists, spelled out below as inline `VALUES`, carry a broadcast hint; every
table read from a file is left to its size statistics.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import broadcast, expr

from quayside.functions import dates, money, rules
from quayside.functions.text import literal
from quayside.params import DRIVER, Params
from quayside.sources.frames import Feeds

CARRIERS = 9
NATIONS = 25
BRANCHES = 5
LINE_SLOT = 100_000  # keys of one job's lines occupy job*LINE_SLOT onwards; a job with more lines fails
CREDIT_SLOT = LINE_SLOT - 1
LOST_CHARGES = 499

BRANDS = 25  # of the part table: each is a kind of charge
# Two modes with two grades each; the metrics know the modes by name and measure them in these units.
MODES = """(SELECT mode_key, mode, service_level, concat(mode, ' / ', service_level) AS mode_service, unit_of_measure
    FROM (SELECT cast(m + 1 AS bigint) AS mode_key, if(m < 2, 'Ocean', 'Air') AS mode, if(m % 2 = 0, 'Grade 1', 'Grade 2') AS service_level,
                 if(m < 2, 'TEU', 'kg') AS unit_of_measure
          FROM (VALUES (0), (1), (2), (3)) AS g(m)) AS grades) AS t"""
# A charge type for each brand of the part table. Odd brands are base costs.
CHARGE_TYPES = """SELECT brand AS charge_type_key, concat('BR', cast(brand AS string)) AS charge_code,
    concat('Service ', cast(brand AS string)) AS charge_name,
    if(brand % 2 = 1, 'Base Cost', 'Surcharge') AS charge_category,
    case brand % 5 when 0 then 'Ocean' when 1 then 'Air' else 'Both' end AS applies_to_mode,
    brand % 4 <> 3 AS is_passthrough_expected
    FROM (SELECT DISTINCT try_cast(substring(p_brand, 7) AS bigint) AS brand FROM {part}) AS brands
    WHERE brand IS NOT NULL"""
# The event types of the events table, as exceptions.
EXCEPTION_TYPES = """VALUES
    (1L, 'CLICK', 'Query raised', 'Low', 'Customer'),
    (2L, 'ERROR', 'Document error', 'High', 'Carrier'),
    (3L, 'PURCHASE', 'Rebooking', 'Medium', 'Forwarder'),
    (4L, 'SIGNUP', 'Registration hold', 'Medium', 'Customs'),
    (5L, 'VIEW', 'Inspection', 'Low', 'Customs')
    AS t(exception_type_key, exception_code, exception_name, severity, responsible_party)"""
# Columns that order the lines of a job; rows equal in all of them are interchangeable.
LINE_ORDER = ("linenumber", "partkey", "suppkey", "extendedprice", "quantity", "discount", "tax", "shipdate", "returnflag", "linestatus")
COMMODITIES = ("Textiles", "Machinery", "Chemicals", "Foodstuffs", "Electronics")
INCOTERMS = ("fob", "cif ", "exw", " dap")


def _pick(values: tuple[str, ...], index: str) -> str:
    return f"element_at(array({', '.join(map(literal, values))}), cast({index} + 1 as int))"


def _padded(c: str) -> str:
    return f"lpad(cast({c} as string), 12, '0')"


def _job_number(k: str) -> str:
    return f"concat(if({k} % 10 = 0, ' job-', 'JOB-'), {_padded(k)}, if({k} % 7 = 0, ' ', ''))"


def _invoice_number(k: str, series: str) -> str:
    return f"concat(if({series} = 'S', 'SUP/', 'INV/'), {_padded(k)}, '/', {series})"


def _digits(d: str) -> str:
    return f"replace(cast({d} as string), '-', '')"


def _midnight(c: str) -> str:
    return f"cast(cast({c} as date) as timestamp_ntz)"


def _terms(cust: str) -> str:
    return f"if({cust} % 9 = 0, 45, 30)"


def batch_name(source: str, hour: str) -> str:
    return f"concat(if({source} = 'Operations', 'ops-', 'fin-'), {_digits(f'cast({hour} as date)')}, '-', lpad(cast(hour({hour}) as string), 2, '0'))"


class TableFeeds(Feeds):
    """Feeds and dimensions over `<path>/<table>.parquet`."""

    def __init__(self, spark: SparkSession, path: str, params: Params = DRIVER):
        super().__init__(spark, self._unknown)
        self.path = path
        self.params = params
        self._tables: dict[str, DataFrame] = {}

    @staticmethod
    def _unknown(kind: str, name: str) -> DataFrame:
        raise KeyError(f"no {kind} named {name}")

    def keeping(self, kept: Callable[[str, DataFrame], DataFrame]) -> TableFeeds:
        feeds = TableFeeds(self.spark, self.path, self.params)
        feeds.kept = kept
        return feeds

    def table(self, name: str) -> DataFrame:
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.path}/{name}.parquet")
        return self._tables[name]

    def _values(self, rows: str) -> DataFrame:
        """An inline list; its few rows are spelled out here, which is what allows the hint."""
        return broadcast(self.spark.sql(f"SELECT * FROM {rows}"))

    # ---------------------------------------------------------------- jobs --
    @cached_property
    def timeline(self) -> DataFrame:
        """One row per job with its full planned timeline, before the as-of mask."""
        return self.table("orders").selectExpr(
            "o_orderkey as k",
            "o_custkey as cust",
            "cast(o_orderdate as date) as booking",
            "cast(3 + (k * 13) % 35 as int) as committed_days",
            f"greatest(1, committed_days + cast((k * 17) % 13 - 9 + if(k % {CARRIERS} = 5, 3, 0) as int)) as actual_days",
            f"{dates.plus_days('booking', '2 + k % 14')} as etd",
            f"{dates.plus_days('etd', 'committed_days')} as committed",
            f"{dates.plus_days('etd', 'k % 3')} as departed",
            f"{dates.plus_days('departed', 'actual_days')} as delivered",
            f"{dates.plus_days('delivered', 'k % 5')} as completed",
        )

    @cached_property
    def jobs(self) -> DataFrame:
        """The timeline as known on the as-of date, with status."""
        as_of = self.params.as_of
        return self.timeline.selectExpr(
            "k", "cust", "booking", "etd", "committed", "committed_days", "actual_days",
            f"{rules.lifecycle('departed', 'delivered', 'completed', as_of)} as status",
            *[f"{rules.known_by(c, as_of)} as {c}" for c in ("departed", "delivered", "completed")],
        )

    @cached_property
    def shipments(self) -> DataFrame:
        counts = self.exceptions.groupBy("shipment_key").agg(expr("count(*) as exceptions_logged"))
        return (
            self.jobs.selectExpr("*", "k as shipment_key", f"k % {NATIONS} as origin", f"(k * 7 + 3) % {NATIONS} as dest", "k % 4 < 2 as ocean")
            .join(counts, "shipment_key", "left")
            .selectExpr(
                "shipment_key",
                f"{_job_number('k')} as job_number",
                "cust as customer_key",
                f"k % {CARRIERS} as carrier_key",
                f"cust % {BRANCHES} as branch_key",
                "k % 4 + 1 as mode_key",
                "origin as origin_port_key",
                "dest as destination_port_key",
                "concat('Nation ', cast(origin as string), ' → Nation ', cast(dest as string)) as trade_lane",
                f"concat('Region ', cast(dest % {BRANCHES} as string)) as destination_region",
                "booking as booking_date",
                "committed as committed_delivery_date",
                "etd as planned_etd",
                "departed as actual_departure_date",
                f"{dates.plus_days('committed', 'k % 5 - 2')} as carrier_eta",
                "delivered as actual_delivery_date",
                "completed as job_completion_date",
                "concat(status, if(k % 6 = 0, '  ', '')) as shipment_status",
                f"{_pick(COMMODITIES, 'k % 5')} as commodity",
                f"{_pick(INCOTERMS, 'k % 4')} as incoterm",
                "if(ocean, 1 + k % 3, null) as container_count",
                "if(ocean, (1 + k % 3) * 2, null) as teu",
                "if(ocean, null, 120 + (k * 97) % 7880) as chargeable_weight_kg",
                "committed_days as committed_transit_days",
                "if(delivered is null, null, actual_days) as actual_transit_days",
                "coalesce(exceptions_logged, 0) as exception_count",
            )
        )

    # ------------------------------------------------------------- charges --
    @cached_property
    def charge_base(self) -> DataFrame:
        """Every row of the line table with its job, if there is one; lines are numbered within the job.

        Line numbers repeat in the table, so they are counted anew, in the order of all columns. The
        count and the join to the jobs need the same shuffle. Charges, invoice lines and receipts all
        derive from this.
        """
        order = ", ".join(f"l_{c}" for c in LINE_ORDER)
        numbered = (
            self.table("lineitem")
            .selectExpr("l_orderkey as k", *(f"l_{c}" for c in LINE_ORDER))  # renamed first: the window and the join then name the same key
            .selectExpr("k", f"row_number() over (partition by k order by {order}) as row", "l_suppkey", "l_extendedprice")
            .withColumnsRenamed({"l_suppkey": "supplier", "l_extendedprice": "price"})
            .join(self.jobs.select("k", "cust", "booking", "completed"), "k", "left")
            .selectExpr(
                "k", f"if(row < {CREDIT_SLOT}, cast(row as bigint), raise_error('a job has more lines than its keys')) as line",
                "supplier", "cust", "booking", "completed",
                f"{money.scaled(money.amount('price'), '0.7')} as cost",
                f"1 + (k + 4 * line) % {BRANDS} as charge_type",
                f"{dates.plus_days('booking', '(k * 7 + line * 11) % 60')} as charge_day",
            )
        )
        return self.kept("charge_base", numbered)

    @cached_property
    def job_charges(self) -> DataFrame:
        """All lines as charges; 1 in 499 names a job that does not exist."""
        return self.charge_base.selectExpr(
            f"k * {LINE_SLOT} + line as charge_key",
            f"if(charge_key % {LOST_CHARGES} = 0, -charge_key, k) as shipment_key",
            f"{_job_number('shipment_key')} as job_number",
            "charge_type as charge_type_key",
            "cust as customer_key",
            f"k % {CARRIERS} as carrier_key",
            f"cust % {BRANCHES} as branch_key",
            "k % 4 + 1 as mode_key",
            "charge_day as charge_date",
            "concat(' Vendor ', cast(supplier as string), ' ') as vendor_name",
            "cost as amount_inr",
        )

    # ------------------------------------------------------------ invoices --
    @cached_property
    def billed_lines(self) -> DataFrame:
        """Priced sales lines with their job key and voucher series (A, B original, S supplementary)."""
        delay = "case series when 'A' then 0 when 'B' then 3 * ((k + 1) % 2) else 9 end"
        low, high = money.scaled("line_amount", "0.05"), money.scaled("line_amount", "0.18")
        return (
            self.charge_base.where("completed is not null and cust % 20 != 0")
            .selectExpr(
                "k", "line", "cust", "cost", "charge_type",
                "case when line <= 3 then 'A' when line = 4 then 'B' else 'S' end as series",
                f"{dates.plus_days('completed', f'2 + (k * 11) % 14 + {delay}')} as invoice_day",
                f"{dates.plus_days('invoice_day', _terms('cust'))} as due_day",
                f"{money.scaled('cost', '1.2')} as line_amount",
                f"if(charge_type <= 2, {low}, {high}) as tax_amount",
                f"{money.amount('line_amount + tax_amount')} as total_amount",
            )
            .where(f"invoice_day <= {dates.day(self.params.as_of)}")
        )

    @cached_property
    def invoice_lines(self) -> DataFrame:
        number = _invoice_number("k", "series")
        key = f"(k * {LINE_SLOT} + line)"
        sales = self.billed_lines.selectExpr(
            f"{key} as invoice_line_key",
            f"concat({number}, if({key} % 13 = 0, ' ', '')) as invoice_number",
            f"""case when {key} % 997 = 0 then ' Debit Note '
                    when series != 'S' then if({key} % 3 = 0, 'ORIGINAL', 'Original ')
                    else if({key} % 3 = 0, ' supplementary', 'Supplementary') end as invoice_type""",
            "invoice_day as invoice_date",
            "due_day as due_date",
            "cust as customer_key",
            f"""case when cast(floor(cost) as bigint) % 211 = 0 then null when {key} % 67 = 0 then concat('JOB-', {_padded('k')}, 'XX')
                     else {_job_number('k')} end as job_number""",
            f"cust % {BRANCHES} as branch_key",
            "charge_type as charge_type_key",
            f"concat('Line ', cast(line as string), ' of ', {number}) as line_description",
            "line_amount as line_amount_inr",
            "tax_amount as tax_amount_inr",
            "total_amount as total_amount_inr",
        )
        return sales.unionByName(self._credit_notes())

    def _credit_notes(self) -> DataFrame:
        return (
            self.jobs.where("completed is not null and cust % 20 != 0 and k % 83 = 0")
            .selectExpr("*", "date_add(completed, 30) as day")
            .where(f"day <= {dates.day(self.params.as_of)}")
            .selectExpr(
                f"k * {LINE_SLOT} + {CREDIT_SLOT} as invoice_line_key",
                f"concat('CN/', {_padded('k')}) as invoice_number",
                "case k % 3 when 0 then 'cn' when 1 then ' CreditNote' else 'Credit Note' end as invoice_type",
                "day as invoice_date",
                "day as due_date",
                "cust as customer_key",
                f"{_job_number('k')} as job_number",
                f"cust % {BRANCHES} as branch_key",
                "1L as charge_type_key",
                f"""case when k % 11 = 0 then 'Goodwill'
                         else concat('Credit note against ', if(k % 5 = 1, 'OLD/0001', {_invoice_number('k', "'A'")})) end
                    as line_description""",
                f"{money.amount('-1000')} as line_amount_inr",
                f"{money.amount('-180')} as tax_amount_inr",
                f"{money.amount('-1180')} as total_amount_inr",
            )
        )

    # ------------------------------------------------------------ receipts --
    @cached_property
    def payments(self) -> DataFrame:
        first, second = dates.plus_days("due_day", "k % 40 - 5"), dates.plus_days("due_day", "k % 40 + 15")
        parts = f"""if(k % 12 = 0,
            array(struct(0 as part, {first} as day, {money.scaled('gross', '0.6')} as paid),
                  struct(1 as part, {second} as day, {money.scaled('gross', '0.4')} as paid)),
            array(struct(0 as part, {first} as day, {money.amount('gross')} as paid)))"""
        return (
            self.billed_lines.where("cust % 31 != 0")
            .groupBy("k", "series")
            .agg(expr("sum(total_amount) as gross"), expr("min(due_day) as due_day"), expr("min(cust) as cust"))
            .selectExpr("k", "series", "cust", "gross", f"inline({parts})")
            .where(f"day <= {dates.day(self.params.as_of)}")
            .selectExpr("*", f"k * {LINE_SLOT} + case series when 'A' then 0 when 'B' then 2 else 4 end + part as payment_key")
            .selectExpr(
                "payment_key",
                "concat(' RCP/', cast(payment_key as string)) as receipt_number",
                f"""if(cast(floor(gross) as bigint) % 97 = 0, concat('ADV/', {_padded('k')}), {_invoice_number('k', 'series')})
                    as invoice_number""",
                "cust as customer_key",
                "day as payment_date",
                "paid as amount_inr",
                "case k % 3 when 0 then 'Wire ' when 1 then ' Cheque' else 'Transfer' end as payment_mode",
            )
        )

    # ---------------------------------------------------------- exceptions --
    @cached_property
    def exceptions(self) -> DataFrame:
        """Three consecutive events fall on one job; 1 in 50 names a job that does not exist."""
        return (
            self.table("events")
            .selectExpr(
                "event_id as exception_key",
                "if(event_id % 50 = 49, -event_id, event_id - event_id % 3) as shipment_key",
                f"{_job_number('shipment_key')} as job_number",
                """cast(case event_type when 'click' then 1 when 'error' then 2 when 'purchase' then 3 when 'signup' then 4
                        when 'view' then 5 end as bigint) as exception_type_key""",
                f"pmod(shipment_key, {CARRIERS}L) as carrier_key",
                "user_id as customer_key",
                f"user_id % {BRANCHES} as branch_key",
                "cast(ts as date) as raised_date",
                f"if(event_id % 7 = 0, null, {dates.plus_days('raised_date', '1 + event_id % 6')}) as resolved_date",
                "cast(floor(value) % 10 as int) as delay_days_attributed",
                "if(event_id % 7 = 0, ' Open', 'Resolved') as exception_status",
            )
        )

    # ------------------------------------------------------------- run log --
    @cached_property
    def event_batches(self) -> DataFrame:
        """Events with the source they came from and the hour they were landed in."""
        return self.table("events").selectExpr(
            "event_type",
            "cast(value as decimal(12,2)) as seconds",
            f"{_midnight('ts')} + make_dt_interval(0, hour(ts)) as hour",
            "if(event_type in ('click', 'view'), 'Operations', 'Finance') as source_system",
        )

    @cached_property
    def pipeline_runs(self) -> DataFrame:
        failed = "processed % 17 = 0"
        # Whole hours since the epoch, two sources each.
        hour_no = "cast(datediff(cast(hour as date), date'1970-01-01') as bigint) * 24 + hour(hour)"
        return (
            self.event_batches.groupBy("hour", "source_system")
            .agg(
                expr("count(*) as processed"), expr("count_if(event_type = 'error') as rejected"), expr("max(seconds) as seconds")
            )
            .selectExpr(
                f"({hour_no}) * 2 + if(source_system = 'Finance', 1, 0) as run_key",
                "hour + interval '12' minute as run_timestamp",
                "cast(hour as date) as run_date",
                "concat(source_system, ' ') as source_system",
                "' Ingest' as pipeline_stage",
                f"{batch_name('source_system', 'hour')} as batch_id",
                "processed as records_processed",
                "rejected as records_rejected",
                "seconds as execution_seconds",
                f"{rules.run_status(failed, 'rejected')} as run_status",
                f"if({failed}, 'extraction error', null) as error_message",
            )
        )

    # ------------------------------------------------- append-only exports --
    @cached_property
    def export_batches(self) -> DataFrame:
        """Every job as exported in 1 to 3 daily batches; later ones amend the promise and the status."""
        return self.timeline.selectExpr("*", "explode(sequence(0, cast(k % 3 as int))) as n").selectExpr(
            "k as shipment_key",
            f"concat('JOB-', {_padded('k')}) as job_number",
            f"concat('exp-', {_digits('date_add(booking, n)')}) as batch_id",
            f"{_midnight('booking')} + make_dt_interval(n, cast(k % 24 as int)) as loaded_at",
            f"{dates.plus_days('committed', 'n * 2')} as committed_delivery_date",
            "case n when 0 then 'Booked' when 1 then 'In Transit' else 'Delivered' end as shipment_status",
        )

    @cached_property
    def batch_arrivals(self) -> DataFrame:
        """Deliveries of hourly batches; every fifth hour's batch is delivered a second time, amended."""
        return (
            self.event_batches.groupBy("hour", "source_system")
            .agg(expr("count(*) as rows_in"))
            .selectExpr("*", "explode(if(hour(hour) % 5 = 0, array(0, 1), array(0))) as n")
            .selectExpr(
                f"{batch_name('source_system', 'hour')} as batch_id",
                "source_system",
                "hour + make_dt_interval(0, 1 + n, 12) as delivered_at",
                "rows_in + n as row_count",
            )
        )

    @cached_property
    def raw_receipts(self) -> DataFrame:
        """Untyped receipt export with unreadable amounts and dates among the good ones."""
        return self.table("orders").selectExpr(
            "o_orderkey as receipt_key",
            "concat('rcp-', substring(cast(cast(o_orderdate as date) as string), 1, 7)) as batch_id",
            """case when o_orderkey % 53 = 0 then 'n/a' when o_orderkey % 59 = 0 then null
                    else cast(cast(o_totalprice as decimal(14,2)) as string) end as amount_text""",
            "if(o_orderkey % 71 = 0, '2001-13-45', cast(cast(o_orderdate as date) as string)) as date_text",
        )

    # ---------------------------------------------------------- dimensions --
    @cached_property
    def dim_mode(self) -> DataFrame:
        return self._values(MODES)

    @cached_property
    def dim_charge_type(self) -> DataFrame:
        return self.kept("dim_charge_type", self.spark.sql(CHARGE_TYPES, part=self.table("part")))

    @cached_property
    def dim_exception_type(self) -> DataFrame:
        return self._values(EXCEPTION_TYPES)

    @cached_property
    def dim_branch(self) -> DataFrame:
        return self.table("region").selectExpr(
            "cast(r_regionkey as bigint) as branch_key",
            "concat('BR-', cast(r_regionkey as string)) as branch_code",
            "initcap(r_name) as branch_name",
            "concat('City ', cast(r_regionkey as string)) as city",
            "concat('State ', cast(r_regionkey as string)) as state",
            "r_regionkey = 0 as is_hq",
        )

    @cached_property
    def dim_carrier(self) -> DataFrame:
        return self.table("supplier").selectExpr(
            "s_suppkey as carrier_key",
            f"concat('CAR-', {_padded('s_suppkey')}) as carrier_code",
            "s_name as carrier_name",
            "if(s_suppkey % 2 = 1, 'Air', 'Ocean') as carrier_mode",
            "if(s_suppkey % 2 = 1, 'Airline', 'Vessel operator') as carrier_type",
            "concat('Nation ', cast(s_nationkey as string)) as primary_lanes",
            "date_add(date'1990-01-01', cast(s_suppkey % 1000 as int)) as contract_start_date",
            "s_suppkey % 50 != 49 as is_active",
        )

    @cached_property
    def dim_customer(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey as customer_key",
            f"concat('CUST-', {_padded('c_custkey')}) as customer_code",
            "concat(c_name, ' (Debtors)') as tally_ledger_name",
            "c_name as customer_name",
            "initcap(c_mktsegment) as industry_segment",
            f"concat('City ', cast(c_custkey % {BRANCHES} as string)) as city",
            "concat('State ', cast(c_nationkey as string)) as state",
            f"concat('BR-', cast(c_custkey % {BRANCHES} as string)) as home_branch",
            f"{_terms('c_custkey')} as payment_terms_days",
            "1000000 + (c_custkey % 10) * 500000 as credit_limit_inr",
            "date_add(date'1985-01-01', cast(c_custkey % 3000 as int)) as customer_since",
            "concat('Manager ', cast(c_custkey % 7 as string)) as kam_owner",
            "c_custkey % 40 != 39 as is_active",
        )

    @cached_property
    def dim_origin_port(self) -> DataFrame:
        return self._ports("Origin", "concat(n_name, ' — Terminal (North)')")

    @cached_property
    def dim_destination_port(self) -> DataFrame:
        return self._ports(
            "Destination",
            """case n_nationkey % 3 when 0 then concat('Port of ', n_name) when 1 then concat(n_name, ' Port')
                    else concat(n_name, ' International Airport') end""",
        )

    def _ports(self, role: str, name: str) -> DataFrame:
        # Grouped, hence known to be unique: Catalyst drops the join where the region is not read.
        regions = (
            self.table("region").groupBy("r_regionkey").agg(expr("max(initcap(r_name)) as region"))
            .withColumnRenamed("r_regionkey", "n_regionkey")
        )
        return self.table("nation").join(regions, "n_regionkey", "left").selectExpr(
            "cast(n_nationkey as bigint) as port_key",
            f"concat('{role[0]}-', lpad(cast(n_nationkey as string), 3, '0')) as port_code",
            f"{name} as port_name",
            "if(n_nationkey % 3 = 2, 'Airport', 'Seaport') as port_type",
            "concat('City ', cast(n_nationkey as string)) as city",
            "n_name as country",
            "region",
            f"'{role}' as trade_lane_role",
        )
