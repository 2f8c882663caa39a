"""Batch forms of the declared ingest behaviours and the small reporting relations."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.dates import day, instant
from quayside.functions.text import literal
from quayside.params import Outage, Params


# ------------------------------------------------------ append-only exports --
def first_seen_commit(exports: DataFrame) -> DataFrame:
    """The promise each job was first exported with, by landing time; later amendments never restate it."""
    landed = F.struct("loaded_at", "batch_id")
    return exports.groupBy("job_number").agg(
        F.min_by("committed_delivery_date", landed).alias("committed_delivery_date"),
        F.min("loaded_at").alias("first_loaded_at"),
        F.count("*").alias("export_count"),
    )


def latest_snapshot(exports: DataFrame) -> DataFrame:
    """Newest exported row of each job. An aggregate, not a window: it combines before the shuffle."""
    others = [c for c in exports.columns if c != "job_number"]
    newest = F.max_by(F.struct(*others), F.struct("loaded_at", "batch_id"))
    return exports.groupBy("job_number").agg(newest.alias("s")).select("job_number", "s.*")


def skip_repeated_batches(arrivals: DataFrame) -> DataFrame:
    """First delivery of every batch fingerprint; repeats are counted and left out."""
    others = [c for c in arrivals.columns if c != "batch_id"]
    return (
        arrivals.groupBy("batch_id")
        .agg(F.min_by(F.struct(*others), F.struct("delivered_at", "row_count")).alias("s"), F.count("*").alias("deliveries"))
        .select("batch_id", "s.*", "deliveries")
    )


# --------------------------------------------------------------- quarantine --
@dataclass(frozen=True)
class Split:
    valid: DataFrame
    rejected: DataFrame


def judged_receipts(raw: DataFrame) -> DataFrame:
    """Untyped receipts with typed columns and the reason a row cannot be used, NULL when it can."""
    return raw.selectExpr(
        "*", "try_cast(amount_text as decimal(14,2)) as amount_inr", "try_cast(date_text as date) as payment_date"
    ).selectExpr(
        "*",
        """case when amount_text is null then 'missing amount' when amount_inr is null then 'unreadable amount'
                when date_text is null then 'missing date' when payment_date is null then 'unreadable date'
           end as reject_reason""",
    )


def quarantine_split(raw: DataFrame) -> Split:
    judged = judged_receipts(raw)
    return Split(
        judged.where("reject_reason is null").drop("reject_reason", "amount_text", "date_text"),
        judged.where("reject_reason is not null").select(*raw.columns, "reject_reason"),
    )


def quarantine_counts(raw: DataFrame) -> DataFrame:
    """Per batch: rows accepted, rows rejected and the accepted amount."""
    return judged_receipts(raw).groupBy("batch_id").agg(
        F.expr("count_if(reject_reason is null) as records_processed"),
        F.expr("count_if(reject_reason is not null) as records_rejected"),
        F.expr("cast(sum(if(reject_reason is null, amount_inr, null)) as decimal(24,2)) as amount_inr"),
    )


# ------------------------------------------------------------------ run log --
def hourly_run_log(runs: DataFrame) -> DataFrame:
    """Runs, rows and rejects per source and hour."""
    return (
        runs.groupBy(F.window("run_timestamp", "1 hour").alias("w"), "source_system")
        .agg(
            F.count("*").alias("runs"),
            F.sum("records_processed").alias("records_processed"),
            F.sum("records_rejected").alias("records_rejected"),
        )
        .select(F.col("w.start").cast("timestamp_ntz").alias("hour"), "source_system", "runs", "records_processed", "records_rejected")
    )


def outage_windows(spark: SparkSession, outages: tuple[Outage, ...]) -> DataFrame:
    """A short declared list as a relation: outage_source, outage_start, outage_end, outage_message."""
    rows = ", ".join(f"({literal(o.source)}, {instant(o.start)}, {instant(o.end)}, {literal(o.message)})" for o in outages)
    columns = "outage_source, outage_start, outage_end, outage_message"
    if not outages:
        none = "cast(null as string), cast(null as timestamp_ntz), cast(null as timestamp_ntz), cast(null as string)"
        return spark.sql(f"SELECT * FROM VALUES ({none}) AS t({columns})").where("false")
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({columns})")


_SECONDS = "timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', {0})"
_SLOT = "floor({0} / ({1} * shiftleft(1L, level)))"
#: Length in seconds of the time slots of level 0; those of each further level are twice as long.
SLOT_SECONDS = 3600


def outage_tagging(runs: DataFrame, outages: DataFrame | tuple[Outage, ...]) -> DataFrame:
    """Mark runs that fall into an outage window of their source (start <= t < end), with the messages of all of them.

    Windows may be a table of any size. A window is entered in the slots it touches among those of
    its own length rounded up to a power of two: two or three, however long it is. A run looks up one slot
    of each length that occurs, a few dozen at most, so runs meet windows by equality on (source, level, slot).
    The tag hangs on source and time alone, so each pair of these is looked up once, however many
    runs share it, and no run is repeated. Messages are joined with '; ', by start and then by text.
    """
    windows = outages if isinstance(outages, DataFrame) else outage_windows(runs.sparkSession, outages)
    length = "timestampdiff(SECOND, outage_start, outage_end)"
    slotted = (
        windows.where("outage_start < outage_end")
        .withColumn("level", F.expr(f"cast(greatest(ceil(log2(greatest({length}, 1) / {SLOT_SECONDS}D)), 0) as int)"))
        .withColumn("slot", F.expr(f"explode(sequence({_slot('outage_start')}, {_slot('outage_end')}))"))
    )
    levels = slotted.agg(F.collect_set("level").alias("levels"))
    at = (
        runs.select(F.col("source_system").alias("at_source"), F.col("run_timestamp").alias("at_time"))
        .where("at_source is not null and at_time is not null")
        .distinct()
        .withColumn("levels", levels.scalar())
        .selectExpr("at_source", "at_time", "explode(levels) as level")
        .withColumn("slot", F.expr(_slot("at_time")))
    )
    inside = "at_source = outage_source and at.level = w.level and at.slot = w.slot and at_time >= outage_start and at_time < outage_end"
    hits = (
        at.alias("at").join(slotted.alias("w"), F.expr(inside))
        .groupBy("at_source", "at_time")
        .agg(F.array_sort(F.collect_set(F.struct("outage_start", "outage_message"))).alias("hits"))
        .selectExpr("*", "nullif(array_join(array_distinct(transform(hits, x -> x.outage_message)), '; '), '') as outage_message")
        .drop("hits")
    )
    return (
        runs.join(hits, F.expr("source_system = at_source and run_timestamp = at_time"), "left")
        .withColumn("in_outage", F.expr("at_source is not null"))
        .drop("at_source", "at_time")
    )


def _slot(time: str) -> str:
    return _SLOT.format(_SECONDS.format(time), SLOT_SECONDS)


def source_freshness(
    runs: DataFrame, now: datetime, warn_hours: int, error_hours: int, sources: tuple[str, ...] = ()
) -> DataFrame:
    """Age of the newest run of each source at `now`, and its verdict; a declared source without runs is an error."""
    newest = runs.groupBy("source_system").agg(F.expr("max(run_timestamp) as newest_run"))
    if sources:
        declared = runs.sparkSession.sql(f"SELECT * FROM VALUES {', '.join(f'({literal(s)})' for s in sources)} AS t(source_system)")
        newest = newest.join(declared, "source_system", "full")
    return (
        newest.selectExpr("*", f"timestampdiff(SECOND, newest_run, {instant(now)}) as age_seconds")
        .selectExpr(
            "*",
            f"""case when age_seconds is null or age_seconds > {error_hours * 3600} then 'error' when age_seconds > {warn_hours * 3600} then 'warn'
                     else 'pass' end as status""",
        )
    )


# ---------------------------------------------------------------- reporting --
def overdue_in_transit(jobs: DataFrame, params: Params) -> DataFrame:
    """Undelivered jobs past their promised day, counted per status."""
    as_of = day(params.as_of)
    return (
        jobs.where(f"actual_delivery_date is null and committed_delivery_date < {as_of}")
        .groupBy("shipment_status")
        .agg(F.expr("count(*) as overdue_jobs"), F.expr(f"max(datediff({as_of}, committed_delivery_date)) as worst_days"))
    )


def ar_summary(settlement: DataFrame) -> DataFrame:
    """Open and settled receivables per customer and ageing shelf."""
    return settlement.groupBy("customer_key", "aging_bucket").agg(
        F.expr("count(*) as invoices"),
        *[F.expr(f"cast(sum({c}) as decimal(24,2)) as {c}") for c in ("invoice_total_inr", "outstanding_inr")],
    )


def dim_date(jobs: DataFrame, column: str = "booking_date") -> DataFrame:
    """One row per calendar day between the first and last date seen."""
    return (
        jobs.agg(F.expr(f"min({column}) as lo"), F.expr(f"max({column}) as hi"))
        .selectExpr("explode(sequence(lo, hi)) as date_day")
        .selectExpr(
            "date_day", "year(date_day) as year", "quarter(date_day) as quarter", "month(date_day) as month",
            "dayofmonth(date_day) as day_of_month", "weekday(date_day) + 1 as iso_weekday", "weekofyear(date_day) as iso_week",
            "weekday(date_day) >= 5 as is_weekend",
        )
    )
