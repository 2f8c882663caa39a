"""Hourly append-only landing as streams over a folder of files.

`ingest_runs` and `land_once` account for every row whatever order files come in: they keep what they
landed in tables (see `store`), and count what was late or repeated. `hourly_run_log` and
`skip_repeated_batches` are the forms with bounded state: rows behind their watermark are lost to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quayside.operators import ingest
from quayside.streaming.store import BatchTables


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int | None = None, kind: str = "parquet") -> DataFrame:
    """New parquet (or CSV) files of a folder as a stream; the schema is declared, never inferred."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.option("header", True).csv(path) if kind == "csv" else reader.parquet(path)


def _watermarked(stream: DataFrame, column: str, lateness: str) -> DataFrame:
    """Watermarks need an instant: a zoneless time is taken in the session time zone."""
    return stream.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, lateness)


def skip_repeated_batches(arrivals: DataFrame, lateness: str = "2 days") -> DataFrame:
    """First delivery of each batch fingerprint; state is dropped once the watermark has passed it."""
    return _watermarked(arrivals, "delivered_at", lateness).dropDuplicatesWithinWatermark(["batch_id"])


def hourly_run_log(runs: DataFrame, lateness: str = "2 hours") -> DataFrame:
    """Runs, rows and rejects per source and closed hour; state holds only the open hours."""
    return (
        _watermarked(runs, "run_timestamp", lateness)
        .groupBy(F.window("run_timestamp", "1 hour").alias("w"), "source_system")
        .agg(
            F.expr("count(*) as runs"),
            F.expr("sum(records_processed) as records_processed"),
            F.expr("sum(records_rejected) as records_rejected"),
        )
        .selectExpr(
            "cast(w.start as timestamp_ntz) as hour", "source_system", "runs", "records_processed", "records_rejected"
        )
    )


# ------------------------------------------------------ resumable landing --
RUN = "run_timestamp timestamp_ntz, source_system string, records_processed long, records_rejected long"
HOURS = "hour timestamp_ntz, source_system string, runs long, records_processed long, records_rejected long, late_runs long"
RUN_COUNTS = ("source_system", "records_processed", "records_rejected")
LATENESS = "2 hours"


def run_tables(spark: SparkSession, root: str) -> BatchTables:
    """`runs` as landed, `hours`, the share of each batch in every hour, and per batch its rows, late rows and newest time."""
    return BatchTables(spark, root, {"runs": RUN, "hours": HOURS}, "rows long, late_rows long, newest timestamp_ntz")


def ingest_runs(runs: DataFrame, root: str, lateness: str = LATENESS) -> StreamingQuery:
    """Land every run once and add it to its hour; call again to take what came since.

    A row is late when its hour ended `lateness` or more before the newest run of the batches before
    its own. Late rows are landed and counted as any other; the ledger and `late_runs` say how many they were.
    Hours are kept as sums per batch, so counting them reads no landed row again.
    """
    tables = run_tables(runs.sparkSession, root)

    def put(rows: DataFrame, batch: int) -> DataFrame:
        landed = tables.write("runs", rows.selectExpr("cast(run_timestamp as timestamp_ntz) as run_timestamp", *RUN_COUNTS), batch)
        newest = tables.ledger().agg(F.max("newest").alias("newest"))
        known = landed.withColumn("newest", newest.scalar()).withColumn("hour", F.expr("date_trunc('hour', run_timestamp)").cast("timestamp_ntz"))
        marked = known.withColumn("late", F.expr(f"coalesce(hour + interval 1 hour + interval {lateness} <= newest, false)"))
        hours = marked.groupBy("hour", "source_system").agg(
            F.expr("count(*) as runs"),
            F.expr("sum(records_processed) as records_processed"),
            F.expr("sum(records_rejected) as records_rejected"),
            F.expr("count_if(late) as late_runs"),
        )
        summed = tables.write("hours", hours, batch)
        # an empty batch has sums of none
        return summed.selectExpr("coalesce(sum(runs), 0L) as rows", "coalesce(sum(late_runs), 0L) as late_rows").withColumn(
            "newest", landed.agg(F.max("run_timestamp").alias("newest")).scalar()
        )

    return tables.land(runs, put)


def hourly_log(spark: SparkSession, root: str, lateness: str = LATENESS) -> DataFrame:
    """Runs, rows and rejects per source and hour of all that was landed, late runs among them.

    An hour is open until the newest run is `lateness` past its end: its counts may still grow, and
    `is_open` says so. Runs without a time have an hour, and a flag, of NULL.
    """
    tables = run_tables(spark, root)
    newest = tables.ledger().agg(F.max("newest").alias("newest"))
    sums = ("runs", "records_processed", "records_rejected", "late_runs")
    return (
        tables.read("hours")
        .groupBy("hour", "source_system")
        .agg(*[F.sum(c).alias(c) for c in sums])
        .withColumn("newest", newest.scalar())
        .withColumn("is_open", F.expr(f"hour + interval 1 hour + interval {lateness} > newest"))
        .drop("newest")
    )


def delivery_tables(spark: SparkSession, root: str, arrivals: str) -> BatchTables:
    """`deliveries`, the first delivery of each fingerprint in every micro-batch and how many there were, and `batches`, those landed."""
    return BatchTables(spark, root, {"deliveries": f"{arrivals}, deliveries long", "batches": arrivals}, "rows long, repeats long")


def land_once(arrivals: DataFrame, root: str) -> StreamingQuery:
    """Land the first delivery of each `batch_id` and count the others, in whatever order and however late they come.

    Of several deliveries in one micro-batch the earliest counts as first (all columns but `batch_id`, in
    their order). Landed fingerprints are looked up by key, and are not shuffled where a micro-batch is
    small enough to be broadcast. A missing fingerprint is one like any other.
    """
    kind = arrivals.schema
    others = [c for c in arrivals.columns if c != "batch_id"]
    tables = delivery_tables(arrivals.sparkSession, root, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kind))

    def put(rows: DataFrame, batch: int) -> DataFrame:
        counted = rows.groupBy("batch_id").agg(F.count("*").alias("deliveries"), *([F.min(F.struct(*others)).alias("s")] if others else []))
        columns = {**{c: F.col(f"s.{c}") for c in others}, "batch_id": F.col("batch_id")}
        # the micro-batch is read once; all else reads what is written here
        came = tables.write("deliveries", counted.select(*[columns[c].alias(c) for c in arrivals.columns], "deliveries"), batch)
        seen = tables.read("batches").select(F.col("batch_id").alias("seen")).join(came.select("batch_id"), F.expr("seen <=> batch_id"), "left_semi")
        new = tables.write("batches", came.drop("deliveries").join(seen, F.expr("batch_id <=> seen"), "left_anti"), batch)
        landed = new.agg(F.count("*").alias("landed"))
        total = came.agg(F.expr("coalesce(sum(deliveries), 0L) as rows"))
        return total.withColumn("landed", landed.scalar()).selectExpr("rows", "rows - landed as repeats")

    return tables.land(arrivals, put)


def landed_batches(spark: SparkSession, root: str, arrivals: str) -> DataFrame:
    """Every landed batch with the number of its deliveries so far."""
    tables = delivery_tables(spark, root, arrivals)
    counts = tables.read("deliveries").select("batch_id", "deliveries").groupBy("batch_id").agg(F.sum("deliveries").alias("deliveries"))
    return tables.read("batches").drop("batch").join(counts.withColumnRenamed("batch_id", "id"), F.expr("batch_id <=> id")).drop("id")


def land(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append everything available to a parquet table and stop; the next run resumes at the checkpoint."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )
