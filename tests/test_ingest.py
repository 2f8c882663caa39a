import collections
import time
from datetime import date, datetime, timedelta
from decimal import Decimal

from quayside.operators import ingest, mart
from quayside.params import DRIVER, Outage
from quayside.plans import catalogue
from quayside.sources.tables import TableFeeds
from quayside.streaming import landing
from tests.conftest import SF_DIR
from tests.fixtures import feeds

T0 = datetime(2025, 1, 1)


def exports(spark):
    rows = [
        ("J1", "b2", T0 + timedelta(hours=2), date(2025, 2, 9), "In Transit"),
        ("J1", "b1", T0, date(2025, 2, 1), "Booked"),
        ("J1", "b3", T0 + timedelta(hours=3), date(2025, 2, 20), "Delivered"),
        ("J2", "b1", T0, date(2025, 3, 1), "Booked"),
    ]
    return spark.createDataFrame(
        rows, "job_number string, batch_id string, loaded_at timestamp_ntz, committed_delivery_date date, shipment_status string"
    )


def test_later_amendments_never_restate_the_promise(spark):
    rows = {r["job_number"]: r for r in ingest.first_seen_commit(exports(spark)).collect()}
    assert rows["J1"]["committed_delivery_date"] == date(2025, 2, 1)
    assert rows["J1"]["export_count"] == 3


def test_latest_snapshot_takes_the_whole_newest_row(spark):
    rows = {r["job_number"]: r for r in ingest.latest_snapshot(exports(spark)).collect()}
    assert (rows["J1"]["batch_id"], rows["J1"]["shipment_status"]) == ("b3", "Delivered")
    assert rows["J2"]["committed_delivery_date"] == date(2025, 3, 1)


def test_quarantine_keeps_every_row_on_one_side(spark):
    raw = spark.createDataFrame(
        [(1, "b", "1.50", "2025-01-01"), (2, "b", "x", "2025-01-01"), (3, "b", None, "2025-01-01"), (4, "b", "2", "2025-02-30"), (5, "c", "3", None)],
        "receipt_key long, batch_id string, amount_text string, date_text string",
    )
    split = ingest.quarantine_split(raw)
    assert [(r["receipt_key"], r["amount_inr"]) for r in split.valid.collect()] == [(1, Decimal("1.50"))]
    assert {r["receipt_key"]: r["reject_reason"] for r in split.rejected.collect()} == {
        2: "unreadable amount", 3: "missing amount", 4: "unreadable date", 5: "missing date",
    }
    counts = {r["batch_id"]: (r["records_processed"], r["records_rejected"]) for r in ingest.quarantine_counts(raw).collect()}
    assert counts == {"b": (1, 3), "c": (0, 1)}


def test_overlapping_outages_tag_a_run_once(spark):
    runs = mart.fact_pipeline_runs(feeds(spark))
    windows = (
        Outage("Ops", datetime(2025, 1, 15, 9), datetime(2025, 1, 15, 10), "first"),
        Outage("Ops", datetime(2025, 1, 15, 9, 30), datetime(2025, 1, 15, 11), "second"),
        Outage("Fin", datetime(2025, 1, 15, 6), datetime(2025, 1, 15, 7), "ends as the run starts"),
    )
    tagged = {r["run_key"]: r["in_outage"] for r in ingest.outage_tagging(runs, windows).collect()}
    assert tagged == {0: False, 1: True, 2: False}
    assert not any(r["in_outage"] for r in ingest.outage_tagging(runs, ()).collect())


def test_every_message_of_overlapping_outages_is_kept(spark):
    runs = mart.fact_pipeline_runs(feeds(spark)).select("run_key", "run_timestamp", "source_system")
    lost = runs.selectExpr("-1L as run_key", "cast(null as timestamp_ntz) as run_timestamp", "source_system").limit(1)
    runs = runs.unionByName(runs).unionByName(lost)  # runs at one instant, and one without a time
    day = datetime(2025, 1, 15)
    windows = (
        Outage("Ops", day + timedelta(hours=9), day + timedelta(hours=10), "short"),
        Outage("Ops", datetime(1999, 1, 1), datetime(2031, 1, 1), "for ever"),
        Outage("Ops", day, day + timedelta(hours=11), "short"),
        Outage("Ops", day + timedelta(hours=9), day + timedelta(hours=11), None),
        Outage("Ops", day + timedelta(hours=12), day, "runs backwards"),
    )
    table = spark.createDataFrame(
        [(o.source, o.start, o.end, o.message) for o in windows], "outage_source string, outage_start timestamp_ntz, outage_end timestamp_ntz, outage_message string"
    )
    found = [(r["run_key"], r["in_outage"], r["outage_message"]) for r in ingest.outage_tagging(runs, table).collect()]
    tags = {r["run_key"]: (r["in_outage"], r["outage_message"]) for r in ingest.outage_tagging(runs, table).collect()}
    assert len(found) == runs.count() and tags[-1] == (False, None)
    for r in runs.where("run_key >= 0").collect():
        hits = sorted((w.start, w.message) for w in windows if w.message and w.source == r["source_system"] and w.start <= r["run_timestamp"] < w.end)
        assert tags[r["run_key"]] == (bool(hits), "; ".join(dict.fromkeys(m for _, m in hits)) or None)
    assert any(t == (True, "for ever; short") for t in tags.values())


def test_a_hundred_thousand_outage_windows_meet_runs_by_equality(spark):
    windows = spark.range(100_000).selectExpr(
        "concat('s', cast(id % 3 as string)) as outage_source",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(pmod(xxhash64(id), 500000) as int)) as outage_start",
        "outage_start + make_dt_interval(0, 0, 0, cast(1 + pmod(xxhash64(id, 1), if(id % 100 = 0, 300000, 90)) as int)) as outage_end",
        "cast(id as string) as outage_message",
    )
    runs = spark.range(2000).selectExpr(
        "id as run_key", "concat('s', cast(id % 4 as string)) as source_system",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id * 251 as int)) as run_timestamp",
    )
    tagged = ingest.outage_tagging(runs, windows)
    text = tagged._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Cartesian" not in text
    by_source = collections.defaultdict(list)
    for w in windows.collect():
        by_source[w["outage_source"]].append(w)
    got = {r["run_key"]: r["outage_message"] for r in tagged.collect()}
    assert len(got) == 2000
    for r in runs.where("run_key % 40 < 3").collect():
        hits = sorted((w["outage_start"], w["outage_message"]) for w in by_source[r["source_system"]] if w["outage_start"] <= r["run_timestamp"] < w["outage_end"])
        assert got[r["run_key"]] == ("; ".join(m for _, m in hits) or None)


ARRIVALS = "batch_id string, source_system string, delivered_at timestamp_ntz, row_count long"


def test_stream_skips_repeated_batches_like_the_batch_form(spark, tmp_path):
    files = [
        [("b1", "Ops", T0, 5), ("b2", "Ops", T0 + timedelta(hours=1), 6)],
        [("b1", "Ops", T0 + timedelta(hours=2), 50), ("b3", "Fin", T0 + timedelta(hours=2), 7)],
        [("b2", "Ops", T0 + timedelta(hours=3), 60), ("b4", "Fin", T0 + timedelta(hours=3), 8)],
    ]
    for rows in files:
        spark.createDataFrame(rows, ARRIVALS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = landing.file_stream(spark, f"{tmp_path}/in", ARRIVALS, files_per_batch=1)
    landing.land(landing.skip_repeated_batches(stream), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    landed = {r["batch_id"] for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    batch = ingest.skip_repeated_batches(spark.read.schema(ARRIVALS).parquet(f"{tmp_path}/in"))
    assert sorted(r["batch_id"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["b1", "b2", "b3", "b4"]
    assert landed == {r["batch_id"] for r in batch.collect()}
    first = {r["batch_id"]: (r["row_count"], r["deliveries"]) for r in batch.collect()}
    assert first == {"b1": (5, 2), "b2": (6, 2), "b3": (7, 1), "b4": (8, 1)}


RUNS = "run_timestamp timestamp_ntz, source_system string, records_processed long, records_rejected long"


def test_stream_run_log_resumes_and_drops_late_rows(spark, tmp_path):
    def land(rows):
        spark.createDataFrame(rows, RUNS).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = landing.hourly_run_log(landing.file_stream(spark, f"{tmp_path}/in", RUNS))
        landing.land(stream, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
        out = spark.read.parquet(f"{tmp_path}/out").collect()
        return {(r["hour"], r["source_system"]): (r["runs"], r["records_processed"], r["records_rejected"]) for r in out}

    at = lambda h, m=0: T0 + timedelta(hours=h, minutes=m)
    first = land([(at(0, 5), "Ops", 3, 1), (at(0, 50), "Ops", 4, 0), (at(4), "Ops", 9, 0)])
    assert first == {(at(0), "Ops"): (2, 7, 1)}
    # the open hour is closed by newer rows; a row behind the watermark changes nothing
    second = land([(at(0, 30), "Ops", 100, 100), (at(9), "Ops", 1, 0)])
    assert second == {(at(0), "Ops"): (2, 7, 1), (at(4), "Ops"): (1, 9, 0)}
    batch = ingest.hourly_run_log(spark.read.schema(RUNS).parquet(f"{tmp_path}/in").where("records_processed < 100"))
    closed = {(r["hour"], r["source_system"]): (r["runs"], r["records_processed"], r["records_rejected"]) for r in batch.collect()}
    assert {k: v for k, v in closed.items() if k[0] < at(9)} == second


def test_stream_hourly_counts_do_not_depend_on_the_order_of_arrival(spark, tmp_path, monkeypatch):
    """Files that are read one by one, newest first, lose no row of any hour; hours near the end are open."""
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    rows = sorted(events.collect(), key=lambda r: r["ts"], reverse=True)
    size = -(-len(rows) // 4)
    for k in range(4):
        part = spark.createDataFrame(rows[k * size : (k + 1) * size], events.schema).coalesce(1)
        part.write.mode("append").parquet(f"{tmp_path}/events.parquet")
        time.sleep(0.05)  # the stream takes files by their time
    want, fingerprints = collections.Counter(), collections.Counter()
    for r in rows:
        hour = r["ts"].replace(minute=0, second=0, microsecond=0)
        source = "Operations" if r["event_type"] in ("click", "view") else "Finance"
        want[(hour, source, hour + timedelta(hours=3) > rows[0]["ts"])] += 1
        fingerprints[f"{'ops' if source == 'Operations' else 'fin'}-{hour:%Y%m%d-%H}"] += 1
    stream = landing.file_stream
    monkeypatch.setattr(landing, "file_stream", lambda *args: stream(*args, files_per_batch=1))
    found = catalogue.stream_hourly_counts(TableFeeds(spark, str(tmp_path), DRIVER), DRIVER).collect()
    assert {(r["hour"], r["source_system"], r["is_open"]): r["runs"] for r in found} == dict(want)
    assert sum(r["runs"] for r in found) == len(rows)
    batches = catalogue.stream_batch_dedup(TableFeeds(spark, str(tmp_path), DRIVER), DRIVER).collect()
    assert {r["batch_id"]: r["deliveries"] for r in batches} == dict(fingerprints) and len(batches) == len(fingerprints)
