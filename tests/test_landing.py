"""Landing that survives restarts: every row once, whatever came late, twice or halfway."""

import time
from datetime import datetime, timedelta

import pytest

from quayside.streaming import landing, store

T0 = datetime(2025, 1, 15, 6)
FILES = [[(T0 + timedelta(minutes=m), source, 1, 0) for m in range(start, start + 240, 10) for source in ("Ops", "Fin")] for start in (720, 480, 240, 0)]


def deliver(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    time.sleep(0.05)  # files are taken by their time


def stream(spark, folder, schema):
    return landing.file_stream(spark, folder, schema, files_per_batch=1)


def by_hour(rows):
    out = {}
    for t, source, done, rejected in rows:
        key = (t.replace(minute=0), source)
        n = out.get(key, (0, 0, 0))
        out[key] = (n[0] + 1, n[1] + done, n[2] + rejected)
    return out


def hours(spark, root):
    return {(r["hour"], r["source_system"]): (r["runs"], r["records_processed"], r["records_rejected"]) for r in landing.hourly_log(spark, root).collect()}


def test_runs_land_once_over_two_calls_and_a_crash(spark, tmp_path, monkeypatch):
    source, root = f"{tmp_path}/in", f"{tmp_path}/out"
    for rows in FILES[:2]:
        deliver(spark, source, rows, landing.RUN)
    landing.ingest_runs(stream(spark, source, landing.RUN), root).awaitTermination()
    assert hours(spark, root) == by_hour(FILES[0] + FILES[1])
    for rows in FILES[2:]:
        deliver(spark, source, rows, landing.RUN)

    # the third batch writes its runs and dies before its hours
    write = store.BatchTables.write

    def dies(self, name, df, batch):
        if (name, batch) == ("hours", 2):
            raise RuntimeError("the driver is lost")
        return write(self, name, df, batch)

    monkeypatch.setattr(store.BatchTables, "write", dies)
    with pytest.raises(Exception, match="lost"):
        landing.ingest_runs(stream(spark, source, landing.RUN), root).awaitTermination()
    # readers see nothing of it
    assert landing.run_tables(spark, root).read("runs").count() == len(FILES[0] + FILES[1])
    assert hours(spark, root) == by_hour(FILES[0] + FILES[1])

    monkeypatch.undo()
    landing.ingest_runs(stream(spark, source, landing.RUN), root).awaitTermination()
    every = [r for rows in FILES for r in rows]
    assert hours(spark, root) == by_hour(every)
    assert landing.run_tables(spark, root).read("runs").count() == len(every)
    # nothing new: nothing changes
    landing.ingest_runs(stream(spark, source, landing.RUN), root).awaitTermination()
    assert hours(spark, root) == by_hour(every)


def test_a_committed_batch_is_not_landed_again(spark, tmp_path):
    """The ledger is written, but the stream dies before it notes the batch: the replay changes nothing."""
    root = f"{tmp_path}/out"
    tables = store.BatchTables(spark, root, {"rows": "n long"}, "rows long")
    put = []

    def once(df, batch):
        put.append(batch)
        return tables.write("rows", df, batch).selectExpr("count(*) as rows")

    for k in range(2):
        deliver(spark, f"{tmp_path}/in", [(k,)], "n long")
    tables.land(stream(spark, f"{tmp_path}/in", "n long"), once).awaitTermination()
    assert put == [0, 1]
    (tmp_path / "out/checkpoint/commits/1").unlink()
    for crc in (tmp_path / "out/checkpoint/commits").glob(".1.crc"):
        crc.unlink()
    tables.land(stream(spark, f"{tmp_path}/in", "n long"), once).awaitTermination()
    assert put == [0, 1]
    assert sorted(r["n"] for r in tables.read("rows").collect()) == [0, 1]


def test_late_rows_are_landed_and_counted(spark, tmp_path):
    source, root = f"{tmp_path}/in", f"{tmp_path}/out"
    for rows in FILES:
        deliver(spark, source, rows, landing.RUN)
    deliver(spark, source, [(None, "Ops", 4, 4)], landing.RUN)
    landing.ingest_runs(stream(spark, source, landing.RUN), root).awaitTermination()
    newest = max(t for t, *_ in FILES[0])
    late = [sum(t.replace(minute=0) + timedelta(hours=3) <= newest for t, *_ in rows) for rows in FILES]
    late[0] = 0  # nothing was there before
    ledger = {r["batch"]: (r["rows"], r["late_rows"]) for r in landing.run_tables(spark, root).ledger().collect()}
    assert ledger == {**{k: (48, n) for k, n in enumerate(late)}, 4: (1, 0)}
    log = landing.hourly_log(spark, root).collect()
    assert sum(r["late_runs"] for r in log) == sum(late) > 0
    assert sum(r["runs"] for r in log) == 4 * 48 + 1
    open_hours = {r["hour"] for r in log if r["is_open"]}
    assert open_hours == {h for h, _ in by_hour(FILES[0]) if h + timedelta(hours=3) > newest}
    assert [(r["runs"], r["is_open"]) for r in log if r["hour"] is None] == [(1, None)]


ARRIVALS = "batch_id string, delivered_at timestamp_ntz, row_count long"


@pytest.mark.parametrize("newest_first", [False, True])
def test_batches_land_once_in_any_order(spark, tmp_path, newest_first):
    source, root = f"{tmp_path}/in", f"{tmp_path}/out"
    files = [
        [("b1", T0, 5), ("b2", T0, 6), ("b1", T0 - timedelta(days=1), 4)],
        [("b1", T0 + timedelta(days=9), 50), ("b3", T0 + timedelta(days=30), 7), (None, T0, 1)],
        [("b2", T0 + timedelta(days=60), 60), ("b4", T0, 8), (None, T0, 2)],
    ]
    for rows in files[:: -1 if newest_first else 1]:
        deliver(spark, source, rows, ARRIVALS)
        landing.land_once(stream(spark, source, ARRIVALS), root).awaitTermination()
    landed = landing.landed_batches(spark, root, ARRIVALS).collect()
    assert {r["batch_id"]: r["deliveries"] for r in landed} == {"b1": 3, "b2": 2, "b3": 1, "b4": 1, None: 2}
    assert len(landed) == 5
    first = {r["batch_id"]: r["row_count"] for r in landed}
    assert first == ({"b1": 50, "b2": 60, "b3": 7, "b4": 8, None: 2} if newest_first else {"b1": 4, "b2": 6, "b3": 7, "b4": 8, None: 1})
    ledger = landing.delivery_tables(spark, root, ARRIVALS).ledger().agg({"rows": "sum", "repeats": "sum"}).first()
    assert sorted(ledger) == [4, 9]


def test_nothing_to_land(spark, tmp_path):
    (tmp_path / "in").mkdir()
    landing.ingest_runs(stream(spark, f"{tmp_path}/in", landing.RUN), f"{tmp_path}/out").awaitTermination()
    assert landing.hourly_log(spark, f"{tmp_path}/out").count() == 0
