from dataclasses import replace
from datetime import datetime

import pytest

from quayside.plans import build
from quayside.sources.frames import csv_feeds
from quayside.sources.schemas import DIMS, FEED_FILES, FEEDS
from tests.fixtures import JOBS, PARAMS, feeds

KNOWN = frozenset(
    {
        "not_null(stg_shipments.customer_code)",
        "not_null(stg_shipments.carrier_code)",
        "not_null(stg_job_charges.job_number)",
        "relationships(stg_job_charges.job_number->stg_shipments.job_number)",
        "accepted_values(stg_invoice_lines.invoice_type)",
        "relationships(stg_payments.invoice_number->stg_invoice_lines.invoice_number)",
    }
)


def test_release_gate(spark, tmp_path):
    root, source = str(tmp_path), feeds(spark)
    fresh = replace(PARAMS, now=datetime(2025, 1, 15, 11, 30))
    stale = build.release(source, PARAMS, root, "r0")
    assert (stale.published, stale.stale_sources) == (False, ["Fin"])
    blocked = build.release(source, replace(fresh, now=datetime(2025, 1, 15, 11)), root, "r1")
    assert not blocked.published and set(blocked.failed_checks) == KNOWN
    late = replace(fresh, now=datetime(2025, 1, 15, 11))
    done = build.release(source, late, root, "r2", tolerate=KNOWN)
    assert done.published and done.root.endswith("r2")
    published = build.current_mart(spark, root)
    assert published["fact_shipments"].count() == len(JOBS)
    # a blocked later run leaves the released one in place
    build.release(source, late, root, "r3")
    assert build.released(spark, root)["run_id"] == "r2"
    # a run id used before is refused, and what it published stays
    with pytest.raises(Exception, match="(?i)exist"):
        build.release(source, late, root, "r2")
    assert build.current_mart(spark, root)["fact_shipments"].count() == len(JOBS)


def test_a_declared_source_without_runs_blocks_the_release(spark, tmp_path):
    declared = replace(PARAMS, now=datetime(2025, 1, 15, 11), source_systems=(*PARAMS.source_systems, "Customs"))
    held = build.release(feeds(spark), declared, str(tmp_path), "r1", tolerate=KNOWN)
    assert (held.published, held.stale_sources) == (False, ["Customs"])
    assert not (tmp_path / "runs").exists()


def test_released_layers_can_be_queried_by_name(spark, tmp_path):
    late = replace(PARAMS, now=datetime(2025, 1, 15, 11))
    for run_id in ("r1", "r2"):
        done = build.release(feeds(spark), late, str(tmp_path), run_id, tolerate=KNOWN)
        build.publish_names(spark, done.root, "test_")
    names = {"reference": "dim_customer", "staging": "stg_job_charges", "intermediate": "int_invoices_matched", "mart": "fact_shipments"}
    for layer, name in names.items():
        assert spark.table(f"test_{layer}.{name}").count() > 0
        assert "/r2/" in spark.table(f"test_{layer}.{name}").inputFiles()[0]
    # staging tables say when they were read
    assert spark.sql("select count(*) from test_staging.stg_payments where _loaded_at is null").first()[0] == 0
    for layer in sorted(set(build.LAYERS.values())):
        spark.sql(f"drop database test_{layer} cascade")
    assert build.read_run(spark, done.root)["fact_shipments"].count() == len(JOBS)  # the names go, the tables stay


def test_unreadable_rows_are_written_beside_the_layers(spark, tmp_path):
    source = feeds(spark)
    for name in FEEDS:
        getattr(source, name).coalesce(1).write.option("header", True).csv(f"{tmp_path}/raw/{FEED_FILES[name]}.csv")
    for name in DIMS:
        getattr(source, name).coalesce(1).write.option("header", True).csv(f"{tmp_path}/dims/{name}.csv")
    columns = source.payments.columns
    row = {"payment_key": "99", "amount_inr": "a lot", "payment_date": "2025-01-01"}
    (tmp_path / "raw/fact_payments.csv/late.csv").write_text(",".join(columns) + "\n" + ",".join(row.get(c, "") for c in columns) + "\n")
    late = replace(PARAMS, now=datetime(2025, 1, 15, 11))
    done = build.release(csv_feeds(spark, f"{tmp_path}/raw", f"{tmp_path}/dims"), late, str(tmp_path / "out"), "r1", tolerate=KNOWN)
    assert done.published and done.rejected_rows == 1
    kept = spark.read.parquet(f"{done.root}/rejected/rows").first()
    assert (kept["relation"], kept["reason"]) == ("payments", "unreadable amount_inr") and "a lot" in kept["row_text"]
    assert build.current_mart(spark, str(tmp_path / "out"))["fact_payments"].count() == source.payments.count()


def test_relations_are_queryable_by_name(spark):
    build.register_views(build.all_relations(feeds(spark), PARAMS))
    assert spark.sql("select count(*) from int_invoices_matched where is_matched").first()[0] > 0
