"""Plan shape and behaviour under hot keys."""

import re

import pytest
from pyspark.sql.functions import spark_partition_id

from quayside import session
from quayside.operators import mart, rules, staging
from quayside.operators.joins import match_to_jobs
from quayside.params import DRIVER
from quayside.plans import catalogue
from quayside.sources.frames import Feeds
from quayside.sources.schemas import FEEDS
from quayside.sources.tables import TableFeeds
from tests.conftest import SF_DIR
from tests.fixtures import ROWS, frame


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def conf(spark):
    changed = {}

    def put(key, value):
        changed.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield put
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


HOT = 120_000


def hot_feeds(spark) -> Feeds:
    """Invoice lines of which a third name one job and a third name none."""
    lines = spark.range(HOT).selectExpr(
        "id as invoice_line_key", "concat('INV-', id div 3) as invoice_number", "'Original' as invoice_type",
        "date_add(date'2024-05-01', cast(id % 20 as int)) as invoice_date", "date'2024-06-01' as due_date", "1L as customer_key",
        "case id % 3 when 0 then 'JOB-1' when 1 then null else concat('JOB-', id) end as job_number", "1L as branch_key",
        "1L as charge_type_key", "sha2(cast(id as string), 256) as line_description", "10.0BD as line_amount_inr", "0.0BD as tax_amount_inr",
        "10.0BD as total_amount_inr",
    )
    empty = spark.createDataFrame([], FEEDS["shipments"])
    jobs = spark.range(HOT).selectExpr(
        *[
            {"shipment_key": "id as shipment_key", "job_number": "concat('JOB-', id) as job_number",
             "job_completion_date": "date'2024-04-30' as job_completion_date"}.get(
                f.name, f"cast(null as {f.dataType.simpleString()}) as {f.name}")
            for f in empty.schema
        ]
    )
    made = {"invoice_lines": lines, "shipments": jobs}
    return Feeds(spark, lambda kind, name: made[name] if name in made else frame(spark, name, ROWS[name]))


def test_hot_job_is_split_and_missing_references_are_spread(spark, conf):
    session.tune(spark)
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "128k")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "1.5")
    conf("spark.sql.shuffle.partitions", "16")
    source = hot_feeds(spark)
    matched = rules.invoices_matched(source)
    rows = matched.collect()
    assert "skew=true" in plan(matched)
    assert len(rows) == HOT
    assert sum(r["job_number"] is None for r in rows) == HOT // 3
    firsts = [r for r in rows if r["is_first_original_invoice"] and r["job_number"] == "JOB-1"]
    expected = min((r["invoice_date"], r["invoice_number"]) for r in rows if r["job_number"] == "JOB-1")
    assert {(r["invoice_date"], r["invoice_number"]) for r in firsts} == {expected}


def test_missing_references_are_spread_and_never_match(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.enabled", "false")
    rows = spark.range(4000).selectExpr("id", "cast(null as string) as job_number")
    jobs = spark.createDataFrame([("row:1", 1), (None, 2)], "job_number string, hit int")
    matched = match_to_jobs(rows, "id", jobs)
    assert matched.where("hit is not null").count() == 0
    assert matched.groupBy(spark_partition_id()).count().count() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_unused_lookups_leave_the_plan(spark):
    source = TableFeeds(spark, SF_DIR)
    narrow = plan(rules.jobs_core(source).select("job_number", "job_completion_date"))
    assert "Join" not in narrow and "Exchange" not in narrow
    assert "o_custkey" not in narrow
    facts = plan(mart.fact_shipments(source))
    assert "c_custkey" not in facts and "s_suppkey" not in facts
    assert "r_regionkey" not in plan(staging.stg_shipments(source))


def test_profit_aggregates_before_it_joins(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    source = TableFeeds(spark, SF_DIR)
    text = plan(rules.shipment_financials(source))
    assert set(re.findall(r"Window \[(\w+)", text)) <= {"row_number"}  # the numbering of a job's lines, inside the feed
    assert "BroadcastNestedLoop" not in text and "Cartesian" not in text
    assert text.count("partial_sum") >= 2


def test_settlement_reads_the_lines_once_and_joins_without_a_shuffle_of_its_own(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    source = TableFeeds(spark, SF_DIR)
    lines = plan(rules.netted_invoices(staging.stg_invoice_lines(source)))
    assert lines.count("Join") == 1  # lineitem with orders, inside the feed
    settled = plan(rules.invoice_settlement(source, DRIVER))
    assert len(re.findall(r"hashpartitioning\(invoice_number", settled)) == 2


def test_lines_are_numbered_and_joined_in_one_shuffle(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    text = plan(TableFeeds(spark, SF_DIR).charge_base)
    assert text.count("Exchange hashpartitioning") == 2  # the lines once, the jobs once
    assert len(re.findall(r"l_(?:orderkey|suppkey|extendedprice)#\d+L? AS ", text.split("Window")[1])) == 1  # only the key is renamed below


def test_cohorts_start_no_job_and_give_no_hint(spark):
    from quayside.operators.kpi import members

    dim = spark.range(20_000).selectExpr("id as customer_key", "cast(id as string) as code")
    found = members(dim, "customer_key", "code", tuple(str(i) for i in range(20)))
    assert "ResolvedHint" not in found._jdf.queryExecution().analyzed().toString()
    assert found.count() == 20


def test_no_query_plans_a_cross_join_or_python_rows(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "1k")
    for name in (
        "shipments_conformed", "charges_classified", "invoices_matched", "invoice_settlement", "shipment_financials",
        "trade_lane", "outcome_report", "fk_audit", "outage_tagging", "latest_snapshot", "batch_dedup", "dim_date",
    ):
        text = plan(catalogue.run(name, spark, SF_DIR))
        for banned in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "PythonMapInArrow"):
            assert banned not in text, (name, banned)
        # the feed numbers the lines of a job; no rule works on a window
        assert set(re.findall(r"Window \[(\w+)", text)) <= {"row_number"}, name


def test_task_counts_follow_the_input():
    assert session.shuffle_width(0, 8) == 8
    assert session.shuffle_width(2**40, 8) == 4096
    assert session.shuffle_width(100 * 2**40, 8) == session.MAX_SHUFFLE_PARTITIONS
    assert session.scan_split(0) == 128 * session.MIB
    assert session.scan_split(100 * 2**40) == 1024 * session.MIB


def test_user_settings_are_left_alone(spark, conf):
    conf("spark.sql.shuffle.partitions", "5")
    session.tune(spark, 10**12)
    assert spark.conf.get("spark.sql.shuffle.partitions") == "5"
    assert spark.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_shared_folder_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = session.shared_folder(spark, "x"), session.shared_folder(spark, "x")
    assert a != b and a.startswith(root)


def test_sorts_of_a_gigabyte_are_dealt_to_many_tasks(spark, conf):
    assert session.shuffle_width(2**30, 12) == 128
    assert session.merged_size(2**30) == 16 * session.MIB and session.merged_size(2**40) == 64 * session.MIB
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    session.tune(spark, 2**30)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == str(16 * session.MIB)
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_scans_of_run_tables_are_not_taken_for_small(spark, conf, tmp_path):
    spark.range(50_000).write.option("compression", "zstd").parquet(f"{tmp_path}/t")
    size = lambda: int(str(spark.read.parquet(f"{tmp_path}/t")._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    conf("spark.sql.sources.fileCompressionFactor", "1.0")
    plain = size()
    spark.conf.unset("spark.sql.sources.fileCompressionFactor")
    session.tune(spark)
    assert size() == 2 * plain
