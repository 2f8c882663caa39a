"""What a run leaves on disk, and in which order it is written."""

import threading
import time
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from quayside import session
from quayside.operators import mart, rules
from quayside.params import DRIVER
from quayside.plans import build
from quayside.sources.tables import TableFeeds
from tests.conftest import SF_DIR
from tests.fixtures import PARAMS, feeds


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffle_files(spark) -> set[str]:
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {str(f) for top in manager.localDirsString() for f in Path(top).rglob("shuffle_*")}


def test_shuffle_files_go_with_the_write_they_served(spark, tmp_path, monkeypatch):
    left, before = {}, shuffle_files(spark)
    write = build.write_fact

    def written(df, name, root):
        write(df, name, root)
        until = time.time() + 20  # they are deleted in the background
        while time.time() < until and (found := shuffle_files(spark) - before):
            time.sleep(0.1)
        left[name] = found

    monkeypatch.setattr(build, "write_fact", written)
    build.write_run(feeds(spark), PARAMS, str(tmp_path / "run"))
    assert left == {name: set() for name in mart.FACTS}
    assert shuffle_files(spark) <= before


def test_the_setting_is_put_back(spark):
    was = spark.conf.get(session.CLEAN_SHUFFLES)
    with pytest.raises(KeyError), session.removing_shuffles(spark):
        assert spark.conf.get(session.CLEAN_SHUFFLES) == "true"
        raise KeyError
    assert spark.conf.get(session.CLEAN_SHUFFLES) == was


def test_tables_that_grow_are_written_one_after_the_other(spark, tmp_path, monkeypatch):
    lock, running, most, names = threading.Lock(), [0], [0], []
    writers = {"write_fact": build.write_fact, "_write": build._write}

    def watched(kind):
        def write(df, *to):
            if kind == "_write" and "/reference/" in to[0]:
                return writers[kind](df, *to)
            with lock:
                running[0] += 1
                most[0] = max(most[0], running[0])
                names.append(to[0])
            time.sleep(0.2)
            writers[kind](df, *to)
            running[0] -= 1

        return write

    for kind in writers:
        monkeypatch.setattr(build, kind, watched(kind))
    run = build.write_run(feeds(spark), PARAMS, str(tmp_path / "run"))
    assert most == [1] and len(names) == len(set(names))
    assert all(run[name].count() == df.count() for name, df in build.all_relations(feeds(spark), PARAMS).items())


def test_profit_is_written_once_and_published_from_there(spark, tmp_path):
    source, params = TableFeeds(spark, SF_DIR), DRIVER
    run = build.Run(source, params, str(tmp_path / "run"))
    found = run["fact_shipment_financials"]
    assert sorted(p.name for p in (tmp_path / "run").glob("*/*financials")) == ["fact_shipment_financials", "int_shipment_financials"]
    assert sorted(map(str, found.collect())) == sorted(map(str, mart.fact_shipment_financials(source).collect()))


def test_a_date_of_a_fact_is_in_the_order_of_the_key_and_stored_as_differences(spark, tmp_path):
    rows = spark.range(0, 20_000, 1, 4).selectExpr("(id * 7919) % 20000 as charge_key", "date_add(date'2024-01-01', cast(id % 3 as int)) as charge_date")
    build.write_fact(rows, "fact_charges", str(tmp_path))
    files = sorted((tmp_path / "mart/fact_charges").glob("*.parquet"))
    for f in files:
        held = [(r["charge_date"], r["charge_key"]) for r in pq.read_table(f).to_pylist()]
        assert held == sorted(held)
    assert any("DELTA_BINARY_PACKED" in pq.ParquetFile(f).metadata.row_group(0).column(0).encodings for f in files)
    read = spark.read.parquet(f"{tmp_path}/mart/fact_charges")
    assert read.exceptAll(rows).count() == rows.exceptAll(read).count() == 0


@pytest.mark.parametrize("most", [10_000, 3])
def test_charge_types_are_looked_up_without_a_shuffle_of_the_lines(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(build, "HELD", {"dim_charge_type": most})
    spark.sql("select id as p_partkey, concat('Brand#', if(id = 5, 'x', cast(id % 25 + 1 as string))) as p_brand from range(50000)").write.parquet(f"{tmp_path}/part.parquet")
    for table in ("orders", "lineitem"):
        spark.read.parquet(f"{SF_DIR}/{table}.parquet").write.parquet(f"{tmp_path}/{table}.parquet")
    source = TableFeeds(spark, str(tmp_path))
    kept = build.KeptFeeds(source, str(tmp_path / "run"))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10k")
    try:
        text = plan(rules.classified_costs(kept))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert ("BroadcastHashJoin" in text and "SortMergeJoin" not in text) == (most == 10_000)
    assert kept.dim_charge_type.schema == source.dim_charge_type.schema
    assert sorted(map(tuple, kept.dim_charge_type.collect())) == sorted(map(tuple, source.dim_charge_type.collect()))
