import pytest

from quayside.operators import mart, rules
from quayside.operators.joins import match_to_jobs
from quayside.plans import build
from quayside.sources.frames import csv_feeds, parquet_feeds
from quayside.sources.schemas import DIMS, FEED_FILES, FEEDS
from quayside.sources.tables import TableFeeds
from tests.fixtures import PARAMS, feeds


def same(a, b):
    return sorted(map(str, a.select(*sorted(a.columns)).collect())) == sorted(map(str, b.select(*sorted(b.columns)).collect()))


def test_csv_exports_give_the_same_mart(spark, tmp_path):
    source = feeds(spark)
    for name in FEEDS:
        getattr(source, name).coalesce(1).write.option("header", True).csv(f"{tmp_path}/raw/{FEED_FILES[name]}.csv")
    for name in DIMS:
        getattr(source, name).coalesce(1).write.option("header", True).csv(f"{tmp_path}/dims/{name}.csv")
    read = csv_feeds(spark, f"{tmp_path}/raw", f"{tmp_path}/dims")
    # text with surrounding spaces is trimmed by staging either way
    assert same(mart.fact_shipments(read), mart.fact_shipments(source))
    assert same(mart.fact_charges(read), mart.fact_charges(source))
    assert same(mart.fact_pipeline_runs(read), mart.fact_pipeline_runs(source))
    assert same(mart.fact_exceptions(read), mart.fact_exceptions(source))
    assert same(rules.shipment_financials(read), rules.shipment_financials(source))


def test_csv_header_must_match_the_declared_columns(spark, tmp_path):
    target = tmp_path / "dims"
    target.mkdir()
    (target / "dim_mode.csv").write_text("mode_key,wrong\n1,Ocean\n")
    try:
        csv_feeds(spark, str(tmp_path), str(target)).dim_mode.collect()
    except Exception as e:  # noqa: BLE001
        assert "header" in str(e).lower() or "schema" in str(e).lower()
    else:
        raise AssertionError("a wrong header was accepted")


DIM = "dim_mode"


def export(spark, folder, text, name=DIM):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.csv").write_text(text)
    return csv_feeds(spark, str(folder), str(folder)).export("dim", name)


def test_csv_columns_are_bound_by_their_names(spark, tmp_path):
    text = "note,unit_of_measure, mode_service,mode,service_level,mode_key,more\nx,kg,Air / A,Air,A,2,y\nx,TEU,Ocean / B,Ocean,B,1,\n"
    found = export(spark, tmp_path, text)
    assert {tuple(r) for r in found.valid.collect()} == {(2, "Air", "A", "Air / A", "kg"), (1, "Ocean", "B", "Ocean / B", "TEU")}
    assert found.valid.schema.simpleString() == "struct<mode_key:bigint,mode:string,service_level:string,mode_service:string,unit_of_measure:string>"
    assert found.rejected.count() == 0


def test_unreadable_csv_rows_are_kept_aside_and_counted(spark, tmp_path):
    good = "\n".join(f"{i},CAR-{i},n,Air,t,l,1990-01-{i + 10},true" for i in range(4))
    bad = ["x,CAR-8,n,Air,t,l,1990-01-08,true", "9,CAR-9,n,Air,t,l,1990-13-08,true", "10,CAR-10,n", "11,CAR-11,n,Air,t,l,,maybe", "12,C,n,Air,t,l,1990-01-08,true,one too many"]
    header = "carrier_key,carrier_code,carrier_name,carrier_mode,carrier_type,primary_lanes,contract_start_date,is_active"
    found = export(spark, tmp_path, "\n".join([header, good, *bad, ",,,,,,,", ""]), "dim_carrier")
    assert sorted(r["carrier_key"] for r in found.valid.collect() if r["carrier_key"] is not None) == [0, 1, 2, 3]
    assert found.valid.count() == 5  # a row of empty fields is a row of nulls
    # whatever columns are read, the same rows are in and out
    assert found.valid.select("carrier_code").count() == 5 and found.rejected.select("reason").count() == 5
    reasons = {r["row_text"].split(",")[0]: r["reason"] for r in found.rejected.collect()}
    assert reasons == {
        "x": "unreadable carrier_key", "9": "unreadable contract_start_date", "10": "wrong number of fields", "11": "unreadable is_active", "12": "wrong number of fields",
    }
    assert all(r["source_file"].endswith("dim_carrier.csv") for r in found.rejected.collect())


def test_csv_header_rules(spark, tmp_path):
    for header in ("mode_key,mode,service_level,mode_service", "mode_key,mode,service_level,mode_service,unit_of_measure,mode", ""):
        with pytest.raises(ValueError, match="header"):
            export(spark, tmp_path, header + "\n1,a,b,c,d\n")
    assert export(spark, tmp_path, "mode_key,mode,service_level,mode_service,unit_of_measure\n").valid.count() == 0


def test_files_of_one_export_share_a_header(spark, tmp_path):
    folder = tmp_path / f"{DIM}.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("mode_key,mode,service_level,mode_service,unit_of_measure\n1,a,b,c,d\n")
    (folder / "b.csv").write_text("mode,mode_key,service_level,mode_service,unit_of_measure\na,2,b,c,d\n")
    with pytest.raises(Exception, match="(?i)header"):
        csv_feeds(spark, str(tmp_path), str(tmp_path)).dim_mode.collect()


def test_landed_parquet(spark, tmp_path):
    source = feeds(spark)
    for name in FEEDS:
        getattr(source, name).write.parquet(f"{tmp_path}/raw/{name}")
    for name in DIMS:
        getattr(source, name).write.parquet(f"{tmp_path}/dims/{name}")
    read = parquet_feeds(spark, f"{tmp_path}/raw", f"{tmp_path}/dims")
    for fact in mart.FACTS:
        assert same(mart.FACTS[fact](read, PARAMS), mart.FACTS[fact](source, PARAMS)), fact


def test_a_run_numbers_the_lines_once(spark, tmp_path):
    keys = ", ".join(f"({k}, {line})" for k in (1, 2, 3) for line in (1, 2, 2))
    spark.sql(f"""select cast(k as bigint) as l_orderkey, line as l_linenumber, 1L as l_partkey, 2L as l_suppkey, 100.0D + line as l_extendedprice,
        1.0D as l_quantity, 0.0D as l_discount, 0.0D as l_tax, timestamp_ntz'2024-01-05 00:00:00' as l_shipdate, 'N' as l_returnflag, 'O' as l_linestatus
        from values {keys} as t(k, line)""").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.sql("select id as o_orderkey, id + 1 as o_custkey, timestamp_ntz'2024-01-01 00:00:00' as o_orderdate from range(1, 4)").write.parquet(
        f"{tmp_path}/orders.parquet"
    )
    source = TableFeeds(spark, str(tmp_path))
    kept = build.KeptFeeds(source, f"{tmp_path}/run")
    for name in ("job_charges", "invoice_lines", "payments"):
        plan = getattr(kept, name)._jdf.queryExecution().optimizedPlan().toString()
        assert "l_orderkey" not in plan and "Window" not in plan, name
        assert same(getattr(kept, name), getattr(source, name))
    assert spark.read.parquet(f"{tmp_path}/run/work/charge_base").count() == 9


def test_a_matched_row_keeps_its_reference_and_ships_it_once(spark):
    rows = spark.sql("select * from values (1L, 'A', 5), (2L, null, 6), (3L, 'row:2', 7), (4L, '', 8), (5L, 'Z', 9) as t(id, job_number, amount)")
    jobs = spark.sql("select * from values ('A', 10), ('', 11), (null, 12) as t(job_number, hit)")
    matched = match_to_jobs(rows, "id", jobs)
    assert matched.columns == ["id", "job_number", "amount", "hit"]
    assert sorted(map(tuple, matched.collect())) == [(1, "A", 5, 10), (2, None, 6, None), (3, "row:2", 7, None), (4, "", 8, 11), (5, "Z", 9, None)]
    joined = [x for x in matched._jdf.queryExecution().optimizedPlan().toString().splitlines() if "LocalRelation" in x]
    assert joined and not any("job_number" in x for x in joined)
