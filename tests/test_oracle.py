"""Every query against its SQL on the smallest tables."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from quayside.plans import catalogue
from tests.conftest import SF_DIR
from verification.compare import compare, connect

QUERIES = {k: v for k, v in entry.queries().items() if k in catalogue.QUERIES}
SQL = {k: v for k, v in entry.oracle_sql().items() if k in catalogue.QUERIES}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, SQL[name]) == []


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "gross_margin_inr" in df.columns


def test_every_line_becomes_a_charge(spark, con):
    (lines, cost), = con.execute(
        "select count(*), sum(cast(cast(l_extendedprice as decimal(14,2)) * cast(0.7 as decimal(2,1)) as decimal(14,2))) from lineitem"
    ).fetchall()
    charges = QUERIES["fact_charges"](spark, SF_DIR)
    found = charges.selectExpr("count(*) as n", "count(distinct charge_key) as keys", "cast(sum(amount_inr) as decimal(24,2)) as cost").first()
    assert (found["n"], found["keys"]) == (lines, lines)
    assert found["cost"] == cost


def test_charges_without_a_job_are_counted(spark, con):
    found = {r["child"]: r["orphan_rows"] for r in QUERIES["orphan_counts"](spark, SF_DIR).collect()}
    assert found == dict(con.execute(SQL["orphan_counts"]).fetchall())
    assert all(found.values())


def test_the_rest_works_where_the_corpus_queries_cannot_be_imported():
    code = "import sys; sys.modules['zstandard'] = None; import __spark_entry__ as e; print(sorted(e.queries()), sorted(e.oracle_sql()))"
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=Path(entry.__file__).parent, capture_output=True, text=True, check=True)
    assert done.stdout.strip() == f"{sorted(catalogue.QUERIES)} {sorted(catalogue.QUERIES)}"
