from quayside import app
from quayside.sources.schemas import DIMS, FEEDS
from tests.fixtures import feeds


def test_steps(spark, tmp_path, capsys):
    source = feeds(spark)
    for name in FEEDS:
        getattr(source, name).write.parquet(f"{tmp_path}/raw/{name}")
    for name in DIMS:
        getattr(source, name).write.parquet(f"{tmp_path}/dims/{name}")
    common = ["--feeds", f"{tmp_path}/raw", "--dims", f"{tmp_path}/dims", "--root", f"{tmp_path}/out", "--format", "parquet"]
    # one stale source, and three declared ones without a run
    assert app.main(["freshness", *common, "--now", "2025-01-15 11:30:00"]) == 4
    assert app.main(["run", *common]) == 0
    # six planted defects, and two source names outside the accepted list
    assert app.main(["test", *common]) == 7
    assert app.main(["outcomes", *common]) > 0
    assert "A1 total shipments" in capsys.readouterr().out
    assert app.main(["release", *common, "--now", "2025-01-15 11:00:00"]) == 1
