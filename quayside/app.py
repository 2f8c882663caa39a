"""Command line of the batch job.

    spark-submit --py-files quayside.zip quayside/app.py {ingest|freshness|run|test|outcomes|release}
        --feeds DIR --dims DIR --root DIR [--format csv|parquet] [--run-id ID]
        [--as-of 2025-01-15] [--go-live 2024-07-01] [--now "2025-01-15 23:00:00"]

`ingest` lands what is new in the run log under `<root>/landed`, each row once, and shows the newest hours.
`freshness` reports the age of each source, `run` builds all layers under `<root>/runs/<run-id>`,
`test` counts the failures of the declared checks on it, `outcomes` evaluates the assertion
suite, and `release` does freshness, run and test and publishes only a run that passes.
The exit code is the number of failures, at most 100.
"""

from __future__ import annotations

import argparse
import sys
from dataclasses import replace
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside import session
from quayside.operators import kpi
from quayside.operators.quality import suite_report
from quayside.params import CASE_STUDY, Params
from quayside.plans import build
from quayside.plans.checks import declared_checks
from quayside.sources.frames import Feeds, csv_feeds, parquet_feeds
from quayside.sources.schemas import FEED_FILES, FEEDS
from quayside.streaming import landing

#: Rows of a report that are printed.
SHOWN = 1000


def main(argv: list[str] | None = None) -> int:
    args = _arguments(argv)
    spark = SparkSession.builder.appName(f"quayside {args.step}").getOrCreate()
    session.tune(spark, session.path_bytes(spark, args.feeds))
    opener = csv_feeds if args.format == "csv" else parquet_feeds
    feeds, params = opener(spark, args.feeds, args.dims), _params(args)
    return min(STEPS[args.step](feeds, params, args), 100)


def land(feeds: Feeds, params: Params, args: argparse.Namespace) -> int:
    """Exports of the run log arrive as files in one folder per feed."""
    name = "pipeline_runs" if args.format == "parquet" else f"{FEED_FILES['pipeline_runs']}.csv"
    stream = landing.file_stream(feeds.spark, f"{args.feeds}/{name}", FEEDS["pipeline_runs"], kind=args.format)
    root = f"{args.root}/landed/run_log"
    landing.ingest_runs(stream, root).awaitTermination()
    landing.hourly_log(feeds.spark, root).orderBy(F.col("hour").desc(), "source_system").show(SHOWN, truncate=False)
    return 0


def freshness(feeds: Feeds, params: Params, args: argparse.Namespace) -> int:
    return _show(build.freshness(feeds, params), "status = 'error'")


def run(feeds: Feeds, params: Params, args: argparse.Namespace) -> int:
    build.write_run(feeds, params, _run_root(args))
    return 0


def test(feeds: Feeds, params: Params, args: argparse.Namespace) -> int:
    relations = build.read_run(feeds.spark, _run_root(args))
    return _show(suite_report(feeds.spark, declared_checks(params), relations), "status = 'fail'")


def outcomes(feeds: Feeds, params: Params, args: argparse.Namespace) -> int:
    tables = build.read_run(feeds.spark, _run_root(args))
    booked = kpi.booked_financials(tables["fact_shipment_financials"], tables["fact_shipments"])
    return _show(kpi.outcome_report(kpi.outcome_metrics(tables, booked, tables, params), params), "verdict != 'pass'")


def release(feeds: Feeds, params: Params, args: argparse.Namespace) -> int:
    run_id = args.run_id or datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%SZ")
    done = build.release(feeds, params, args.root, run_id)
    print(done)
    if done.published:
        build.publish_names(feeds.spark, done.root)
    return 0 if done.published else 1


STEPS = {"ingest": land, "freshness": freshness, "run": run, "test": test, "outcomes": outcomes, "release": release}


def _show(report: DataFrame, failing: str) -> int:
    """Print a report, worst rows first, and count its failures; all of it, however many rows are printed."""
    report = report.persist()
    found = report.where(failing).count()
    rows = report.count()
    report.orderBy(F.expr(f"coalesce({failing}, false)").desc()).show(SHOWN, truncate=False)
    if rows > SHOWN:
        print(f"{rows - SHOWN} more rows; {found} of all fail")
    return found


def _run_root(args: argparse.Namespace) -> str:
    return f"{args.root}/runs/{args.run_id or 'manual'}"


def _params(args: argparse.Namespace) -> Params:
    given = {
        "as_of": args.as_of and date.fromisoformat(args.as_of),
        "go_live": args.go_live and date.fromisoformat(args.go_live),
        "now": args.now and datetime.fromisoformat(args.now),
    }
    return replace(CASE_STUDY, **{k: v for k, v in given.items() if v})


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("step", choices=STEPS)
    for name in ("feeds", "dims", "root"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--format", choices=("csv", "parquet"), default="csv")
    parser.add_argument("--run-id", help="of run, test and outcomes: manual; of release: the time, an id used before is refused")
    for name in ("as-of", "go-live", "now"):
        parser.add_argument(f"--{name}")
    return parser.parse_args(argv)


if __name__ == "__main__":
    sys.exit(main())
