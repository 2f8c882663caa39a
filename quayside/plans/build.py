"""Build the layers, publish the mart and gate its release."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, Row, SparkSession

from quayside import session
from quayside.operators import ingest, mart, rules, staging
from quayside.operators.quality import suite_report
from quayside.params import Params
from quayside.plans.checks import declared_checks
from quayside.sources.frames import Feeds

# Facts with a calendar column most readers filter on; written clustered by it.
CLUSTER_BY = {
    "fact_shipments": "booking_date",
    "fact_charges": "charge_date",
    "fact_invoice_lines": "invoice_date",
    "fact_payments": "payment_date",
    "fact_invoice_settlement": "due_date",
    "fact_shipment_financials": "job_completion_date",
    "fact_exceptions": "raised_date",
    "fact_pipeline_runs": "run_date",
}


class Relations(Mapping):
    """Relations by name, each defined when first asked for."""

    def __init__(self, definitions: dict[str, Callable[[], DataFrame]]):
        self._definitions = definitions
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._definitions[name]()
        return self._made[name]

    def __iter__(self):
        return iter(self._definitions)

    def __len__(self) -> int:
        return len(self._definitions)

    def replaced(self, frames: dict[str, DataFrame]) -> Relations:
        """The same relations with some of them read from somewhere else, e.g. from written tables."""
        return Relations({**self._definitions, **{n: (lambda df=df: df) for n, df in frames.items()}})


STAGING = {
    "stg_shipments": lambda feeds, params: staging.stg_shipments(feeds),
    "stg_job_charges": lambda feeds, params: staging.stg_job_charges(feeds),
    "stg_invoice_lines": lambda feeds, params: staging.stg_invoice_lines(feeds),
    "stg_payments": lambda feeds, params: staging.stg_payments(feeds),
}
INTERMEDIATE = {
    "int_shipments_conformed": lambda feeds, params: rules.shipments_conformed(feeds),
    "int_charges_classified": lambda feeds, params: rules.charges_classified(feeds),
    "int_invoices_matched": lambda feeds, params: rules.invoices_matched(feeds),
    "int_invoice_settlement": rules.invoice_settlement,
    "int_shipment_financials": lambda feeds, params: rules.shipment_financials(feeds),
}


def all_relations(feeds: Feeds, params: Params) -> Relations:
    """Every relation of the four layers, all lazy."""
    derived = {**STAGING, **INTERMEDIATE, **mart.FACTS}
    return Relations(
        {
            **{name: partial(getattr, feeds, name) for name in mart.DIMENSIONS},
            **{name: partial(fn, feeds, params) for name, fn in derived.items()},
        }
    )


def register_views(relations: Mapping[str, DataFrame]) -> None:
    """Make the relations queryable by name from Spark SQL."""
    for name, df in relations.items():
        df.createOrReplaceTempView(name)


def write_fact(df: DataFrame, name: str, root: str) -> None:
    """Overwrite one mart table under `<root>/mart/<name>`, clustered by its calendar column.

    `rebalance` sizes the output files at run time, splitting a date that holds a large
    share of the rows, and keeps each date in few files so scans can skip by statistics.
    Within a date rows are in the order of the key, the first column: keys then take few bytes.
    """
    day = CLUSTER_BY[name]
    df.hint("rebalance", day).sortWithinPartitions(day, df.columns[0]).write.options(**STORED).mode("overwrite").parquet(f"{root}/mart/{name}")


def read_mart(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    dims = {d: spark.read.parquet(f"{root}/reference/{d}") for d in mart.DIMENSIONS}
    return {**dims, **{f: spark.read.parquet(f"{root}/mart/{f}") for f in mart.FACTS}}


# ------------------------------------------------------------- built runs --
# Where each relation of a run is written. Shared relations are written when they are first asked for, so
# that every later one reads the table; `work` holds what is only a step towards others.
LAYERS = {
    **{name: "reference" for name in mart.DIMENSIONS},
    **{name: "staging" for name in STAGING},
    **{name: "intermediate" for name in INTERMEDIATE},
    **{name: "mart" for name in mart.FACTS},
}
#: Tables of a run that are written at the same time.
WRITERS = 4
#: How the tables are stored, a run holding each line of the feeds some eight times: numbers and texts as differences to the value before.
STORED = {"compression": "zstd", "parquet.compression.codec.zstd.level": "9", "parquet.writer.version": "v2"}
KEPT = {
    "charge_base": "work/charge_base",
    "typed_shipments": "work/typed_shipments",
    "stg_job_charges": "staging/stg_job_charges",
    "stg_invoice_lines": "staging/stg_invoice_lines",
    "stg_payments": "staging/stg_payments",
    "charges_classified": "intermediate/int_charges_classified",
    "invoices_matched": "intermediate/int_invoices_matched",
    "invoice_settlement": "intermediate/int_invoice_settlement",
    "shipment_financials": "intermediate/int_shipment_financials",
}
#: Relations that a run holds as rows, and up to how many. Catalyst takes a few rows drawn from a large table for
#: as large as that table, and would shuffle every line of the feeds to look them up.
HELD = {"dim_charge_type": 10_000}


class KeptFeeds(Feeds):
    """The feeds of `source`, with each shared relation and step of `KEPT` written once under `root` and read from there, and those of `HELD` as rows."""

    def __init__(self, source: Feeds, root: str):
        self.root = root
        opened = source.keeping(self.kept)
        super().__init__(source.spark, lambda kind, name: getattr(opened, name))

    def kept(self, name: str, df: DataFrame) -> DataFrame:
        if name in HELD:
            return _in_rows(df, HELD[name])
        if name not in KEPT:
            return df
        _write(df, f"{self.root}/{KEPT[name]}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{KEPT[name]}")


def _write(df: DataFrame, path: str) -> None:
    """Overwrite one table; a staging table is stamped with the time of reading, which later layers do not see."""
    stamped = staging.with_loaded_at(df) if "/staging/" in path else df
    stamped.write.options(**STORED).mode("overwrite").parquet(path)


def _in_rows(df: DataFrame, most: int) -> DataFrame:
    """The rows of `df`, whose size a join then knows when it is planned; a relation of more than `most` rows stays a plan."""
    rows = df._jdf.takeAsList(most + 1)
    if len(rows) > most:
        return df
    return DataFrame(df.sparkSession._jsparkSession.createDataFrame(rows, df._jdf.schema()), df.sparkSession)


def _planned_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


class Run(Relations):
    """The relations of a run under `root`, each written once, when it is first asked for, and read as written.

    What a relation is built on is written before it where it is shared (`KEPT`). Relations that nobody asks
    for are not written; `write_run` asks for all.
    """

    def __init__(self, feeds: Feeds, params: Params, root: str):
        super().__init__({name: partial(self._written, name) for name in LAYERS})
        self.root = root
        self.spark = feeds.spark
        self._plans = all_relations(KeptFeeds(feeds, root), params)

    def write(self, names: Iterable[str]) -> Run:
        """Write those of `names` that are not there yet.

        Dimensions are written a few at a time. Of the tables that grow with the feeds one is written after the other, the
        largest first, and its shuffle files go when it is there: the disk then holds the tables and one shuffle, not the sum of all.
        """
        asked = [name for name in dict.fromkeys(names) if name not in self._made]
        with session.removing_shuffles(self.spark):
            self._write_asked(asked)
        written = read_run(self.spark, self.root)
        self._made.update({name: written[name] for name in asked})
        return self

    def _write_asked(self, asked: list[str]) -> None:
        plans = {name: self._plans[name] for name in asked}  # writes the shared ones, in order
        there = {path.split("/")[1] for path in KEPT.values()}

        def write(name: str) -> None:
            if LAYERS[name] == "mart":
                write_fact(plans[name], name, self.root)
            else:
                _write(plans[name], f"{self.root}/{LAYERS[name]}/{name}")

        # the others do not depend on each other
        rest = [name for name in asked if name not in there]
        large = sorted((name for name in rest if LAYERS[name] != "reference"), key=lambda name: _planned_bytes(plans[name]), reverse=True)
        with ThreadPoolExecutor(WRITERS) as pool:
            in_turn = pool.submit(lambda: [write(name) for name in large])
            list(pool.map(write, [name for name in rest if name not in large]))
            in_turn.result()

    def _written(self, name: str) -> DataFrame:
        return self.write([name])._made[name]


def write_run(feeds: Feeds, params: Params, root: str) -> Relations:
    """Build every relation of the four layers once, each from the tables of those before it, and return them as written.

    Staging tables carry `_loaded_at`, when the feed was read. Rows of the feeds that could not be read
    are kept beside the layers, in `rejected/rows`.
    """
    run = Run(feeds, params, root).write(LAYERS)
    rejected = feeds.rejected()
    if rejected is not None:
        rejected.write.mode("overwrite").parquet(f"{root}/rejected/rows")
    return run


def read_run(spark: SparkSession, root: str) -> Relations:
    """The relations of a built run, all of them tables."""
    return Relations({name: partial(spark.read.parquet, f"{root}/{layer}/{name}") for name, layer in LAYERS.items()})


def publish_names(spark: SparkSession, root: str, prefix: str = "") -> None:
    """Point the tables `staging.stg_*`, `intermediate.int_*`, `mart.*` and `reference.*` of the catalogue at a built run.

    The databases are created where they are missing; `prefix` keeps several environments apart. Data
    are not copied: the names are external tables over the run's folders, replaced by the next run's.
    """
    for layer in sorted(set(LAYERS.values())):
        spark.sql(f"create database if not exists `{prefix}{layer}`")
    for name, layer in LAYERS.items():
        table = f"`{prefix}{layer}`.`{name}`"
        spark.sql(f"drop table if exists {table}")
        spark.sql(f"create table {table} using parquet location '{root}/{layer}/{name}'")


# ---------------------------------------------------------------- release --
@dataclass(frozen=True)
class Release:
    root: str
    published: bool
    stale_sources: list[str]
    failed_checks: dict[str, int]
    rejected_rows: int = 0


def freshness(feeds: Feeds, params: Params) -> DataFrame:
    """Age and verdict of every source, those declared in the parameters included."""
    return ingest.source_freshness(
        mart.fact_pipeline_runs(feeds), params.now, params.freshness_warn_hours, params.freshness_error_hours, params.source_systems
    )


def release(feeds: Feeds, params: Params, root: str, run_id: str, tolerate: frozenset[str] = frozenset()) -> Release:
    """Freshness, then build, then checks; the run becomes current only if nothing blocks it.

    Each run is written to a folder of its own, every layer of it, and the checks read what was
    written; a run id used before is refused. Released runs are appended to `<root>/current`, and readers
    take the newest, so a blocked, failed or lost run never disturbs what they see. A source that is
    declared but has no run blocks the release as a stale one does. Only the verdicts reach the driver.
    """
    spark = feeds.spark
    fresh = freshness(feeds, params)
    stale = [r["source_system"] for r in fresh.where("status = 'error'").collect()]
    run_root = f"{root}/runs/{run_id}"
    if stale:
        return Release(run_root, False, stale, {})
    # fails where the folder exists, before anything in it is touched
    spark.createDataFrame([(run_id,)], "run_id string").coalesce(1).write.mode("error").parquet(f"{run_root}/started")
    relations = write_run(feeds, params, run_root)
    failed = suite_report(spark, declared_checks(params), relations).where("status = 'fail'").collect()
    failures = {r["check_name"]: r["failures"] for r in failed if r["check_name"] not in tolerate}
    rejected = 0 if feeds.rejected() is None else spark.read.parquet(f"{run_root}/rejected/rows").count()
    if failures:
        return Release(run_root, False, stale, failures, rejected)
    pointer = spark.createDataFrame([(run_id, run_root)], "run_id string, root string").selectExpr("*", "current_timestamp() as released_at")
    pointer.coalesce(1).write.mode("append").parquet(f"{root}/current")
    return Release(run_root, True, stale, {}, rejected)


def released(spark: SparkSession, root: str) -> Row:
    """The newest released run: run_id, root, released_at."""
    return spark.read.parquet(f"{root}/current").selectExpr("max_by(struct(*), released_at) as run").first()["run"]


def current_mart(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the released run."""
    return read_mart(spark, released(spark, root)["root"])
