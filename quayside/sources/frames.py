"""The two bundles every operator starts from: raw feeds and dimensions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property, reduce, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quayside.functions.text import literal
from quayside.sources.schemas import DIMS, FEED_FILES, FEEDS


class Feeds:
    """Raw feeds and dimensions by name, opened on first use.

    `opener(kind, name)` returns the DataFrame of one feed (`kind="feed"`) or dimension
    (`kind="dim"`). Subclasses may override single attributes instead.
    """

    def __init__(self, spark: SparkSession, opener: Callable[[str, str], DataFrame]):
        self.spark = spark
        self._opener = opener
        self.relations: dict[tuple, tuple] = {}

    def kept(self, name: str, df: DataFrame) -> DataFrame:
        """What relations built on the shared relation `name` read; here its plan."""
        return df

    def keeping(self, kept: Callable[[str, DataFrame], DataFrame]) -> Feeds:
        """These feeds with `kept` applied to each step that several of them share; exports share none."""
        return self

    def rejected(self) -> DataFrame | None:
        """Rows of the exports that could not be read; none where the feeds are typed already."""
        return None

    shipments = cached_property(lambda self: self._opener("feed", "shipments"))
    job_charges = cached_property(lambda self: self._opener("feed", "job_charges"))
    invoice_lines = cached_property(lambda self: self._opener("feed", "invoice_lines"))
    payments = cached_property(lambda self: self._opener("feed", "payments"))
    exceptions = cached_property(lambda self: self._opener("feed", "exceptions"))
    pipeline_runs = cached_property(lambda self: self._opener("feed", "pipeline_runs"))

    dim_branch = cached_property(lambda self: self._opener("dim", "dim_branch"))
    dim_carrier = cached_property(lambda self: self._opener("dim", "dim_carrier"))
    dim_charge_type = cached_property(lambda self: self._opener("dim", "dim_charge_type"))
    dim_customer = cached_property(lambda self: self._opener("dim", "dim_customer"))
    dim_destination_port = cached_property(lambda self: self._opener("dim", "dim_destination_port"))
    dim_exception_type = cached_property(lambda self: self._opener("dim", "dim_exception_type"))
    dim_mode = cached_property(lambda self: self._opener("dim", "dim_mode"))
    dim_origin_port = cached_property(lambda self: self._opener("dim", "dim_origin_port"))


def shared(fn):
    """Define a relation once per `Feeds`, so that relations built on it hold the same plan."""

    @wraps(fn)
    def once(feeds: Feeds, *args) -> DataFrame:
        key = (fn.__module__, fn.__name__, *map(id, args))
        if key not in feeds.relations:
            feeds.relations[key] = (feeds.kept(fn.__name__, fn(feeds, *args)), args)  # holding the arguments keeps their ids valid
        return feeds.relations[key][0]

    return once


@dataclass(frozen=True)
class Export:
    """An untyped export: its readable rows, typed, and the others as text with the reason."""

    valid: DataFrame
    rejected: DataFrame


class CsvFeeds(Feeds):
    """Header CSV exports: `fact_*.csv` under `feed_dir`, `dim_*.csv` under `dim_dir`."""

    def __init__(self, spark: SparkSession, feed_dir: str, dim_dir: str):
        super().__init__(spark, lambda kind, name: self.export(kind, name).valid)
        self._dirs = {"feed": feed_dir, "dim": dim_dir}
        self._exports: dict[str, Export] = {}

    def export(self, kind: str, name: str) -> Export:
        if name not in self._exports:
            schema, file = (FEEDS[name], FEED_FILES[name]) if kind == "feed" else (DIMS[name], name)
            self._exports[name] = by_header(self.spark, f"{self._dirs[kind]}/{file}.csv", schema)
        return self._exports[name]

    def rejected(self) -> DataFrame:
        """(relation, reason, source_file, row_text) of every unreadable row of all exports."""
        exports = {**{n: self.export("feed", n) for n in FEEDS}, **{n: self.export("dim", n) for n in DIMS}}
        return reduce(DataFrame.unionByName, [e.rejected.select(F.lit(n).alias("relation"), "*") for n, e in exports.items()])


def csv_feeds(spark: SparkSession, feed_dir: str, dim_dir: str) -> Feeds:
    return CsvFeeds(spark, feed_dir, dim_dir)


def parquet_feeds(spark: SparkSession, feed_dir: str, dim_dir: str) -> Feeds:
    """The same feeds landed as parquet, one directory or file per relation."""

    def open_parquet(kind: str, name: str) -> DataFrame:
        return spark.read.parquet(f"{feed_dir if kind == 'feed' else dim_dir}/{name}")

    return Feeds(spark, open_parquet)


# Columns beside those of the export; a header cannot well hold these names.
CORRUPT, REASON = "_unreadable_row", "_reject_reason"


def by_header(spark: SparkSession, path: str, schema: str) -> Export:
    """A CSV export with its columns bound by the names in the header, in whatever order they stand there.

    The header must hold every declared column; further columns are left out, but no name may repeat. All files of an export share
    one header, and a file with another is refused when it is read. A row with too many or too few fields,
    or with text that is no value of its column's type, is not dropped and fails nothing: it comes
    out in `rejected` as the text it was, with the reason and its file.
    """
    declared = StructType.fromDDL(schema)
    header = list(spark.read.option("header", False).csv(path).limit(1).first() or ())
    named = {(c or "").strip(): c for c in header}
    lacking = [f.name for f in declared if f.name not in named]
    if lacking or len(named) < len(header):
        raise ValueError(f"the header of {path} must hold distinct names, these among them: {', '.join(lacking or named)}")
    text = StructType([StructField(c, StringType()) for c in header])
    raw = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", False)  # a row is judged by all of its fields, whatever is read of it
        .schema(StructType([*text, StructField(CORRUPT, StringType())]))
        .csv(path)
        .select(*[F.col(f"`{c}`").alias(name) for name, c in named.items()], CORRUPT)
    )
    typed = {f.name: f"`{f.name}`" if f.dataType == StringType() else f"try_cast(`{f.name}` as {f.dataType.simpleString()})" for f in declared}
    reasons = [f"when `{CORRUPT}` is not null then 'wrong number of fields'"]
    reasons += [f"when `{c}` is not null and {cast} is null then {literal(f'unreadable {c}')}" for c, cast in typed.items() if cast != f"`{c}`"]
    judged = raw.withColumn(REASON, F.expr(f"case {' '.join(reasons)} end"))
    fields = ", ".join(f"`{name}`" for name in named)
    return Export(
        judged.where(f"{REASON} is null").selectExpr(*[f"{cast} as `{c}`" for c, cast in typed.items()]),
        judged.where(f"{REASON} is not null").selectExpr(
            f"{REASON} as reason", "input_file_name() as source_file", f"coalesce(`{CORRUPT}`, to_csv(struct({fields}))) as row_text"
        ),
    )
