"""Shared pieces: durable intermediate tables, word hashing, streams of groups, exact ratios."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Texts handled at once by the array code, in bytes; a longer text is handled alone.
CHUNK_BYTES = 1 << 20
#: Rows of one emitted Arrow batch.
EMIT_ROWS = 1 << 16
#: Size of the bitmap that keeps rows out of a join's shuffle: 1 MiB. A fuller bitmap keeps out fewer.
MARK_BITS = 1 << 23
#: Whether shuffle files are deleted as soon as their query ends, not only when the driver collects its garbage.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_U = np.uint64
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


# ---- durable tables -------------------------------------------------------------------------


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a local one is made only for a local master without it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="quayside-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once to the shared folder and return the table read from there.

    What is read later depends on files only, so a lost executor costs no recomputation of what
    led to them, and the shuffle files of the write go when it ends. The folder's owner expires its content.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    cleans = spark.conf.get(CLEAN_SHUFFLES)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEAN_SHUFFLES, cleans)
    table = spark.read.schema(df.schema).parquet(path)
    table._stored_at = path
    return table


#: Tables written within each `dropping` block that is open.
_OPEN: list[list[str]] = []


@contextmanager
def dropping(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete at the end, or at a failure, the tables that `stored` writes in the block, but for those `keep` is given.

    Nothing that was defined in the block and not written or kept may be read after it. What an
    inner block keeps is a table of the outer one.
    """
    kept: list[str] = []

    def keep(table: DataFrame) -> DataFrame:
        kept.append(table._stored_at)
        return table

    _OPEN.append([])
    try:
        yield keep
    finally:
        for path in _OPEN.pop():
            if path in kept:
                if _OPEN:
                    _OPEN[-1].append(path)
            else:
                where = spark._jvm.org.apache.hadoop.fs.Path(path)
                where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def dense(values: DataFrame, size: int) -> DataFrame:
    """One row with `values`, an array that has the `value` of each `index` below size, 0 where there is none."""
    every = values.sparkSession.range(size).select(F.col("id").alias("index"))
    full = every.join(values, "index", "left").select("index", F.expr("coalesce(value, 0)").alias("value"))
    return full.agg(F.expr("transform(array_sort(collect_list(struct(index, value))), x -> x.value)").alias("values"))


def marks(keys: DataFrame) -> DataFrame:
    """One row with a bitmap of hashed keys, `MARK_BITS` large whatever the input; `keys` has one column."""
    name = keys.columns[0]
    at = keys.select(F.expr(f"pmod(xxhash64(cast({name} as bigint)), {MARK_BITS})").alias("at")).distinct()
    word = at.groupBy(F.expr("at div 64").alias("index")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("value"))
    return stored(dense(word, MARK_BITS // 64), "marks")


def marked(column: str, bitmap: DataFrame) -> Column:
    """False only for rows whose key is surely not among those marked; it saves their shuffle before an exact join."""
    at = F.expr(f"pmod(xxhash64(cast({column} as bigint)), {MARK_BITS})")
    word = F.get(bitmap.scalar(), (at / 64).cast("int"))
    bit = F.call_function("shiftrightunsigned", word, F.pmod(at, F.lit(64)).cast("int"))
    return F.coalesce(bit.bitwiseAND(F.lit(1)) == 1, F.lit(False))


# ---- hashing --------------------------------------------------------------------------------


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser, so that every bit of a sum reaches every bit of the name."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def odd_constants(seed: int, n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed)) | _U(1)


_BYTE = odd_constants(11, 256)
_PLACE = odd_constants(12, 4096)
_LENGTH = _U(0xD6E8FEB86659FD93)


def _places(n: int) -> np.ndarray:
    global _PLACE
    if n > len(_PLACE):
        _PLACE = odd_constants(12, 2 * n)
    return _PLACE


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Name and text index of every maximal run of bytes outside 0x20, 0x09-0x0D."""
    data = b"\n".join([*texts, b""]) if texts else b""
    raw = np.frombuffer(data, np.uint8)
    ink = ~_WHITE[raw]
    edge = np.flatnonzero(np.diff(ink.view(np.int8), prepend=np.int8(0)))
    start, end = edge[0::2], edge[1::2]
    if not len(start):
        return np.zeros(0, _U), np.zeros(0, np.int64)
    length = end - start
    first = np.cumsum(length) - length
    at = np.flatnonzero(ink)
    place = np.arange(len(at)) - np.repeat(first, length)
    with np.errstate(over="ignore"):
        value = _BYTE[raw[at]] * _places(int(length.max()))[place]
        names = mix(np.add.reduceat(value, first) + length.astype(_U) * _LENGTH)
    begin = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    return names, np.searchsorted(begin, start, "right") - 1


def window_hashes(words: np.ndarray, width: int, seed: int = 21) -> np.ndarray:
    """Name of every `width` consecutive words, by the position of the first."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, _U)
    total = np.zeros(n, _U)
    with np.errstate(over="ignore"):
        for j, c in enumerate(odd_constants(seed, width)):
            total += words[j : j + n] * c
        return mix(total + _U(width) * _LENGTH)


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


# ---- streams --------------------------------------------------------------------------------


def by_bytes(texts: list[bytes | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of texts of about `limit` bytes together."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t or b"") > limit:
            yield start, i
            start, size = i, 0
        size += len(t or b"") + 1
    if start < len(texts):
        yield start, len(texts)


def binary_texts(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def emit(columns: dict[str, object], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Columns as Arrow batches of bounded length."""
    arrays = [pa.array(columns[f.name], f.type, from_pandas=False) for f in schema]
    n = len(arrays[0])
    for k in range(0, n, EMIT_ROWS):
        yield pa.RecordBatch.from_arrays([a.slice(k, EMIT_ROWS) for a in arrays], schema=schema)


def arrow_schema(ddl: str) -> tuple[T.StructType, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_schema

    kind = T.StructType.fromDDL(ddl)
    return kind, to_arrow_schema(kind)


def over_groups(
    df: DataFrame, keys: list[str], order: list[str], make: Callable[[pa.Table], dict[str, object] | None], ddl: str
) -> DataFrame:
    """`make` for the rows of each key, many groups per task, read as a sorted stream.

    The caller keeps groups bounded. Sorting spills, and only one group is held at a time, so a
    task's memory is a batch and a group, whatever the partition holds.
    """
    kind, schema = arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        last = None
        out: dict[str, list] = {f.name: [] for f in schema}
        rows = 0

        def flush():
            nonlocal out, rows
            made = {k: np.concatenate(v) if v and isinstance(v[0], np.ndarray) else [y for x in v for y in x] for k, v in out.items()}
            out, rows = {f.name: [] for f in schema}, 0
            yield from emit(made, schema)

        def close():
            nonlocal rows
            made = make(pa.concat_tables(held).combine_chunks())
            if made:
                for k, v in made.items():
                    out[k].append(v)
                rows += len(next(iter(made.values())))

        for batch in batches:
            table = pa.Table.from_batches([batch])
            columns = [np.asarray(table.column(k).to_numpy()) for k in keys]
            change = np.zeros(table.num_rows, bool)
            for c in columns:
                change[1:] |= c[1:] != c[:-1]
            cuts = [0, *np.flatnonzero(change).tolist(), table.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                key = tuple(c[a] for c in columns)
                if held and key != last:
                    close()
                    held = []
                last = key
                held.append(table.slice(a, b - a))
                if rows >= EMIT_ROWS:
                    yield from flush()
        if held:
            close()
        if rows:
            yield from flush()

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, kind)
