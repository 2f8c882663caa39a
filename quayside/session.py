"""Session settings the plans rely on, and the shared folder for durable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

MIB = 1024 * 1024
SHUFFLE_PARTITION_BYTES = (8 * MIB, 256 * MIB)
FINE_SHUFFLE_PARTITIONS = 4096
MERGED_PARTITION_BYTES = (16 * MIB, 64 * MIB)
MAX_SHUFFLE_PARTITIONS = 100_000
SCAN_PARTITION_BYTES = (128 * MIB, 1024 * MIB)
MAX_SCAN_TASKS = 100_000

# Adaptive execution splits a hot key's partition on the streamed side of a join; the force
# flag keeps that split even where the next aggregate needs one more exchange because of it.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Tables of a run are zstd, half of what snappy takes; their sizes alone would make Catalyst broadcast millions of jobs.
    "spark.sql.sources.fileCompressionFactor": "2.0",
    # HotSpot leaves methods above 8000 bytes uncompiled; wide projections then run split instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Set what the user has not set: adaptive execution, shuffle width and scan split size.

    Adaptive execution merges small shuffle partitions but does not split ordinary large
    ones, so the width is derived from the input size. A row of the line table takes some
    18 bytes in its file and over 200 in a sort, so a partition gets few bytes of input while
    that makes a moderate number of tasks: the sorts then stay in memory, some 200 MB a task.
    Beyond, partitions grow; at 100 TB the widest hold well under 1 GB of what was read,
    and both task counts stay near 100,000, which bounds the number of shuffle blocks.
    """
    chosen = spark.conf.getAll
    wanted = dict(DEFAULTS)
    if input_bytes is not None:
        wanted["spark.sql.shuffle.partitions"] = str(shuffle_width(input_bytes, spark.sparkContext.defaultParallelism))
        wanted["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = str(merged_size(input_bytes))
        wanted["spark.sql.files.maxPartitionBytes"] = str(scan_split(input_bytes))
    for key, value in wanted.items():
        if key not in chosen or (key, chosen[key]) in _OURS:
            spark.conf.set(key, value)
            _OURS.add((key, value))
    return spark


#: Whether shuffle files are deleted as soon as their query ends, not only when the driver collects its garbage.
CLEAN_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def removing_shuffles(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is written in the block go when its write ends, so they never add up over the writes."""
    before = spark.conf.get(CLEAN_SHUFFLES)
    spark.conf.set(CLEAN_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN_SHUFFLES, before)


# Settings made here, which a later call for another input may change again.
_OURS: set[tuple[str, str]] = set()


def shuffle_width(input_bytes: int, parallelism: int) -> int:
    fine, coarse = (-(-input_bytes // size) for size in SHUFFLE_PARTITION_BYTES)
    return max(parallelism, min(fine, FINE_SHUFFLE_PARTITIONS), min(coarse, MAX_SHUFFLE_PARTITIONS))


def merged_size(input_bytes: int) -> int:
    """Up to how many shuffled bytes adaptive execution merges. They are compressed: a narrow row takes 13 there and over 300 in a sort."""
    small, large = MERGED_PARTITION_BYTES
    return small if input_bytes <= FINE_SHUFFLE_PARTITIONS * SHUFFLE_PARTITION_BYTES[0] else large


def scan_split(input_bytes: int) -> int:
    low, high = SCAN_PARTITION_BYTES
    return max(low, min(input_bytes // MAX_SCAN_TASKS, high))


def path_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes under the paths, as their file system reports them."""
    total = 0
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        total += p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p).getLength()
    return total


def fingerprint(spark: SparkSession, *paths: str) -> tuple:
    """What the file system says of the paths: bytes, files and the newest change; it differs once a table is rewritten."""
    found = []
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        held = fs.getContentSummary(p)
        found.append((path, held.getLength(), held.getFileCount(), fs.getFileStatus(p).getModificationTime()))
    return tuple(found)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new subfolder of the cluster's shared checkpoint folder.

    A machine-local folder is only ever chosen for a local master that names none.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="quayside-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
