"""Best-fit packing by linear grouping on the histogram of lengths.

Only the histogram, one count per possible length, is planned on the driver. The plan is a list of
runs: so many sequences alike, each a list of slot lengths.

1. Large lengths, in descending order, are cut into `SIZE_GROUPS` groups of equal cardinality and
   rounded up to the largest of their group.
2. Over these few sizes, configurations are chosen one after another: the largest size left and
   the exact fullest completion of it (bounded subset sum), as often as the counts allow.
3. Actual lengths replace the rounded ones, slot by slot, which leaves gaps.
4. Small lengths go best-fit, largest first, into the fullest sequences that still hold them.

Documents are then ranked within their length, in buckets, and each takes the slot of its rank.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm import common as c
from quayside.llm.segments import json_encoder

VOCABULARY = "byte_bpe_50k.json"
CAPACITY = 1024
END_ID = 2
SIZE_GROUPS = 256
#: Lengths up to this part of the capacity are small.
SMALL = 8


def pieces(docs: DataFrame, id_col: str, text_col: str, vocabulary: str, capacity: int, end_id: int) -> DataFrame:
    """(id, piece, start, length, ids_crc32) of every document's ids followed by `end_id`."""
    kind, schema = c.arrow_schema("id long, piece int, start long, length long, ids_crc32 long")
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = json_encoder(vocabulary)
        for batch in batches:
            ids = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in c.by_bytes(texts):
                rows = []
                for i, made in zip(ids[a:b], encode(texts[a:b]), strict=True):
                    made += end
                    n = len(made) // 4
                    start, stop = 0, (n - 1) % capacity + 1
                    for k in range(-(-n // capacity)):
                        rows.append((i, k, start, stop - start, zlib.crc32(made[4 * start : 4 * stop])))
                        start, stop = stop, stop + capacity
                yield from c.emit(dict(zip(schema.names, zip(*rows, strict=True), strict=True)), schema)

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, kind)


def _configurations(sizes: list[int], counts: list[int], capacity: int) -> Iterator[tuple[int, list[int]]]:
    """(times, group indexes) until every group is used up; `sizes` descends."""
    left = counts[:]
    top = 0
    while top < len(sizes):
        if not left[top]:
            top += 1
            continue
        room = capacity - sizes[top]
        mask = (1 << (room + 1)) - 1
        reach, steps = 1, []
        for g in range(len(sizes) - 1, top - 1, -1):  # small to large, so that tracing back prefers large
            most = min(left[g] - (g == top), room // sizes[g])
            if most <= 0:
                continue
            before, now = reach, reach
            for _ in range(most):
                more = now | ((now << sizes[g]) & mask)
                if more == now:
                    break
                now = more
            reach = now
            steps.append((g, before, most))
        fill, slots = reach.bit_length() - 1, [top]
        for g, before, most in reversed(steps):
            take = next(m for m in range(min(most, fill // sizes[g]), -1, -1) if before >> (fill - m * sizes[g]) & 1)
            slots += [g] * take
            fill -= take * sizes[g]
        times = min(left[g] // slots.count(g) for g in set(slots))
        for g in slots:
            left[g] -= times
        yield times, slots


def plan(counts: np.ndarray, capacity: int = CAPACITY, groups: int = SIZE_GROUPS) -> list[tuple[int, list[int]]]:
    """Runs (times, slot lengths) that use `counts[n]` slots of each length n, from 1 to capacity."""
    runs: list[tuple[int, list[int]]] = [(int(counts[capacity]), [capacity])] if counts[capacity] else []
    small = capacity // SMALL
    large = [(n, int(counts[n])) for n in range(capacity - 1, small, -1) if counts[n]]
    total = sum(k for _, k in large)
    each = max(1, -(-total // groups))
    queues: list[list[list[int]]] = [[]]
    space = each
    for n, k in large:
        while k:
            if not space:
                queues.append([])
                space = each
            take = min(k, space)
            queues[-1].append([n, take])
            space -= take
            k -= take
    queues = [q for q in queues if q]
    open_: list[list[tuple[int, list[int]]]] = [[] for _ in range(capacity + 1)]
    for times, slots in _configurations([q[0][0] for q in queues], [sum(k for _, k in q) for q in queues], capacity):
        filled: list[list[list[int]]] = []
        for g in slots:  # the next `times` actual lengths of the group
            part, need = [], times
            while need:
                n, k = queues[g][0]
                take = min(k, need)
                part.append([n, take])
                need -= take
                if take == k:
                    queues[g].pop(0)
                else:
                    queues[g][0][1] -= take
            filled.append(part)
        while filled[0]:
            take = min(p[0][1] for p in filled)
            lengths = [p[0][0] for p in filled]
            open_[capacity - sum(lengths)].append((take, lengths))
            for p in filled:
                p[0][1] -= take
                if not p[0][1]:
                    p.pop(0)
    for n in range(small, 0, -1):
        k, room = int(counts[n]), n
        while k:
            while room <= capacity and not open_[room]:
                room += 1
            if room > capacity:
                fit = capacity // n
                times = k // fit
                if times:
                    open_[capacity - fit * n].append((times, [n] * fit))
                    k -= times * fit
                if k:
                    open_[capacity - k * n].append((1, [n] * k))
                k = 0
                continue
            times, lengths = open_[room].pop()
            take = min(times, k)
            if take < times:
                open_[room].append((times - take, lengths))
            open_[room - n].append((take, [*lengths, n]))
            k -= take
            if room - n >= n:
                room = n
    return runs + [r for rs in open_ for r in rs]


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the end id alone. Every row of `docs` is packed, also repeated rows and
    rows with a null id. Other columns are not read; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    cut = c.stored(pieces(docs, id_col, text_col, vocabulary, capacity, end_id), "pieces")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    item = cut.withColumn("bucket", F.expr(f"cast(pmod(xxhash64(id, piece, ids_crc32), {buckets}) as int)"))
    each = c.stored(item.groupBy("length", "bucket").count(), "piece-counts")
    counts = np.zeros(capacity + 1, np.int64)
    for n, k in each.groupBy("length").agg(F.sum("count")).collect():  # a row per length: capacity at most
        counts[n] = k
    slots, sequence = [], 0
    used = np.zeros(capacity + 1, np.int64)
    for times, lengths in plan(counts, capacity):
        offset = 0
        for n in lengths:
            slots.append((n, int(used[n]), sequence, offset))
            used[n] += times
            offset += n
        sequence += times
    slots.sort()
    table = spark.sparkContext.broadcast(np.array(slots, np.int64).reshape(-1, 4))
    before = F.sum("count").over(Window.partitionBy("length").orderBy("bucket")) - F.col("count")
    place = F.row_number().over(Window.partitionBy("length", "bucket").orderBy("id", "piece", "ids_crc32"))
    ranked = item.withColumn("place", place).join(each.withColumn("before", before).drop("count"), ["length", "bucket"])
    ranked = ranked.select("id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("place") - 1).alias("rank"))
    kind, schema = c.arrow_schema("id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, first, sequence, offset = table.value.T
        for batch in batches:
            n, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            at = np.zeros(len(n), np.int64)
            for size in np.unique(n):
                here = n == size
                lo, hi = np.searchsorted(length, [size, size + 1])
                at[here] = lo + np.searchsorted(first[lo:hi], rank[here], "right") - 1
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence[at] + rank - first[at]), pa.array(offset[at])], schema=schema)

    return ranked.mapInArrow(run, kind).withColumnRenamed("id", id_col)
