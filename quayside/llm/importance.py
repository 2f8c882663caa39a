"""Importance resampling towards a target: documents whose hashed features the target has more often.

Features are runs of one to three words, hashed into buckets by CRC-32. Bucket frequencies of all
documents and of the target give each bucket a gain, each document the sum of its gains; Gumbel noise
from a hash of the id turns the highest scores into a draw by importance.

Hashing works on chunks of text at a time, in arrays:

1. Words are copied together with one space after each, so every feature is one stretch of bytes.
2. Distinct words, pairs and triples are told apart exactly (Arrow dictionaries of bytes, then of
   number pairs), and only distinct features are hashed.
3. Features of equal length form a two-dimensional uint8 array, and all their CRCs are updated
   column by column. The buckets are scattered back to every occurrence.

A text longer than a chunk is cut at word boundaries, with two words carried over, so memory is
bounded by the chunk (and the longest word), not by the text. Texts are hashed twice, once for the
counts and once for the weights: that costs no disk. Only bucket counts, a number fixed by a parameter, pass the driver.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm import common as c

BUCKETS = 10_000
RUN = 3
MIN_WORDS = 20
#: Percent of the documents long enough that are drawn.
SHARE = 5
SEED = 42
CHUNK_BYTES = 1 << 21
#: Lengths with fewer features than this are hashed one by one: a loop over columns pays off for many rows only.
FEW = 12

_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_GAP = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
_LAST = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _crc_table() -> np.ndarray:
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & 1, (x >> 1) ^ np.uint32(0xEDB88320), x >> 1).astype(np.uint32)
    return x


_TABLE = _crc_table()


def crc_columns(rows: np.ndarray) -> np.ndarray:
    """CRC-32 of every row of a two-dimensional uint8 array."""
    crc = np.full(len(rows), 0xFFFFFFFF, np.uint32)
    for column in np.ascontiguousarray(rows.T):
        low = crc.astype(np.uint8)
        low ^= column
        crc >>= np.uint32(8)
        crc ^= _TABLE[low]
    return ~crc


def crcs(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of the stretches of `data`, those of equal length together."""
    out = np.empty(len(start), np.uint32)
    by = np.argsort(length, kind="stable")
    cuts = np.flatnonzero(np.diff(length[by], prepend=-1, append=-1))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        group = by[a:b]
        n = int(length[group[0]])
        if len(group) < FEW:
            out[group] = [zlib.crc32(data[s : s + n]) for s in start[group].tolist()]
        else:
            out[group] = crc_columns(np.lib.stride_tricks.sliding_window_view(data, n)[start[group]])
    return out


def _distinct(keys: pa.Array) -> tuple[np.ndarray, int]:
    """The number of each key among the distinct ones, and how many there are."""
    coded = keys.dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(coded.dictionary)


def features(texts: list[bytes], carried: list[int], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text index and bucket of every feature, and the words of each text.

    The first carried[i] words of text i are known from before: features that end in them do not count again.
    """
    none = np.zeros(0, np.int64)
    raw = _LOWER[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)] if texts else none.astype(np.uint8)
    ink = _WORD[raw]
    edge = np.diff(ink.view(np.int8), prepend=np.int8(0))
    begin = np.flatnonzero(edge == 1)
    if not len(begin):
        return none, none, np.zeros(len(texts), np.int64)
    kept = ink | (edge == -1)
    data = np.where(ink, raw, np.uint8(0x20))[kept]
    end = np.flatnonzero(data == 0x20)
    start = np.concatenate([[0], end[:-1] + 1])
    at = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    text = np.searchsorted(at, begin, "right") - 1
    first = np.searchsorted(text, np.arange(len(texts)))
    new = np.arange(len(text)) - first[text] >= np.asarray(carried, np.int64)[text]
    words = np.bincount(text[new], minlength=len(texts))

    offsets = pa.py_buffer(np.concatenate([start, [len(data)]]).astype(np.int64))
    spelled = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(start), [None, offsets, pa.py_buffer(data)])
    word, n_words = _distinct(spelled)
    owner, found = [], []
    name, last = word, np.arange(len(word))  # of the run that begins at each word, and its last word
    for k in range(RUN):
        if k >= len(word):
            break
        if k:
            name = name[: len(word) - k] * n_words + word[k:]
            last = np.arange(k, len(word))
        held = np.flatnonzero((text[: len(last)] == text[last]) & new[last])
        # a run that reaches into the next text gets a name too, which no feature uses
        name, n = _distinct(pa.array(name))
        one = np.full(n, -1, np.int64)
        one[name[held][::-1]] = held[::-1]  # where each distinct run stands first
        used = np.flatnonzero(one >= 0)
        bucket = np.zeros(n, np.int64)
        bucket[used] = crcs(data, start[one[used]], end[last[one[used]]] - start[one[used]]) % buckets
        owner.append(text[held])
        found.append(bucket[name[held]])
    return np.concatenate(owner), np.concatenate(found), words


def _pieces(text: bytes, limit: int) -> Iterator[tuple[bytes, int]]:
    """A long text cut where no word is cut, each piece led by the RUN - 1 words before it."""
    at, lead = 0, []
    while at < len(text):
        gap = _GAP.search(text, at + limit) if at + limit < len(text) else None
        stop = gap.end() if gap else len(text)
        yield b" ".join([*lead, text[at:stop]]), len(lead)
        # the words before the next piece stand at the end of this one; a longer tail is read only if they do not
        tail, size = [], 4096
        while True:
            part = text[max(at, stop - size) : stop]
            tail = _LAST.findall(part)
            if len(tail) >= RUN or stop - size <= at:
                break
            size *= 4
        lead = [*lead, *tail][-(RUN - 1) :]
        at = stop


def hashed(texts: list[bytes], buckets: int = BUCKETS, limit: int = CHUNK_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(text index, bucket) of all features and the words of each text, a chunk at a time, with the first text's number."""
    for a, b in c.by_bytes(texts, limit):
        if b - a == 1 and len(texts[a]) > limit:
            for piece, carried in _pieces(texts[a], limit):
                yield *features([piece], [carried], buckets), a
        else:
            yield *features(texts[a:b], [0] * (b - a), buckets), a


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> list[int]:
    """How often features of each bucket stand in all texts; null texts have none."""
    kind, schema = c.arrow_schema("bucket int, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, bucket, _, _ in hashed([t or b"" for t in c.binary_texts(batch, "text")], buckets):
                total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield from c.emit({"bucket": some.astype(np.int32), "n": total[some]}, schema)

    rows = docs.select(F.col(text_col).cast("string").alias("text")).where("text is not null").mapInArrow(run, kind)
    found = {r["bucket"]: r["n"] for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect()}  # at most `buckets` rows
    return [found.get(k, 0) for k in range(buckets)]


def gains(source: list[int], target: list[int]) -> np.ndarray:
    """Thousandths of the logarithm of target over source frequency of each bucket, smoothed by one, rounded down."""
    s_all, t_all, m = sum(source), sum(target), len(source)
    return np.array([math.floor(1000 * math.log(float(t + 1) * (s_all + m) / (float(s + 1) * (t_all + m)))) for s, t in zip(source, target, strict=True)], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: id, n_words, n_features, weight."""
    kind, schema = c.arrow_schema("id long, n_words long, n_features long, weight long")
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value = shared.value
        for batch in batches:
            texts = [t or b"" for t in c.binary_texts(batch, "text")]
            words, count, weight = (np.zeros(len(texts), np.int64) for _ in range(3))
            for text, bucket, n, a in hashed(texts, len(value)):
                words[a : a + len(n)] += n
                count[a : a + len(n)] += np.bincount(text, minlength=len(n))
                # sums of whole numbers far below 2^53
                weight[a : a + len(n)] += np.bincount(text, value[bucket], minlength=len(n)).astype(np.int64)
            yield from c.emit({"id": batch.column(0), "n_words": words, "n_features": count, "weight": weight}, schema)

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, kind)


def ranked(scored: DataFrame, order: list, rank: str = "rank") -> DataFrame:
    """Adds the place of each row in `order`, from 1, without one task that sees all rows.

    Rows are dealt out by ranges of the order and written with their range; the ranges' counts, summed
    up, tell each range where its places begin. The order should be total, so that a lost task repeats its places.
    """
    dealt = c.stored(scored.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # one row per range, as many as shuffle partitions
    before = dealt.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    placed = dealt.withColumn(rank, place).join(F.broadcast(before), "_range")
    return placed.withColumn(rank, F.col(rank) + F.col("_before")).drop("_range", "_before")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    share: int = SHARE,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of `docs`: id, n_features, weight, score, rank (null where not drawn).

    Of the N rows with an id and at least `min_words` words, floor(share * N / 100) of the highest score
    are drawn; ties go to the smaller id. Null and empty texts have no features and weight 0. A row
    without an id has a weight, but no noise: score and rank are null. Repeated rows count each for itself
    and are ranked one after another. Other columns are not read; empty tables give an empty
    result, an empty target gains from its smoothing alone.
    """
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_text_col, buckets))
    h = f"cast(conv(substring(sha2(concat('{seed}:', id), 256), 1, 8), 16, 10) as long)"
    noise = f"cast(floor(-1000 * ln(-ln(({h} + 0.5D) / 4294967296D))) as long)"
    found = c.stored(weights(docs, gain, id_col, text_col).withColumn("score", F.expr(f"weight + {noise}")), "weights")
    long_enough = F.expr(f"id is not null and n_words >= {int(min_words)}")
    order = [F.col("score").desc(), F.col("id"), F.col("n_features"), F.col("weight")]
    placed = ranked(found.where(long_enough), order)
    n = found.where(long_enough).agg(F.count("*").alias("n"))
    drawn = placed.withColumn("_n", n.scalar()).withColumn("rank", F.expr(f"if(rank <= ({int(share)} * _n) div 100, rank, null)")).drop("_n")
    return drawn.unionByName(found.where(~long_enough).withColumn("rank", F.lit(None).cast("long"))).select(
        F.col("id").alias(id_col), "n_features", "weight", "score", "rank"
    )
