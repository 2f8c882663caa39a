"""Byte-level BPE encoding and decoding of whole texts by overlapping chunks.

A text of more than `STEP` characters is cut into chunks that overlap by `OVERLAP`. Each chunk is
pre-tokenised on its own; because a match depends only on the text from its start on, two chunks
agree from their first common boundary inside the overlap, and there they are stitched. The pieces
between stitches are then encoded in parallel, and the ids of a document are read back in order as
a stream. Where an overlap holds no common boundary (a run of letters longer than it), the chunks
it should have joined are encoded together, so ids are always those of the whole text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm import common as c
from quayside.llm.segments import rank_encoder

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
STEP = 1 << 15
OVERLAP = 1 << 10


def _split(docs: DataFrame, vocabulary: str, step: int, overlap: int) -> DataFrame:
    """Digests of the texts that fit one chunk, and the chunks of all others."""
    kind, schema = c.arrow_schema(
        "row long, id long, chunk int, body string, head array<int>, tail array<int>, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, encoding = rank_encoder(vocabulary)
        for batch in batches:
            row, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts = [t or "" for t in batch.column(2).to_pylist()]
            for a, b in c.by_bytes(texts):
                whole = [i for i in range(a, b) if len(texts[i]) <= step]
                made = encode([texts[i] for i in whole])
                out = [
                    (row[i], ids[i], None, None, len(m) // 4, hashlib.sha256(m).hexdigest(), hashlib.sha256(encoding.decode_bytes(np.frombuffer(m, "<u4").tolist())).hexdigest())
                    for i, m in zip(whole, made, strict=True)
                ]
                out += [
                    (row[i], ids[i], k, texts[i][k * step : (k + 1) * step + overlap], None, None, None)
                    for i in range(a, b)
                    if len(texts[i]) > step
                    for k in range(-(-len(texts[i]) // step))
                ]
                for k in range(0, len(out), 64):
                    r, i, n, body, t, s, d = (list(x) for x in zip(*out[k : k + 64], strict=True))
                    void = [None] * len(r)
                    yield from c.emit({"row": r, "id": i, "chunk": n, "body": body, "head": void, "tail": void, "n_tokens": t, "ids_sha256": s, "decoded_sha256": d}, schema)

    return docs.mapInArrow(run, kind)


def _boundaries(chunks: DataFrame, step: int, overlap: int) -> DataFrame:
    """(row, chunk, head, tail): certain match starts in the first and the last overlap, from the chunk's start."""
    kind, schema = c.arrow_schema("row long, chunk int, head array<int>, tail array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers
        import regex

        match = regex.compile(public_tokenizers.PATTERN)
        for batch in batches:
            heads, tails = [], []
            for body in batch.column(2).to_pylist():
                # a match that reaches the chunk's end may be longer in the text
                ends = [m.end() for m in match.finditer(body)]
                starts = [0, *(e for e in ends if e < len(body))]
                heads.append([s for s in starts if s < overlap])
                tails.append([s for s in starts if s >= step])
            yield from c.emit({"row": batch.column(0), "chunk": batch.column(1), "head": heads, "tail": tails}, schema)

    return chunks.select("row", "chunk", "body").mapInArrow(run, kind)


def _encode_pieces(pieces: DataFrame, vocabulary: str) -> DataFrame:
    kind, schema = c.arrow_schema("row long, chunk int, tokens binary, rest string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, _ = rank_encoder(vocabulary)
        for batch in batches:
            row, chunk, body, start, stop, loose = (x.to_pylist() for x in batch.columns)
            for i in range(len(row)):
                text = body[i][start[i] : stop[i]]
                tokens, rest = (None, text) if loose[i] else (encode([text])[0], None)
                yield from c.emit({"row": [row[i]], "chunk": [chunk[i]], "tokens": [tokens], "rest": [rest]}, schema)

    return pieces.mapInArrow(run, kind)


def _digests(tokens: DataFrame, vocabulary: str) -> DataFrame:
    kind, schema = c.arrow_schema("row long, n_tokens long, ids_sha256 string, decoded_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, encoding = rank_encoder(vocabulary)
        now, n, ids, raw, loose = None, 0, hashlib.sha256(), hashlib.sha256(), []

        def add(m: bytes):
            nonlocal n
            n += len(m) // 4
            ids.update(m)
            raw.update(encoding.decode_bytes(np.frombuffer(m, "<u4").tolist()))

        def close():
            if loose:
                add(encode(["".join(loose)])[0])
                loose.clear()
            yield from c.emit({"row": [now], "n_tokens": [n], "ids_sha256": [ids.hexdigest()], "decoded_sha256": [raw.hexdigest()]}, schema)

        for batch in batches:
            for row, _, m, rest in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if row != now:
                    if now is not None:
                        yield from close()
                    now, n, ids, raw = row, 0, hashlib.sha256(), hashlib.sha256()
                if rest is not None:
                    loose.append(rest)
                else:
                    add(m)
        if now is not None:
            yield from close()

    return tokens.repartition("row").sortWithinPartitions("row", "chunk").mapInArrow(run, kind)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, step: int = STEP, overlap: int = OVERLAP) -> DataFrame:
    """One row per row of `docs`: id, n_tokens, ids_sha256, decoded_sha256.

    A null text counts as empty: no ids, and the digests of nothing. Rows are kept apart whatever
    their ids, so repeated and null ids come back as they are. Other columns are not read; an empty
    table gives an empty result.
    """
    plain = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    split = c.stored(_split(plain, vocabulary, step, overlap), "bpe-chunks")
    done = split.where("chunk is null").select("id", "n_tokens", "ids_sha256", "decoded_sha256")
    chunks = split.where("chunk is not null").select("row", "id", "chunk", "body")
    ordered = Window.partitionBy("row").orderBy("chunk")
    everything = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    seams = (
        _boundaries(chunks, step, overlap)
        .withColumn("meet", F.expr(f"array_min(array_intersect(tail, transform(lead(head) over (partition by row order by chunk), x -> x + {step})))"))
        .withColumn("last", F.lead("chunk").over(ordered).isNull())
        .withColumn("start", F.coalesce(F.lag("meet").over(ordered) - step, F.lit(0)))
        .withColumn("open", F.expr("meet is null and not last"))
        .withColumn("loose", F.max("open").over(everything))
    )
    # a document with an open seam is read whole, without the overlaps
    cut = seams.select(
        "row",
        "chunk",
        F.expr("if(loose, 0, start)").cast("int").alias("start"),
        F.expr(f"if(loose, {step}, if(last, {step + overlap}, meet))").cast("int").alias("stop"),
        "loose",
    )
    pieces = chunks.join(cut, ["row", "chunk"]).select("row", "chunk", "body", "start", "stop", "loose")
    long = _digests(_encode_pieces(pieces, vocabulary), vocabulary)
    owner = chunks.where("chunk = 0").select("row", "id")
    long = long.join(owner, "row").select("id", "n_tokens", "ids_sha256", "decoded_sha256")
    return done.unionByName(long).withColumnRenamed("id", id_col)
