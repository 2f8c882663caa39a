"""Quality classifier by compression: which of two zstandard dictionaries, good or bad, shortens a text more.

The dictionaries are built from a bounded sample of labelled texts. A text is compressed block by
block under each; the difference of the compressed sizes over the plain one, with two more such
ratios, is the evidence that a logistic curve, fitted on other labelled texts, turns into a score.
Only the text is read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm import common as c

#: Labelled texts taken per class, and their longest length in characters: some 20 MB at most.
SAMPLE = 2000
SAMPLE_CHARS = 20_000
DICTIONARY_BYTES = 400_000
#: Bytes taken from a random place of a text at a time.
PART_BYTES = 512
#: Added to a compressed size that divides, so that the few bytes of a short text say little.
SMOOTH = 20
#: Bytes of a frame's fixed parts.
FRAME_BYTES = 11
#: A dictionary helps the start of a frame most, so a long text is compressed in blocks.
BLOCK_BYTES = 1024
LEVEL = 3
THRESHOLD = 0.3


@dataclass(frozen=True)
class Model:
    good: bytes
    bad: bytes
    centre: tuple[float, ...]
    spread: tuple[float, ...]
    weights: tuple[float, ...]

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.plain = zstandard.ZstdCompressor(level=LEVEL)
        self.packed = []
        for raw in (model.good, model.bad):
            dictionary = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=LEVEL)
            self.packed.append(zstandard.ZstdCompressor(dict_data=dictionary, level=LEVEL))

    def evidence(self, text: bytes) -> list[float]:
        """Normalised difference of compressed sizes, overall and in the extreme blocks; how far the good
        dictionary and none at all shorten the text; its length."""
        none = good = bad = 0
        each = []
        for k in range(0, len(text), BLOCK_BYTES):
            block = text[k : k + BLOCK_BYTES]
            n = len(self.plain.compress(block))
            g, b = (len(p.compress(block)) for p in self.packed)
            none, good, bad = none + n, good + g, bad + b
            each.append((g - b) / (n + SMOOTH))
        if not each:
            return [0.0] * 6
        plain = (none - FRAME_BYTES * len(each)) / len(text)
        return [(good - bad) / (none + SMOOTH), max(each), min(each), good / (none + SMOOTH), plain, float(np.log(len(text)))]

    def terms(self, texts: list[bytes]) -> np.ndarray:
        """One, the evidence in units of its spread, and its products."""
        x = np.array([self.evidence(t) for t in texts]).reshape(len(texts), -1)
        z = np.clip((x - np.array(self.model.centre)) / np.array(self.model.spread), -5, 5)
        n = z.shape[1]
        return np.column_stack([np.ones(len(z)), z, *(z[:, i] * z[:, j] for i in range(n) for j in range(i, n))])

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        p = 1 / (1 + np.exp(-np.clip(self.terms(texts) @ np.array(self.model.weights), -30, 30)))
        p[[not t.strip() for t in texts]] = 0.0
        return p


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _dictionary(texts: list[bytes]) -> bytes:
    """Parts from random places of the texts, in turn, until the dictionary is full."""
    rng = np.random.default_rng(3)
    parts: list[bytes] = []
    total = 0
    while texts and total < DICTIONARY_BYTES and len(parts) < 8 * len(texts) + 8:
        for i in rng.permutation(len(texts)):
            at = int(rng.integers(0, max(1, len(texts[i]) - PART_BYTES + 1)))
            parts.append(texts[i][at : at + PART_BYTES])
            total += len(parts[-1]) + 1
            if total >= DICTIONARY_BYTES:
                break
    return b"\n".join(parts)[-DICTIONARY_BYTES:].ljust(64)


def fit(good: list[bytes], bad: list[bytes]) -> Model:
    """A model from texts of either class; every other text builds the dictionaries, the rest calibrate."""
    raw = _dictionary(good[::2]), _dictionary(bad[::2])
    scorer = Scorer(Model(*raw, (0.0,), (1.0,), ()))
    rest = [*good[1::2], *bad[1::2]]
    y = np.array([1.0] * len(good[1::2]) + [0.0] * len(bad[1::2]))
    x = np.array([scorer.evidence(t) for t in rest] or [[0.0] * 6])
    model = Model(*raw, tuple(x.mean(0)), tuple(x.std(0) + 1e-9), ())
    terms = Scorer(model).terms(rest or [b""])
    weights = _logistic(terms, y) if len(y) else np.eye(terms.shape[1])[0]
    return Model(*raw, model.centre, model.spread, tuple(weights))


def sample(docs: DataFrame, labels: DataFrame, learn: Column, label_col: str, size: int, chars: int, id_col: str = "doc_id", text_col: str = "text") -> tuple[list[bytes], list[bytes]]:
    """Up to `size` texts of label 1 and of label 0 of at most `chars` characters, chosen by a hash of the id.

    Ids are chosen from the labels alone (`learn` is a condition on their id): a hash below a bound set
    by the count of each class, some quarter more than `size` of them. These few are broadcast, so texts
    are read once, none is shuffled but those chosen, and what the driver gets does not grow with the
    tables. An id with both labels is left out; of several texts under one id the first in their order counts.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & learn).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("truth"))
    truth = known.groupBy("id").agg(F.min("truth").alias("truth"), F.max("truth").alias("other")).where("truth = other and id is not null")
    place = F.pmod(F.xxhash64("id", F.lit(17)), F.lit(1 << 40))
    ranked = truth.select("id", "truth", place.alias("place"))
    wanted = F.lit(False)
    for row in truth.groupBy("truth").count().collect():
        wanted = wanted | ((F.col("truth") == row["truth"]) & (F.col("place") < int((1 << 40) * min(1.0, 1.25 * (size + 64) / row["count"]))))
    ids = F.broadcast(ranked.where(wanted))
    texts = docs.where(F.col(text_col).isNotNull() & (F.length(text_col) <= chars)).select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")
    )
    rows = texts.join(ids, "id").groupBy("truth", "place", "id").agg(F.min("text").alias("text")).collect()
    found = [sorted((r["place"], r["id"], r["text"]) for r in rows if r["truth"] == value)[:size] for value in (1, 0)]
    return [t.encode() for _, _, t in found[0]], [t.encode() for _, _, t in found[1]]


def remainder(id_col: str, mod: int) -> Column:
    """crc32 of the id's text, modulo `mod`; null for a null id."""
    return F.crc32(F.col(id_col).cast("long").cast("string").cast("binary")) % mod


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", size: int = SAMPLE) -> Model:
    return fit(*sample(docs, labels, learn, label_col, size, SAMPLE_CHARS, id_col, text_col))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of `docs`: id, score, predicted. Null, empty and blank texts score 0.

    Rows are scored one by one, so repeated rows and null ids come back as they are. Other columns
    are not read; an empty table gives an empty result. Without labelled texts every text
    gets one and the same score.
    """
    kind, schema = c.arrow_schema("id long, score double, predicted int")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value.scorer()
        for batch in batches:
            texts = [t or b"" for t in c.binary_texts(batch, "text")]
            p = scorer.scores(texts)
            yield from c.emit({"id": batch.column(0), "score": p, "predicted": (p >= threshold).astype(np.int32)}, schema)

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(run, kind).withColumnRenamed("id", id_col)


def good_only(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs` that the classifier accepts, with all their columns."""
    from pyspark.sql.functions import pandas_udf

    shared = docs.sparkSession.sparkContext.broadcast(model)

    @pandas_udf("double")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = shared.value.scorer()
        for texts in batches:
            yield pd.Series(scorer.scores([t.encode() if isinstance(t, str) else b"" for t in texts]), dtype="float64")

    return docs.where(rate(F.col(text_col).cast("string")) >= threshold)
