"""Substring dedup by recompression: shared interior symbols reveal long repeats, which are then verified.

Recompression rewrites a word sequence in rounds: first every maximal run of one symbol becomes a
symbol, then every adjacent (left, right) pair of a fixed split of the alphabet becomes one. A
symbol's name is a hash of what it stands for, so all tasks name globally alike without a shared
dictionary, and equal substrings get equal symbols except near their ends. With every symbol goes
the exact stretch of words that decides it; two equal windows therefore share every symbol whose
stretch lies inside the window.

1. Documents of one and the same word sequence are one class; all but its first are repeats whole.
2. Symbol pass: of the symbols decided inside a window, the one of smallest name stands for the
   window. Its key is the name of its deciding stretch. A key found in one class only, and there
   once, proves that no window standing on it is repeated. Occurrences are combined per batch
   first, so a key in every document is no hot group.
3. The other windows of each class's first document are named word by word and compared: a window
   is a repeat when its sequence starts earlier, by (document, position).
4. Words under repeats are removed. Only texts that may lose words are shuffled for it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm import common as c

WIDTH = 20
#: Rounds of runs and pairs; after three, the deciding stretch of most symbols outgrows 20 words.
ROUNDS = 2

_U = np.uint64


def _join_names(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    k = c.odd_constants(salt, 2)
    with np.errstate(over="ignore"):
        return c.mix(a * k[0] + c.mix(b * k[1]))


def recompress(words: np.ndarray, doc: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name, low, high): symbols of the last round and the words [low, high) that decide each.

    A stretch that reaches past its document's ends is given as such, so it lies in no window.
    """
    n = len(words)
    name, d = words, doc
    low, high = np.arange(n), np.arange(1, n + 1)
    if not n:
        return name, low, high
    begin = np.searchsorted(doc, doc, "left")
    end = np.searchsorted(doc, doc, "right")
    for r in range(rounds):
        # runs: a symbol stands alone, or in a run, because both its neighbours differ
        new = np.ones(len(name), bool)
        new[1:] = (name[1:] != name[:-1]) | (d[1:] != d[:-1])
        at = np.flatnonzero(new)
        last = np.append(at[1:], len(name)) - 1
        length = (last - at + 1).astype(_U)
        run = np.where(length > 1, _join_names(name[at], length, 31 + r), name[at])
        lo, hi = low[at].copy(), high[last].copy()
        d2 = d[at]
        inner = np.zeros(len(at), bool)
        inner[1:] = d2[1:] == d2[:-1]
        lo[1:] = np.where(inner[1:], np.minimum(lo[1:], low[last[:-1]]), begin[np.minimum(low[at][1:].clip(0), n - 1)] - 1)
        lo[:1] = -1
        after = np.zeros(len(at), bool)
        after[:-1] = inner[1:]
        hi[:-1] = np.where(after[:-1], np.maximum(hi[:-1], high[at[1:]]), end[(high[last][:-1] - 1).clip(0, n - 1)] + 1)
        hi[-1:] = n + 1
        name, low, high, d = run, lo, hi, d2
        # pairs: a left symbol takes the right symbol after it
        left = (c.mix(name + _U(77 + r)) & _U(1)) == 0
        pair = np.zeros(len(name), bool)
        pair[:-1] = left[:-1] & ~left[1:] & (d[1:] == d[:-1])
        taken = np.zeros(len(name), bool)
        taken[1:] = pair[:-1]
        lo, hi = low.copy(), high.copy()
        same = np.zeros(len(name), bool)
        same[1:] = d[1:] == d[:-1]
        # alone: a left symbol because of what follows it, a right symbol because of what precedes it
        lone_left = left & ~pair
        nxt = np.minimum(np.arange(len(name)) + 1, len(name) - 1)
        ends = np.append(~same[1:], True) if len(name) else same
        hi = np.where(lone_left, np.where(ends, high + n, np.maximum(high, high[nxt])), hi)
        lone_right = ~left & ~taken
        prv = np.maximum(np.arange(len(name)) - 1, 0)
        lo = np.where(lone_right, np.where(~same, low - n - 1, np.minimum(low, low[prv])), lo)
        # a pair is decided by its two symbols
        lo = np.where(pair, np.minimum(low, low[nxt]), lo)
        hi = np.where(pair, np.maximum(high, high[nxt]), hi)
        name = np.where(pair, _join_names(name, name[nxt], 51 + r), name)
        keep = ~taken
        name, low, high, d = name[keep], lo[keep], hi[keep], d[keep]
    return name, low, high


def _keys(words: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, low) of the symbols that stand for some window, and (window, symbol), -1 for a window without one.

    Of the symbols decided inside a window, the one of smallest name is taken: which one that is,
    only the window's words decide.
    """
    name, low, high = recompress(words, doc)
    begin = np.searchsorted(doc, doc, "left")
    end = np.searchsorted(doc, doc, "right")
    at = low.clip(0, max(len(words) - 1, 0))
    ok = (high - low <= width) & (low >= 0) & (high <= len(words))
    ok[ok] &= (low[ok] >= begin[at[ok]]) & (high[ok] <= end[at[ok]])
    name, low, high = name[ok], low[ok], high[ok]
    if not len(low):
        w = np.flatnonzero(end - np.arange(len(words)) >= width)
        return name, low, w, np.full(len(w), -1)
    order = np.lexsort((high, low))
    name, low, high = name[order], low[order], high[order]
    # low and high both rise, so a window's symbols are consecutive: a range minimum by doubling
    w = np.flatnonzero(end - np.arange(len(words)) >= width)
    left, right = np.searchsorted(low, w, "left"), np.searchsorted(high, w + width, "right")
    empty = right <= left
    best = [np.arange(len(low))]
    while 1 << len(best) <= int((right - left).max(initial=0)):
        half, x = 1 << (len(best) - 1), best[-1]
        y = x[half:]
        best.append(np.where(name[y] < name[x[: len(y)]], y, x[: len(y)]))
    level = np.where(empty, -1, np.frexp(np.maximum(right - left, 1).astype(np.float64))[1] - 1)
    which = np.full(len(w), -1)
    for k, x in enumerate(best):
        here = np.flatnonzero(level == k)
        i, j = x[left[here]], x[right[here] - (1 << k)]
        which[here] = np.where(name[j] < name[i], j, i)
    chosen = np.zeros(len(low), bool)
    chosen[which[~empty]] = True
    which = np.where(empty, -1, (np.cumsum(chosen) - 1)[which])
    name, low, high = name[chosen], low[chosen], high[chosen]
    total = np.zeros(len(low), _U)
    with np.errstate(over="ignore"):
        for j, k in enumerate(c.odd_constants(61, width)):
            here = low + j < high
            total[here] += words[low[here] + j] * k
        key = c.mix(total + (high - low).astype(_U) * c._LENGTH)
    return key, low, w, which


def _texts_of(batch: pa.RecordBatch) -> tuple[np.ndarray, list[bytes]]:
    return batch.column(batch.schema.get_field_index("id")).to_numpy(), [t or b"" for t in c.binary_texts(batch, "text")]


def _sequences(words: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Name of each of n texts' word sequence, and its length."""
    count = np.bincount(doc, minlength=n)
    place = np.arange(len(words)) - (np.cumsum(count) - count)[doc]
    name = np.zeros(n, _U)
    full = np.flatnonzero(count)
    if len(full):
        with np.errstate(over="ignore"):
            placed = words * (c.mix(place.astype(_U) + _U(0x77)) | _U(1))
            name[full] = c.mix(np.add.reduceat(placed, (np.cumsum(count) - count)[full]) + count[full].astype(_U) * c._LENGTH)
    return name, count


def _classes(docs: DataFrame) -> DataFrame:
    """(id, class, n): the name and length of every document's word sequence."""
    kind, schema = c.arrow_schema("id long, class long, n long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = _texts_of(batch)
            for a, b in c.by_bytes(texts):
                words, doc = c.word_hashes(texts[a:b])
                name, count = _sequences(words, doc, b - a)
                yield from c.emit({"id": ids[a:b], "class": c.signed(name), "n": count}, schema)

    return docs.mapInArrow(run, kind)


def _symbols(docs: DataFrame, width: int) -> DataFrame:
    """(key, class, place, known): a key's first occurrence in a batch, or an occurrence known to be repeated."""
    kind, schema = c.arrow_schema("key long, class long, place int, known boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, texts = _texts_of(batch)
            parts, bares, seen = [], [], set()
            for a, b in c.by_bytes(texts):
                words, doc = c.word_hashes(texts[a:b])
                name = _sequences(words, doc, b - a)[0]
                fresh = np.zeros(b - a, bool)  # one text of each class in a batch is enough
                for i, x in enumerate(name.tolist()):
                    if x not in seen:
                        seen.add(x)
                        fresh[i] = True
                words, doc = words[fresh[doc]], doc[fresh[doc]]
                key, low, w, which = _keys(words, doc, width)
                d = doc[low]
                count = np.bincount(d, minlength=b - a)
                place = np.arange(len(key)) - (np.cumsum(count) - count)[d]
                parts.append((key, name[d], place))
                bares += name[np.unique(doc[w[which < 0]])].tolist()
            if not parts:
                continue
            key, owner, place = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(key, kind="stable")
            key, owner, place = key[order], owner[order], place[order]
            first = np.ones(len(key), bool)
            first[1:] = key[1:] != key[:-1]
            single = first.copy()
            single[:-1] &= first[1:]
            with np.errstate(over="ignore"):  # a name of their own for what needs no comparing
                key = np.where(first, key, c.mix(owner * _U(5) + place.astype(_U) * _U(3) + _U(1)))
            yield from c.emit({"key": c.signed(key), "class": c.signed(owner), "place": place.astype(np.int32), "known": ~single}, schema)
            if bares:  # a window without a decided symbol is compared whatever the keys say
                bare = np.array(bares, _U)
                place = np.full(len(bare), -1, np.int32)
                yield from c.emit({"key": c.signed(c.mix(bare)), "class": c.signed(bare), "place": place, "known": place < 0}, schema)

    return docs.mapInArrow(run, kind)


def _windows(docs: DataFrame, width: int) -> DataFrame:
    """(name, id, start, stop, known): a window's first occurrence in a batch, or a stretch of starts known to be repeated.

    `docs` has id, text and `places`, the ordinals of the text's repeated keys.
    """
    kind, schema = c.arrow_schema("name long, id long, start int, stop int, known boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = _texts_of(batch)
            places = batch.column(batch.schema.get_field_index("places"))
            found = []
            for a, b in c.by_bytes(texts):
                words, doc = c.word_hashes(texts[a:b])
                if not len(words):
                    continue
                key, low, w, which = _keys(words, doc, width)
                count = np.bincount(doc[low], minlength=b - a)
                offset = np.cumsum(count) - count
                repeated = np.ones(len(low) + 1, bool)  # the last: windows without a symbol
                repeated[: len(low)] = False
                for i in range(b - a):
                    if places[a + i].is_valid:
                        own = places[a + i].values.to_numpy()
                        repeated[offset[i] + own[(own >= 0) & (own < count[i])]] = True
                at = w[repeated[which]]
                begin = np.searchsorted(doc, doc, "left")
                total = np.zeros(len(at), _U)
                with np.errstate(over="ignore"):
                    for j, k in enumerate(c.odd_constants(21, width)):
                        total += words[at + j] * k
                found.append((c.mix(total), ids[a:b][doc[at]], at - begin[at]))
            if not found:
                continue
            name, owner, start = (np.concatenate(x) for x in zip(*found, strict=True))
            order = np.lexsort((start, owner, name))
            name, owner, start = name[order], owner[order], start[order]
            first = np.ones(len(name), bool)
            first[1:] = name[1:] != name[:-1]
            head = np.maximum.accumulate(np.where(first, np.arange(len(name)), 0))
            stay = first | (owner != owner[head]) | (start != start[head])  # else a repeated row of the head's
            name, owner, start, first = name[stay], owner[stay], start[stay], first[stay]
            yield from c.emit({"name": c.signed(name[first]), "id": owner[first], "start": start[first], "stop": start[first] + 1, "known": np.zeros(first.sum(), bool)}, schema)
            owner, start = owner[~first], start[~first]
            if len(owner):
                order = np.lexsort((start, owner))
                owner, start = owner[order], start[order]
                new = np.ones(len(owner), bool)
                new[1:] = (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)
                at = np.flatnonzero(new)
                stop = start[np.append(at[1:], len(start)) - 1] + 1
                owner, start = owner[at], start[at]
                with np.errstate(over="ignore"):  # a name of its own for what needs no comparing
                    name = c.mix(owner.view(_U) * _U(5) + start.astype(_U) * _U(3) + _U(1))
                yield from c.emit({"name": c.signed(name), "id": owner, "start": start, "stop": stop, "known": np.ones(len(at), bool)}, schema)

    return docs.mapInArrow(run, kind)


def _cut(docs: DataFrame, width: int) -> DataFrame:
    """id, kept text, counts and digest; `docs` has id, text and `starts` and `stops` of the stretches of repeated windows' first words."""
    kind, schema = c.arrow_schema("id long, kept binary, n_words long, n_removed long, kept_sha256 string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("id"))
            begins = batch.column(batch.schema.get_field_index("starts"))
            stops = batch.column(batch.schema.get_field_index("stops"))
            texts = c.binary_texts(batch, "text")
            for a, b in c.by_bytes(texts):
                kept, total, removed, digest = [], [], [], []
                for i in range(a, b):
                    words = (texts[i] or b"").split()
                    n, gone = len(words), 0
                    if begins[i].is_valid:
                        cut = np.zeros(n + 1, np.int32)
                        np.add.at(cut, np.minimum(begins[i].values.to_numpy(), n), 1)
                        np.add.at(cut, np.minimum(stops[i].values.to_numpy().astype(np.int64) + (width - 1), n), -1)
                        stay = np.cumsum(cut)[:n] == 0
                        gone = int(n - stay.sum())
                        words = [w for w, ok in zip(words, stay.tolist(), strict=True) if ok]
                    whole = b" ".join(words)
                    kept.append(whole if gone else None)
                    total.append(n)
                    removed.append(gone)
                    digest.append(hashlib.sha256(whole).hexdigest())
                yield from c.emit(
                    {"id": ids.slice(a, b - a), "kept": kept, "n_words": total, "n_removed": removed, "kept_sha256": digest}, schema
                )

    return docs.mapInArrow(run, kind)


def repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(id, starts, stops): stretches of the first words of every document's repeated windows.

    `docs` has id, not null, and text.
    """
    named = c.stored(_classes(docs), "sequences")
    head = named.where(f"n >= {width}").groupBy("class", "n").agg(F.min("id").alias("id"))
    whole = named.join(head.withColumnRenamed("id", "head"), ["class", "n"]).where("id <> head")
    whole = whole.select("id", F.lit(0).alias("start"), F.expr("cast(least(n, 2147483000) as int)").alias("stop"))
    seen = _symbols(docs, width)
    of_key = Window.partitionBy("key")
    shared = seen.withColumn("lo", F.min("class").over(of_key)).withColumn("hi", F.max("class").over(of_key)).where("known or lo <> hi")
    places = shared.groupBy("class").agg(F.collect_list("place").alias("places"))
    asked = c.stored(places.join(head, "class").groupBy("id").agg(F.flatten(F.collect_list("places")).alias("places")), "symbol-places")
    windows = _windows(docs.where(c.marked("id", c.marks(asked.select("id")))).join(asked, "id"), width)
    least = F.min(F.struct("id", "start")).over(Window.partitionBy("name"))
    again = windows.withColumn("least", least).where("known or struct(id, start) > least").select("id", "start", "stop")
    stretch = again.unionByName(whole)
    return stretch.groupBy("id").agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))


def _decided(docs: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """`repeats` as a table, and a bitmap of the ids it has."""
    found = c.stored(repeats(docs, width), "repeats")
    return found, c.marks(found.select("id"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per row of `docs`: id, kept (null where nothing was removed), n_words, n_removed, kept_sha256.

    Words are maximal runs outside 0x20 and 0x09-0x0D, unchanged. A null, empty or blank text has no
    words; a text shorter than `width` words has no window and stays whole. Rows without an id stay
    whole and repeat nothing. Rows that share an id are copies of one document: what is repeated at a
    position of one is cut there in each. Other columns are not read; an empty table gives an
    empty result. Windows are compared by 64-bit name.
    """
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found, bitmap = _decided(plain.where("id is not null"), width)
    mark = c.marked("id", bitmap)
    none = F.lit(None).cast("array<int>")
    kept = _cut(plain.where(~mark).select("id", "text", none.alias("starts"), none.alias("stops")), width)
    cut = _cut(plain.where(mark).join(found, "id", "left"), width)
    return kept.unionByName(cut).withColumnRenamed("id", id_col)


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """`docs` with repeated words removed from the text; texts that keep every word stay as they are."""
    plain = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found, bitmap = _decided(plain, width)
    mark = c.marked(f"`{id_col}`", bitmap)
    row = docs.where(mark).select(F.struct("*").alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    cut = _cut_rows(row.join(found, "id", "left"), docs, text_col, width)
    return docs.where(~mark).unionByName(cut)


def _cut_rows(rows: DataFrame, docs: DataFrame, text_col: str, width: int) -> DataFrame:
    """The rows with their texts cut by a pandas function; all columns of `docs` as they are."""

    @F.pandas_udf("string")
    def cut(texts: pd.Series, starts: pd.Series, stops: pd.Series) -> pd.Series:
        out = []
        for text, a, b in zip(texts, starts, stops, strict=True):
            if a is None or not isinstance(text, str):
                out.append(text)
                continue
            words = text.encode().split()
            n = len(words)
            depth = np.zeros(n + 1, np.int32)
            np.add.at(depth, np.minimum(np.asarray(a), n), 1)
            np.add.at(depth, np.minimum(np.asarray(b, dtype=np.int64) + (width - 1), n), -1)
            stay = np.cumsum(depth)[:n] == 0
            out.append(text if stay.all() else b" ".join(w for w, ok in zip(words, stay.tolist(), strict=True) if ok).decode())
        return pd.Series(out, dtype=object)

    made = rows.withColumn("kept", cut("text", "starts", "stops"))
    return made.select(*[F.col("kept").alias(x) if x == text_col else F.col("row").getField(x).alias(x) for x in docs.columns])
