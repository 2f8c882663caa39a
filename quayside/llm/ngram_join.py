"""N-gram Jaccard join through R-trees over count vectors.

Every shingle is hashed into one of `GROUPS` token groups; a document becomes the point of its
counts per group. Two sets overlap in at most the summed coordinate minima of their points, which
prunes pairs, and whole R-tree nodes, before any set is compared.

1. Signature pass: set size, set name, point, and a count of every shingle bucket over the whole corpus.
2. Equal sets share their name and go on as one class.
3. Blocks: two sets with Jaccard >= num/den share a shingle among the first
   n - ceil(n * num / den) + 1 of each, in any fixed order. Rare buckets come first, so shared
   passages and frequent phrases are rarely in a block key. Nothing is dropped: any order is exact.
4. Stars, in rounds: in each block that still holds several components every class meets one class
   of the block only, another one each round, and of those it meets the one of best bound is
   verified. This joins almost all of a group of near copies with as many pairs as classes. Blocks
   of frequent shingles are dealt out by class and their heads meet in turn, so no block is one
   task's work.
5. Blocks that still hold different components get an R-tree each, which finds the pairs of
   different components whose bound reaches the needed overlap; parities of finer counts, which
   differ in no more places than the sets do, rule out most of the others. No block gives these pairs away,
   only a forest that ties their classes together. Classes that are tied form a group, in which
   each set is brought once; there an R-tree finds the pairs again and their sets are verified, and
   only links that join components leave it. Blocks of equal membership are searched once; large
   blocks and groups are dealt out as pairs of tiles.
6. Components of all verified links.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm import common as c
from quayside.llm.graph import components

GROUPS = 256
#: Counts are kept in 16 bits; the largest value stands for itself and more.
FULL = np.iinfo(np.uint16).max
#: Shingle buckets counted for the order: 4 MiB of counts, 1 MiB of ranks, whatever the input.
BUCKET_BITS = 20
SLICE_BITS = 12
#: Parities kept of a set: 512 bytes.
PARITY_BITS = 4096
LEAF = 16
FAN = 16
TILE = 2048
#: Classes in one tile of a group and shingles of their sets, 32 MiB, unless a single set has more.
GROUP_TILE = 8192
TILE_SHINGLES = 1 << 22
#: Parts of a block whose shingle bucket counts this many, over the mean, or more.
DEAL = 64
OFTEN = 2000
STAR_ROUNDS = 2
#: A block or group, and two of its tiles.
PLACE = ["h", "ti", "tj"]

_U = np.uint64


def _distinct(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle, text index), distinct, sorted by text and shingle."""
    words, doc = c.word_hashes([t.lower() for t in texts])
    hashes = [c.window_hashes(words, width)]
    docs = [doc[: len(hashes[0])]]
    inside = doc[: len(hashes[0])] == doc[width - 1 :] if len(hashes[0]) else np.zeros(0, bool)
    hashes[0], docs[0] = hashes[0][inside], docs[0][inside]
    count = np.bincount(doc, minlength=len(texts))
    for k in range(1, width):  # shorter texts: the whole sequence is the one shingle
        short = words[np.isin(doc, np.flatnonzero(count == k))]
        if len(short):
            hashes.append(c.window_hashes(short, k)[::k])
            docs.append(np.flatnonzero(count == k))
    h, d = np.concatenate(hashes), np.concatenate(docs)
    order = np.lexsort((h, d))
    h, d = h[order], d[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    return h[keep], d[keep]


def _set_names(h: np.ndarray, d: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Size and name of the set of each of n texts."""
    size = np.bincount(d, minlength=n)
    name = np.zeros(n, _U)
    full = np.flatnonzero(size)
    if len(full):
        first = (np.cumsum(size) - size)[full]
        with np.errstate(over="ignore"):
            name[full] = c.mix(np.add.reduceat(c.mix(h + _U(0x51)), first) + size[full].astype(_U) * c._LENGTH)
    return size, name


def _points(h: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
    """Counts per group of each of n texts."""
    at = d * GROUPS + (h % _U(GROUPS)).astype(np.int64)
    return np.minimum(np.bincount(at, minlength=n * GROUPS), FULL).astype(np.uint16).reshape(n, GROUPS)


def _parities(h: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
    """Whether each of n sets has an odd number of shingles per place, as bits."""
    odd = np.zeros(n * (PARITY_BITS // 64), _U)
    place = (h >> _U(20)) & _U(PARITY_BITS - 1)
    np.bitwise_xor.at(odd, d * (PARITY_BITS // 64) + (place >> _U(6)).astype(np.int64), _U(1) << (place & _U(63)))
    return odd.reshape(n, PARITY_BITS // 64)


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> _U(64 - BUCKET_BITS)).astype(np.int64)


def _signatures(docs: DataFrame, width: int) -> DataFrame:
    kind, schema = c.arrow_schema("id long, n long, key long, point binary, odd binary, slice int, counts binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << BUCKET_BITS, np.uint32)
        for batch in batches:
            texts = c.binary_texts(batch, "text")
            ids = batch.column(batch.schema.get_field_index("id"))
            for a, b in c.by_bytes(texts):
                part = [t or b"" for t in texts[a:b]]
                h, d = _distinct(part, width)
                counts += np.bincount(_bucket(h), minlength=len(counts)).astype(np.uint32)
                size, name = _set_names(h, d, len(part))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(a, b - a),
                        pa.array(size, pa.int64()),
                        pa.array(c.signed(name), pa.int64(), mask=size == 0),
                        pa.array([x.tobytes() for x in _points(h, d, b - a)], pa.binary()),
                        pa.array([x.tobytes() for x in _parities(h, d, b - a)], pa.binary()),
                        pa.nulls(b - a, pa.int32()),
                        pa.nulls(b - a, pa.binary()),
                    ],
                    schema=schema,
                )
        step = 1 << SLICE_BITS
        for k in range(len(counts) // step):
            part = counts[k * step : (k + 1) * step]
            if part.any():
                yield pa.RecordBatch.from_arrays(
                    [*(pa.nulls(1, pa.int64()) for _ in range(3)), *(pa.nulls(1, pa.binary()) for _ in range(2)), pa.array([k], pa.int32()), pa.array([part.tobytes()], pa.binary())],
                    schema=schema,
                )

    return docs.mapInArrow(run, kind)


def _ranks(signatures: DataFrame) -> tuple[np.ndarray, int]:
    """A byte per bucket, larger for buckets with more shingles: 1 MiB to the driver, whatever the input.

    And the rank of a bucket that counts OFTEN more shingles than the mean bucket.
    """
    kind, schema = c.arrow_schema("slice int, counts binary")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(raw, np.uint32).astype(np.int64)
                total[k] = total[k] + part if k in total else part
        for k, part in total.items():
            rank = np.minimum(np.log2(part + 1.0) * 6, 255).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([rank.tobytes()], pa.binary())], schema=schema)

    found = signatures.where("slice is not null").select("slice", "counts").repartition("slice").mapInArrow(add, kind).collect()
    rank = np.zeros(1 << BUCKET_BITS, np.uint8)
    for k, raw in found:
        rank[k << SLICE_BITS : (k + 1) << SLICE_BITS] = np.frombuffer(bytes(raw), np.uint8)
    mean = signatures.agg(F.sum("n")).first()[0] or 0
    return rank, int(np.log2(mean / len(rank) + OFTEN) * 6)


@dataclass(frozen=True)
class Order:
    """The ranks of buckets as a broadcast, and the rank from which on a block is dealt out."""

    shared: object
    often: int

    @property
    def value(self) -> np.ndarray:
        return self.shared.value


def _prefixes(h: np.ndarray, d: np.ndarray, rank: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles of every set in the order (rank, shingle): (shingle, text index)."""
    order = np.lexsort((h, rank[_bucket(h)], d))
    h, d = h[order], d[order]
    size = np.bincount(d) if len(d) else np.zeros(0, np.int64)
    length = size - -(-size * num // den) + 1
    place = np.arange(len(h)) - (np.cumsum(size) - size)[d]
    keep = place < length[d]
    return h[keep], d[keep]


def _postings(docs: DataFrame, width: int, num: int, den: int, rank) -> DataFrame:
    """(h, key, top): the blocks of every class; `top` is set where a frequent block is dealt out by class."""
    kind, schema = c.arrow_schema("h long, key long, top long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = c.binary_texts(batch, "text")
            seen: set[int] = set()
            for a, b in c.by_bytes(texts):
                part = [t or b"" for t in texts[a:b]]
                h, d = _distinct(part, width)
                name = _set_names(h, d, len(part))[1]
                fresh = np.zeros(len(part), bool)  # one text of each class in a batch is enough
                for i, x in enumerate(name.tolist()):
                    if x not in seen:
                        seen.add(x)
                        fresh[i] = True
                h, d = h[fresh[d]], d[fresh[d]]
                h, d = _prefixes(h, d, rank.value, num, den)
                key = name[d]
                often = rank.value[_bucket(h)] >= rank.often
                with np.errstate(over="ignore"):
                    dealt = np.where(often, c.mix(h + (key % _U(DEAL) + _U(1)) * c._LENGTH), h)
                yield from c.emit({"h": c.signed(dealt), "key": c.signed(key), "top": pa.array(c.signed(h), mask=~often)}, schema)

    return docs.mapInArrow(run, kind)


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """(key, shingles): the whole sorted sets of the classes asked for."""
    kind, schema = c.arrow_schema("key long, shingles binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = c.binary_texts(batch, "text")
            wanted = batch.column(batch.schema.get_field_index("key")).to_numpy()
            for a, b in c.by_bytes(texts):
                part = [t or b"" for t in texts[a:b]]
                h, d = _distinct(part, width)
                size, name = _set_names(h, d, len(part))
                end = np.cumsum(size)
                rows = np.flatnonzero((c.signed(name) == wanted[a:b]) & (size > 0))
                made = [h[end[i] - size[i] : end[i]].tobytes() for i in rows]
                yield from c.emit({"key": wanted[a:b][rows], "shingles": made}, schema)

    return docs.mapInArrow(run, kind)


def overlap_bound(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Summed coordinate minima of the rows of x and y; without bound where both counts are full."""
    low = np.minimum(x, y)
    bound = low.sum(1, dtype=np.int64)
    if low.size and low.max() == FULL:
        bound[(low == FULL).any(1)] = np.iinfo(np.int64).max
    return bound


def needed(n: np.ndarray, m: np.ndarray, num: int, den: int) -> np.ndarray:
    """Least overlap of sets of sizes n and m whose Jaccard is num/den or more."""
    return -(-num * (n + m) // (num + den))


def _bounded(pairs: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs whose sizes and summed minima allow a link, and by how much."""
    kind, schema = c.arrow_schema("a long, b long, slack double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, n, m = (batch.column(i).to_numpy() for i in range(4))
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, GROUPS) for i in (4, 5))
            bound, least = overlap_bound(x, y), needed(n, m, num, den)
            ok = bound >= least
            yield from c.emit({"a": a[ok], "b": b[ok], "slack": bound[ok] / least[ok]}, schema)

    return pairs.mapInArrow(run, kind)


def _whole_sets(keys: DataFrame, texts: DataFrame, owner: DataFrame, width: int) -> DataFrame:
    """(key, shingles) of distinct keys; `owner` has a document of each class."""
    asked = c.stored(owner.join(keys, "key").select("key", "id"), "ngram-asked")
    return c.stored(_sets(texts.where(c.marked("id", c.marks(asked.select("id")))).join(asked, "id").select("text", "key"), width), "ngram-sets")


def _verified(pairs: DataFrame, texts: DataFrame, owner: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """The pairs (a, b) whose sets are that similar, written; `owner` has a document of each class."""
    kind, schema = c.arrow_schema("a long, b long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(k)[i].as_buffer(), _U) for k in (2, 3))
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                ok[i] = den * common >= num * (len(x) + len(y) - common)
            yield from c.emit({"a": batch.column(0).to_numpy()[ok], "b": batch.column(1).to_numpy()[ok]}, schema)

    with c.dropping(texts.sparkSession) as keep:
        sets = _whole_sets(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), texts, owner, width)
        both = (
            pairs.join(sets.select(F.col("key").alias("b"), F.col("shingles").alias("y")), "b")
            .join(sets.select(F.col("key").alias("a"), F.col("shingles").alias("x")), "a")
            .select("a", "b", "x", "y")
        )
        return keep(c.stored(both.mapInArrow(run, kind), "ngram-links"))


def _with_counts(pairs: DataFrame, points: DataFrame, num: int, den: int) -> DataFrame:
    x = points.select(F.col("key").alias("a"), F.col("n").alias("n"), F.col("point").alias("x"))
    y = points.select(F.col("key").alias("b"), F.col("n").alias("m"), F.col("point").alias("y"))
    fits: Column = F.expr(f"{num} * n <= {den} * m and {num} * m <= {den} * n")
    return pairs.join(x, "a").join(y, "b").where(fits).select("a", "b", "n", "m", "x", "y")


class CountTree:
    """R-tree packed over count vectors; a node keeps the largest count per group and its size range."""

    def __init__(self, counts: np.ndarray, sizes: np.ndarray):
        self.order = self._tiled(counts, sizes)
        low = high = sizes[self.order]
        top, step = counts[self.order], LEAF
        self.levels = [(top, low, high, 1)]
        while len(top) > 1:
            at = np.arange(0, len(top), step)
            top, low, high = np.maximum.reduceat(top, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.levels.append((top, low, high, step))
            step = FAN

    @staticmethod
    def _tiled(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Leaf order: halve by size, then by the coordinate that varies most, down to a leaf."""
        open_, done = [np.argsort(sizes, kind="stable")], []
        while open_:
            rows = open_.pop()
            if len(rows) <= LEAF:
                done.append(rows)
                continue
            if done or len(open_):
                rows = rows[np.argsort(counts[rows, int(counts[rows].std(0).argmax())], kind="stable")]
            half = -(-(len(rows) // 2) // LEAF) * LEAF
            open_ += [rows[half:], rows[:half]]
        return np.concatenate(done)

    def search(self, counts: np.ndarray, sizes: np.ndarray, num: int, den: int, block: int = 64):
        """(query, point) pairs whose bound reaches the needed overlap, in blocks of queries."""
        for start in range(0, len(sizes), block):
            q = np.arange(start, min(start + block, len(sizes)))
            node = np.zeros(len(q), np.int64)
            for depth in range(len(self.levels) - 1, -1, -1):
                top, low, high, _ = self.levels[depth]
                if depth < len(self.levels) - 1:
                    step = self.levels[depth + 1][3]
                    child = node[:, None] * step + np.arange(step)
                    inside = child < len(top)
                    q, node = np.repeat(q, inside.sum(1)), child[inside]
                ok = (num * sizes[q] <= den * high[node]) & (num * low[node] <= den * sizes[q])
                q, node = q[ok], node[ok]
                ok = np.zeros(len(q), bool)
                for k in range(0, len(q), 4096):
                    part = slice(k, k + 4096)
                    bound = overlap_bound(counts[q[part]], top[node[part]])
                    ok[part] = bound >= needed(sizes[q[part]], low[node[part]], num, den)
                q, node = q[ok], node[ok]
            yield q, self.order[node]


def _sides(block: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the tiles ti and tj."""
    tile = block.column("tile").to_numpy()
    return np.flatnonzero(tile == block.column("ti")[0].as_py()), np.flatnonzero(tile == block.column("tj")[0].as_py())


def apart(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Least number of shingles in one but not both sets, by the rows of their parities."""
    return np.concatenate([np.bitwise_count(x[k : k + 4096] ^ y[k : k + 4096]).sum(1, dtype=np.int64) for k in range(0, len(x), 4096)] or [np.zeros(0, np.int64)])


def _by_query(q: np.ndarray, p: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each query with its points."""
    order = np.argsort(q, kind="stable")
    q, p = q[order], p[order]
    cuts = [0, *(np.flatnonzero(q[1:] != q[:-1]) + 1).tolist(), len(q)]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if a < b:
            yield q[a], p[a:b]


def _tree_ties(num: int, den: int):
    """A forest over the pairs of different components that pass the bound in one block, or between its tiles ti and tj."""

    def make(block: pa.Table) -> dict[str, object] | None:
        key, label, n = (block.column(k).to_numpy() for k in ("key", "label", "n"))
        counts = np.frombuffer(b"".join(block.column("point").to_pylist()), np.uint16).reshape(-1, GROUPS)
        odd = np.frombuffer(b"".join(block.column("odd").to_pylist()), _U).reshape(len(key), -1)
        left, right = _sides(block)
        tied = np.arange(len(key))
        found = []
        for q, p in CountTree(counts[right], n[right]).search(counts[left], n[left], num, den):
            a, b = left[q], right[p]
            ok = (label[a] != label[b]) & (tied[a] != tied[b])
            a, b = a[ok], b[ok]
            ok = apart(odd[a], odd[b]) <= n[a] + n[b] - 2 * needed(n[a], n[b], num, den)
            for x, others in _by_query(a[ok], b[ok]):
                trees, at = np.unique(tied[others], return_index=True)
                at = at[trees != tied[x]]
                found += [(key[x], key[y]) for y in others[at].tolist()]
                tied[np.isin(tied, trees)] = tied[x]
        return {"a": np.array([a for a, _ in found]), "b": np.array([b for _, b in found])} if found else None

    return make


def _tree_links(num: int, den: int):
    """Links that join different components in one group, or between its tiles ti and tj; none that closes a circle."""

    def make(block: pa.Table) -> dict[str, object] | None:
        key, label = block.column("key").to_numpy(), block.column("label").to_numpy()
        sets = [np.frombuffer(x, _U) for x in block.column("shingles").to_pylist()]
        size = np.array([len(x) for x in sets])
        start = np.cumsum(size) - size
        every = np.concatenate(sets)
        names, place = np.unique(every, return_inverse=True)
        counts = _points(every, np.repeat(np.arange(len(sets)), size), len(sets))
        group = np.unique(label, return_inverse=True)[1]
        held = np.zeros(len(names), bool)
        found = []
        left, right = _sides(block)
        for q, p in CountTree(counts[right], size[right]).search(counts[left], size[left], num, den):
            for x, others in _by_query(left[q], right[p]):
                others = others[group[others] != group[x]]
                if not len(others):
                    continue
                mine, n = place[start[x] : start[x] + size[x]], size[others]
                first = np.cumsum(n) - n
                held[mine] = True
                common = np.add.reduceat(held[place[np.repeat(start[others] - first, n) + np.arange(n.sum())]], first, dtype=np.int64)
                held[mine] = False
                for y in others[den * common >= num * (size[x] + n - common)].tolist():
                    if group[y] != group[x]:
                        found.append((key[x], key[y]))
                        group[group == group[y]] = group[x]
        return {"a": np.array([a for a, _ in found]), "b": np.array([b for _, b in found])} if found else None

    return make


def _dealt(member: DataFrame, tiles: str) -> DataFrame:
    """The members of each block once for every pair of tiles that their tile is one of."""
    pairs = "transform(sequence(0, tiles - 1), t -> struct(least(t, tile) as ti, greatest(t, tile) as tj))"
    return (
        member.withColumn("tiles", F.expr(f"cast({tiles} as int)"))
        .withColumn("tile", F.expr("cast(pmod(xxhash64(key), tiles) as int)"))
        .select("h", "key", "label", "tile", F.explode(F.expr(pairs)).alias("t"))
        .select("h", "key", "label", "tile", "t.ti", "t.tj")
    )


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, num: int = 3, den: int = 4) -> DataFrame:
    """One row per row of `docs`: id, n_shingles, component_id.

    Words are maximal runs outside 0x20 and 0x09-0x0D, after lower-casing A-Z. A text of fewer
    than `width` words has its whole sequence as one shingle; null, empty and blank texts have none
    and link with nothing. Rows link when den * |A & B| >= num * |A | B|, compared on 64-bit names.
    component_id is the smallest id reachable by links. Repeated rows are one class; an id that
    comes with several texts is kept row by row, and its rows share the id only. Rows with a null
    id keep n_shingles, link with nothing and get a null component_id. Other columns of `docs` are
    not read, whatever their names; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    signatures = c.stored(_signatures(plain, width), "ngram-signatures")
    ranks, often = _ranks(signatures)
    order = Order(spark.sparkContext.broadcast(ranks), often)
    named = signatures.where("slice is null").select("id", "n", F.expr("if(id is null, null, key)").alias("key"))
    texts = plain.where("id is not null")
    owner = named.where("key is not null").groupBy("key").agg(F.min("id").alias("id"))

    group = Window.partitionBy("h")
    posting = _postings(texts, width, num, den, order).withColumn("head", F.min("key").over(group)).withColumn("last", F.max("key").over(group))
    posting = c.stored(posting.where("head <> last or top is not null").drop("last"), "ngram-postings")
    heads = posting.where("top is not null").select("top", "head").distinct()
    pairs = posting.select(F.col("head").alias("a"), F.col("key").alias("b")).unionByName(
        heads.join(heads.groupBy("top").agg(F.min("head").alias("a")), "top").select("a", F.col("head").alias("b"))
    )
    tried = c.stored(pairs.where("a <> b").distinct(), "ngram-stars")
    # one point of each class that shares a block with another
    shared = tried.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    points = signatures.where("slice is null and id is not null").select("id", "key", "n", "point", "odd")
    points = c.stored(points.join(owner.join(shared, "key"), ["key", "id"], "left_semi").dropDuplicates(["key"]).drop("id"), "ngram-points")
    best = F.max_by("a", F.struct("slack", "a")).alias("a")
    nearest = c.stored(_bounded(_with_counts(tried, points, num, den), num, den).groupBy("b").agg(best).select("a", "b"), "ngram-nearest")
    links = _verified(nearest, texts, owner, width, num, den)
    block = posting.select(F.coalesce("top", "h").alias("h"), "key").distinct()
    for round_ in range(1, STAR_ROUNDS):
        with c.dropping(spark) as keep:
            member, split = _unsettled(block, links)
            other = F.min_by("key", F.xxhash64("key", F.lit(round_))).alias("a")
            head = member.join(split.select("h"), "h").groupBy("h").agg(other).join(member.select("h", F.col("key").alias("a"), F.col("label").alias("of")), ["h", "a"])
            pairs = member.join(head, "h").where("label <> of").select(F.least("a", "key").alias("a"), F.greatest("a", "key").alias("b")).distinct()
            pairs = _bounded(_with_counts(pairs.join(nearest, ["a", "b"], "left_anti"), points, num, den), num, den)
            pairs = keep(c.stored(pairs.groupBy("b").agg(best).select("a", "b"), "ngram-nearest"))
        nearest = nearest.unionByName(pairs)
        links = links.unionByName(_verified(pairs, texts, owner, width, num, den))
    with c.dropping(spark) as keep:
        member, split = _unsettled(block, links)
        dealt = _dealt(member.join(split, "h"), f"ceil(m / {TILE})").join(points, "key")
        ties = c.over_groups(dealt, PLACE, [], _tree_ties(num, den), "a long, b long")
        tied = components(ties).select(F.col("node").alias("key"), F.col("root").alias("h"))
        tied = keep(c.stored(tied.join(member.select("key", "label").distinct(), "key").join(points.select("key", "n"), "key"), "ngram-tied"))
    with c.dropping(spark) as keep:
        groups = tied.groupBy("h").agg(F.count("*").alias("m"), F.sum("n").alias("total"))
        dealt = _dealt(tied.join(groups, "h"), f"greatest(ceil(m / {GROUP_TILE}), ceil(total / {TILE_SHINGLES}))")
        sets = _whole_sets(tied.select("key"), texts, owner, width)
        found = c.over_groups(dealt.join(sets, "key"), PLACE, [], _tree_links(num, den), "a long, b long")
        links = links.unionByName(keep(c.stored(found, "ngram-links")))

    root = components(links).select(F.col("node").alias("key"), "root")
    row = named.join(root, "key", "left").withColumn("root", F.coalesce("root", "key"))
    least = row.where("root is not null").groupBy("root").agg(F.min("id").alias("least"))
    return row.join(least, "root", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("least", "id").alias("component_id")
    )


def _unsettled(block: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(h, key, label) with the components so far; (who, m, h): a block for each membership of several components."""
    label = components(links).select(F.col("node").alias("key"), F.col("root").alias("label"))
    member = c.stored(block.join(label, "key", "left").select("h", "key", F.coalesce("label", "key").alias("label")), "ngram-members")
    blocks = member.groupBy("h").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("m"), F.bit_xor(F.xxhash64("key")).alias("who"))
    return member, c.stored(blocks.where("lo <> hi").groupBy("who", "m").agg(F.min("h").alias("h")), "ngram-blocks")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs` whose id is the smallest of its group; rows without id stay, all columns are kept."""
    found = join(docs, id_col, text_col, **options).where("component_id <> {0}".format(id_col)).select(F.col(id_col).alias("_gone")).distinct()
    return docs.join(found, docs[id_col] == found["_gone"], "left_anti")
