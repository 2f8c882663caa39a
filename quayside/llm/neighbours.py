"""Approximate nearest neighbours by vantage-point trees, one per shard.

A node keeps a vantage point and the median distance of its points to it; the nearer half goes
inside, the rest outside. A side is left out when the triangle inequality, relaxed by `factor`,
says that it holds nothing nearer than the k-th best so far: |d - radius| > best / factor. Factor
one is exact search; a larger factor looks at less. Shards are bounded in size and grow in number
with the table. Every query visits every shard's tree; the queries are a stated part of the table
and are streamed past each tree in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm import common as c
from quayside.llm.vectors import exact_cosine, matrix, unit, usable

SHARD_ROWS = 4096
LEAF = 128
FACTOR = 1.5
#: Kept per query and shard beyond k, so that exact scores and ids decide near ties.
SPARE = 4


class VantageTree:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.points = unit(vectors)
        self.ids, self.vectors = ids, vectors
        self.root = self._build(np.argsort(ids, kind="stable"))

    def _build(self, rows: np.ndarray):
        if len(rows) <= LEAF:
            return rows
        centre = self.points[rows[0]]
        d = np.sqrt(np.maximum(2 - 2 * (self.points[rows] @ centre), 0))
        radius = float(np.median(d))
        near = d <= radius
        if near.all() or not near.any():  # copies of one point: any halves will do
            near = np.arange(len(rows)) < len(rows) // 2
        return centre, float(d[near].max()), float(d[~near].min()), self._build(rows[near]), self._build(rows[~near])

    def search(self, ids: np.ndarray, vectors: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, rank within the tree, row): the k nearest rows found, not counting the query's own id."""
        q = unit(vectors)
        best = np.full((len(q), k), np.inf)
        row = np.full((len(q), k), -1)

        def visit(node, at: np.ndarray) -> None:
            if not len(at):
                return
            if isinstance(node, np.ndarray):
                d = np.sqrt(np.maximum(2 - 2 * (q[at] @ self.points[node].T), 0))
                d[self.ids[node][None, :] == ids[at][:, None]] = np.inf
                d = np.concatenate([best[at], d], 1)
                r = np.concatenate([row[at], np.broadcast_to(node, (len(at), len(node)))], 1)
                key = np.where(r >= 0, self.ids[r], np.iinfo(np.int64).max)
                order = np.lexsort((key, np.round(d, 12)), axis=1)[:, :k]
                best[at], row[at] = np.take_along_axis(d, order, 1), np.take_along_axis(r, order, 1)
                return
            centre, inner, outer, near, far = node
            d = np.sqrt(np.maximum(2 - 2 * (q[at] @ centre), 0))
            first = d <= (inner + outer) / 2
            visit(near, at[first])
            visit(far, at[~first])
            visit(far, at[first & (outer - d <= best[at, -1] / factor)])
            visit(near, at[~first & (d - inner <= best[at, -1] / factor)])

        visit(self.root, np.arange(len(q)))
        found = np.isfinite(best)
        who, place = np.nonzero(found)
        return who, place, row[found]


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    factor: float = FACTOR,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """(query_id, rank, <id>, score): the k rows of `vectors` found nearest to each row of `queries` by cosine.

    Both tables have the two columns named; others are not read. A row with the query's own id is no
    candidate. Equal scores are ranked by id. Rows without an id and vectors that are null, zero, or
    hold a null or non-finite component take no part; vectors of another length than the shard's
    first are compared among their like only. A repeated row counts once per id. Empty tables give
    an empty result.
    """
    spark = vectors.sparkSession
    index = usable(vectors, id_col, vector_col).dropDuplicates(["id"]).withColumn("size", F.size("vector"))
    asked = usable(queries, id_col, vector_col).dropDuplicates(["id"]).withColumn("size", F.size("vector"))
    sizes = {r["size"]: -(-r["count"] // shard_rows) for r in index.groupBy("size").count().collect()}  # a row per dimension
    if not sizes:
        sizes = {0: 1}
    width = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])
    shards = width[F.col("size")]
    placed = index.withColumn("shard", F.pmod(F.xxhash64("id"), shards).cast("int")).select("size", "shard", F.lit(0).alias("kind"), "id", "vector")
    visits = (
        asked.where(F.col("size").isin(list(sizes)))
        .withColumn("shard", F.explode(F.sequence(F.lit(0), (shards - 1).cast("int"))))
        .select("size", "shard", F.lit(1).alias("kind"), "id", "vector")
    )
    kind, schema = c.arrow_schema("query_id long, vec_id long, score double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, tree = None, [], None
        for batch in batches:
            size, shard, what = (batch.column(i).to_numpy() for i in range(3))
            change = np.flatnonzero((size[1:] != size[:-1]) | (shard[1:] != shard[:-1]) | (what[1:] != what[:-1])) + 1
            cuts = [0, *change.tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if (size[a], shard[a]) != now:
                    now, held, tree = (size[a], shard[a]), [], None
                part = batch.slice(a, b - a)
                ids, x = part.column(3).to_numpy(), matrix(part.column(4), int(size[a]))
                if what[a] == 0:  # the shard's rows come before its queries, and are bounded
                    held.append((ids, x))
                    continue
                if tree is None and held:
                    tree = VantageTree(np.concatenate([i for i, _ in held]), np.concatenate([v for _, v in held]))
                    held = []
                if tree is None:
                    continue
                for s in range(0, len(ids), 512):
                    qi, qx = ids[s : s + 512], x[s : s + 512]
                    who, _, row = tree.search(qi, qx, k + SPARE, factor)
                    yield from c.emit({"query_id": qi[who], "vec_id": tree.ids[row], "score": exact_cosine(qx[who], tree.vectors[row])}, schema)

    found = placed.unionByName(visits).repartition("size", "shard").sortWithinPartitions("size", "shard", "kind", "id").mapInArrow(run, kind)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.select("query_id", "rank", F.col("vec_id").alias(id_col), "score")
