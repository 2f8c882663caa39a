"""Embedding near-dedup by Euclidean p-stable hashing.

A table's hash is several random Gaussian projections of the unit vector, shifted and quantised.
Near vectors fall into the same bucket of some table; every pair of a bucket is checked by exact
cosine. Projections per table and tables follow from the largest label and from the wanted chance
of missing a link, by the collision probability of the family. A pair counts in the first table
that brings it together, so nothing is emitted per pair: a bucket returns links per vector and the
edges of a spanning forest. Large buckets are dealt out as pairs of bounded tiles, whole.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.llm import common as c
from quayside.llm.graph import components
from quayside.llm.vectors import exact_cosine, matrix, unit, usable

WIDTH = 2.0
#: Chance of missing a pair at the threshold itself; nearer pairs are missed far less often.
MISS = 0.002
#: Unrelated vectors of its label that a vector may meet in a bucket, on average.
CROWD = 32
TILE = 1024
SEED = 7


def collision(distance: float, width: float) -> float:
    """Chance that one projection puts two points of that distance into one cell."""
    if distance == 0:
        return 1.0
    r = width / distance
    return 1 - 2 * 0.5 * math.erfc(r / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


def shape(rows: int, cosine: float, width: float = WIDTH, miss: float = MISS) -> tuple[int, int]:
    """(projections per table, tables) for a label of so many rows."""
    near, apart = collision(math.sqrt(2 - 2 * cosine), width), collision(math.sqrt(2), width)
    per_table = max(1, math.ceil(math.log(max(rows / CROWD, 1.0)) / -math.log(apart)))
    tables = math.ceil(math.log(miss) / math.log1p(-(near**per_table)))
    return per_table, tables


def _hashed(rows: DataFrame, per_table: int, tables: int, width: float) -> DataFrame:
    """(size, label, id, vector, codes): one 64-bit name of a bucket per table."""
    kind, schema = c.arrow_schema("label long, id long, vector array<double>, codes array<long>")

    def run(batches):
        for batch in batches:
            lengths = batch.column(2).value_lengths().to_numpy()
            for size in np.unique(lengths):
                part = batch.filter(pa.array(lengths == size))
                rng = np.random.default_rng([SEED, int(size)])
                a = rng.standard_normal((int(size), per_table * tables))
                shift = rng.uniform(0, width, per_table * tables)
                label = part.column(0).to_numpy()
                cell = np.floor((unit(matrix(part.column(2), int(size))) @ a + shift) / width).astype(np.int64).view(np.uint64)
                cell = cell.reshape(-1, tables, per_table)
                code = np.zeros(cell.shape[:2], np.uint64)
                with np.errstate(over="ignore"):
                    for j, k in enumerate(c.odd_constants(91, per_table)):
                        code += cell[:, :, j] * k
                    code = c.mix(code + c.odd_constants(92, tables)[None, :] + c.mix(label.view(np.uint64) * np.uint64(31) + np.uint64(size))[:, None])
                flat = pa.ListArray.from_arrays(pa.array(np.arange(0, code.size + 1, tables), pa.int32()), pa.array(code.view(np.int64).ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(2).cast(schema.field("vector").type), flat.cast(schema.field("codes").type)], schema=schema)

    return rows.select("label", "id", "vector").mapInArrow(run, kind)


def _forest(m: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of m nodes."""
    root = np.arange(m)
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def _links(cosine: float):
    def make(block: pa.Table) -> dict[str, object] | None:
        ids = block.column("id").to_numpy()
        tile, ti, tj = (block.column(k).to_numpy() for k in ("tile", "ti", "tj"))
        table = int(block.column("table")[0].as_py())
        chunk = block.column("vector").combine_chunks()
        x = matrix(chunk, len(chunk[0]))
        codes = block.column("codes").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
        u = unit(x)
        left, right = np.flatnonzero(tile == ti[0]), np.flatnonzero(tile == tj[0])
        i, j = np.nonzero(u[left] @ u[right].T >= cosine - 1e-9)
        i, j = left[i], right[j]
        ok = (i < j) if ti[0] == tj[0] else np.ones(len(i), bool)
        ok &= (ids[i] != ids[j]) & ~(codes[i, :table] == codes[j, :table]).any(1)
        i, j = i[ok], j[ok]
        ok = exact_cosine(x[i], x[j]) >= cosine if len(i) else np.zeros(0, bool)
        i, j = i[ok], j[ok]
        if not len(i):
            return None
        links = np.bincount(np.concatenate([i, j]), minlength=len(ids))
        root = _forest(len(ids), i, j)
        tied = np.flatnonzero(links)
        return {"a": ids[tied], "b": ids[root[tied]], "links": links[tied]}

    return make


def dedup(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = 0.93) -> DataFrame:
    """One row per row of `vectors`: id, n_links, component_id, kept.

    Rows link when their labels are equal and not null and their cosine in double precision is
    `cosine` or more. Rows without an id or a label and vectors that are null, zero, or hold a null or
    non-finite component link with nothing and are kept. Rows that share an id do not link with each
    other and share their figures. Other columns are not read; an empty table gives an empty result.
    Labels that are no whole numbers are compared by a 64-bit hash: among a million label values, the odds
    of any two with one hash are 3 in 10^8.
    """
    label = F.col(label_col)
    if not isinstance(vectors.schema[label_col].dataType, T.IntegralType):
        label = F.when(label.isNotNull(), F.xxhash64(label))
    rows = usable(vectors, id_col, vector_col, label.cast("long").alias("label")).where("label is not null")
    largest = rows.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    per_table, tables = shape(largest, cosine)
    hashed = c.stored(_hashed(rows, per_table, tables, WIDTH), "vector-buckets")
    member = hashed.select("id", F.posexplode("codes").alias("table", "bucket"))
    crowd = member.groupBy("table", "bucket").agg(F.count("*").alias("m"), F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi")
    dealt = (
        hashed.select("id", "vector", "codes", F.posexplode("codes").alias("table", "bucket"))
        .join(crowd.select("table", "bucket", F.expr(f"cast(ceil(m / {TILE}) as int)").alias("tiles")), ["table", "bucket"])
        .withColumn("tile", F.expr("cast(pmod(xxhash64(id), tiles) as int)"))
        .withColumn("t", F.explode(F.expr("transform(sequence(0, tiles - 1), t -> struct(least(t, tile) as ti, greatest(t, tile) as tj))")))
        .select("table", "bucket", "t.ti", "t.tj", "tile", "id", "vector", "codes")
    )
    found = c.stored(c.over_groups(dealt, ["table", "bucket", "ti", "tj"], [], _links(cosine), "a long, b long, links long"), "vector-links")
    count = found.groupBy("a").agg(F.sum("links").alias("links"))
    root = components(found.select("a", "b"))
    every = vectors.select(F.col(id_col).cast("long").alias("id"))
    return (
        every.join(count, F.col("id") == F.col("a"), "left")
        .join(root, F.col("id") == F.col("node"), "left")
        .select(
            F.col("id").alias(id_col),
            F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("root", "id").alias("component_id"),
            F.coalesce(F.col("root") == F.col("id"), F.lit(True)).alias("kept"),
        )
    )
