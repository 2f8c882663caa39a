"""Filter interaction audit: what each filter removes, at each place of every order of the filters.

1. Every document becomes a part and a failure mask, one bit per filter; documents of one part and
   mask are counted, with those whose loss matters. At most 2^filters counts a part are left.
2. Per part, Spark tasks build a decision diagram of the masks: one level per filter, the low child
   of a node passes, the high child fails, leaves carry the counts, a node weighs what lies below.
3. Two neighbouring levels are swapped in place, which touches the nodes of these levels alone;
   swaps run through all orders, one swap from each order to the next.
4. In each order the all-pass path gives the steps: at a node of the path the high child weighs
   what the filter of that level removes, the low child what it keeps.

Equal texts are found by the SHA-256 of the text: the smallest id of a digest is counted with map-side
combining and joined back by digest, where adaptive execution splits a text that makes up much of the table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm import common as c

BLANKS = " \\t\\n\\u000B\\u000C\\r"
SPLIT = "[\\x20\\x09-\\x0D]+"
#: n filters have n! orders and 2^n masks; the diagram of a part is held in one task.
MOST_FILTERS = 8

#: What makes a document fail, over the columns of `measured`.
FAILURES: dict[str, str] = {
    "A": "n_words < 100",
    "B": "100 * n_distinct < 80 * n_words",
    "C": "100 * n_upper > 10 * n_points",
    "D": "has_marks",
    "E": "repeats",
}


# ---- decision diagram -----------------------------------------------------------------------


class Diagram:
    """A count-weighted decision diagram of failure masks; level k tests variable order[k]."""

    def __init__(self, variables: int, counts: dict[int, tuple[int, ...]], width: int):
        self.order = list(range(variables))
        self.low: list[int] = []
        self.high: list[int] = []
        self.weight: list[tuple[int, ...]] = []
        leaves: dict[tuple[int, ...], int] = {}
        zero = (0,) * width
        row = []
        # leaves in the order of the path bits, variable 0 first
        for path in range(1 << variables):
            mask = sum(1 << v for v in range(variables) if path >> (variables - 1 - v) & 1)
            found = counts.get(mask, zero)
            if found not in leaves:
                leaves[found] = self._add(-1, -1, found)
            row.append(leaves[found])
        self.levels: list[dict[tuple[int, int], int]] = [{} for _ in range(variables)]
        for level in reversed(range(variables)):
            row = [self._node(level, a, b) for a, b in zip(row[::2], row[1::2], strict=True)]
        self.root = row[0]

    def _add(self, low: int, high: int, weight: tuple[int, ...]) -> int:
        self.low.append(low)
        self.high.append(high)
        self.weight.append(weight)
        return len(self.low) - 1

    def _node(self, level: int, low: int, high: int) -> int:
        """The one node of this level with these children."""
        known = self.levels[level]
        if (low, high) not in known:
            weight = tuple(a + b for a, b in zip(self.weight[low], self.weight[high], strict=True))
            known[low, high] = self._add(low, high, weight)
        return known[low, high]

    def swap(self, level: int) -> None:
        """Exchange the variables of `level` and `level` + 1: nodes of `level` keep their place and weight."""
        upper = list(self.levels[level].values())
        self.levels[level + 1] = {}
        self.levels[level] = {}
        for node in upper:
            a, b = self.low[node], self.high[node]
            low = self._node(level + 1, self.low[a], self.low[b])
            high = self._node(level + 1, self.high[a], self.high[b])
            self.low[node], self.high[node] = low, high
            self.levels[level][low, high] = node
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def path(self) -> Iterator[tuple[int, tuple[int, ...], tuple[int, ...]]]:
        """(variable, weight removed, weight kept) along the path on which every filter passes."""
        node = self.root
        for variable in self.order:
            yield variable, self.weight[self.high[node]], self.weight[self.low[node]]
            node = self.low[node]


def swaps(n: int) -> Iterator[int]:
    """Levels to swap, one after another, that lead from one order of n variables through all others."""
    if n < 2:
        return
    inner = list(swaps(n - 1))
    down = True
    for k in range(math.factorial(n - 1)):
        # the last variable walks through the others; between walks, these move on by one swap
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        if k < len(inner):
            yield inner[k] + down
        down = not down


def steps(counts: dict[int, tuple[int, ...]], names: list[str], width: int) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique fails, shapley, other counts removed) for every order and step.

    A count is a tuple whose first number counts documents; the others count those of them whose loss matters.
    """
    n = len(names)
    diagram = Diagram(n, counts, width)
    fails, unique, total, found = [0] * n, [0] * n, [0] * n, []

    def read() -> None:
        walked = list(diagram.path())
        fails[walked[0][0]] = walked[0][1][0]
        unique[walked[-1][0]] = walked[-1][1][0]
        for v, removed, _ in walked:
            total[v] += removed[0]
        found.append(("".join(names[v] for v in diagram.order), walked))

    read()
    for level in swaps(n):
        diagram.swap(level)
        read()
    return [
        (order, k, kept[0], removed[0], fails[v] - removed[0], unique[v], total[v], *removed[1:])
        for order, walked in found
        for k, (v, removed, kept) in enumerate(walked, 1)
    ]


# ---- masks ----------------------------------------------------------------------------------


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """One row per document: id, part, digest, n_words, n_distinct, n_upper, n_points, has_marks."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    found = plain.withColumn("words", F.expr(f"array_remove(split(btrim(text, '{BLANKS}'), r'{SPLIT}'), '')"))
    return found.select(
        "id",
        "part",
        F.unhex(F.sha2("text", 256)).alias("digest"),
        F.size("words").cast("long").alias("n_words"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"),
        F.length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long").alias("n_upper"),
        F.length("text").cast("long").alias("n_points"),
        F.col("text").rlike("[#$%&*|]").alias("has_marks"),
    )


def with_repeats(found: DataFrame) -> DataFrame:
    """Adds `repeats`: a smaller id has the same text. A null id is no smaller one and has none.

    `found` has id and digest, and is read twice, so it should be a table.
    """
    first = found.where("id is not null").groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    # digests of a single id meet nothing; of the others, only the smallest id is carried
    return found.join(first.select("digest", "first"), "digest", "left").withColumn("repeats", F.expr("coalesce(id > first, false)")).drop("first")


def audit(rows: DataFrame, failures: dict[str, str | Column], part_col: str = "part", lost: dict[str, Column] | None = None) -> DataFrame:
    """Steps of every order of the filters, per value of `part_col` (a null is an empty string).

    `failures` names each filter and its failure condition over `rows`; a condition that is null does
    not fail. `lost` names further counts and the rows they count. Columns: part, filter_order, step,
    kept, removed, redundant, unique_fails, one per name of `lost`, shapley; all orders and steps of
    every part, zeros included. Each row counts, repeated ones too; an empty table gives no part.
    """
    names, lost = list(failures), lost or {}
    if not 1 <= len(names) <= MOST_FILTERS:
        raise ValueError(f"{len(names)} filters; 1 to {MOST_FILTERS} can be audited")
    bits = [F.when(F.expr(f) if isinstance(f, str) else f, F.lit(1 << i)).otherwise(0) for i, f in enumerate(failures.values())]
    mask = bits[0]
    for bit in bits[1:]:
        mask = mask + bit
    part = F.coalesce(F.col(part_col).cast("string"), F.lit(""))
    flags = {f"c{i}": F.coalesce(condition, F.lit(False)) for i, condition in enumerate(lost.values())}
    masked = rows.select(part.alias("part"), mask.alias("mask"), *[flag.alias(k) for k, flag in flags.items()])
    counted = masked.groupBy("part", "mask").agg(F.count("*").alias("n"), *[F.count_if(F.col(k)).alias(k) for k in flags])
    # a part has at most 2^filters masks
    gathered = counted.groupBy("part").agg(F.collect_list(F.struct("mask", F.array("n", *flags).alias("counts"))).alias("masks"))

    extra = "".join(f", {k} long" for k in flags)
    kind, schema = c.arrow_schema(
        f"part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, shapley long{extra}"
    )
    width = 1 + len(flags)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = steps({m["mask"]: tuple(m["counts"]) for m in row["masks"]}, names, width)
                columns = [[row["part"]] * len(found), *map(list, zip(*found, strict=True))]
                yield from c.emit(dict(zip(schema.names, columns, strict=True)), schema)

    made = gathered.mapInArrow(run, kind)
    return made.select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", *[F.col(k).alias(name) for k, name in zip(flags, lost, strict=True)], "shapley"
    )


def audit_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """`audit` of the five text filters, with the good and the toxic labelled documents that each step loses.

    A null text is an empty one. A document with several rows of labels is good, or toxic, if any row
    says so; one without an id has no labels, and no smaller id than its own. Extra columns are not read.
    """
    marks = labels.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.bool_or(F.expr("quality = 1")).alias("good"), F.bool_or(F.expr("toxic = 1")).alias("toxic"))
    found = c.stored(measured(docs, id_col, text_col, part_col), "filter-measures")
    return audit(with_repeats(found.join(marks, "id", "left")), FAILURES, lost={"good_lost": F.col("good"), "toxic_lost": F.col("toxic")})
