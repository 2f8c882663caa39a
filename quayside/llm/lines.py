"""Line dedup by an exact set-similarity join, in DataFrame operations only.

A line is the set of its words. Two lines match when the Jaccard similarity of their sets is
`threshold` or more; a line is removed when a line that comes earlier, by (document, line), matches.

1. Rarity: words are counted in 2^18 hashed buckets, 2 MB whatever the input. Each line's words are
   ordered by (bucket count, name), one total order for all lines, which is all exactness needs.
2. Equal sets: every line but the first of its set goes; first lines stand for their set from here.
3. Prefix filter: matching sets share a word among the first n - ceil(threshold * n) + 1 of each.
   Position and length filters bound the overlap that is left after the shared word, and a 64-bit
   parity sketch bounds the symmetric difference, all inside the join condition.
4. First each set meets the earliest set of its prefix words only, which settles groups of near
   copies with as many pairs as sets. What is not removed by then meets every earlier set.
5. Candidates are verified on their whole sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quayside.llm.common import dense, marked, marks, stored

THRESHOLD = 0.9
#: Lines of fewer distinct words are never judged; blank lines have none.
MIN_WORDS = 1
BUCKET_BITS = 18
#: An ordered word: rank above, name below.
NAME_BITS = 52

BLANKS = " \\t\\n\\u000B\\u000C\\r"
SPLIT = "[\\x20\\x09-\\x0D]+"


def _ratio(threshold: float) -> tuple[int, int]:
    """The threshold as an exact fraction of integers."""
    from fractions import Fraction

    f = Fraction(str(threshold))
    return f.numerator, f.denominator


def _words(text: str) -> str:
    """SQL for the words of a text; one empty word for a blank text."""
    return f"split(btrim({text}, '{BLANKS}'), r'{SPLIT}')"


def _lines(docs: DataFrame) -> DataFrame:
    return docs.where("text is not null").select("id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def rarity(docs: DataFrame) -> DataFrame:
    """One row: the rank of each bucket as an array, larger for buckets with more words, in the bits above a name."""
    # words are named after they are exploded: compiled code, which a lambda over their array is not
    word = docs.where("text is not null").select(F.explode(F.expr(_words("text"))).alias("w")).select(F.xxhash64("w").alias("w"))
    count = word.groupBy(F.expr(f"cast(shiftrightunsigned(w, {64 - BUCKET_BITS}) as int)").alias("bucket")).count()
    rank = F.expr(f"shiftleft(cast(least(log2(count + 1) * 32, 2047) as bigint), {NAME_BITS})")
    return dense(count.select(F.col("bucket").cast("long").alias("index"), rank.alias("value")), 1 << BUCKET_BITS).withColumnRenamed("values", "ranks")


def _with_sets(lines: DataFrame, ranks: DataFrame) -> DataFrame:
    """Adds `words`, the line's distinct ordered words; rare ones first."""
    mask = (1 << NAME_BITS) - 1
    # an array that holds no null is sorted without comparing objects
    ordered = (
        f"sort_array(array_distinct(transform({_words('line')}, "
        f"w -> coalesce(ranks[shiftrightunsigned(xxhash64(w), {64 - BUCKET_BITS})], 0L) | (xxhash64(w) & {mask}))))"
    )
    return lines.withColumn("ranks", ranks.scalar()).withColumn("words", F.expr(ordered)).drop("ranks")


def _fits(num: int, den: int) -> Column:
    """Length, position and parity filters of the pair (a, b) that shares a word at places p and q."""
    need = f"((({num} * (n + m)) + {num + den - 1}) div {num + den})"
    return F.expr(
        f"{num} * n <= {den} * m and {num} * m <= {den} * n "
        f"and 1 + least(n - p - 1, m - q - 1) >= {need} "
        f"and bit_count(s ^ t) <= n + m - 2 * {need}"
    )


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, min_words: int = MIN_WORDS) -> DataFrame:
    """One row per line of every row with an id and a text: id, line_no (from 0), n_words, removed.

    Lines end at each line feed. Words are maximal runs outside 0x20 and 0x09-0x0D, unchanged; n_words
    counts distinct ones. Lines of fewer than `min_words` are always kept. Null texts have no lines, an
    empty text one blank line; rows without an id are left out and stay untouched. Rows that share an
    id are one document: an equal (id, line) is the same place, and of different texts under one id
    each line is judged by its own words. Other columns are not read; an empty table gives an
    empty result. Words are compared by the rank and 52 bits of their 64-bit name.
    """
    return _decide(docs, id_col, text_col, threshold, min_words)[0]


def _decide(docs: DataFrame, id_col: str, text_col: str, threshold: float, min_words: int) -> tuple[DataFrame, DataFrame]:
    num, den = _ratio(threshold)
    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null")
    ranks = stored(rarity(plain), "word-ranks")
    sized = _with_sets(_lines(plain), ranks).withColumn("blank", F.expr(f"length(btrim(line, '{BLANKS}')) = 0"))
    n = F.when(F.col("blank"), 0).otherwise(F.size("words"))
    lines = stored(
        sized.select(
            "id",
            "line_no",
            n.alias("n"),
            F.xxhash64("words").alias("set"),
            F.expr(f"slice(words, 1, size(words) - (({num} * size(words) + {den - 1}) div {den}) + 1)").alias("prefix"),
            F.expr("aggregate(words, 0L, (a, h) -> a ^ shiftleft(1L, cast(h & 63 as int)))").alias("sketch"),
        ),
        "lines",
    )
    judged = lines.where(F.col("n") >= min_words)
    at = F.struct("id", "line_no")
    first = judged.groupBy("set", "n").agg(F.min(at).alias("at"), F.any_value("prefix").alias("prefix"), F.any_value("sketch").alias("sketch"))

    # only sets of this size or more have a match that is not equal to them
    posting = first.where(F.expr(f"{den - num} * n >= {num}")).select(
        F.posexplode("prefix").alias("p", "word"), "n", F.col("sketch").alias("s"), "at"
    )
    group = Window.partitionBy("word")
    posting = stored(
        posting.withColumn("low", F.min(F.struct("at", "n", "p", "s")).over(group)).withColumn("high", F.max("at").over(group)).where("low.at < high").drop("high"),
        "line-postings",
    )
    fits = _fits(num, den)
    star = (
        posting.where("at > low.at")
        .select("n", "p", "s", "at", F.col("low.at").alias("with"), F.col("low.n").alias("m"), F.col("low.p").alias("q"), F.col("low.s").alias("t"))
        .where(fits)
        .select("at", "with")
        .distinct()
    )
    gone = stored(_verified(star, plain, ranks, num, den).select("at").distinct(), "lines-gone")
    later = posting.join(gone, "at", "left_anti").select("word", "n", "p", "s", "at")
    earlier = posting.select("word", F.col("n").alias("m"), F.col("p").alias("q"), F.col("s").alias("t"), F.col("at").alias("with"))
    more = later.join(earlier, "word").where("`with` < at").where(fits).select("at", "with").distinct()
    gone = gone.unionByName(_verified(more, plain, ranks, num, den).select("at")).distinct()

    head = first.select("set", F.col("n").alias("size"), "at").join(gone.withColumn("similar", F.lit(True)), "at", "left")
    decided = lines.join(
        head.select("set", "size", F.col("at").alias("head"), "similar"),
        (lines["set"] == head["set"]) & (lines["n"] == head["size"]),
        "left",
    ).select(
        lines["id"], lines["line_no"], lines["n"].alias("n_words"),
        F.expr("head is not null and (similar is not null or head <> struct(id, line_no))").alias("removed"),
    )
    return decided.withColumnRenamed("id", id_col), plain


def _verified(pairs: DataFrame, plain: DataFrame, ranks: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (at, with) whose whole sets match."""
    pairs = stored(pairs, "line-pairs")
    asked = pairs.select("at").union(pairs.select("with")).distinct().select("at.id", "at.line_no")
    owner = asked.select("id").distinct()
    whole = plain.where(marked("id", marks(owner))).join(owner, "id", "left_semi")
    sets = _with_sets(_lines(whole).join(asked, ["id", "line_no"], "left_semi"), ranks).select(F.struct("id", "line_no").alias("place"), "words")
    sets = stored(sets, "line-sets")
    both = pairs.join(sets.select(F.col("place").alias("at"), F.col("words").alias("x")), "at").join(
        sets.select(F.col("place").alias("with"), F.col("words").alias("y")), "with"
    )
    common = both.withColumn("common", F.size(F.array_intersect("x", "y")))
    return common.where(f"{den} * common >= {num} * (size(x) + size(y) - common)").select("at", "with")


def without_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, min_words: int = MIN_WORDS, drop_emptied: bool = False
) -> DataFrame:
    """`docs` with removed lines taken out of the text; other texts and all other columns stay as they are.

    Null and empty texts and rows without an id stay untouched; rows that share an id lose the same
    line numbers. With `drop_emptied`, a row that lost lines and has only blank ones left goes. Columns may
    have any names; an empty table gives an empty result.
    """
    decided, _ = _decide(docs, id_col, text_col, threshold, min_words)
    cut = decided.where("removed").groupBy(F.col(id_col).alias("_cut_id")).agg(F.sort_array(F.collect_set("line_no")).alias("_cut"))
    joined = docs.join(cut, docs[id_col].cast("long") == cut["_cut_id"], "left")
    text, gone = docs[text_col], cut["_cut"]
    lines = F.split(text, "\n")
    # the stretches between removed lines
    kept = F.array_join(
        F.flatten(
            F.transform(
                F.sequence(F.lit(0), F.size(gone)),
                lambda i: _stretch(lines, gone, i),
            )
        ),
        "\n",
    )
    left = F.when(gone.isNull(), text).otherwise(kept)
    if drop_emptied:
        joined = joined.where(gone.isNull() | left.isNull() | left.rlike("[^\\x20\\x09-\\x0D]"))
    return joined.select(*[left.alias(x) if x == text_col else docs[x] for x in docs.columns])


def _stretch(lines: Column, cut: Column, i: Column) -> Column:
    start = F.when(i == 0, 0).otherwise(F.get(cut, i - 1) + 1)
    stop = F.least(F.coalesce(F.get(cut, i), F.size(lines)), F.size(lines))
    return F.slice(lines, start + 1, F.greatest(stop - start, F.lit(0)))
