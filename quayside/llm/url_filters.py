"""URL filters as a temporal join: what a list said about a host at the time its page was fetched.

List entries are dated: on a day a list starts or stops to name a pattern, a host or one of its
parent domains. Consecutive entries of a (list, pattern) become validity intervals, half open. A
capture is joined on each suffix of its host, and of those only intervals that hold its fetch time
count: an as-of join without sorting the captures of a host together. The longest pattern decides,
then the list's name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HOST = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)"


def host(url):
    """Lower-case host of a column of URLs; null without one."""
    found = F.lower(F.regexp_extract(url, HOST, 1))
    return F.when(found != "", found)


def intervals(entries: DataFrame) -> DataFrame:
    """(list, pattern, since, until) from entries (list, pattern, day, listed).

    An entry holds until the next later day of its list and pattern. Of entries of one day, being
    listed wins. Entries with a null in any of the four are passed over; repeated entries count once.
    """
    known = entries.dropna(subset=["list", "pattern", "day", "listed"])
    daily = known.groupBy("list", F.lower("pattern").alias("pattern"), "day").agg(F.max("listed").alias("listed"))
    ordered = Window.partitionBy("list", "pattern").orderBy("day")
    spans = daily.withColumn("until", F.lead("day").over(ordered))
    return spans.where("listed").select("list", "pattern", F.col("day").alias("since"), "until")


def judge(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", time_col: str = "fetched") -> DataFrame:
    """One row per id of `captures`: id, host, fetched, blocked, list, pattern.

    A capture without an id is left out; without a host or a fetch time it is not blocked, and list
    and pattern are null. Repeated rows give one row; of different rows under one id the
    smallest (fetched, host) that is blocked decides, else the smallest. An empty list blocks
    nothing. Other columns are not read.
    """
    capture = captures.select(
        F.col(id_col).alias("id"), host(F.col(url_col).cast("string")).alias("host"), F.col(time_col).cast("date").alias("fetched")
    ).where("id is not null").distinct()
    suffix = F.expr(
        "transform(filter(sequence(1, size(split(host, '[.]'))), i -> i < size(split(host, '[.]')) or i = 1), "
        "i -> array_join(slice(split(host, '[.]'), i, size(split(host, '[.]'))), '.'))"
    )
    part = capture.where("host is not null and fetched is not null").select("id", "host", "fetched", F.explode(suffix).alias("pattern"))
    spans = intervals(entries)
    hit = part.join(spans, "pattern").where("fetched >= since and (until is null or fetched < until)")
    choice = F.struct((-F.length("pattern")).alias("size"), F.col("list"), F.col("pattern"))
    best = hit.groupBy("id", "host", "fetched").agg(F.min(choice).alias("best"))
    best = best.select(F.col("id").alias("hit_id"), F.col("host").alias("hit_host"), F.col("fetched").alias("hit_day"), "best")
    every = capture.join(best, F.expr("id = hit_id and host = hit_host and fetched = hit_day"), "left")
    one = every.groupBy("id").agg(F.min(F.struct(F.col("best").isNull().alias("free"), "fetched", "host", "best")).alias("x"))
    return one.select(
        F.col("id").alias(id_col), F.col("x.host").alias("host"), F.col("x.fetched").alias("fetched"), (~F.col("x.free")).alias("blocked"),
        F.col("x.best.list").alias("list"), F.col("x.best.pattern").alias("pattern"),
    )
