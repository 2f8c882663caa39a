"""Registered queries of the corpus operators, and their SQL where SQL expresses them."""

from __future__ import annotations

import os
from collections.abc import Callable
from fractions import Fraction
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import (
    bpe,
    filter_audit,
    importance,
    licenses,
    lines,
    near_vectors,
    neighbours,
    ngram_join,
    packing,
    quality,
    substrings,
    toxicity,
    url_filters,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents"))


#: A host's entries, from a hash of its name: listed on a day of the year, struck off, listed again.
ENTRIES = """
select list, pattern, date_add(date '2024-01-01', cast(day as int)) as day, listed from (
  select 'spam' as list, host as pattern, h % 200 as day, true as listed from hosts where h % 3 = 0
  union all select 'spam', host, h % 200 + 40, false from hosts where h % 6 = 0
  union all select 'spam', host, h % 200 + 90, true from hosts where h % 12 = 0
  union all select 'adult', parent, h % 300, true from hosts where parent is not null and h % 11 = 0
  union all select 'adult', parent, h % 300 + 30, false from hosts where parent is not null and h % 11 = 0)
"""


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page, fetched on a day of 2024 by its id, against entries dated by a hash of the host."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url").withColumn("fetched", F.expr("date_add(date '2024-01-01', cast(pmod(page_id * 7, 366) as int))"))
    hosts = pages.select(url_filters.host(F.col("url")).alias("host")).where("host is not null").distinct()
    hosts = hosts.withColumn("h", F.crc32(F.col("host").cast("binary"))).withColumn(
        "parent", F.expr("if(size(split(host, '[.]')) > 3, substring(host, instr(host, '.') + 1), null)")
    )
    entries = spark.sql(ENTRIES.replace("hosts", "{hosts}"), hosts=hosts)
    return url_filters.judge(pages, entries)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, vectors.where("vec_id % 50 = 0"))


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.dedup(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.decide(table(spark, sf_dir, "documents"), min_words=1)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.dedup(table(spark, sf_dir, "embeddings"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, fold = table(spark, sf_dir, "documents"), quality.remainder("doc_id", 5)
    model = quality.train(docs, table(spark, sf_dir, "labels"), fold != 0)
    return quality.score(docs, model).select("doc_id", (fold == 0).alias("held_out"), "score", "predicted")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, fold = table(spark, sf_dir, "documents"), quality.remainder("doc_id", 4)
    net = toxicity.train(docs, table(spark, sf_dir, "labels"), fold != 2)
    return toxicity.score(docs, net).select("doc_id", (fold == 2).alias("held_out"), "score", "predicted")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_ngram_join, op2_url_filters, op3_packing, op4_neighbours, op5_substrings, op6_lines, op7_bpe, op8_near_vectors,
        op9_quality, op10_toxicity, op11_filter_audit, op12_importance, op13_licenses,
    )
} | {"pipeline": _pipeline}


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, run so that local Python workers find this package wherever the session was started."""
    root = str(Path(__file__).resolve().parents[2])

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        known = spark.sparkContext.environment.get("PYTHONPATH", "")
        if root not in known.split(os.pathsep):
            spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, known) if x)
        return query(spark, sf_dir)

    return run


# DuckDB has no crc32, so the hosts' is folded bit by bit.
_OP2 = """
with captures as (
  select page_id, nullif(lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') as host,
         date '2024-01-01' + cast(page_id * 7 % 366 as int) as fetched
  from pages),
named as (select distinct host from captures where host is not null),
hosts as (
  select host, list_reduce(list_prepend(4294967295::bigint, list_transform(range(0, octet_length(encode(host))),
             lambda i: ord(host[i + 1])::bigint)),
           lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(0, 8)),
             lambda x, step: case when x & 1 = 1 then xor(x >> 1, 3988292384::bigint) else x >> 1 end)) as crc,
         case when len(string_split(host, '.')) > 3 then substring(host, position('.' in host) + 1) end as parent
  from named),
hashed as (select host, parent, xor(crc, 4294967295::bigint) as h from hosts),
entries as (
  select 'spam' as list, host as pattern, h % 200 as day, true as listed from hashed where h % 3 = 0
  union all select 'spam', host, h % 200 + 40, false from hashed where h % 6 = 0
  union all select 'spam', host, h % 200 + 90, true from hashed where h % 12 = 0
  union all select 'adult', parent, h % 300, true from hashed where parent is not null and h % 11 = 0
  union all select 'adult', parent, h % 300 + 30, false from hashed where parent is not null and h % 11 = 0),
daily as (select list, pattern, date '2024-01-01' + cast(day as int) as day, bool_or(listed) as listed from entries group by all),
spans as (
  select list, pattern, day as since, lead(day) over (partition by list, pattern order by day) as until, listed from daily),
suffixes as (
  select page_id, host, fetched, array_to_string(parts[i:], '.') as pattern
  from (select *, string_split(host, '.') as parts from captures where host is not null), unnest(range(1, len(parts) + 1)) as u(i)
  where i < len(parts) or i = 1),
hits as (
  select page_id, s.list, s.pattern,
         row_number() over (partition by page_id order by -length(s.pattern), s.list, s.pattern) as place
  from suffixes x join spans s on x.pattern = s.pattern and s.listed and x.fetched >= s.since and (s.until is null or x.fetched < s.until))
select c.page_id, c.host, c.fetched, h.page_id is not null as blocked, h.list as list, h.pattern as pattern
from captures c left join hits h on h.page_id = c.page_id and h.place = 1
"""

_WORDS = r"""
words as (select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w from documents)
"""

_OP5 = f"""
with {_WORDS},
starts as (select doc_id, unnest(range(1, len(w) - 18)) as s, w from words where len(w) >= 20),
windows as (select doc_id, s, array_to_string(w[s:s + 19], ' ') as x from starts),
ranked as (select doc_id, s, row_number() over (partition by x order by doc_id, s) as k from windows),
gone as (select distinct doc_id, unnest(range(s, s + 20)) as i from ranked where k > 1),
cut as (select doc_id, list(i) as g from gone group by doc_id),
kept as (
  select doc_id, len(w) as n, coalesce(len(g), 0) as r,
         array_to_string(case when g is null then w else list_filter(w, lambda x, i: not list_contains(g, i)) end, ' ') as t
  from words left join cut using (doc_id))
select doc_id, cast(n as bigint) as n_words, cast(r as bigint) as n_removed, sha256(t) as kept_sha256 from kept
"""

_OP8 = """
with recursive usable as (
  select vec_id, label, list_transform(embedding, lambda x: x::double) as v from embeddings
  where embedding is not null and label is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0),
links as (
  select a.vec_id as a, b.vec_id as b from usable a join usable b
    on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
   and list_cosine_similarity(a.v, b.v) >= 0.93),
reach(a, b) as (select vec_id, vec_id from embeddings union select r.a, l.b from reach r join links l on l.a = r.b),
root as (select a, min(b) as m from reach group by a)
select e.vec_id, cast(count(l.b) as bigint) as n_links, r.m as component_id, e.vec_id = r.m as kept
from embeddings e join root r on r.a = e.vec_id left join links l on l.a = e.vec_id group by e.vec_id, r.m
"""

_OP11 = r"""
with doc as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as w
  from documents),
marks as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
judged as (
  select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
    len(w) < 100 as a, 100 * len(list_distinct(w)) < 80 * len(w) as b,
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) as c, regexp_matches(t, '[#$%&*|]') as d,
    coalesce(d.doc_id > min(d.doc_id) over (partition by t), false) as e
  from doc d left join marks m on m.doc_id = d.doc_id),
tallied as (
  select part, a, b, c, d, e, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from judged group by all),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
orders as (
  select p.x || q.x || r.x || s.x || t.x as filter_order from letters p, letters q, letters r, letters s, letters t
  where len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
flags as (
  select part, n, good, toxic, map(['A', 'B', 'C', 'D', 'E'], [a, b, c, d, e]) as f, a::int + b::int + c::int + d::int + e::int as fails from tallied),
walked as (
  select o.filter_order, k.step, g.part, n, good, toxic, fails, f[o.filter_order[k.step]] as here,
         len(list_filter(range(1, k.step), lambda i: f[o.filter_order[i]])) > 0 as before
  from flags g, orders o, (select unnest(range(1, 6)) as step) k),
summed as (
  select part, filter_order, step,
    coalesce(sum(n) filter (not here and not before), 0) as kept, coalesce(sum(n) filter (here and not before), 0) as removed,
    coalesce(sum(n) filter (here and before), 0) as redundant, coalesce(sum(n) filter (here and fails = 1), 0) as unique_fails,
    coalesce(sum(good) filter (here and not before), 0) as good_lost, coalesce(sum(toxic) filter (here and not before), 0) as toxic_lost
  from walked group by all)
select part, filter_order, cast(step as int) as step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
  cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost,
  cast(toxic_lost as bigint) as toxic_lost,
  cast(sum(removed) over (partition by part, filter_order[step]) as bigint) as shapley
from summed
"""

_OP12 = r"""
with recursive bits as (
  select i, 0 as k, i::bigint as x from range(0, 256) r(i)
  union all
  select i, k + 1, case when x & 1 = 1 then xor(x >> 1, 3988292384::bigint) else x >> 1 end from bits where k < 8),
crc_table as (select list(x order by i) as t from bits where k = 8),
texts as (select doc_id, text, true as own from documents union all select item_id, text, false from benchmark),
split as (
  select row_number() over () as r, doc_id, own,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as w from texts),
word as (select r, i, w[i] as w from (select r, w, unnest(range(1, len(w) + 1)) as i from split)),
spelled as (
  select w, list_transform(range(1, len(h), 2),
    lambda i: (16 * (strpos('0123456789ABCDEF', h[i]) - 1) + strpos('0123456789ABCDEF', h[i + 1]) - 1)::bigint) as b
  from (select w, hex(encode(w)) as h from (select distinct w from word))),
numbered as (
  select w, b, row_number() over () as id,
    list_reduce(list_prepend(4294967295::bigint, b), lambda crc, x: xor(crc >> 8, t[(xor(crc, x) & 255) + 1])) as c1
  from spelled, crc_table),
place as (
  select r, i, id as a, lead(id) over (partition by r order by i) as b, lead(id, 2) over (partition by r order by i) as c
  from word join numbered using (w)),
two as (
  select a, p.b, list_reduce(list_concat([x.c1, 32], y.b), lambda crc, x: xor(crc >> 8, t[(xor(crc, x) & 255) + 1])) as c2
  from (select distinct a, b from place where b is not null) p join numbered x on x.id = p.a join numbered y on y.id = p.b, crc_table),
three as (
  select a, p.b, c, list_reduce(list_concat([c2, 32], y.b), lambda crc, x: xor(crc >> 8, t[(xor(crc, x) & 255) + 1])) as c3
  from (select distinct a, b, c from place where c is not null) p join two using (a, b) join numbered y on y.id = p.c, crc_table),
feature as (
  select r, xor(c1, 4294967295::bigint) % 10000 as bucket from place join numbered on id = a
  union all select r, xor(c2, 4294967295::bigint) % 10000 from place join two using (a, b)
  union all select r, xor(c3, 4294967295::bigint) % 10000 from place join three using (a, b, c)),
counted as (
  select bucket, count(*) filter (own) as s, count(*) filter (not own) as t from feature join split using (r) group by bucket),
gain as (
  select bucket, floor(1000 * ln((t + 1)::double * (s_all + 10000) / ((s + 1)::double * (t_all + 10000))))::bigint as g
  from counted, (select sum(s)::bigint as s_all, sum(t)::bigint as t_all from counted)),
weighed as (select r, count(*) as n, sum(g)::bigint as weight from feature join gain using (bucket) group by r),
scored as (
  select doc_id, len(w) as n_words, coalesce(n, 0) as n_features, coalesce(weight, 0) as weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('42:' || doc_id)[1:8])::bigint + 0.5::double) / 4294967296::double)))::bigint as score
  from split left join weighed using (r) where own),
placed as (
  select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id) as k, count(*) filter (n_words >= 20) over () as m from scored)
select doc_id, cast(n_features as bigint) as n_features, cast(weight as bigint) as weight, cast(score as bigint) as score,
  cast(case when n_words >= 20 and k <= 5 * m // 100 then k end as bigint) as rank
from placed
"""

_OP13 = r"""
with doc as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') as w
  from documents),
phrases as (select p.phrase, p.label, string_split(p.phrase, ' ') as x from (values {phrases}) p(phrase, label)),
templates as (select row_number() over () as id, t.label, list_distinct(string_split(t.sentence, ' ')) as x from (values {templates}) t(label, sentence)),
places as (
  select d.doc_id, p.label, i.i as place from doc d, unnest(range(0, len(d.w))) as i(i), phrases p
  where d.w[i.i + 1:i.i + len(p.x)] = p.x),
base as (
  select doc_id, count(*) as n, min(place) as a, max(place) as z, list_sort(list(distinct label)) as labels from places group by doc_id),
blocks as (select d.doc_id, list_distinct(d.w[{step} * k.k + 1:{step} * k.k + {block}]) as b from doc d, unnest(range(0, (len(d.w) + {step} - 1) // {step})) as k(k)),
met as (
  select doc_id, label, len(list_intersect(b, x)) / len(x) as share from blocks, templates
  where len(list_intersect(b, x)) * {den} >= {num} * len(x)),
more as (select doc_id, list(distinct label) as labels, max(share) as share from met group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, cast(coalesce(b.n, 0) as bigint) as n_base,
  cast(b.a as bigint) as first_word, cast(b.z as bigint) as last_word,
  coalesce(array_to_string(b.labels, ','), '') as base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(m.labels, [])))), ','), '') as labels,
  case when b.n > 0 then 1.0::double else coalesce(m.share, 0)::double end as score
from doc d left join base b on b.doc_id = d.doc_id left join more m on m.doc_id = d.doc_id
"""


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" for x in row) + ")" for row in rows)


def _op13() -> str:
    share = Fraction(str(licenses.THRESHOLD))
    return _OP13.format(
        phrases=_values(licenses.PHRASES.items()), templates=_values(licenses.TEMPLATES),
        step=licenses.STEP, block=licenses.BLOCK, num=share.numerator, den=share.denominator,
    )


ORACLE_SQL: dict[str, str] = {
    "op2_url_filters": _OP2, "op5_substrings": _OP5, "op8_near_vectors": _OP8, "op11_filter_audit": _OP11,
    "op12_importance": _OP12, "op13_licenses": _op13(),
}
