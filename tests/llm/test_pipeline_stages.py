"""Every pipeline stage against brute force on a small corpus, each on its own input."""

import collections
import os
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quayside.llm import lines, near_vectors, packing, quality, toxicity, url_filters
from tests.llm.test_operators import WORDS, line_decisions, linked

GOOD = [" ".join(f"calm{(k * 7 + j * 3) % 23} river{(k + j) % 19} stone{j}." for j in range(30)) for k in range(40)]
BAD = [" ".join(f"BUY$$ {(k * 13 + j) % 89} click!!! {j % 7}xx" for j in range(30)) for k in range(40)]
LONG = " ".join(f"passage{i}" for i in range(60))
MORE = [
    (900, LONG + " alpha beta", "en"), (901, "gamma delta " + LONG, "fr"), (902, LONG + " alpha beta", "en"), (903, LONG + " alpha beta zeta", None),
    (904, None, "en"), (905, "", "en"), (906, " \n ", ""), (None, GOOD[0], "en"), (907, GOOD[1] + "\n" + GOOD[2] + "\nan own line of nine words to be kept here", "de"),
    (908, GOOD[3] + "\n" + GOOD[4], "de"), (909, "é " * 900, "fr"), (910, LONG.upper(), "en"),
]


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, t, "en") for i, t in enumerate(GOOD + BAD)] + MORE
    docs = spark.createDataFrame([(i, t, x, "web", len(t or ""), "clash", "clash") for i, t, x in rows], "doc_id long, text string, lang string, source string, n_chars long, id string, _cut string")
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(i < len(GOOD)), 0) for i in range(len(GOOD + BAD))] + [(900, 1, 0), (901, 1, 0), (900, 1, 0), (77, None, 0), (None, 1, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


@pytest.fixture(scope="module")
def stages(spark, corpus, tmp_path_factory):
    """(input, output) rows of every stage, each written and read again."""
    made, docs = {}, spark.read.parquet(f"{corpus}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path_factory.mktemp('stage')}/out"
        stage(spark, docs, corpus).write.parquet(path)
        out = spark.read.parquet(path)
        made[name] = docs, out
        docs = out
    return made


def key(r):
    return tuple(r)


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_columns_stay(stages):
    for name, (before, after) in stages.items():
        if name != "best-fit packing":
            assert after.schema == before.schema, name


def test_quality_stage(spark, corpus, stages):
    before, after = stages["quality classifier"]
    model = quality.train(before, spark.read.parquet(f"{corpus}/labels.parquet"), quality.remainder("doc_id", 5) != 0)
    rows = before.collect()
    scores = model.scorer().scores([(r["text"] or "").encode() for r in rows])
    want = collections.Counter(key(r) for r, s in zip(rows, scores, strict=True) if s >= quality.THRESHOLD)
    assert collections.Counter(map(key, after.collect())) == want
    kept = {r["doc_id"] for r in after.collect()}
    assert sum(i in kept for i in range(len(GOOD))) >= 38 and sum(i in kept for i in range(len(GOOD), len(GOOD + BAD))) <= 2


def test_line_stage(stages):
    before, after = stages["line dedup"]
    cut = line_decisions(texts(before), lines.THRESHOLD)
    want = collections.Counter()
    for r in before.collect():
        t = r["text"]
        if r["doc_id"] is not None and t is not None:
            here = t.split("\n")
            t = "\n".join(x for k, x in enumerate(here) if not cut[(r["doc_id"], k)][1])
        want[key(r[:1] + (t,) + r[2:])] += 1
    assert collections.Counter(map(key, after.collect())) == want
    gone = {r["doc_id"] for r in after.collect() if r["text"] is not None and not WORDS.search(r["text"])} - {905, 906}
    kept = lines.without_repeats(before, drop_emptied=True).collect()
    assert gone and {r["doc_id"] for r in kept} == {r["doc_id"] for r in after.collect()} - gone


def test_near_duplicate_stage(stages):
    before, after = stages["n-gram Jaccard join"]
    root = {i: r for i, _, r in linked(texts(before)) if i is not None}
    want = collections.Counter(key(r) for r in before.collect() if r["doc_id"] is None or root[r["doc_id"]] == r["doc_id"])
    assert collections.Counter(map(key, after.collect())) == want


def test_substring_stage(stages):
    before, after = stages["substring dedup"]
    seen, want = set(), {}
    for r in sorted((r for r in before.collect() if r["doc_id"] is not None), key=lambda r: r["doc_id"]):
        w = WORDS.findall(r["text"] or "")
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            window = tuple(w[k : k + 20])
            if window in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(window)
        want[r["doc_id"]] = " ".join(x for x, g in zip(w, gone, strict=True) if not g) if any(gone) else r["text"]
    assert {r["doc_id"]: r["text"] for r in after.collect() if r["doc_id"] is not None} == want
    assert after.count() == before.count()
    assert any(want[r["doc_id"]] != r["text"] for r in before.collect() if r["doc_id"] is not None)


def test_packing_stage(stages):
    import public_tokenizers
    from tokenizers import Tokenizer

    before, after = stages["best-fit packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    want = collections.Counter()
    for i, t in texts(before):
        want[(i, len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1)] += 1
    pieces = after.collect()
    total, room = collections.Counter(), collections.defaultdict(list)
    for r in pieces:
        total[r["doc_id"]] += r["length"]
        room[r["sequence_id"]].append((r["offset"], r["length"]))
    assert sum(want.values()) == sum(r["piece"] == 0 for r in pieces)
    assert total == sum((collections.Counter({i: n * k}) for (i, n), k in want.items()), collections.Counter())
    for places in room.values():
        places.sort()
        assert [a for a, _ in places] == [0, *np.cumsum([n for _, n in places]).tolist()[:-1]] and sum(n for _, n in places) <= packing.CAPACITY


def test_run_gives_the_stages_rows_and_leaves_no_tables(spark, corpus, stages):

    root = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(root))
    got = corpus_pipeline.run(spark, corpus)
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(root)) - before}
    assert left == {*(n.replace(" ", "-") for n, _ in corpus_pipeline.STAGES[:-1]), "pieces", "piece-counts"}
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    count = lambda df: collections.Counter(tuple(r[c] for c in columns) for r in df.collect())
    assert count(got) == count(stages["best-fit packing"][1])


# ---- edges of single operators --------------------------------------------------------------


def test_good_only_on_odd_rows(spark):
    rows = [(None, GOOD[0], "x"), (1, None, "x"), (2, "", "x"), (2, "", "x"), (3, BAD[0], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    model = quality.fit([t.encode() for t in GOOD], [t.encode() for t in BAD])
    kept = quality.good_only(docs, model)
    assert kept.columns == docs.columns and [r["doc_id"] for r in kept.collect()] == [None]
    assert quality.good_only(docs.where("false"), model).count() == 0
    assert quality.score(docs.where("false"), model).count() == toxicity.score(docs.where("false"), toxicity.fit([], [])).count() == 0


def test_labels_are_sampled_without_the_texts(spark):
    docs = spark.createDataFrame([(i % 300, f"text {i % 300}") for i in range(600)] + [(None, "lost"), (7, None)], "doc_id long, text string")
    labels = spark.range(300).selectExpr("id as doc_id", "cast(id % 3 = 0 as int) as quality").unionByName(spark.createDataFrame([(0, 0), (None, 1), (3, None)], "doc_id long, quality int"))
    learn = quality.remainder("doc_id", 5) != 0
    able = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5]
    good, bad = quality.sample(docs, labels, learn, "quality", 1000, 50)
    assert sorted(good) == sorted(f"text {i}".encode() for i in able if i % 3 == 0 and i)  # 0 has both labels
    assert sorted(bad) == sorted(f"text {i}".encode() for i in able if i % 3)
    some, _ = quality.sample(docs.repartition(7), labels.repartition(5), learn, "quality", 20, 50)
    assert len(some) == 20 and set(some) <= set(good)
    assert quality.sample(docs, labels, learn, "quality", 20, 50)[0] == some
    assert quality.sample(docs.where("false"), labels, learn, "quality", 20, 50) == ([], [])
    assert quality.sample(docs, labels.where("false"), learn, "quality", 20, 50) == ([], [])


def test_text_labels_of_vectors(spark):
    rows = [(i, [1.0, float(i % 2), 0.01 * i], label) for i, label in enumerate(["a", "a", "a", "b", "b", None, "c"])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_vectors.dedup(vectors).collect()}
    assert got == {0: (1, 0), 1: (0, 1), 2: (1, 0), 3: (0, 3), 4: (0, 4), 5: (0, 5), 6: (0, 6)}


def test_no_captures(spark):
    pages = spark.createDataFrame([], "page_id long, url string, fetched date")
    entries = spark.createDataFrame([("x", "b.org", True)], "list string, pattern string, listed boolean").withColumn("day", F.lit("2024-01-01").cast("date"))
    assert url_filters.judge(pages, entries).count() == 0
