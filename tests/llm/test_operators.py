"""Every operator against brute force, on edge rows and on the smallest tables."""

import collections
import hashlib
import math
import pathlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from quayside.llm import bpe, common, graph, lines, near_vectors, neighbours, ngram_join, packing, quality, queries, segments, substrings, toxicity, url_filters
from tests.conftest import SF_DIR

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
BASE = " ".join(f"w{i}" for i in range(80))
EDGE = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "ONE"), (6, "a b c d"), (7, BASE), (8, BASE), (8, BASE),
    (9, BASE.replace("w40", "x")), (10, BASE.upper()), (11, "w " * 300), (12, "é " * 60 + BASE), (13, BASE + "\n" + BASE),
    (14, "\n".join(["p q r s t u v"] * 3)), (15, "x" * 5000), (None, BASE), (16, " ".join(f"w{i}" for i in range(5, 80))),
]


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t, "clash", "clash", None) for i, t in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, id string, h string, starts string")


@pytest.fixture(scope="module")
def nothing(edge):
    return edge.where("false")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def shingles(text):
    w = WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))) if w else frozenset()


def linked(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return collections.Counter((i, len(s), find(i)) for i, s in sets) + collections.Counter((None, len(shingles(t)), None) for i, t in rows if i is None)


@pytest.mark.parametrize("name", ["edge", "documents", "nothing"])
def test_ngram_join(name, request):
    df = request.getfixturevalue(name)
    got = collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.join(df).collect())
    assert got == linked(texts(df))


def test_one_of_each_keeps_columns(edge):
    kept = ngram_join.one_of_each(edge)
    assert kept.columns == edge.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, 2, 3, 4, 6, 7, 11, 14, 15, None}


def test_count_tree_loses_nothing():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 5, (300, ngram_join.GROUPS)).astype(np.uint16)
    sizes = counts.sum(1, dtype=np.int64)
    found = {(a, b) for q, p in ngram_join.CountTree(counts, sizes).search(counts, sizes, 3, 4) for a, b in zip(q.tolist(), p.tolist(), strict=True)}
    for a in range(300):
        bound = np.minimum(counts[a], counts).sum(1, dtype=np.int64)
        fits = (bound >= ngram_join.needed(sizes[a], sizes, 3, 4)) & (3 * sizes[a] <= 4 * sizes) & (3 * sizes <= 4 * sizes[a])
        assert {(a, int(b)) for b in np.flatnonzero(fits)} <= found


def test_blocks_give_away_no_pairs(spark, monkeypatch):
    """Forty texts share most of their many words: each pair shares a block and passes the summed minima, none is linked."""
    rows = [(i, " ".join([*(f"s{k}" for k in range(3800)), *(f"t{i}x{k}" for k in range(1200))])) for i in range(40)]
    made = []
    over = ngram_join.c.over_groups

    def counted(df, *args):
        out = over(df, *args)
        made.append((df.count(), out.count()))
        return out

    monkeypatch.setattr(ngram_join.c, "over_groups", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.join(df).collect())
    assert got == linked(rows)
    assert made and all(found <= read for read, found in made)


def test_parities_never_rule_out_a_link():
    rng = np.random.default_rng(3)
    one = [np.unique(rng.integers(0, 2**63, 900).astype(np.uint64)) for _ in range(30)]
    sets = one + [np.unique(np.concatenate([x[: len(x) - 40 * k], rng.integers(0, 2**63, 40 * k).astype(np.uint64)])) for k, x in enumerate(one)]
    odd = ngram_join._parities(np.concatenate(sets), np.repeat(np.arange(60), [len(x) for x in sets]), 60)
    for a in range(60):
        true = np.array([len(np.setxor1d(sets[a], y)) for y in sets])
        assert (ngram_join.apart(odd[[a] * 60], odd) <= true).all()


def removed(rows):
    seen, out = {}, {}
    for i, t in sorted({r for r in rows if r[0] is not None}, key=lambda r: r[0]):
        w = WORDS.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            if tuple(w[k : k + 20]) in seen:
                gone[k : k + 20] = [True] * 20
            seen.setdefault(tuple(w[k : k + 20]), 1)
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


@pytest.mark.parametrize("name", ["edge", "documents", "nothing"])
def test_substrings(name, request):
    df = request.getfixturevalue(name)
    rows = substrings.dedup(df).collect()
    assert len(rows) == df.count()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in rows if r["doc_id"] is not None} == removed(texts(df))
    assert substrings.without_repeats(df).columns == df.columns


def test_recompression_is_consistent_inside():
    rng = np.random.default_rng(2)
    words = rng.integers(1, 6, 400).astype(np.uint64)
    name, low, high = substrings.recompress(words, np.zeros(400, int))
    part = words[100:300]
    name2, low2, high2 = substrings.recompress(part, np.zeros(200, int))
    whole = {(a, b, n) for n, a, b in zip(name.tolist(), low.tolist(), high.tolist(), strict=True) if a >= 100 and b <= 300}
    inner = {(a + 100, b + 100, n) for n, a, b in zip(name2.tolist(), low2.tolist(), high2.tolist(), strict=True) if a >= 0 and b <= 200}
    assert whole == inner and whole


def line_decisions(rows, threshold):
    f, sets, seen, out = Fraction(str(threshold)), [], set(), {}
    for i, t in sorted({r for r in rows if r[0] is not None and r[1] is not None}, key=lambda r: r[0]):
        for k, line in enumerate(t.split("\n")):
            s = frozenset(WORDS.findall(line))
            hit = len(s) >= 1 and (s in seen or any(len(s & x) * f.denominator >= f.numerator * len(s | x) for x in sets))
            out[(i, k)] = (len(s), hit)
            if s and s not in seen:
                seen.add(s)
                sets.append(s)
    return out


def test_ngram_join_leaves_no_sets_members_or_shuffles(spark, documents):
    """Whole sets and memberships of blocks go when they have been used, shuffle files with the write they served."""
    root, local = pathlib.Path(spark.conf.get("spark.checkpoint.dir")), pathlib.Path(spark._jsc.sc().env().blockManager().diskBlockManager().localDirsString()[0])
    cleans = spark.conf.get(common.CLEAN_SHUFFLES)
    before, shuffles = set(root.iterdir()), set(local.rglob("shuffle_*.data"))
    found = ngram_join.join(documents)
    made = {x.name.rsplit("-", 1)[0] for x in set(root.iterdir()) - before}
    assert "ngram-links" in made and not made & {"ngram-sets", "ngram-asked", "ngram-members", "ngram-blocks"}
    written = set(local.rglob("shuffle_*.data")) - shuffles
    assert sum(x.stat().st_size for x in written) < 2e6, "only those of counts that the driver collects"
    assert spark.conf.get(common.CLEAN_SHUFFLES) == cleans
    assert found.count() == documents.count()


@pytest.mark.parametrize("name", ["edge", "documents", "nothing"])
@pytest.mark.parametrize("threshold", [0.9, 0.6])
def test_lines(name, threshold, request):
    df = request.getfixturevalue(name)
    want = line_decisions(texts(df), threshold)
    assert {(r["doc_id"], r["line_no"]): (r["n_words"], r["removed"]) for r in lines.decide(df, threshold=threshold).collect()} == want
    for r in lines.without_repeats(df, threshold=threshold).collect() if threshold == 0.9 else []:
        t = dict(texts(df))[r["doc_id"]]
        if r["doc_id"] is not None:
            assert r["text"] == (None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if not want[(r["doc_id"], k)][1]))


def test_lines_words_are_named_in_compiled_code_and_sorted_as_numbers(spark):
    """The two passes over all words: no lambda counts them, and the sorted array holds no null."""
    docs = spark.createDataFrame([(1, "a b a\nc")], "id long, text string")
    ranks = lines.rarity(docs)
    assert "explode(transform" not in ranks._jdf.queryExecution().optimizedPlan().toString()
    assert not lines._with_sets(lines._lines(docs), ranks).schema["words"].dataType.containsNull


@pytest.mark.parametrize("step", [bpe.STEP, 40])
def test_bpe(edge, step):
    encoding = segments.rank_encoding(bpe.VOCABULARY)
    want = collections.Counter()
    for i, t in texts(edge):
        ids = encoding.encode_ordinary(t or "")
        raw = np.array(ids, "<u4").tobytes()
        want[(i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())] += 1
    assert collections.Counter(tuple(r) for r in bpe.digests(edge, step=step, overlap=8).collect()) == want
    assert bpe.digests(edge.where("false")).count() == 0


def test_packing(edge, documents, nothing):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    for df in (edge, documents):
        rows = packing.pack(df).collect()
        want = collections.Counter()
        for i, t in texts(df):
            ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
            stop = (len(ids) - 1) % 1024 + 1
            for k, (a, b) in enumerate(zip([0, *range(stop, len(ids), 1024)], [*range(stop, len(ids) + 1, 1024)], strict=True)):
                want[(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
        assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
        sequence = collections.defaultdict(list)
        for r in rows:
            sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        for places in sequence.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= 1024
        assert len(sequence) <= math.ceil(sum(r["length"] for r in rows) / 1024) * 1.03 + 2
    assert packing.pack(nothing).count() == 0


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((60, 8))
    rows = [(i, [float(x) for x in base[i % 60] + 0.05 * rng.standard_normal(8)], i % 3 if i % 7 else None, "clash") for i in range(400)]
    rows += [(400, None, 1, ""), (401, [0.0] * 8, 1, ""), (402, [float("nan")] * 8, 1, ""), (403, [None] * 8, 1, ""), (None, [1.0] * 8, 1, ""), (404, rows[0][1], 0, "")]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, id string")


def usable(vectors):
    return [(r["vec_id"], np.array(r["embedding"]), r["label"]) for r in vectors.collect() if r["vec_id"] is not None and r["vec_id"] not in (400, 401, 402, 403)]


def cosine(a, b):
    return float(a @ b / math.sqrt(a @ a) / math.sqrt(b @ b))


def test_neighbours(vectors):
    rows = usable(vectors)
    got = collections.defaultdict(list)
    for r in neighbours.nearest(vectors, vectors.where("vec_id % 50 = 0"), factor=1.0, shard_rows=100).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], round(r["score"], 9)))
    for i, a, _ in rows:
        if i % 50 == 0:
            near = sorted(((-round(cosine(a, b), 9), j) for j, b, _ in rows if j != i))[:5]
            assert got.pop(i) == [(j, -s) for s, j in near]
    assert not got
    assert neighbours.nearest(vectors.where("false"), vectors).count() == 0


def test_near_vectors(vectors):
    rows = usable(vectors)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in near_vectors.dedup(vectors).collect()}
    links = collections.Counter()
    root = {i: i for i, *_ in rows}
    for k, (i, a, x) in enumerate(rows):
        for j, b, y in rows[:k]:
            if x is not None and x == y and cosine(a, b) >= 0.93:
                links[i] += 1
                links[j] += 1
                p, q = i, j
                while root[p] != p:
                    p = root[p]
                while root[q] != q:
                    q = root[q]
                root[max(p, q)] = min(p, q)
    assert sum(links[i] for i, *_ in rows) > 100
    found = sum(v[0] for v in got.values())
    assert 0.98 * sum(links.values()) <= found <= sum(links.values())
    assert all(got[i] == (0, i, True) for i in (400, 401, 402, 403)) and None in got
    assert near_vectors.dedup(vectors.where("false")).count() == 0


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 90), (90, 95)], "a long, b long")
    assert {tuple(r) for r in graph.components(edges).collect()} == {(i, 1) for i in range(1, 41)} | {(x, 90) for x in (90, 95, 100)}
    assert graph.components(edges.where("false")).count() == 0


def test_bitmap_never_loses_a_key(spark):
    keys = spark.range(0, 500, 7)
    kept = spark.range(500).where(common.marked("id", common.marks(keys)))
    assert {r["id"] for r in keys.collect()} <= {r["id"] for r in kept.collect()}


def test_classifiers(spark, edge):
    sf = SF_DIR.replace("sf0.001", "sf0.1")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    for query, column, least in ((queries.op9_quality, "quality", 0.9), (queries.op10_toxicity, "toxic", 0.9)):
        rows = query(spark, sf).join(labels, "doc_id").where(f"held_out and {column} is not null").collect()
        assert sum(r["predicted"] == r[column] for r in rows) >= least * len(rows)
        assert all(0 <= r["score"] <= 1 for r in rows)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    model = quality.train(docs, labels, quality.remainder("doc_id", 5) != 0)
    net = toxicity.fit([b"you idiot clown"] * 6, [b"a fine day"] * 6)
    for scored in (quality.score(edge, model), toxicity.score(edge, net)):
        found = scored.collect()
        assert len(found) == len(EDGE) and all(r["score"] == 0 for r in found if r["doc_id"] in (1, 2, 3))
    assert quality.fit([], []).scorer().scores([b"x"]).shape == (1,)
    assert toxicity.score(edge, toxicity.fit([], [])).count() == len(EDGE)


def test_url_filters(spark):
    pages = spark.createDataFrame(
        [(1, "http://a.b.org/x", "2024-03-01"), (2, "https://B.org", "2024-05-01"), (3, None, "2024-03-01"), (4, "nohost", None), (None, "http://b.org", "2024-01-01"), (5, "http://c.b.org", "2023-01-01")],
        "page_id long, url string, fetched string",
    ).withColumn("list", url_filters.F.lit("clash"))
    days = spark.createDataFrame(
        [("x", "b.org", "2024-02-01", True), ("x", "b.org", "2024-04-01", False), ("y", "a.b.org", "2024-01-01", True), ("x", None, "2024-01-01", True)],
        "list string, pattern string, day string, listed boolean",
    ).withColumn("day", url_filters.F.col("day").cast("date"))
    got = {r["page_id"]: (r["blocked"], r["list"], r["pattern"]) for r in url_filters.judge(pages, days).collect()}
    no = (False, None, None)
    assert got == {1: (True, "y", "a.b.org"), 2: no, 3: no, 4: no, 5: no}
    assert not any(r["blocked"] for r in url_filters.judge(pages, days.where("false")).collect())


def test_segments_encoded_together_are_those_of_the_whole_text(monkeypatch):
    """New segments are encoded as one text; ids stay those of the whole, whatever white space and however small the cache."""
    import random

    from quayside.llm import segments

    rng = random.Random(5)
    bits = ["a", "b", " ", "  ", "\n", "\t", "'s", "é", "　", "\xa0", "\x1c", "7", "!", "<|endoftext|>", "\x85", "中", "ab cd ef", "x" * 40]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(60))) for _ in range(600)]
    monkeypatch.setattr(segments, "CACHE_SEGMENTS", 50)
    for encoder in (segments.json_encoder("byte_bpe_50k.json"), segments.rank_encoder("byte_bpe_multi_50k.tiktoken")[0]):
        whole = encoder.encode(texts)
        assert [x for k in range(0, 600, 7) for x in encoder(texts[k : k + 7])] == whole
        assert [encoder([t])[0] for t in texts] == whole


def test_short_lines_repeat_too(spark, tmp_path):
    """The query and the pipeline judge lines of one or two distinct words; only blank ones are exempt."""
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "Go.\n\na b\nw w w"), (2, "Go.\n\nb a\nx"), (3, "w\n \t\nGo.")], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = {(r["doc_id"], r["line_no"]) for r in queries.op6_lines(spark, str(tmp_path)).where("removed").collect()}
    assert found == {(2, 0), (2, 2), (3, 0), (3, 2)}
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_stage(spark, docs, str(tmp_path)).collect()}
    assert kept == {1: "Go.\n\na b\nw w w", 2: "\nx", 3: " \t"}


def test_toxicity_reads_long_runs_to_their_end():
    """What follows the 40th character of a run without blanks counts, wherever it stands."""
    rng = np.random.default_rng(6)
    for n in (41, 43, 77, 78, 1000):
        run = "".join(rng.choice(list("abcdefgh"), n))
        pieces = toxicity.words_of(f"so {run} on")
        assert pieces[0] == "so" and pieces[-1] == "on" and max(map(len, pieces)) <= 40
        assert {run[i : i + 4] for i in range(n - 3)} <= {g for w in pieces[1:-1] for g in toxicity.grams(w)}
    assert toxicity.words_of("a " + "b" * 40 + "... --") == ["a", "b" * 40 + "...", "--"]
    for link in ("_", "-", "/"):
        head = link.join(["such", "a", "day"] * 5)  # the same 40 characters begin either class
        toxic, clean = ([link.join([head, *tail * 20, str(i)]) for i in range(13)] for tail in (["you", "idiot", "clown"], ["walk", "along", "river"]))
        scores = toxicity.Scorer(toxicity.fit(*([t.encode() for t in x[1:]] for x in (toxic, clean)))).scores([toxic[0], clean[0]])
        assert scores[0] > 0.5 > scores[1]


def test_the_twin_of_a_vocabulary_gives_the_ids_of_tokenizers():
    import random

    encoder = segments.json_encoder("byte_bpe_50k.json")
    assert encoder.twin is not None
    rng = random.Random(8)
    safe = [chr(x) for x in range(0x10000) if not 0xD800 <= x < 0xE000 and not segments._ODD.search(chr(x))]
    common_ = " \n\t'aeiouthsnrl'1 .,"
    texts = ["".join(rng.choice(safe) if rng.random() < 0.3 else rng.choice(common_) for _ in range(rng.randrange(200))) for _ in range(3000)]
    texts += [rng.choice(safe) * rng.randrange(1, 400) for _ in range(500)] + ["", "<|endoftext|> a<|endoftext|>", "x" * 20_000, "a b " * 5000]
    assert all(segments._ODD.search(t) is None or t.count(t[:1]) == len(t) for t in texts)
    assert encoder(texts) == encoder.encode(texts)
    # what the libraries may class differently, and white space without end, goes another way
    for odd in ("\x1c", "\x85", "­", " ", "​", "\U0001f600", "﻿", " " * 200, "\n" * 70_000):
        assert segments._ODD.search("a" + odd)
    assert encoder(["a\x1cb", "ok", " " * 300]) == encoder.encode(["a\x1cb", "ok", " " * 300])


def test_only_plain_byte_level_files_have_a_twin(tmp_path):
    import json

    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        file = json.load(f)
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": {**file["pre_tokenizer"], "add_prefix_space": True}}, {"model": {**file["model"], "merges": file["model"]["merges"][::-1]}}):
        path = tmp_path / "other.json"
        path.write_text(json.dumps({**file, **change}), encoding="utf-8")
        assert segments._twin(str(path)) is None
    assert segments._twin(public_tokenizers.path("word_bpe_49k.json")) is None
