"""The filter audit, importance resampling and the license scan against brute force."""

import collections
import hashlib
import itertools
import math
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import filter_audit, importance, licenses, queries
from tests.conftest import SF_DIR
from verification.compare import compare, connect

CLEAN = "A calm sentence of plain words that differ from each other. " * 3
MANY = " ".join(f"word{i}" for i in range(120))
MIT = licenses.TEMPLATES[0][1]
EDGE = [
    (1, None, "en"), (2, "", "en"), (3, " \n\t ", None), (4, "", ""), (5, MANY, "en"), (6, MANY, "fr"), (6, MANY, "fr"), (7, MANY + " #", "fr"),
    (8, "LOUD " * 200, "de"), (9, "a b " * 80, "de"), (10, CLEAN, "en"), (11, "x" * 70_000, "en"), (None, MANY, "en"), (None, None, None),
    (12, "é" * 50 + " MİT License mit license, MIT\nLicense! Kelvin Key", "en"), (13, f"{MANY} {MIT.upper()} {MANY}", "en"),
    (14, "General Public License general-public_license public license", "en"), (15, "apache license " * 400, "en"),
    (16, f"{MANY} Licensed under CC BY-SA 4.0. {MANY}", "es"), (17, " ".join(MIT.split()[3:]) + " " + MANY, "es"), (18, "mit", "es"), (19, "license mit", "es"),
]


@pytest.fixture(scope="module")
def edge(spark):
    rows = [(i, t, lang, "clash", "clash", 1, "clash") for i, t, lang in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, id string, part string, words int, digest string")


@pytest.fixture(scope="module")
def nothing(edge):
    return edge.where("false")


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(5, 1, 0), (6, 1, 1), (6, 0, 1), (8, None, 1), (9, 1, None), (None, 1, 1), (99, 1, 1), (13, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


# ---- filter audit ---------------------------------------------------------------------------


def failed(rows):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    for i, t, lang in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        hit = {
            "A": len(w) < 100,
            "B": 100 * len(set(w)) < 80 * len(w),
            "C": 100 * sum("A" <= c <= "Z" for c in t) > 10 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": i is not None and i > first[t],
        }
        yield i, lang or "", {k for k, v in hit.items() if v}


def audited(rows, marks):
    good = {i for i, q, _ in marks if q == 1 and i is not None}
    toxic = {i for i, _, x in marks if x == 1 and i is not None}
    parts = collections.defaultdict(list)
    for i, part, fails in failed(rows):
        parts[part].append((i, fails))
    out = {}
    for part, docs in parts.items():
        shapley = collections.Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = docs
            for k, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[f] += len(gone)
                out[part, order, k] = [
                    len(left), len(gone), sum(f in d[1] for d in docs) - len(gone), sum(d[1] == {f} for d in docs),
                    sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone), f,
                ]
        for (p, _, _), row in out.items():
            if p == part:
                row[6] = shapley[row[6]]
    return {k: tuple(v) for k, v in out.items()}


COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audit_rows(df):
    got = df.collect()
    out = {(r["part"], r["filter_order"], r["step"]): tuple(r[k] for k in COUNTS) for r in got}
    assert len(out) == len(got)
    return out


@pytest.mark.parametrize("name", ["edge", "nothing"])
def test_filter_audit(name, labels, request):
    df = request.getfixturevalue(name)
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in df.select("doc_id", "text", "lang").collect()]
    marks = [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()]
    got = audit_rows(filter_audit.audit_documents(df, labels))
    assert got == audited(rows, marks)
    assert len(got) == 600 * len({r[2] or "" for r in rows})


def test_filter_audit_without_labels(edge, labels):
    got = audit_rows(filter_audit.audit_documents(edge, labels.where("false")))
    assert got and all(v[4] == v[5] == 0 for v in got.values())


def test_audit_of_other_filters(spark):
    rows = spark.createDataFrame([("x", 1, None), ("x", 5, True), (None, 9, True), ("y", 2, False)], "g string, v int, f boolean")
    got = filter_audit.audit(rows, {"big": "v > 4", "flag": F.col("f")}, "g").collect()
    assert {(r["part"], r["filter_order"], r["step"]): (r["kept"], r["removed"], r["redundant"]) for r in got} == {
        ("x", "bigflag", 1): (1, 1, 0), ("x", "bigflag", 2): (1, 0, 1), ("x", "flagbig", 1): (1, 1, 0), ("x", "flagbig", 2): (1, 0, 1),
        ("", "bigflag", 1): (0, 1, 0), ("", "bigflag", 2): (0, 0, 1), ("", "flagbig", 1): (0, 1, 0), ("", "flagbig", 2): (0, 0, 1),
        ("y", "bigflag", 1): (1, 0, 0), ("y", "bigflag", 2): (1, 0, 0), ("y", "flagbig", 1): (1, 0, 0), ("y", "flagbig", 2): (1, 0, 0),
    }
    with pytest.raises(ValueError):
        filter_audit.audit(rows, {str(k): "false" for k in range(9)}, "g")


@pytest.mark.parametrize("n", range(1, 6))
def test_swaps_reach_every_order_once(n):
    order, seen = list(range(n)), [tuple(range(n))]
    for k in filter_audit.swaps(n):
        order[k], order[k + 1] = order[k + 1], order[k]
        seen.append(tuple(order))
    assert len(seen) == len(set(seen)) == math.factorial(n)


def test_diagram_shares_nodes_and_keeps_weights():
    rng = np.random.default_rng(4)
    counts = {int(m): (int(v), 1) for m, v in enumerate(rng.integers(0, 3, 32))}
    diagram = filter_audit.Diagram(5, counts, 2)
    total = diagram.weight[diagram.root]
    assert total == (sum(v for v, _ in counts.values()), 32)
    for level in filter_audit.swaps(5):
        diagram.swap(level)
        assert diagram.weight[diagram.root] == total
        assert all(len(nodes) <= 1 << k for k, nodes in enumerate(diagram.levels))
    same = filter_audit.Diagram(5, {m: (7,) for m in range(32)}, 1)
    assert [len(nodes) for nodes in same.levels] == [1] * 5


# ---- importance -----------------------------------------------------------------------------


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def bucket_list(text):
    w = tokens(text)
    return [zlib.crc32(" ".join(w[k : k + n]).encode()) % 10_000 for n in (1, 2, 3) for k in range(len(w) - n + 1)]


def resampled(rows, goal):
    found = [bucket_list(t) for _, t in rows]
    s = collections.Counter(b for f in found for b in f)
    t = collections.Counter(b for x in goal for b in bucket_list(x))
    s_all, t_all = s.total(), t.total()
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000)))) for b in s}
    out = []
    for (i, text), f in zip(rows, found, strict=True):
        weight = sum(gain[b] for b in f)
        h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        score = None if i is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None, len(tokens(text))])
    able = sorted((r for r in out if r[0] is not None and r[5] >= 20), key=lambda r: (-r[3], r[0], r[1], r[2]))
    for k, r in enumerate(able[: 5 * len(able) // 100], 1):
        r[4] = k
    return collections.Counter(tuple(r[:5]) for r in out)


@pytest.mark.parametrize("name", ["edge", "documents", "nothing"])
def test_importance(name, spark, request):
    df = request.getfixturevalue(name)
    if name == "edge":  # enough rows that some are drawn, ties among them
        df = df.unionByName(df).unionByName(df).unionByName(df)
    goal = spark.createDataFrame([(MANY,), (None,), ("",), ("é word1 word2 über",)], "text string")
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    got = collections.Counter((r["doc_id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in importance.resample(df, goal).collect())
    assert got == resampled(rows, [r["text"] for r in goal.collect()])
    assert name == "nothing" or any(k[4] for k in got)


def test_importance_without_target(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    got = importance.resample(documents, documents.where("false")).collect()
    assert collections.Counter(tuple(r[k] for k in ("doc_id", "n_features", "weight", "score", "rank")) for r in got) == resampled(rows, [])


def test_long_texts_are_hashed_whole_in_pieces():
    rng = np.random.default_rng(5)
    words = ["".join(chr(97 + x) for x in rng.integers(0, 26, rng.integers(1, 9))) for _ in range(300)] + ["ñandú", "Z" * 700, "日本" * 90]
    gaps = [" ", "\n", ". ", "--" * 300, "\0"]
    text = "".join(words[i] + gaps[j] for i, j in zip(rng.integers(0, len(words), 4000), rng.integers(0, len(gaps), 4000), strict=True))
    for limit in (1, 50, 1000, 1 << 30):
        found, n = collections.Counter(), 0
        for _, bucket, count, _ in importance.hashed([text.encode()], 10_000, limit):
            found.update(bucket.tolist())
            n += int(count.sum())
        assert found == collections.Counter(bucket_list(text)) and n == len(tokens(text))


def test_crc_columns():
    rows = np.random.default_rng(6).integers(0, 256, (40, 33)).astype(np.uint8)
    assert importance.crc_columns(rows).tolist() == [zlib.crc32(r.tobytes()) for r in rows]


# ---- licenses -------------------------------------------------------------------------------


def scanned(rows):
    share, out = Fraction(str(licenses.THRESHOLD)), collections.Counter()
    for i, text in rows:
        w = tokens(text)
        places = [(k, label) for p, label in licenses.PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        base, more, best = {label for _, label in places}, set(), 0.0
        for k in range(0, len(w), licenses.STEP):
            block = set(w[k : k + licenses.BLOCK])
            for label, sentence in licenses.TEMPLATES:
                t = set(sentence.split())
                if len(block & t) >= share * len(t):
                    more.add(label)
                    best = max(best, len(block & t) / len(t))
        starts = [k for k, _ in places]
        out[
            i, len(w), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(base | more)), 1.0 if places else best,
        ] += 1
    return out


@pytest.mark.parametrize("name", ["edge", "nothing"])
def test_licenses(name, request):
    df = request.getfixturevalue(name)
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    got = collections.Counter(tuple(r[k] for k in columns) for r in licenses.scan(df).collect())
    assert got == scanned(rows)
    if name == "edge":
        by_id = {k[0]: k for k in got}
        assert by_id[13][5:] == ("", "mit", 1.0)  # a notice without any phrase, upper case, across blocks
        assert by_id[16][6] == "cc-by,cc-by-sa"
        assert by_id[12][2:5] == (2, 3, 5)  # neither a dotted capital nor the Kelvin sign is a letter of A-Z


def test_license_templates_must_fit_a_block(edge):
    with pytest.raises(ValueError):
        licenses.scan(edge, templates=(("long", " ".join(map(str, range(40)))),))


def test_license_scan_stays_native(edge):
    plan = licenses.scan(edge)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas|ExistingRDD.*words", plan)


@pytest.mark.parametrize("name", ["op11_filter_audit", "op12_importance", "op13_licenses"])
def test_sql(spark, name):
    assert compare(queries.shipped(queries.QUERIES[name])(spark, SF_DIR), connect(SF_DIR), queries.ORACLE_SQL[name]) == []
