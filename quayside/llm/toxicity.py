"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word enters as the sum of a word vector and the mean of the vectors of its character n-grams,
both learnt. One recurrent layer reads a window of words forward, another backward; attention pools
their states and a linear layer gives the window's logit. Windows overlap by a quarter and cover the
whole text; the text's evidence is its highest window, which a logistic curve turns into a score.
Training uses a bounded sample of labelled texts: every window first takes its text's label, then
only the highest window of each toxic text does.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm import common as c
from quayside.llm.quality import _logistic, sample

#: Labelled texts taken per class, and their longest length in characters.
SAMPLE = 1500
SAMPLE_CHARS = 20_000
#: The network itself learns from texts of at most so many characters; longer ones only calibrate.
TRAIN_CHARS = 3_000
#: Longest word; a longer run between white space is cut into words that share `SHARED` characters.
LONGEST = 40
SHARED = 3
WINDOW = 32
STRIDE = 24
INPUT = 12
HIDDEN = 8
#: Words and n-grams known to the network, the most frequent of the sample; others enter as nothing.
WORDS = 20_000
GRAMS = 30_000
LEAST = 4
ROUNDS = 5
#: Least steps of a round; few windows are gone through again and again.
STEPS = 60
#: One in so many sampled texts is kept from training, to calibrate the score.
CALIBRATE = 3
BATCH = 256
#: Windows scored together.
SCORED = 2048
#: Word projections kept per worker: some 100 MB at most.
CACHE = 300_000
THRESHOLD = 0.3

_STRIP = ".,;:!?\"'()[]{}|*#&%$-_"


def normal(word: str) -> str:
    return word.strip(_STRIP).lower()


def words_of(text: str) -> list[str]:
    """All of a text's words; long runs, as in scripts without spaces, in pieces that lose no four-gram."""
    words = text.split()
    if all(len(w) <= LONGEST for w in words):
        return words
    out = []
    for w in words:
        if len(w) > LONGEST and len(run := normal(w)) > LONGEST:
            out += [run[i : i + LONGEST] for i in range(0, len(run) - SHARED, LONGEST - SHARED)]
        else:
            out.append(w)
    return out


def grams(word: str) -> list[str]:
    """Character four-grams, marked at both ends; a shorter word is one n-gram."""
    w = f"^{word}$"
    return [w[i : i + 4] for i in range(len(w) - 3)] or [w]


@dataclass
class Network:
    words: dict[str, int]
    grams: dict[str, int]
    parts: dict[str, np.ndarray] = field(default_factory=dict)
    curve: tuple[float, float] = (0.0, 1.0)

    def features(self, words: list[str]) -> np.ndarray:
        """Input vectors of words."""
        forms: dict[str, int] = {}
        at = [forms.setdefault(normal(w), len(forms)) for w in words]
        known, pieces, size = self.grams.get, [], []
        for w in forms:
            found = [k for g in grams(w) if (k := known(g)) is not None] if w else []
            size.append(len(found))
            pieces += found
        size = np.array(size, np.int64)
        total = np.concatenate([np.zeros((1, INPUT)), np.cumsum(self.parts["gram"][np.array(pieces, np.int64)], 0, dtype=np.float64)])
        end = np.cumsum(size)
        out = ((total[end] - total[end - size]) / 4).astype(np.float32)
        place = np.array([self.words.get(w, len(self.words)) for w in forms])
        return (out + self.parts["word"][place])[np.array(at, np.int64)]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _layer(x: np.ndarray, mask: np.ndarray, u: np.ndarray, keep: list | None = None) -> np.ndarray:
    """States (time, batch, hidden) of a gated layer over projected inputs (time, batch, 3 hidden)."""
    steps, batch, _ = x.shape
    h = np.zeros((batch, HIDDEN), np.float32)
    out = np.empty((steps, batch, HIDDEN), np.float32)
    for t in range(steps):
        a = h @ u
        gate = _sigmoid(x[t, :, : 2 * HIDDEN] + a[:, : 2 * HIDDEN])
        z, r = gate[:, :HIDDEN], gate[:, HIDDEN:]
        n = np.tanh(x[t, :, 2 * HIDDEN :] + r * a[:, 2 * HIDDEN :])
        new = n + z * (h - n)
        m = mask[t][:, None]
        if keep is not None:
            keep.append((h, z, r, n, a[:, 2 * HIDDEN :]))
        h = np.where(m, new, h)
        out[t] = h
    return out


def _pool(states: np.ndarray, mask: np.ndarray, p: dict[str, np.ndarray]) -> tuple[np.ndarray, ...]:
    e = np.tanh(states @ p["att_w"] + p["att_b"])
    s = np.where(mask, e @ p["att_v"], -1e9)
    s = np.exp(s - s.max(0))
    weight = s / s.sum(0)
    pooled = (weight[:, :, None] * states).sum(0)
    return e, weight, pooled


def window_logits(projected: np.ndarray, mask: np.ndarray, p: dict[str, np.ndarray]) -> np.ndarray:
    """Logits of windows, from inputs (time, batch, 6 hidden) already projected for both directions."""
    f = _layer(projected[:, :, : 3 * HIDDEN], mask, p["fwd_u"])
    b = _layer(projected[::-1, :, 3 * HIDDEN :], mask[::-1], p["bwd_u"])[::-1]
    _, _, pooled = _pool(np.concatenate([f, b], 2), mask, p)
    return pooled @ p["out_w"] + p["out_b"][0]


def _windows(length: int) -> list[int]:
    return [0] if length <= WINDOW else [*range(0, length - WINDOW, STRIDE), length - WINDOW]


def _backward_layer(grad: np.ndarray, keep: list, mask: np.ndarray, u: np.ndarray, dx: np.ndarray, du: np.ndarray) -> None:
    dh = np.zeros_like(grad[0])
    for t in range(len(keep) - 1, -1, -1):
        h, z, r, n, an = keep[t]
        m = mask[t][:, None]
        dh = dh + grad[t]
        d = np.where(m, dh, 0)
        dn = d * (1 - z) * (1 - n * n)
        dz = d * (h - n) * z * (1 - z)
        dr = dn * an * r * (1 - r)
        da = np.concatenate([dz, dr, dn * r], 1)
        dx[t] += np.concatenate([dz, dr, dn], 1)
        du += h.T @ da
        dh = np.where(m, d * z + da @ u.T, dh)


def _gradients(x: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray, p: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Gradients of the logistic loss of windows and of their inputs x (time, batch, input)."""
    projected = x @ p["in_w"] + p["in_b"]
    kf: list = []
    kb: list = []
    f = _layer(projected[:, :, : 3 * HIDDEN], mask, p["fwd_u"], kf)
    b = _layer(projected[::-1, :, 3 * HIDDEN :], mask[::-1], p["bwd_u"], kb)[::-1]
    states = np.concatenate([f, b], 2)
    e, att, pooled = _pool(states, mask, p)
    logit = pooled @ p["out_w"] + p["out_b"][0]
    d = ((_sigmoid(logit) - y) * weight / len(y)).astype(np.float32)
    g = {k: np.zeros_like(v) for k, v in p.items() if k not in ("word", "gram")}
    g["out_w"], g["out_b"] = pooled.T @ d, np.array([d.sum()], np.float32)
    dpool = d[:, None] * p["out_w"]
    ds = att[:, :, None] * dpool
    datt = (states * dpool).sum(2)
    dscore = att * (datt - (att * datt).sum(0))
    de = dscore[:, :, None] * p["att_v"] * (1 - e * e)
    g["att_v"] = np.einsum("tbk,tb->k", e, dscore)
    g["att_w"], g["att_b"] = np.einsum("tbi,tbj->ij", states, de), de.sum((0, 1))
    ds = ds + de @ p["att_w"].T
    dx = np.zeros_like(projected)
    _backward_layer(ds[:, :, :HIDDEN], kf, mask, p["fwd_u"], dx[:, :, : 3 * HIDDEN], g["fwd_u"])
    _backward_layer(ds[::-1, :, HIDDEN:], kb, mask[::-1], p["bwd_u"], dx[::-1, :, 3 * HIDDEN :], g["bwd_u"])
    g["in_w"], g["in_b"] = np.einsum("tbi,tbj->ij", x, dx), dx.sum((0, 1))
    return g, dx @ p["in_w"].T


def _start(words: int, grams_: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    def normal_(*shape, scale):
        return (rng.standard_normal(shape) * scale).astype(np.float32)

    h = HIDDEN
    return {
        "word": np.zeros((words + 1, INPUT), np.float32),
        "gram": normal_(grams_ + 1, INPUT, scale=0.05),
        "in_w": normal_(INPUT, 6 * h, scale=0.4), "in_b": np.zeros(6 * h, np.float32),
        "fwd_u": normal_(h, 3 * h, scale=0.25), "bwd_u": normal_(h, 3 * h, scale=0.25),
        "att_w": normal_(2 * h, h, scale=0.3), "att_b": np.zeros(h, np.float32), "att_v": normal_(h, scale=0.3),
        "out_w": normal_(2 * h, scale=0.3), "out_b": np.zeros(1, np.float32),
    }


class _Adam:
    def __init__(self, p: dict[str, np.ndarray], rate: float):
        self.p, self.rate, self.n = p, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, name: str, g: np.ndarray, rows: np.ndarray | slice = slice(None)) -> None:
        m, v = self.m[name], self.v[name]
        m[rows] = 0.9 * m[rows] + 0.1 * g
        v[rows] = 0.99 * v[rows] + 0.01 * g * g
        scale = np.sqrt(1 - 0.99**self.n) / (1 - 0.9**self.n)
        self.p[name][rows] -= self.rate * scale * m[rows] / (np.sqrt(v[rows]) + 1e-6)


def fit(toxic: list[bytes], clean: list[bytes], seed: int = 5) -> Network:
    """A network from texts of either class; one text in `CALIBRATE` only calibrates."""
    learn = [[t for i, t in enumerate(texts) if i % CALIBRATE and len(t) <= TRAIN_CHARS] for texts in (toxic, clean)]
    rest = [[t for i, t in enumerate(texts) if not i % CALIBRATE] for texts in (toxic, clean)]
    net = _fit_network(*learn, seed)
    scorer = Scorer(net)
    x = np.concatenate([scorer.evidence([t.decode("utf-8", "replace") for t in texts]) for texts in rest])
    y = np.array([1.0] * len(rest[0]) + [0.0] * len(rest[1]))
    ok = np.isfinite(x)
    if ok.any():
        net.curve = tuple(_logistic(np.column_stack([np.ones(ok.sum()), x[ok]]), y[ok], 0.1))
    return net


def _fit_network(toxic: list[bytes], clean: list[bytes], seed: int) -> Network:
    rng = np.random.default_rng(seed)
    texts = [words_of(t.decode("utf-8", "replace")) for t in [*toxic, *clean]]
    truth = np.array([1] * len(toxic) + [0] * len(clean))
    seen: dict[str, int] = {}
    count: dict[str, int] = {}
    pieces: dict[str, int] = {}
    for words in texts:
        for w in {normal(x) for x in words}:
            if w:
                count[w] = count.get(w, 0) + 1
                if w not in seen:
                    seen[w] = len(seen)
                for x in grams(w):
                    pieces[x] = pieces.get(x, 0) + 1

    def most(have: dict[str, int], limit: int) -> dict[str, int]:
        kept = sorted((k for k, n in have.items() if n >= LEAST), key=lambda k: (-have[k], k))[:limit]
        return {k: i for i, k in enumerate(kept)}

    net = Network(most(count, WORDS), most(pieces, GRAMS))
    p = net.parts = _start(len(net.words), len(net.grams), rng)
    # distinct words: their known word and n-grams; row 0 is padding
    order = list(seen)
    word_of = np.array([len(net.words), *(net.words.get(w, len(net.words)) for w in order)])
    gram_at, gram_of = [], []
    for i, w in enumerate(order):
        g = [net.grams[x] for x in grams(w) if x in net.grams]
        gram_of += g
        gram_at += [i + 1] * len(g)
    gram_at, gram_of = np.array(gram_at, np.int64), np.array(gram_of, np.int64)
    span = np.searchsorted(gram_at, np.arange(len(order) + 2))
    rows, owner = [], []
    for d, words in enumerate(texts):
        ids = [seen[w] + 1 if (w := normal(x)) else 0 for x in words]
        for s in _windows(len(ids)):
            part = ids[s : s + WINDOW]
            if part:
                rows.append(part + [0] * (WINDOW - len(part)))
                owner.append(d)
    if not rows:
        return net
    rows, owner = np.array(rows), np.array(owner)
    # padding differs from punctuation only in the mask, so both carry nothing
    filled = np.array([[k < len(texts[d]) for k in range(WINDOW)] for d in owner])
    adam = _Adam(p, 0.01)

    def inputs(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        distinct, back = np.unique(ids, return_inverse=True)
        size = span[distinct + 1] - span[distinct]
        at = np.repeat(np.arange(len(distinct)), size)
        which = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(span[distinct], size)
        x = p["word"][word_of[distinct]].copy()
        np.add.at(x, at, p["gram"][gram_of[which]] / 4)
        return x, back.reshape(ids.shape), distinct, at, gram_of[which]

    def logits(ids: np.ndarray, mask: np.ndarray) -> np.ndarray:
        out = []
        for k in range(0, len(ids), SCORED):
            x, back, *_ = inputs(ids[k : k + SCORED])
            out.append(window_logits((x @ p["in_w"] + p["in_b"])[back.T], mask[k : k + SCORED].T, p))
        return np.concatenate(out)

    def top(score: np.ndarray) -> np.ndarray:
        best = np.full(len(texts), -np.inf)
        np.maximum.at(best, owner, score)
        return best

    for round_ in range(ROUNDS):
        y = truth[owner].astype(np.float32)
        use = np.arange(len(rows))
        if round_ >= 2:  # of a toxic text, only its highest window is known to be toxic
            score = logits(rows, filled)
            use = np.flatnonzero((y == 0) | (score >= top(score)[owner]))
        weight = np.where(y == 1, (y[use] == 0).sum() / max(1, (y[use] == 1).sum()), 1.0).astype(np.float32) ** 0.5
        adam.rate = 0.01 * 0.6**round_
        batches = max(1, len(use) // BATCH)
        order_ = [part for _ in range(-(-STEPS // batches)) for part in np.array_split(rng.permutation(use), batches)]
        for part in order_:
            x, back, distinct, at, which = inputs(rows[part])
            g, dx = _gradients(x[back.T], filled[part].T, y[part], weight[part], p)
            adam.n += 1
            dword = np.zeros_like(x)
            np.add.at(dword, back.T.ravel(), dx.reshape(-1, INPUT))
            dw = np.zeros_like(p["word"])
            np.add.at(dw, word_of[distinct], dword)
            hit = np.unique(word_of[distinct])
            hit = hit[hit < len(net.words)]
            touched, place = np.unique(which, return_inverse=True)
            dg = np.zeros((len(touched), INPUT), np.float32)
            np.add.at(dg, place, dword[at] / 4)
            adam.step("word", dw[hit], hit)
            adam.step("gram", dg, touched)
            for k, v in g.items():
                adam.step(k, v)
    return net


class Scorer:
    """Scores whole texts; projections of words met before are kept."""

    def __init__(self, net: Network):
        self.net = net
        self.start()

    def start(self) -> None:
        p = self.net.parts
        self.at: dict[str, int] = {}
        self.table = p["in_b"][None].astype(np.float32)  # row 0: padding
        self.room = 1

    def _rows(self, words: list[str]) -> np.ndarray:
        missing = [w for w in set(words) if w not in self.at]
        if len(self.at) + len(missing) > CACHE:
            self.start()
            missing = list(set(words))
        if missing:
            p = self.net.parts
            more = self.net.features(missing) @ p["in_w"] + p["in_b"]
            need = self.room + len(missing)
            if need > len(self.table):
                self.table = np.concatenate([self.table, np.empty((max(need, len(self.table)), self.table.shape[1]), np.float32)])
            self.table[self.room : need] = more
            self.at.update(zip(missing, range(self.room, need), strict=True))
            self.room = need
        return np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))

    def scores(self, texts: list[str]) -> np.ndarray:
        x = self.evidence(texts)
        ok = np.isfinite(x)
        a, b = self.net.curve
        p = np.zeros(len(texts))
        p[ok] = _sigmoid(np.clip(a + b * x[ok], -30, 30))
        return p

    def evidence(self, texts: list[str]) -> np.ndarray:
        """The logit of each text's highest window; minus infinity without words."""
        ids, owner, length = [], [], []
        split = [words_of(t) for t in texts]
        flat = self._rows([w for ws in split for w in ws])
        begin = np.cumsum([0, *(len(ws) for ws in split)])
        for i, ws in enumerate(split):
            if ws:
                s = np.array(_windows(len(ws)))
                ids.append(begin[i] + s)
                owner.append(np.full(len(s), i))
                length.append(np.full(len(s), min(WINDOW, len(ws))))
        best = np.full(len(texts), -np.inf)
        if ids:
            ids, owner, length = (np.concatenate(x) for x in (ids, owner, length))
            flat = np.concatenate([flat, np.zeros(WINDOW, np.int64)])
            for k in range(0, len(ids), SCORED):
                step = np.arange(WINDOW)[:, None]
                mask = step < length[None, k : k + SCORED]
                word = np.where(mask, flat[ids[None, k : k + SCORED] + step], 0)
                np.maximum.at(best, owner[k : k + SCORED], window_logits(self.table[word], mask, self.net.parts))
        return best


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", size: int = SAMPLE) -> Network:
    return fit(*sample(docs, labels, learn, label_col, size, SAMPLE_CHARS, id_col, text_col))


def score(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of `docs`: id, score, predicted. Null, empty and blank texts score 0.

    The whole text is read, runs of any length between white space too (see `words_of`).
    Rows are scored one by one, so repeated rows and null ids come back as they are. Other columns
    are not read; an empty table gives an empty result.
    """
    kind, schema = c.arrow_schema("id long, score double, predicted int")
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            ids = batch.column(0)
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, b in c.by_bytes(texts):
                s = scorer.scores(texts[a:b])
                yield from c.emit({"id": ids.slice(a, b - a), "score": s, "predicted": (s >= threshold).astype(np.int32)}, schema)

    plain = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return plain.mapInArrow(run, kind).withColumnRenamed("id", id_col)
