"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

Input of the network at each word is the embedding of the whole word (hashed) next to the
mean and the largest values of the embeddings of its character n-grams. One gated recurrent layer reads a window of
``WINDOW`` words from the left, another from the right; attention weighs their states, and a
linear layer on the weighted sum gives the window's logit. Windows start every ``STRIDE``
words and the last one ends with the text, so all words lie in a window and neighbours
overlap; a text's score is that of its most toxic window, passed through a logistic
calibration. A text without words scores 0.

Labels belong to texts, not to windows: every window of a clean text is clean, and of a
toxic text the window that now scores highest is taken as toxic (multiple-instance
training). Embeddings start from smoothed log-odds of their bucket between the labelled
texts in their first component (zero where the difference may be chance) and at random in
the others; what follows the same word is counted once there, so that copies count as one. Training uses at most
``SAMPLE_PER_LABEL`` labelled rows of each label; a fifth of them fits the calibration.
"""

from __future__ import annotations

import pickle
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pinwheel.llm.common import column, free_name, give_back, held_out, lowest_ids, map_text, ragged, saved, texts_of
from pinwheel.llm.subwords import WORDS_AT_ONCE, gram_buckets, numbered_words, word_buckets

SAMPLE_PER_LABEL = 1_500
WINDOW, STRIDE = 32, 16
GRAMS = (3, 4, 5, 6)
BUCKETS = 1 << 18
WORD_DIM = CHAR_DIM = 4
HIDDEN = 8
EPOCHS = 10
SEED = 11
# Pseudo-texts that pull a bucket's log-odds to zero.
PRIOR = 5.0
THRESHOLD = 0.3
# Standard errors by which a log-odds must differ from zero to count.
MARGIN = 1.5
# What surrounds a word and is no letter or digit says nothing about its meaning.
EDGES = re.compile(r"^[\W_]+|[\W_]+$")
# Windows that go through the network together.
CHUNK = 2048


@dataclass
class Model:
    word: np.ndarray
    char: np.ndarray
    params: dict = field(default_factory=dict)
    slope: float = 1.0
    shift: float = 0.0
    fitted: bool = False


@dataclass
class Words:
    """Distinct words of some texts: their buckets, and the word number at every place."""
    word: np.ndarray
    grams: np.ndarray
    counts: np.ndarray
    at: np.ndarray
    per_text: np.ndarray


def read_words(texts: list[str]) -> Words:
    words, at, per_text = numbered_words(texts)
    words = [EDGES.sub("", w) or w for w in words]
    grams, counts = gram_buckets(words, GRAMS, BUCKETS)
    return Words(word_buckets(words, BUCKETS), grams, counts, at, per_text)


def windows_of(per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, length and text of every window, all texts in turn."""
    n = np.where(per_text > 0, 1 + np.maximum(0, -(-(per_text - WINDOW) // STRIDE)), 0)
    text = np.repeat(np.arange(len(per_text)), n)
    k = ragged(np.zeros(len(per_text), np.int64), n)
    size = per_text[text]
    start = np.minimum(k * STRIDE, np.maximum(size - WINDOW, 0))
    return (np.cumsum(per_text) - per_text)[text] + start, np.minimum(size, WINDOW), text


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


INPUT = WORD_DIM + 2 * CHAR_DIM


def word_vectors(m: Model, w: Words) -> np.ndarray:
    """Per distinct word: its own embedding, the mean and the maximum over its n-grams."""
    out = np.empty((len(w.word), INPUT), np.float32)
    out[:, :WORD_DIM] = m.word[w.word]
    ends = np.cumsum(w.counts)
    for k in range(0, len(w.word), WORDS_AT_ONCE):
        n, base = w.counts[k:k + WORDS_AT_ONCE], ends[k] - w.counts[k]
        grams, first = m.char[w.grams[base:ends[k + len(n) - 1]]], ends[k:k + len(n)] - n - base
        out[k:k + len(n), WORD_DIM:WORD_DIM + CHAR_DIM] = np.add.reduceat(grams, first, axis=0) / n[:, None]
        out[k:k + len(n), WORD_DIM + CHAR_DIM:] = np.maximum.reduceat(grams, first, axis=0)
    return out


def _recur(px, u, mask, reverse: bool, keep: list | None = None) -> np.ndarray:
    """States [time, batch, hidden] of one gated recurrent layer; ``px`` is the input part of
    the gates. Where ``mask`` is 0 the state stays."""
    steps, batch, h3 = px.shape
    h = h3 // 3
    state, out = np.zeros((batch, h), np.float32), np.empty((steps, batch, h), np.float32)
    for t in range(steps - 1, -1, -1) if reverse else range(steps):
        rec = state @ u
        gates = px[t, :, :2 * h] + rec[:, :2 * h]
        np.negative(gates, out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        z, r = gates[:, :h], gates[:, h:]
        new = np.tanh(px[t, :, 2 * h:] + r * rec[:, 2 * h:])
        if keep is not None:
            keep.append((t, state, z, r, new, rec[:, 2 * h:]))
        state = state + mask[t][:, None] * (1 - z) * (new - state)
        out[t] = state
    return out


def _pool(p: dict, states: np.ndarray, mask: np.ndarray):
    """Attention over time: weights, pooled state, logit and the tanh layer."""
    layer = np.tanh(states @ p["att"] + p["att_b"])
    e = np.where(mask > 0, layer @ p["query"], np.float32(-1e9))
    a = np.exp(e - e.max(0))
    a /= a.sum(0)
    pooled = np.einsum("tb,tbh->bh", a, states)
    return a, pooled, pooled @ p["out"] + p["out_b"], layer


def _places(start: np.ndarray, length: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word number at [time, window] and 1 where a window has that word."""
    t = np.arange(WINDOW)[:, None]
    mask = (t < length).astype(np.float32)
    return at[np.where(mask > 0, start + t, start)], mask


def window_logits(m: Model, w: Words, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    p, x = m.params, word_vectors(m, w)
    fwd, bwd = x @ p["wf"] + p["bf"], x @ p["wb"] + p["bb"]  # once per distinct word
    out = np.empty(len(start), np.float32)
    for k in range(0, len(start), CHUNK):
        at, mask = _places(start[k:k + CHUNK], length[k:k + CHUNK], w.at)
        states = np.concatenate([_recur(fwd[at], p["uf"], mask, False), _recur(bwd[at], p["ub"], mask, True)], axis=2)
        out[k:k + CHUNK] = _pool(p, states, mask)[2]
    return out


def _recur_back(grad, px_grad, u, keep, mask):
    """Gradients of one layer from those of its states: fills ``px_grad``, returns that of ``u``."""
    h = grad.shape[2]
    du, carry = np.zeros_like(u), np.zeros(grad.shape[1:], np.float32)
    for t, prev, z, r, new, rec in reversed(keep):
        g = (grad[t] + carry) * mask[t][:, None]
        held = (grad[t] + carry) * (1 - mask[t][:, None])
        dz = g * (prev - new) * z * (1 - z)
        dn = g * (1 - z) * (1 - new * new)
        dr = dn * rec * r * (1 - r)
        drec = np.concatenate([dz, dr, dn * r], axis=1)
        px_grad[t] = np.concatenate([dz, dr, dn], axis=1)
        du += prev.T @ drec
        carry = held + g * z + drec @ u.T
    return du


def gradients(m: Model, x: np.ndarray, at: np.ndarray, mask: np.ndarray, y: np.ndarray, weight: np.ndarray):
    """Gradients of the weighted log loss: of the dense parameters, and of ``x`` by word."""
    p = m.params
    keep_f, keep_b = [], []
    xs = x[at]
    h = HIDDEN
    states = np.concatenate([_recur(xs @ p["wf"] + p["bf"], p["uf"], mask, False, keep_f),
                             _recur(xs @ p["wb"] + p["bb"], p["ub"], mask, True, keep_b)], axis=2)
    a, pooled, logit, layer = _pool(p, states, mask)
    d = ((sigmoid(logit) - y) * weight / weight.sum()).astype(np.float32)
    g = {"out": pooled.T @ d, "out_b": d.sum()}
    dpool = d[:, None] * p["out"]
    da = np.einsum("bh,tbh->tb", dpool, states)
    de = a * (da - (a * da).sum(0))
    g["query"] = np.einsum("tb,tbk->k", de, layer)
    dl = de[:, :, None] * p["query"] * (1 - layer * layer)
    g["att"], g["att_b"] = np.einsum("tbh,tbk->hk", states, dl), dl.sum((0, 1))
    ds = a[:, :, None] * dpool + dl @ p["att"].T
    dx = np.zeros_like(xs)
    for s, keep, part in (("f", keep_f, ds[:, :, :h]), ("b", keep_b, ds[:, :, h:])):
        px = np.empty((*at.shape, 3 * h), np.float32)
        g["u" + s] = _recur_back(part, px, p["u" + s], keep, mask)
        px *= mask[:, :, None]
        g["w" + s], g["b" + s] = np.einsum("tbd,tbk->dk", xs, px), px.sum((0, 1))
        dx += px @ p["w" + s].T
    return g, dx


def _log_odds(pos: np.ndarray, neg: np.ndarray) -> np.ndarray:
    """Smoothed log-odds of each bucket between toxic and clean texts; zero where chance may do."""
    share = max(pos.sum(), 1) / max(pos.sum() + neg.sum(), 2)
    pos, neg = pos + PRIOR * share, neg + PRIOR * (1 - share)
    odds = np.log(pos / share) - np.log(neg / (1 - share))
    sure = np.maximum(np.abs(odds) - MARGIN * np.sqrt(1 / pos + 1 / neg), 0)
    return np.clip(np.sign(odds) * sure, -4, 4).astype(np.float32)


def _gram_sums(w: Words, per_word: np.ndarray) -> np.ndarray:
    """Sum of ``per_word`` over the words that have an n-gram, by bucket."""
    out, ends = np.zeros(BUCKETS), np.cumsum(w.counts)
    for k in range(0, len(w.counts), WORDS_AT_ONCE):
        n, base = w.counts[k:k + WORDS_AT_ONCE], ends[k] - w.counts[k]
        grams = w.grams[base:ends[k + len(n) - 1]]
        out += np.bincount(grams, np.repeat(per_word[k:k + len(n)], n), BUCKETS)
    return out


def _contexts(w: Words, owner: np.ndarray, fit: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each distinct word, after how many distinct words it stands in toxic and clean texts."""
    before = np.where(np.diff(owner, prepend=-1)[fit] > 0, 0, w.at[fit - 1] + 1)
    n = len(w.word) + 1
    seen = np.unique((before * n + w.at[fit]) * 2 + toxic)
    word = seen // 2 % n
    return np.bincount(word, seen % 2, len(w.word)), np.bincount(word, 1 - seen % 2, len(w.word))


def _untrained(rng) -> Model:
    return Model(rng.normal(0, 0.05, (BUCKETS, WORD_DIM)).astype(np.float32), rng.normal(0, 0.05, (BUCKETS, CHAR_DIM)).astype(np.float32))


def train(texts: list[str], labels: list[int], seed: int = SEED) -> Model:
    """Fit on labelled texts; with fewer than two labels the model scores 0 everywhere."""
    rng = np.random.default_rng(seed)
    small = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
    m = _untrained(rng)
    y_text = np.array(labels, np.float64)
    if len(set(labels)) < 2:
        return m
    d, h = INPUT, HIDDEN
    m.params = {"wf": small(d, 3 * h), "bf": np.zeros(3 * h, np.float32), "uf": small(h, 3 * h),
                "wb": small(d, 3 * h), "bb": np.zeros(3 * h, np.float32), "ub": small(h, 3 * h),
                "att": small(2 * h, h), "att_b": np.zeros(h, np.float32), "query": small(h),
                "out": small(2 * h), "out_b": np.float32(0)}
    w = read_words(texts)
    start, length, text = windows_of(w.per_text)
    owner = np.repeat(np.arange(len(texts)), w.per_text)
    check = np.arange(len(texts)) % 5 == 4
    fit = np.flatnonzero(~check[owner])
    first = np.cumsum(w.counts) - w.counts
    pos, neg = _contexts(w, owner, fit, y_text[owner[fit]].astype(np.int64))
    m.word[:, 0] = _log_odds(np.bincount(w.word, pos, BUCKETS), np.bincount(w.word, neg, BUCKETS))
    m.char[:, 0] = _log_odds(_gram_sums(w, pos), _gram_sums(w, neg))
    # Before the network knows anything, a window's score is its strongest word's log-odds.
    x = word_vectors(m, w)
    strength = x[:, 0] + x[:, WORD_DIM + CHAR_DIM]
    score = np.empty(len(start), np.float32)
    for k in range(0, len(start), CHUNK):
        at, mask = _places(start[k:k + CHUNK], length[k:k + CHUNK], w.at)
        score[k:k + CHUNK] = np.where(mask > 0, strength[at], -9).max(0)
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in m.params.items()}
    squares = {"word": np.full(BUCKETS, 1e-4), "char": np.full(BUCKETS, 1e-4)}
    step = 0
    for epoch in range(EPOCHS):
        chosen = _instances(score, text, y_text, check, rng)
        y = y_text[text[chosen]]
        ratio = max(1.0, (y == 0).sum() / max(1, (y == 1).sum()))
        order = rng.permutation(len(chosen))
        for k in range(0, len(order), 64):
            pick = chosen[order[k:k + 64]]
            at, mask = _places(start[pick], length[pick], w.at)
            used, local = np.unique(at, return_inverse=True)
            local = local.reshape(at.shape)
            part = Words(w.word[used], w.grams[ragged(first[used], w.counts[used])], w.counts[used], None, None)
            vec = word_vectors(m, part)
            t = y_text[text[pick]]
            g, dx = gradients(m, vec, local, mask, t, np.where(t > 0, ratio, 1.0))
            step += 1
            rate = 0.02 * (1 - epoch / EPOCHS)
            for name, grad in g.items():
                a, b = moment[name]
                a[...] = 0.9 * a + 0.1 * grad
                b[...] = 0.999 * b + 0.001 * grad * grad
                m.params[name] = (m.params[name] - rate * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-7)).astype(np.float32)
            by_word = np.zeros((len(used), d), np.float32)
            np.add.at(by_word, local.ravel(), dx.reshape(-1, d))
            _adagrad(m.word, squares["word"], part.word, by_word[:, :WORD_DIM], rate)
            mean, top = by_word[:, WORD_DIM:WORD_DIM + CHAR_DIM], by_word[:, WORD_DIM + CHAR_DIM:]
            best = m.char[part.grams] == np.repeat(vec[:, WORD_DIM + CHAR_DIM:], part.counts, axis=0)
            back = np.repeat(mean / part.counts[:, None], part.counts, axis=0) + best * np.repeat(top, part.counts, axis=0)
            _adagrad(m.char, squares["char"], part.grams, back, rate)
        score = window_logits(m, w, start, length)
    m.fitted = True
    top = np.full(len(texts), -np.inf)
    np.maximum.at(top, text, score)
    ok = check & np.isfinite(top)
    if len(set(y_text[ok])) == 2:
        m.slope, m.shift = _logistic(top[ok], y_text[ok])
    return m


def _instances(score, text, y_text, check, rng) -> np.ndarray:
    """Windows to learn from: of each text the highest-scoring one, of clean texts two more."""
    order = np.lexsort((-score, text))
    head = np.flatnonzero(np.diff(text[order], prepend=-1))
    best = order[head]
    sizes = np.diff(np.append(head, len(order)))
    clean = np.flatnonzero(y_text[text[best]] == 0)
    extra = [order[head[clean] + (rng.random(len(clean)) * sizes[clean]).astype(np.int64)] for _ in range(2)]
    chosen = np.unique(np.concatenate([best, *extra]))
    return chosen[~check[text[chosen]]]


def _adagrad(table, squares, rows, grad, rate) -> None:
    used, back = np.unique(rows, return_inverse=True)
    total = np.zeros((len(used), table.shape[1]), np.float32)
    np.add.at(total, back, grad)
    squares[used] += (total * total).mean(1)
    table[used] -= rate * total / np.sqrt(squares[used])[:, None].astype(np.float32)


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton steps with a small penalty on the slope."""
    mean, spread = x.mean(), x.std() + 1e-6
    v = np.stack([(x - mean) / spread, np.ones(len(x))], 1)
    b = np.zeros(2)
    for _ in range(25):
        p = sigmoid(v @ b)
        hess = (v * (p * (1 - p))[:, None]).T @ v + np.diag([0.1, 1e-3])
        b = b - np.linalg.solve(hess, v.T @ (p - y) + np.array([0.1, 1e-3]) * b)
    return float(b[0] / spread), float(b[1] - b[0] * mean / spread)


def text_scores(m: Model, texts: list[str]) -> np.ndarray:
    """Score of each text: that of its most toxic window; 0 without words."""
    out = np.zeros(len(texts))
    if not m.fitted:
        return out
    w = read_words(texts)
    start, length, text = windows_of(w.per_text)
    top = np.full(len(texts), -np.inf)
    np.maximum.at(top, text, window_logits(m, w, start, length))
    has = w.per_text > 0
    out[has] = sigmoid(m.slope * top[has] + m.shift)
    return out


def packed(m: Model, seed: int = SEED) -> bytes:
    """The model without the embeddings that training left as the seed made them; exact."""
    start, rest = _untrained(np.random.default_rng(seed)), vars(m).copy()
    for name in ("word", "char"):
        table, drawn = rest[name], getattr(start, name)
        rows = np.flatnonzero((table[:, 1:] != drawn[:, 1:]).any(1) | (table[:, 0] != 0)).astype(np.int32)
        rest[name] = rows, table[rows]
    return pickle.dumps(rest)


def unpacked(data: bytes, seed: int = SEED) -> Model:
    rest, start = pickle.loads(data), _untrained(np.random.default_rng(seed))
    for name in ("word", "char"):
        (rows, values), table = rest[name], getattr(start, name)
        table[:, 0] = 0
        table[rows] = values
        rest[name] = table
    return Model(**rest)


def labelled(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """``doc`` and ``label`` (0 or 1) of the rows that may be learned from."""
    return labels.select(F.col(id_col).alias("doc"), F.col(label_col).cast("int").alias("label")) \
        .where(F.col("doc").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc")))


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """Texts and labels of up to ``SAMPLE_PER_LABEL`` ids of each label, by md5 of the id.

    Held-out ids, null labels and null texts are left out. The ids are chosen without their
    texts; the texts are joined to that bounded set.
    """
    ids = lowest_ids(labelled(labels, id_col, label_col), "label", SAMPLE_PER_LABEL).groupBy("doc", "rank").agg(F.max("label").alias("label"))  # both labels: toxic
    found = docs.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text")) \
        .join(F.broadcast(ids), "doc").where(F.col("text").isNotNull())
    lowest = W.partitionBy("label").orderBy("rank", "doc", "text")
    return found.withColumn("n", F.row_number().over(lowest)).where(F.col("n") <= SAMPLE_PER_LABEL)


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic") -> bytes:
    """Learn from the labelled texts that aren't held out; gives the packed model.

    One task trains on the bounded sample, sorted so that reruns agree, and sends the model
    back; the driver holds neither texts nor training state, and only passes the model on.
    """
    sample = training_sample(docs, labels, id_col, text_col, label_col).select("rank", "doc", "text", "label")

    def fit(batches):
        texts, marks = [], []
        for batch in batches:
            texts += column(batch, "text").to_pylist()
            marks += column(batch, "label").to_pylist()
        model = packed(train(texts, marks))
        texts = marks = None
        give_back()
        yield pa.RecordBatch.from_pydict({"model": pa.array([model], pa.binary())})

    fitted = saved(sample.repartition(1).sortWithinPartitions("rank", "doc", "text").mapInArrow(fit, "model binary"))
    found = fitted.collect()
    return bytes(found[0].model) if found else packed(train([], []))


def score_toxicity(docs: DataFrame, model: bytes, text_col: str = "text", out_col: str = "toxicity_score") -> DataFrame:
    """All columns of ``docs`` and ``out_col``, the score by a packed model (a column of that name is replaced).

    A null or empty text, or one without words, scores 0. Repeated rows are each scored. No shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c != out_col]
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)],
                        F.col(text_col).cast("string").alias("text"))
    types = dict(plain.dtypes)
    schema = ", ".join(f"c{i} {types[f'c{i}']}" for i in range(len(kept))) + ", score double"

    def start():
        m = unpacked(shared.value)

        def work(piece):
            return [piece.column(i) for i in range(len(kept))] + [text_scores(m, texts_of(piece))]
        return work

    scored = map_text(plain, schema, start)
    return scored.toDF(*kept, out_col)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from ``THRESHOLD`` on) of every document."""
    model = fit_toxicity(docs, labels)
    scored = score_toxicity(docs.select("doc_id", "text"), model, out_col="score")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows whose score reaches ``THRESHOLD``; columns unchanged."""
    name = free_name(docs, "toxicity_score")
    scored = score_toxicity(docs, fit_toxicity(docs, labels), out_col=name)
    return scored.where(F.col(name) < THRESHOLD).drop(name)
