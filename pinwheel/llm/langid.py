"""Language identification: averaged hashed subword embeddings and a linear softmax.

A text is the average of the embeddings of all character n-grams of all its words; one linear
layer and a softmax give the languages' probabilities. Embeddings and layer are trained in
numpy by stochastic gradient descent on a bounded sample of labelled texts
(``SAMPLE_PER_LANGUAGE`` rows of each language), cut into excerpts of mixed length so that
short texts are learned as well. A slice of the sample, kept out of training, fits a
temperature (so that the score is a probability) and the rejection score: the lowest score
at which the kept predictions reach ``PRECISION``.

Since the layer is linear, a trained model reduces to one row of logits per bucket; scoring
sums the rows of a text's n-grams, word by word, over the whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from pinwheel.llm.common import column, held_out, lowest_ids, map_text, ragged, saved, texts_of
from pinwheel.llm.subwords import WORDS, gram_buckets, numbered_words

SAMPLE_PER_LANGUAGE = 400
GRAMS = (2, 3, 4)
BUCKETS = 1 << 16
DIM = 16
EPOCHS = 6
EXCERPTS, EXCERPT_WORDS, EXCERPT_CHARS = 4, 60, 2000
PRECISION = 0.995
UNDETERMINED = "und"


@dataclass
class Model:
    """Logits per bucket, the bias, the languages in order, temperature and rejection score."""
    table: np.ndarray
    bias: np.ndarray
    languages: list[str]
    temperature: float
    reject_below: float


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def excerpts(text: str, rng) -> list[str]:
    """``EXCERPTS`` excerpts of 1 to ``EXCERPT_WORDS`` words from anywhere in a text, words beyond
    ``EXCERPT_CHARS`` characters cut off; none without words."""
    words = WORDS.findall(text.lower())
    out = []
    for _ in range(EXCERPTS if words else 0):
        size = min(len(words), int(np.exp(rng.uniform(0, np.log(EXCERPT_WORDS)))) + 1)
        place = int(rng.integers(0, len(words) - size + 1))
        out.append(" ".join(words[place:place + size])[:EXCERPT_CHARS])
    return out


def _bucket_lists(texts: list[str]) -> list[np.ndarray]:
    words, at, per_text = numbered_words(texts)
    buckets, counts = gram_buckets(words, GRAMS, BUCKETS)
    first, ends = np.cumsum(counts) - counts, np.cumsum(per_text)
    return [buckets[ragged(first[at[e - n:e]], counts[at[e - n:e]])] for e, n in zip(ends.tolist(), per_text.tolist())]


def train(texts: list[str], labels: list[str], check: list[bool], languages: list[str], seed: int = 7) -> Model:
    """Fit on excerpts with labels out of ``languages`` (in order); those marked by ``check`` only
    calibrate."""
    if not languages:
        return Model(np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32), [], 1.0, 0.0)
    rng = np.random.default_rng(seed)
    y = np.array([languages.index(x) for x in labels], np.int64)
    held = np.array(check, bool)
    x = _bucket_lists(texts)
    fit_x, fit_y = [b for b, c in zip(x, held) if not c], y[~held]
    embed = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    layer, bias = np.zeros((DIM, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    sizes = np.array([len(x) for x in fit_x])
    weight = len(fit_y) / (len(languages) * np.maximum(1, np.bincount(fit_y, minlength=len(languages))))
    for epoch in range(EPOCHS):
        rate = 2.0 * (1 - epoch / EPOCHS)
        order = rng.permutation(len(fit_x))
        for k in range(0, len(order), 32):
            part = order[k:k + 32]
            flat, n = np.concatenate([fit_x[i] for i in part]), sizes[part]
            owner = np.repeat(np.arange(len(part)), n)
            mean = np.add.reduceat(embed[flat], np.cumsum(n) - n, axis=0) / n[:, None]
            error = softmax(mean @ layer + bias)
            error[np.arange(len(part)), fit_y[part]] -= 1
            error *= (weight[fit_y[part]] / len(part))[:, None]
            back = (error @ layer.T) / n[:, None]
            layer -= rate * (mean.T @ error)
            bias -= rate * error.sum(0)
            np.subtract.at(embed, flat, (rate * len(part) * back[owner]).astype(np.float32))
    model = Model((embed @ layer).astype(np.float32), bias.astype(np.float32), languages, 1.0, 0.0)
    return _calibrated(model, [b for b, c in zip(x, held) if c], y[held])


def _calibrated(model: Model, x: list[np.ndarray], y: np.ndarray) -> Model:
    """Temperature of least log loss on a grid; the score from which kept predictions are precise."""
    if not x:
        return model
    z = np.array([model.table[b].mean(0) for b in x], np.float64) + model.bias
    grid = np.exp(np.linspace(np.log(0.1), np.log(10), 60))
    loss = [-np.log(np.maximum(softmax(z / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    p = softmax(z / model.temperature)
    score, right = p.max(1), p.argmax(1) == y
    order = np.argsort(-score, kind="stable")
    good = np.cumsum(right[order]) / np.arange(1, len(y) + 1) >= PRECISION
    model.reject_below = float(score[order][np.flatnonzero(good)[-1]]) if good.any() else 1.0
    return model


def scores(model: Model, texts: list[str]) -> np.ndarray:
    """Probabilities of the languages, one row per text; a text without words gets the bias alone."""
    words, at, per_text = numbered_words(texts)
    buckets, counts = gram_buckets(words, GRAMS, BUCKETS)
    k = len(model.languages)
    z = np.zeros((len(texts), k))
    if len(at):
        sums = np.add.reduceat(model.table[buckets], np.cumsum(counts) - counts, axis=0).astype(np.float64)
        owner = np.repeat(np.arange(len(texts)), per_text)
        grams = np.bincount(owner, counts[at], len(texts))
        for j in range(k):
            z[:, j] = np.bincount(owner, sums[at, j], len(texts)) / np.maximum(grams, 1)
    return softmax((z + model.bias) / model.temperature) if k else z


def training_sample(df: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """Up to ``SAMPLE_PER_LANGUAGE`` rows of each language, by md5 of the id, held-out ids left out.

    The ids are chosen without their texts; the texts are joined to that bounded set.
    """
    rows = df.select(F.col(id_col).alias("doc"), F.col(lang_col).alias("lang"), F.col(text_col).cast("string").alias("text")) \
        .where(F.col("lang").isNotNull() & F.col("doc").isNotNull() & ~held_out(F.col("doc")))
    ids = lowest_ids(rows, "lang", SAMPLE_PER_LANGUAGE)
    found = rows.join(F.broadcast(ids), ["doc", "lang"]).where(F.col("text").isNotNull())
    lowest = W.partitionBy("lang").orderBy("rank", "doc", "text")
    return found.withColumn("n", F.row_number().over(lowest)).where(F.col("n") <= SAMPLE_PER_LANGUAGE)


def fit_language_id(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Learn from the texts and non-null languages of the rows that aren't held out.

    Tasks cut the sample's texts into excerpts, chosen by the md5 of the id; one task trains on
    these bounded strings, sorted so that reruns agree. The driver only passes the model on.
    """
    sample = training_sample(df, id_col, text_col, lang_col).select("rank", "text", "lang")

    def cut(batches):
        for batch in batches:
            out = []
            for rank, text, lang in zip(*(column(batch, c).to_pylist() for c in ("rank", "text", "lang"))):
                check = int(rank[-4:], 16) % 5 == 4
                out += [(rank, k, lang, part, check) for k, part in enumerate(excerpts(text, np.random.default_rng(int(rank[:15], 16))))]
            if out:
                yield pa.RecordBatch.from_pydict(dict(zip(("rank", "k", "lang", "excerpt", "held"), (
                    pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int32(), pa.string(), pa.string(), pa.bool_()))))))

    def fit(batches):
        texts, labels, check = [], [], []
        for batch in batches:
            texts += column(batch, "excerpt").to_pylist()
            labels += column(batch, "lang").to_pylist()
            check += column(batch, "held").to_pylist()
        m = train(texts, labels, check, sorted(set(labels)))
        yield pa.RecordBatch.from_pydict({
            "logits": pa.array([m.table.tobytes()], pa.binary()), "bias": pa.array([m.bias.tolist()], pa.list_(pa.float32())),
            "languages": pa.array([m.languages], pa.list_(pa.string())), "temperature": pa.array([m.temperature], pa.float64()),
            "reject_below": pa.array([m.reject_below], pa.float64())})

    parts = sample.mapInArrow(cut, "rank string, k int, lang string, excerpt string, held boolean")
    found = saved(parts.repartition(1).sortWithinPartitions("rank", "lang", "k", "excerpt").mapInArrow(
        fit, "logits binary, bias array<float>, languages array<string>, temperature double, reject_below double")).collect()
    if not found or not found[0].languages:
        return train([], [], [], [])
    r = found[0]
    table = np.frombuffer(r.logits, np.float32).reshape(BUCKETS, len(r.languages))
    return Model(table, np.array(r.bias, np.float32), list(r.languages), r.temperature, r.reject_below)


def identify_language(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, held_out, lang_pred, score (0 to 1), rejected.

    ``und`` with score 0, rejected, if the text is null or has no letter, or nothing was
    learned. Repeated rows are each scored; other columns are ignored. No shuffle.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    id_type = dict(df.dtypes)[id_col]
    source = df.select(F.col(id_col).alias("doc"), held_out(F.col(id_col)).alias("held_out"),
                       F.col(text_col).cast("string").alias("text"))

    def start():
        m = shared.value

        def work(piece):
            texts = texts_of(piece)
            p = scores(m, texts)
            known = np.array([bool(m.languages) and any(map(str.isalpha, t)) for t in texts], bool)
            best = p.argmax(1) if m.languages else np.zeros(len(texts), int)
            top = np.where(known, p.max(1) if m.languages else 0.0, 0.0)
            return [column(piece, "doc"), column(piece, "held_out"),
                    [m.languages[b] if k else UNDETERMINED for b, k in zip(best.tolist(), known.tolist())],
                    top, ~known | (top < m.reject_below)]
        return work

    out = map_text(source, f"doc {id_type}, held_out boolean, lang_pred string, score double, rejected boolean", start)
    return out.withColumnRenamed("doc", id_col)
