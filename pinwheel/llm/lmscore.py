"""Language-model scores by a weighted backoff automaton over word n-grams.

A text's tokens are its words (A-Z lowered, runs without ASCII white space) and one end. The
model counts all n-grams up to ``ORDER`` of the training texts and smooths each order with the
one below: with c the count of the n-gram, C that of its context, K a constant of the order,

    P(w | context) = (c + K * P(w | shorter context)) / (C + K),   P(w) = (c + 1) / (N + V + 1)

(N training tokens, V distinct ones). As an automaton: a state is an n-gram that was seen and
can be a context, or the root; its arcs are the words seen after it, with log10 P; where a word
has no arc, the failure arc leads to the state of the context without its first word, at the
weight log10(K / (C + K)). The root has an arc for every word. One traversal of a text from
left to right carries the state and adds up the arcs.

The model grows with the corpus, so no task holds it:

1. Texts are written once to the shared checkpoint folder as slices of about ``SLICE_BYTES``:
   word numbers and the slice's own vocabulary. A longer text goes on in further slices, with
   the words before it as context; its parts' sums are added at the end.
2. Every slice sends its distinct n-grams, as sorted 64-bit hashes with their training counts,
   to ranges of the hash space of at most ``RANGE_KEYS`` n-grams. A range adds up the counts
   of all slices and answers each with the totals of what it sent.
3. A slice with its answers is the part of the automaton that its texts can reach.

Equal n-grams of a slice are one entry, so neither a frequent word nor a text with many
copies makes a hot key. Different n-grams with equal hashes would share their counts (for a
thousand million n-grams, one such pair is expected with a chance of 3 %).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pinwheel.llm.common import column, saved

ORDER = 2
#: K for n-grams of 2, 3, ... words (the last one holds for all longer ones).
SMOOTHING = (500.0, 100.0)
HELD_OUT_MODULUS, HELD_OUT_REST = 7, 2
SLICE_BYTES = 8 << 20
RANGE_KEYS = 1 << 22
#: Tokens whose part of the automaton is laid out at a time.
WALK_TOKENS = 1 << 18
_LOWER = bytes(range(256)).lower()
_MIX = np.uint64(0x9E3779B97F4A7C15)


def training(doc_id, modulus: int = HELD_OUT_MODULUS, rest: int = HELD_OUT_REST):
    """The model learns from a row unless crc32 of its id as text leaves ``rest`` (null ids: it does)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus != rest, F.lit(True))


def smoothing(order: int, constants=SMOOTHING) -> float:
    return constants[min(order - 2, len(constants) - 1)]


# ---- slices of numbered words ----

class _Slice:
    """Parts of texts that are collected for one slice."""

    def __init__(self):
        self.number, self.ids, self.parts, self.size = {b"": 0}, [], [], 0

    def add(self, row, doc, learn, context: list[bytes], words: list[bytes], size: int) -> None:
        number = self.number
        both = context + words
        self.ids.append(np.fromiter([number.setdefault(w, len(number)) for w in both], np.int32, len(both)))
        self.parts.append((row, doc, learn, len(context), len(words)))
        self.size += size

    def columns(self) -> list:
        words, ids = b" ".join(self.number), np.concatenate(self.ids)
        return [*([c] for c in map(list, zip(*self.parts))), [len(words)], [pa.compress(words, codec="zstd", asbytes=True)],
                [len(ids)], [pa.compress(ids.tobytes(), codec="zstd", asbytes=True)]]


def _parts(text: str, order: int, limit: int):
    """(context, words, bytes) of a text's parts of at most ``limit`` bytes; the empty word stands
    for the text's start and, after its last word, for its end."""
    data = text.encode("utf-8", "surrogatepass").translate(_LOWER)
    start, before = 0, [b""]
    while True:
        stop = len(data)
        if stop - start > limit:
            cut = max(data.rfind(c, start, start + limit) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            stop = cut if cut > start else stop
        words = data[start:stop].split()
        if stop == len(data):
            words.append(b"")
        yield before, words, stop - start
        if stop == len(data):
            return
        before, start = (before + words)[-max(order - 1, 1):], stop


def encoded_slices(docs: DataFrame, id_col: str, text_col: str, order: int, slice_bytes: int) -> DataFrame:
    """Slices, saved: ``slice`` (id), and per part of a text ``row``, ``doc``, ``learn``, ``before``
    (context words) and ``n`` (tokens); the vocabulary and the word numbers, compressed."""
    from pyspark.sql.pandas.types import to_arrow_schema
    kind = docs.schema[id_col].dataType.simpleString()
    schema = (f"row array<long>, doc array<{kind}>, learn array<boolean>, before array<int>, n array<int>, "
              "vocabulary_bytes long, vocabulary binary, n_ids long, ids binary")

    def run(batches):
        one = _Slice()
        for batch in batches:
            for row, doc, learn, text in zip(*(column(batch, c).to_pylist() for c in ("row", "doc", "learn", "text"))):
                for context, words, size in _parts(text or "", order, slice_bytes):
                    one.add(row, doc, learn, context, words, size)
                    if one.size >= slice_bytes:
                        yield made(one)
                        one = _Slice()
        if one.parts:
            yield made(one)

    arrow = to_arrow_schema(docs.sparkSession.createDataFrame([], schema).schema)

    def made(one):
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(one.columns(), arrow)], schema=arrow)

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc"), training(F.col(id_col)).alias("learn"),
                       F.col(text_col).cast("string").alias("text"))
    return saved(rows.mapInArrow(run, schema).withColumn("slice", F.monotonically_increasing_id()))


# ---- n-grams of a slice ----

class Grams:
    """The distinct n-grams of a slice.

    ``keys[m]`` are the sorted hashes of those of m words, ``at[m]`` gives each position's n-gram
    that ends there (-1 where the part has too few words before), ``count[m]`` the training counts.
    """

    def __init__(self, row: dict, order: int):
        import xxhash
        self.before, self.n = np.array(row["before"], np.int64), np.array(row["n"], np.int64)
        self.ids = np.frombuffer(pa.decompress(row["ids"], decompressed_size=4 * row["n_ids"], codec="zstd", asbytes=True), np.int32).astype(np.int64)
        words = pa.decompress(row["vocabulary"], decompressed_size=row["vocabulary_bytes"], codec="zstd", asbytes=True).split(b" ")
        self.n_words = len(words)
        digests = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))
        size = self.before + self.n
        self.ends = np.cumsum(size)
        inside = np.arange(len(self.ids)) - np.repeat(self.ends - size, size)  # place in its part
        self.token = inside >= np.repeat(self.before, size)
        learn = self.token & np.repeat(np.array(row["learn"], bool), size)
        key = word = digests[self.ids]
        self.keys, self.at, self.count = {}, {}, {}
        for m in range(1, order + 1):
            if m > 1:  # the hash of the context, which ends one place earlier, and the word
                key = np.concatenate((key[:1], key[:-1]))
                key = (key ^ (key >> np.uint64(31))) * _MIX + word
            has = np.flatnonzero(inside >= m - 1)
            keys, which = np.unique(key[has], return_inverse=True)
            at = np.full(len(self.ids), -1, np.int64)
            at[has] = which
            self.keys[m], self.at[m] = keys, at
            self.count[m] = np.bincount(at[learn & (at >= 0)], minlength=len(keys))


def _planes(values: np.ndarray) -> bytes:
    """Fixed-width integers by byte place, compressed."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize)
    return pa.compress(np.ascontiguousarray(raw.T).tobytes(), codec="zstd", asbytes=True)


def _from_planes(data: bytes, n: int, kind) -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = np.frombuffer(pa.decompress(data, decompressed_size=n * width, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(raw.reshape(width, n).T).view(kind).ravel()


def _ranges(keys: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each (sorted) key; ranges part the hash space evenly."""
    return ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


_SLICE_COLUMNS = ["slice", "row", "doc", "learn", "before", "n", "vocabulary_bytes", "vocabulary", "n_ids", "ids"]


def sent_grams(slices: DataFrame, order: int, ranges: int) -> DataFrame:
    """``rng``, ``slice``, ``size`` (words of the n-grams), ``n``, ``keys``, ``counts``."""
    schema = pa.schema([("rng", pa.int32()), ("slice", pa.int64()), ("size", pa.int32()), ("n", pa.int64()), ("keys", pa.binary()),
                        ("counts", pa.binary())])

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: v[0] for c, v in batch.slice(k, 1).to_pydict().items()}
                grams, out = Grams(row, order), []
                for m, keys in grams.keys.items():
                    where = _ranges(keys, ranges)
                    starts = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1]))[:len(where)])
                    for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)]):
                        steps = np.diff(keys[a:b], prepend=np.uint64(0))
                        out.append((int(where[a]), row["slice"], m, b - a, _planes(steps), _planes(grams.count[m][a:b].astype(np.uint32))))
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return slices.select("slice", "learn", "before", "n", "vocabulary_bytes", "vocabulary", "n_ids", "ids") \
        .mapInArrow(run, "rng int, slice long, size int, n long, keys binary, counts binary")


def totals(sent: DataFrame, ranges: int) -> DataFrame:
    """``slice``, ``size``, ``rng``, ``n``, ``counts``: for every entry of ``sent`` the training counts
    over all slices; and a row of slice -1 per range, ``n`` being its distinct training words."""
    schema = pa.schema([("slice", pa.int64()), ("size", pa.int32()), ("rng", pa.int32()), ("n", pa.int64()), ("counts", pa.binary())])

    def run(batches):
        entries: dict[tuple, list] = {}
        for batch in batches:
            for rng, slice_id, size, n, keys, counts in zip(*(batch.column(k).to_pylist() for k in range(6))):
                entries.setdefault((rng, size), []).append((slice_id, n, keys, counts))
        for (rng, size), mine in entries.items():
            keys = np.concatenate([np.cumsum(_from_planes(k, n, np.uint64), dtype=np.uint64) for _, n, k, _ in mine])
            counts = np.concatenate([_from_planes(c, n, np.uint32) for _, n, _, c in mine])
            distinct, which = np.unique(keys, return_inverse=True)
            total = np.bincount(which, weights=counts, minlength=len(distinct)).astype(np.uint64)
            known = int((total > 0).sum())
            ends = np.cumsum([n for _, n, _, _ in mine])
            blobs = [_planes(total[which[e - n:e]]) for (_, n, _, _), e in zip(mine, ends.tolist())]
            out = [(s, size, rng, n, b) for (s, n, _, _), b in zip(mine, blobs)]
            if size == 1:
                out.append((-1, size, rng, known, b""))
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return sent.repartitionById(ranges, F.col("rng")).mapInArrow(run, "slice long, size int, rng int, n long, counts binary")


# ---- the automaton ----

class Automaton:
    """States, arcs and failure arcs for the n-grams that end at some positions of a slice."""

    def __init__(self, grams: Grams, total: dict, logs: dict, backs: dict, at: np.ndarray):
        order, words = max(grams.keys), grams.n_words
        base = np.concatenate(([0], np.cumsum([len(grams.keys[m]) for m in range(1, order + 1)])))
        self.root = int(base[-1])
        self.words = words
        arcs, self.fail, self.back = {}, {}, {}
        for m in range(1, order + 1):
            here = at[grams.at[m][at] >= 0]
            gram, first = np.unique(grams.at[m][here], return_index=True)
            here = here[first]
            seen = np.ones(len(gram), bool) if m == 1 else total[m][gram] > 0
            gram, here = gram[seen], here[seen]
            state = base[m - 1] + gram                       # as a context
            known = total[m][gram] > 0
            lower = np.full(len(gram), self.root) if m == 1 else base[m - 2] + grams.at[m - 1][here]
            source = np.full(len(gram), self.root) if m == 1 else base[m - 2] + grams.at[m - 1][here - 1]
            goal = np.where(known, state, lower) if m < order or m == 1 else lower
            arcs.update(zip((source * words + grams.ids[here]).tolist(), zip(logs[m][gram].tolist(), goal.tolist())))
            if m < order:
                self.fail.update(zip(state[known].tolist(), lower[known].tolist()))
                self.back.update(zip(state[known].tolist(), backs[m][gram[known]].tolist()))
        if order == 1:  # no contexts: every arc leads back to the root
            arcs = {k: (v, self.root) for k, (v, _) in arcs.items()}
        self.arcs = arcs

    def walk(self, ids: list[int], start: int) -> float:
        """Log10 probability of the words from place ``start`` on; those before are context."""
        arcs, fail, back, words, state = self.arcs, self.fail, self.back, self.words, self.root
        total = 0.0
        for k, w in enumerate(ids):
            if k == start:
                total = 0.0
            arc = arcs.get(state * words + w)
            while arc is None:
                total += back[state]
                state = fail[state]
                arc = arcs.get(state * words + w)
            total += arc[0]
            state = arc[1]
        return total


def slice_scores(grams: Grams, total: dict, n_train: int, n_distinct: int, constants=SMOOTHING, walk_tokens: int = WALK_TOKENS):
    """(known tokens, base score, score) of every part of a slice; ``total`` as ``Grams.count``."""
    order = max(grams.keys)
    p = {1: (total[1] + 1.0) / (n_train + n_distinct + 1.0)}
    logs, backs = {1: np.log10(p[1])}, {}
    for m in range(2, order + 1):
        gram, first = np.unique(grams.at[m], return_index=True)
        first = first[gram >= 0]  # a position where each n-gram ends
        k = smoothing(m, constants)
        backs[m - 1] = np.log10(k / (total[m - 1] + k))
        p[m] = (total[m] + k * p[m - 1][grams.at[m - 1][first]]) / (total[m - 1][grams.at[m - 1][first - 1]] + k)
        logs[m] = np.log10(p[m])
    size = grams.before + grams.n
    starts = grams.ends - size
    words = grams.at[1]
    known = np.add.reduceat(np.where(grams.token, total[1][words] > 0, False).astype(np.int64), starts)
    base = np.add.reduceat(np.where(grams.token, logs[1][words], 0.0), starts)
    scores, k = [], 0
    while k < len(size):
        stop = max(k + 1, int(np.searchsorted(grams.ends, starts[k] + walk_tokens, side="right")))
        a, b = int(starts[k]), int(grams.ends[stop - 1])
        automaton = Automaton(grams, total, logs, backs, np.arange(a, b))
        ids = grams.ids[a:b].tolist()
        for j in range(k, stop):
            scores.append(automaton.walk(ids[starts[j] - a:grams.ends[j] - a], int(grams.before[j])))
        k = stop
    return known, base, np.array(scores)


def lm_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER, constants=SMOOTHING,
              slice_bytes: int = SLICE_BYTES, range_keys: int = RANGE_KEYS) -> DataFrame:
    """Every row's id, ``held_out``, ``n_tokens``, ``n_known`` (tokens the training texts have),
    ``train_tokens``, ``base_score`` (log10 probability by single tokens) and ``score``.

    A null or wordless text has one token, its end. Repeated rows are returned as often as they
    come. Rows with a null id are trained on. An empty table gives no rows; without training
    rows all tokens are unknown. Other columns may have any names.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    slices = encoded_slices(docs, id_col, text_col, order, slice_bytes)
    both = F.arrays_zip("n", "learn")
    size = slices.select(F.aggregate(both, F.lit(0).cast("long"), lambda s, x: s + x["n"]).alias("all"),
                         F.aggregate(both, F.lit(0).cast("long"), lambda s, x: s + F.when(x["learn"], x["n"]).otherwise(0)).alias("train")) \
        .agg(F.coalesce(F.sum("all"), F.lit(0)).alias("all"), F.coalesce(F.sum("train"), F.lit(0)).alias("train")).first()
    ranges = max(1, -(-order * size["all"] // range_keys))
    answers = saved(totals(sent_grams(slices, order, ranges), ranges))
    n_train = int(size["train"])
    n_distinct = int(answers.where(F.col("slice") < 0).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("v")).first()["v"])
    schema = f"row long, doc {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(docs.sparkSession.createDataFrame([], schema).schema)

    def scored(row, parts):
        grams = Grams(row, order)
        total = {m: np.concatenate([_from_planes(c, n, np.uint64) for n, c in parts[m]]).astype(np.float64) if m in parts
                 else np.zeros(0) for m in grams.keys}
        known, base, score = slice_scores(grams, total, n_train, n_distinct, constants)
        learn = row["learn"]
        cols = [row["row"], row["doc"], [not x for x in learn], row["n"], known, base, score]
        return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(cols, arrow)], schema=arrow)

    def run(batches):
        row, parts = None, {}
        for batch in batches:
            for k in range(batch.num_rows):
                one = {c: v[0] for c, v in batch.slice(k, 1).to_pydict().items()}
                if one["size"] == 0:  # a slice comes before its answers
                    if row is not None:
                        yield scored(row, parts)
                    row, parts = one, {}
                else:
                    parts.setdefault(one["size"], []).append((one["n_counts"], one["counts"]))
        if row is not None:
            yield scored(row, parts)

    lines = slices.select(*_SLICE_COLUMNS, F.lit(0).alias("size"), F.lit(-1).alias("rng")) \
        .unionByName(answers.where(F.col("slice") >= 0).select("slice", "size", "rng", F.col("n").alias("n_counts"), "counts"), allowMissingColumns=True)
    parts = lines.repartition("slice").sortWithinPartitions("slice", "size", "rng").mapInArrow(run, schema)
    whole = parts.groupBy("row").agg(
        F.any_value("doc").alias(id_col), F.any_value("held_out").alias("held_out"), F.sum("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"), F.sum("base_score").alias("base_score"), F.sum("score").alias("score"))
    return whole.select(id_col, "held_out", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"), "base_score", "score")
