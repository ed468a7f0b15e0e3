"""Phrase collocation mining by vertical partitioning of a depth-truncated suffix tree.

Texts are lowered (A-Z), cut into pieces at ``.,;:!?`` and line ends, and pieces into words at
blanks and tabs. For each language, a phrase of 2 to ``DEPTH`` words that occurs at least
``LEAST`` times is a candidate; its score is the lowest, over all cuts into two parts, of
floor(1000 * a * n / (l * r)) from the counts of the phrase, all words and the two parts.

The counts come from the suffix tree of all pieces, with words as symbols, cut off at depth
``DEPTH`` and never built as a whole:

1. Words are counted (one row per word of a slice, summed by Spark). Rarer words than
   ``LEAST`` are in no candidate, so a suffix ends before one.
2. Vertical partitioning: prefixes, one word at first, are packed into groups that have at
   most ``BUDGET`` suffixes. The prefixes are known by a hash slot (a table of ``SLOTS``
   entries, whatever the vocabulary); slots heavier than the budget are split by a longer
   prefix, counted in a further pass, up to the full depth.
3. Every slice of text sends each group its suffixes, equal ones added up, so a passage that
   is repeated everywhere costs one row per slice. A group is one task: it sorts its suffixes
   into the leaves of its subtree, and every inner node's count is the total of its leaves.
   Nodes above a group's prefix are partial and are added up by Spark. The ``CODED`` most
   frequent words travel as numbers, others as they are.

Scores, cuts and dropped candidates are joins over the candidates. Only hash slots' loads
(at most ``SLOTS`` rows a level) pass through the driver.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from pinwheel.llm.common import column, saved, slices

DEPTH, LEAST, TOP = 5, 100, 2000
#: A candidate is dropped if a longer one that contains it has at least this share of its count.
SHARE_PERCENT = 100
SLOT_BITS = 18
SLOTS = 1 << SLOT_BITS
BUDGET = 1 << 21
TEXT_BYTES = 8 << 20
#: The most frequent words (of at most CODED_BYTES bytes) travel as numbers.
CODED, CODED_BYTES = 65_000, 64
ABSENT, LONGER = -1, -2
#: A-Z lowered, what ends a piece is a line feed, a tab is a blank.
_BYTES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")
#: Stands between pieces; no word is a full stop.
END = b"."
_MIX = np.uint64(0x9E3779B97F4A7C15)


def tokens(text: str, limit: int = TEXT_BYTES):
    """Lists of words, with ``END`` after each piece; a text of more than ``limit`` bytes comes in
    several lists, cut between pieces."""
    data = text.encode("utf-8", "surrogatepass").translate(_BYTES)
    start = 0
    while start < len(data):
        stop = len(data)
        if stop - start > limit:
            cut = data.rfind(b"\n", start, start + limit)
            cut = data.find(b"\n", start + limit) if cut < start else cut
            stop = cut + 1 if cut >= 0 else stop
        found = data[start:stop].replace(b"\n", b" . ").split()
        found.append(END)
        yield found
        start = stop


def _lists(batches):
    """(language, words of many texts) of bounded size from batches of ``lang`` and ``text``."""
    for batch in batches:
        for piece in slices(batch, "text", TEXT_BYTES):
            held: dict[str, list] = {}
            for lang, text in zip(column(piece, "lang").to_pylist(), column(piece, "text").to_pylist()):
                if not text:
                    continue
                if len(text) > TEXT_BYTES // 4:
                    for found in tokens(text):
                        yield lang, found
                else:
                    mine = held.setdefault(lang, [])
                    for found in tokens(text):
                        mine += found
            yield from held.items()


def _key(lang: str, word: bytes) -> int:
    import xxhash
    return xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass") + b"\n" + word)


def _slot(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - SLOT_BITS)).astype(np.int64)


def word_counts(texts: DataFrame) -> DataFrame:
    """``lang``, ``word``, ``slot``, ``f``: all words of ``texts`` (``lang``, ``text``)."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("slot", pa.int32()), ("f", pa.int64())])

    def run(batches):
        for lang, found in _lists(batches):
            count = Counter(found)
            del count[END]
            words = list(count)
            slot = _slot(np.fromiter((_key(lang, w) for w in words), np.uint64, len(words)))
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), pa.array([w.decode("utf-8", "surrogatepass") for w in words], pa.string()),
                                              pa.array(slot, pa.int32()), pa.array(list(count.values()), pa.int64())], schema=schema)

    rows = texts.mapInArrow(run, "lang string, word string, slot int, f long")
    return rows.groupBy("lang", "word", "slot").agg(F.sum("f").alias("f"))


# ---- vertical partitioning ----

def packed(loads: np.ndarray, budget: int, first: int) -> tuple[np.ndarray, int]:
    """Group of each slot, heaviest slots first, and the number after the last group used.

    ``ABSENT`` for slots without load, ``LONGER`` for those above the budget.
    """
    table = np.full(len(loads), ABSENT, np.int32)
    table[loads > budget] = LONGER
    fits = np.flatnonzero((loads > 0) & (loads <= budget))
    group, room = first, budget
    for slot in fits[np.argsort(-loads[fits], kind="stable")].tolist():
        if loads[slot] > room:
            group, room = group + 1, budget
        table[slot] = group
        room -= int(loads[slot])
    return table, group + 1 if len(fits) else first


class _Slice:
    """The suffixes of one list of words: rows of up to ``depth`` words that all may be frequent."""

    def __init__(self, lang: str, found: list[bytes], tables: list[np.ndarray], depth: int):
        number = {w: k for k, w in enumerate(dict.fromkeys(found))}
        ids = np.fromiter(map(number.__getitem__, found), np.int64, len(found))
        self.words, self.depth = list(number), depth
        self.keys = np.fromiter((_key(lang, w) for w in self.words), np.uint64, len(self.words))
        frequent = tables[0][_slot(self.keys)] != ABSENT
        frequent[number[END]] = False
        # Words count from 1; 0 ends a suffix.
        line = np.concatenate((np.where(frequent[ids], ids + 1, 0), np.zeros(depth, np.int64)))
        at = np.flatnonzero((line[:len(ids)] > 0) & (line[1:len(ids) + 1] > 0))
        self.cols = [line[at], line[at + 1]]
        for k in range(2, depth):
            self.cols.append(np.where(self.cols[-1] > 0, line[at + k], 0))

    def groups(self, tables: list[np.ndarray], cols: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Group of each row, and the key at which the tables end for rows of group ``LONGER``."""
        padded = np.concatenate((np.zeros(1, np.uint64), self.keys))
        key = padded[cols[0]]
        group = tables[0][_slot(key)]
        for k in range(1, len(tables) + 1):
            more = group == LONGER
            if not more.any() or k >= self.depth:
                break
            key = np.where(more, (key ^ (key >> np.uint64(29))) * _MIX + padded[cols[k]], key)
            if k < len(tables):
                group = np.where(more, tables[k][_slot(key)], group)
        return group, key

    def distinct(self) -> tuple[list[np.ndarray], np.ndarray]:
        """Equal rows added up: the rows in order of their words' numbers, and how often each comes."""
        rank, first, n = self.cols[0], None, np.int64(len(self.words) + 1)
        for col in self.cols[1:]:
            _, first, rank, count = np.unique(rank * n + col, return_index=True, return_inverse=True, return_counts=True)
        return [c[first] for c in self.cols], count


def longer_loads(texts: DataFrame, tables: list[np.ndarray], depth: int) -> np.ndarray:
    """How many suffixes of groups still ``LONGER`` fall into each slot of one word more."""
    def run(batches):
        loads = np.zeros(SLOTS, np.int64)
        for lang, found in _lists(batches):
            part = _Slice(lang, found, tables, depth)
            group, key = part.groups(tables, part.cols)
            loads += np.bincount(_slot(key[group == LONGER]), minlength=SLOTS)
        slots = np.flatnonzero(loads)
        yield pa.RecordBatch.from_pydict({"slot": pa.array(slots, pa.int32()), "n": pa.array(loads[slots], pa.int64())})

    rows = texts.mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    return _loads(rows)


def _loads(rows: DataFrame) -> np.ndarray:
    """At most ``SLOTS`` rows (``slot``, ``n``) as an array."""
    found = rows.toArrow()
    loads = np.zeros(SLOTS, np.int64)
    loads[found["slot"].to_numpy()] = found["n"].to_numpy()
    return loads


def vertical_partition(texts: DataFrame, frequent: DataFrame, depth: int, budget: int) -> tuple[list[np.ndarray], list[int]]:
    """Tables from slots to groups, one for each prefix length, and the first group of each."""
    table, end = packed(_loads(frequent.groupBy("slot").agg(F.sum("f").alias("n"))), budget, 0)
    tables, firsts = [table], [0, end]
    while (tables[-1] == LONGER).any():
        # All words of a suffix are its prefix in the end: equal suffixes are one row per slice.
        most = budget if len(tables) < depth - 1 else 1 << 62
        table, end = packed(longer_loads(texts, tables, depth), most, firsts[-1])
        tables.append(table)
        firsts.append(end)
    return tables, firsts


# ---- subtrees ----

def _pack(rows: np.ndarray) -> bytes:
    return pa.compress(rows.tobytes(), codec="zstd", asbytes=True)


def _unpack(data: bytes, n: int, kind) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, decompressed_size=n * np.dtype(kind).itemsize, codec="zstd", asbytes=True), kind)


def code_book(frequent: DataFrame) -> dict[str, list[bytes]]:
    """The ``CODED`` most frequent words, by language, in a fixed order."""
    top = frequent.where(F.octet_length("word") <= CODED_BYTES).orderBy(F.desc("f"), "lang", "word").limit(CODED).select("lang", "word").toArrow()
    book: dict[str, list[bytes]] = {}
    for lang, word in zip(top["lang"].to_pylist(), top["word"].to_pylist()):
        book.setdefault(lang, []).append(word.encode("utf-8", "surrogatepass"))
    return book


def _dealt(texts: DataFrame, tables: list[np.ndarray], depth: int, book: dict[str, list[bytes]]) -> DataFrame:
    """One row per slice and group: ``grp``, ``lang``, and the suffixes by column. A word is its
    place in the language's code book, from 1, or counts on from there in ``words``; 0 is none."""
    schema = pa.schema([("grp", pa.int32()), ("lang", pa.string()), ("words", pa.binary()), ("word_bytes", pa.int64()),
                        ("n_rows", pa.int64()), ("width", pa.int32()), ("cols", pa.binary()), ("counts", pa.binary())])

    def run(batches):
        codes = {lang: {w: k for k, w in enumerate(words, 1)} for lang, words in book.items()}
        for lang, found in _lists(batches):
            part = _Slice(lang, found, tables, depth)
            if not len(part.cols[0]):
                continue
            cols, count = part.distinct()
            group, _ = part.groups(tables, cols)
            mine = codes.get(lang, {})
            top = len(mine)
            code = np.fromiter((mine.get(w, 0) for w in part.words), np.int64, len(part.words))
            code[code == 0] = top + 1 + np.arange(int((code == 0).sum()))  # of the slice; closed up below
            code = np.concatenate(([0], code))
            plain = np.array([k for k, w in enumerate(part.words) if w not in mine], np.int64)
            order = np.argsort(group, kind="stable")
            group, out = group[order], []
            starts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(group)]):
                block = np.stack([code[c[order[a:b]]] for c in cols])
                others = np.unique(block[block > top])
                block[block > top] = top + 1 + np.searchsorted(others, block[block > top])
                words = b"\n".join([part.words[k] for k in plain[others - top - 1].tolist()])
                kind = np.uint16 if top + len(others) < 1 << 16 else np.uint32
                out.append((int(group[a]), lang, pa.compress(words, codec="zstd", asbytes=True), len(words), b - a, np.dtype(kind).itemsize,
                            _pack(block.astype(kind)), _pack(count[order[a:b]].astype(np.uint32))))
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out), schema)], schema=schema)

    return texts.mapInArrow(run, "grp int, lang string, words binary, word_bytes long, n_rows long, width int, cols binary, counts binary")


def _nodes(rows: list[tuple], depth: int, least: int, whole_from: int, book: dict[str, list[bytes]]):
    """(language, phrase, count) of the subtree's nodes of two words and more.

    ``rows``: (lang, words, cols, counts) of one group. Nodes with fewer than ``whole_from``
    words may continue in other groups; the others are left out below ``least``.
    """
    langs: dict[str, int] = {}
    number: dict[bytes, int] = {b"": 0}
    coded: dict[str, np.ndarray] = {}
    cols, counts, which = [], [], []
    for lang, words, block, count in rows:
        if lang not in coded:
            coded[lang] = np.fromiter((number.setdefault(w, len(number)) for w in [b"", *book.get(lang, [])]), np.int64)
        ids = np.concatenate((coded[lang], np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))))
        cols.append(ids[block])
        counts.append(count.astype(np.int64))
        which.append(np.full(len(count), langs.setdefault(lang, len(langs)), np.int64))
    cols, counts, which = np.concatenate(cols, axis=1), np.concatenate(counts), np.concatenate(which)
    n = np.int64(len(number))
    pairs = [which * n + cols[0], *[cols[k] * n + (cols[k + 1] if k + 1 < depth else 0) for k in range(1, depth, 2)]]
    order = np.lexsort(pairs[::-1])
    cols, counts, which = cols[:, order], counts[order], which[order]
    words, names = list(number), list(langs)
    new = np.concatenate(([True], which[1:] != which[:-1]))
    for k in range(depth):
        new[1:] |= cols[k, 1:] != cols[k, :-1]
        if not k:
            continue
        at = np.flatnonzero(new)
        total = np.add.reduceat(counts, at)
        if k + 1 >= whole_from:
            at, total = at[total >= least], total[total >= least]
        here = cols[k, at] > 0
        for i, t in zip(at[here].tolist(), total[here].tolist()):
            yield names[which[i]], b" ".join([words[w] for w in cols[:k + 1, i].tolist()]).decode("utf-8", "surrogatepass"), t


def phrase_counts(texts: DataFrame, words: DataFrame, depth: int = DEPTH, least: int = LEAST, budget: int = BUDGET) -> DataFrame:
    """``lang``, ``phrase``, ``f``: phrases of 2 to ``depth`` words found at least ``least`` times in
    ``texts`` (``lang``, ``text``); ``words`` from ``word_counts``."""
    schema = "lang string, phrase string, f long"
    arrow = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])
    tables, firsts = vertical_partition(texts, words.where(F.col("f") >= least), depth, budget)
    if not firsts[-1]:
        return texts.sparkSession.createDataFrame([], schema)
    book = code_book(words.where(F.col("f") >= least))

    def subtree(batches):
        rows, group = [], None
        for batch in batches:
            for grp, lang, packed_words, size, n, width, cols, counts in zip(*(batch.column(k).to_pylist() for k in range(8))):
                group = grp
                found = pa.decompress(packed_words, decompressed_size=size, codec="zstd", asbytes=True).split(b"\n") if size else []
                rows.append((lang, found, _unpack(cols, depth * n, np.uint16 if width == 2 else np.uint32).reshape(depth, n), _unpack(counts, n, np.uint32)))
        if rows:
            length = sum(group >= f for f in firsts[1:]) + 1
            out = list(_nodes(rows, depth, least, length, book))
            for k in range(0, len(out), 10_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out[k:k + 10_000]), arrow)], schema=arrow)

    dealt = _dealt(texts, tables, depth, book).repartitionById(firsts[-1], F.col("grp"))
    return dealt.mapInArrow(subtree, schema).groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)


# ---- candidates ----

def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", depth: int = DEPTH, least: int = LEAST,
                 top: int | None = TOP, share_percent: int = SHARE_PERCENT, budget: int = BUDGET) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score`` (see above) of the ``top``
    phrases of each language by score, a (both descending) and phrase; all of them if None.

    Null texts count as empty, null languages as ``und``. Repeated rows count as often as they
    come. An empty table, or one without a candidate, gives no rows.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text"))
    words = saved(word_counts(texts))
    phrases = saved(phrase_counts(texts, words, depth, least, budget))
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    known = words.where(F.col("f") >= least).select("lang", F.col("word").alias("part"), "f") \
        .unionByName(phrases.select("lang", F.col("phrase").alias("part"), "f"))
    w = F.split("phrase", " ")
    cut = phrases.select("lang", "phrase", F.col("f").alias("a"), w.alias("w"), F.explode(F.sequence(F.lit(1), F.size(w) - 1)).alias("k")) \
        .select("lang", "phrase", "a", "k", F.size("w").alias("size"), F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("first"),
                F.array_join(F.slice("w", F.col("k") + 1, F.size("w") - F.col("k")), " ").alias("rest"))
    # A phrase inside a longer one is inside one of one word more that is at least as frequent.
    inside = cut.where(F.col("k") == 1).select("lang", F.col("rest").alias("phrase"), "a") \
        .unionByName(cut.where(F.col("k") == F.col("size") - 1).select("lang", F.col("first").alias("phrase"), "a")) \
        .groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    part = lambda name, f: known.select("lang", F.col("part").alias(name), F.col("f").alias(f))
    scored = cut.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"]).join(totals, "lang")
    wide = "cast({} as decimal(19,0))"
    score = F.expr(f"(cast(1000 as decimal(4,0)) * {wide.format('a')} * {wide.format('n')}) div ({wide.format('l')} * {wide.format('r')})")
    lowest = scored.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
    kept = lowest.join(inside, ["lang", "phrase"], "left") \
        .where(F.col("longer").isNull() | (100 * F.col("longer") < share_percent * F.col("a")))
    order = W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.select("lang", "phrase", "a", "c.l", "c.r", "n", "c.score").withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)  # every task keeps its own best before the shuffle
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def oracle_sql(depth: int = DEPTH, least: int = LEAST, top: int = TOP, share_percent: int = SHARE_PERCENT) -> str:
    """DuckDB SQL for ``collocations``."""
    grams = " UNION ALL ".join(
        f"SELECT lang, {k} AS m, list_aggregate(list_slice(w, i, i + {k - 1}), 'string_agg', ' ') AS phrase "
        f"FROM (SELECT lang, w, unnest(range(1, len(w) - {k - 2})) AS i FROM p WHERE len(w) >= {k})" for k in range(1, depth + 1))
    return f"""
WITH p AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
          unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents)),
g AS ({grams}),
f AS (SELECT lang, m, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= {least}),
t AS (SELECT lang, sum(len(w)) AS n FROM p GROUP BY lang),
c AS (
  SELECT lang, m, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:m], ' ') AS rest
  FROM (SELECT *, string_split(phrase, ' ') AS w, unnest(range(1, m)) AS k FROM f WHERE m > 1)),
s AS (
  SELECT c.*, l.f AS l, r.f AS r, t.n,
    (CAST(1000 AS HUGEINT) * c.a * CAST(t.n AS HUGEINT)) // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM c JOIN f l ON l.lang = c.lang AND l.phrase = c.first JOIN f r ON r.lang = c.lang AND r.phrase = c.rest JOIN t ON t.lang = c.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
x AS (
  SELECT DISTINCT c.lang, i.phrase FROM (SELECT lang, phrase, a, m, string_split(phrase, ' ') AS w FROM c WHERE k = 1) c,
    LATERAL (SELECT array_to_string(w[s:s + z - 1], ' ') AS phrase FROM range(1, m) a1(s), range(2, m) a2(z) WHERE s + z - 1 <= m) i
    JOIN f ON f.lang = c.lang AND f.phrase = i.phrase WHERE 100 * c.a >= {share_percent} * f.f)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
      FROM b WHERE NOT EXISTS (SELECT 1 FROM x WHERE x.lang = b.lang AND x.phrase = b.phrase))
WHERE rank <= {top}"""
