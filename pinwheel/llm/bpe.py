"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

The vocabulary file is a ``tokenizers`` JSON with byte-level symbols and a word-end suffix:
text is NFC-normalised, white space runs become one blank, letters are lowered, and a pattern
cuts it into pieces; every piece is a list of symbols, one per UTF-8 byte, the last with the
suffix. A complete binary tree over the symbol positions holds at each leaf the key
``rank * width + position`` of the pair that starts there and at each node the smaller key of
its children, so the root is the leftmost pair of lowest rank. A merge changes three leaves
(the pair, the symbol it swallows, the pair before it) and the nodes above them: logarithmic
work per merge. Pieces of equal tree width are merged together, one tree per row of a numpy
array, so that the step costs a few array operations for all of them.

Tasks keep what distinct pieces encode to (dropped beyond ``CACHE_PIECES``, which only costs
time). The vocabulary is read on the driver and broadcast; it has a fixed size. Letters that
only newer Unicode versions know may be classed or lowered differently than by a library built
on an older one.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pinwheel.llm.common import column, map_text, ragged, texts_of
from pinwheel.llm.subwords import Numbers

CACHE_PIECES = 200_000
# Pieces that go through the trees together: bounds the memory of one pass.
TREE_CELLS = 1 << 19
# So few rows are merged one by one on plain lists: a step of one row is a few list accesses.
FEW_ROWS = 16


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves, the other bytes, in order, for the
    characters from U+0100 on.
    """
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def load_vocabulary(path: str) -> dict:
    """Symbols, merge table and pattern of a vocabulary file, as numpy arrays and strings."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, vocab = spec["model"], spec["model"]["vocab"]
    suffix = model["end_of_word_suffix"] or ""
    merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    pairs = np.array([[vocab[a], vocab[b]] for a, b in merges], np.int64).reshape(-1, 2)
    made = np.array([vocab[a + b] for a, b in merges], np.int64)
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    size = max([*vocab.values(), *special.values()], default=-1) + 1
    strings = [""] * size
    for token, i in (*vocab.items(), *special.items()):
        strings[i] = token
    pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    keys = pairs[:, 0] * size + pairs[:, 1]
    order = np.argsort(keys, kind="stable")
    symbols = byte_symbols()
    return {"keys": keys[order], "ranks": order.astype(np.int64), "made": made, "size": size, "strings": strings,
            "inner": np.array([vocab.get(s, -1) for s in symbols], np.int64),
            "last": np.array([vocab.get(s + suffix, -1) for s in symbols], np.int64),
            "special": special, "pattern": pattern}


class Encoder:
    """Encodes texts and remembers their distinct pieces; one per task."""

    def __init__(self, vocabulary: dict):
        import regex
        self.v = vocabulary
        # In the vocabulary's pattern \s is Unicode white space. No piece holds white space, so
        # making its runs one blank first would change nothing.
        self.pieces = regex.compile(vocabulary["pattern"].replace(r"[^\s", r"[^\p{White_Space}"))
        names = sorted(vocabulary["special"], key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.pairs: dict[int, int] = {}
        self.forget()

    def forget(self) -> None:
        self.index = Numbers()
        self.flat = np.zeros(0, np.int64)
        self.starts = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)
        self.decoded: list[str] = []

    def split(self, text: str) -> list:
        """The pieces of a text as strings; a special token is the tuple of its id."""
        if self.special is None:
            return self._split_plain(text)
        parts = self.special.split(text)
        if len(parts) == 1:
            return self._split_plain(text)
        out: list = []
        for i, part in enumerate(parts):
            out += [(self.v["special"][part],)] if i % 2 else self._split_plain(part)
        return out

    def _split_plain(self, text: str) -> list[str]:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # no final sigma
        return self.pieces.findall(text.lower())

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, -1 for pairs that don't merge; a negative symbol merges with none."""
        keys = self.v["keys"]
        if not len(keys):
            return np.full(len(left), -1, np.int64)
        key = left * self.v["size"] + right
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where((keys[at] == key) & (left >= 0) & (right >= 0), self.v["ranks"][at], -1)

    def merge(self, symbols: np.ndarray, lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Merge rows of symbols (one after the other, each at most ``width`` long) until no
        pair has a rank; the ids left and how many each row has."""
        n, none = len(lengths), np.int64(1) << 60
        symbol = np.full((n, width + 1), -1, np.int64)  # the last column stands for "no neighbour"
        spots = np.arange(width)
        alive = spots < lengths[:, None]
        symbol[:, :width][alive] = symbols
        after = np.where(spots + 1 < lengths[:, None], spots + 1, width)
        before = np.empty((n, width + 1), np.int64)
        before[:, 1:width] = spots[:-1]
        before[:, 0] = before[:, width] = width
        tree = np.full((n, 2 * width), none, np.int64)
        rank = self.rank(symbol[:, :width].ravel(), np.take_along_axis(symbol, after, 1).ravel()).reshape(n, width)
        tree[:, width:] = np.where(rank >= 0, rank * width + spots, none)
        level = width // 2
        while level >= 1:
            tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2])
            level //= 2
        tree_f, symbol_f, after_f, before_f = tree.ravel(), symbol.ravel(), after.ravel(), before.ravel()
        live = np.arange(n)
        top = tree_f[2 * width * live + 1]
        while True:
            going = top < none
            live, top = live[going], top[going]
            if not len(live):
                break
            at, fresh = top % width, self.v["made"][top // width]
            sym, link, node = live * (width + 1), live * width, live * 2 * width
            gone = after_f[link + at]
            behind, ahead = after_f[link + gone], before_f[sym + at]
            symbol_f[sym + at] = fresh
            alive[live, gone] = False
            after_f[link + at] = behind
            before_f[sym + behind] = at
            # Three leaves change: the new pair at ``at``, none at ``gone``, and the pair that
            # ends here, at ``ahead``.
            right = self.rank(fresh, symbol_f[sym + behind])
            tree_f[node + width + at] = np.where(right >= 0, right * width + at, none)
            tree_f[node + width + gone] = none
            has = ahead < width
            left = self.rank(symbol_f[sym + ahead], fresh)  # column ``width`` holds -1: no rank
            spot = np.where(has, ahead, at)
            tree_f[node + width + spot] = np.where(has, np.where(left >= 0, left * width + ahead, none), tree_f[node + width + at])
            up = [(width + spot) >> 1, (width + at) >> 1, (width + gone) >> 1]
            while up[0][0] >= 1:
                for x in up:
                    tree_f[node + x] = np.minimum(tree_f[node + 2 * x], tree_f[node + 2 * x + 1])
                up = [x >> 1 for x in up]
            top = tree_f[node + 1]
        # A symbol outside the vocabulary has no id and is left out, as the tokenizer does.
        keep = alive & (symbol[:, :width] >= 0)
        return symbol[:, :width][keep], keep.sum(1)

    def merge_row(self, symbols: np.ndarray) -> np.ndarray:
        """``merge`` for a single row, with the same tree on plain lists."""
        n = len(symbols)
        width, none = 1 << max(1, (n - 1).bit_length()), 1 << 60
        tree = np.full(2 * width, none, np.int64)
        rank = self.rank(symbols[:-1], symbols[1:])
        tree[width:width + n - 1] = np.where(rank >= 0, rank * width + np.arange(n - 1), none)
        level = width // 2
        while level >= 1:
            tree[level:2 * level] = np.minimum(tree[2 * level:4 * level:2], tree[2 * level + 1:4 * level:2])
            level //= 2
        if not self.pairs:
            self.pairs = dict(zip(self.v["keys"].tolist(), self.v["ranks"].tolist()))
        pairs, made, size = self.pairs, self.v["made"], self.v["size"]
        tree, symbol, after, before = tree.tolist(), symbols.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))

        def put(spot: int, left: int, right: int) -> None:
            """The pair at a spot, given its symbols; up the tree until a minimum stays."""
            found = pairs.get(left * size + right) if left >= 0 and right >= 0 else None
            node, value = width + spot, none if found is None else found * width + spot
            tree[node] = value
            while node > 1:
                other = tree[node ^ 1]
                if other < value:
                    value = other
                node >>= 1
                if tree[node] == value:
                    return
                tree[node] = value

        while tree[1] < none:
            best, at = divmod(tree[1], width)
            gone, ahead = after[at], before[at]
            behind = after[gone]
            symbol[at] = int(made[best])
            symbol[gone] = -1
            after[at] = behind
            if behind < n:
                before[behind] = at
            put(at, symbol[at], symbol[behind] if behind < n else -1)
            put(gone, -1, -1)
            if ahead >= 0:
                put(ahead, symbol[ahead], symbol[at])
        left = np.array(symbol, np.int64)
        return left[left >= 0]

    def encode_pieces(self, pieces: list) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the pieces and how many each has."""
        raw = [b"" if isinstance(p, tuple) else p.encode() for p in pieces]
        lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        data = np.frombuffer(b"".join(raw), np.uint8)
        ends = np.cumsum(lengths)
        symbols = self.v["inner"][data]
        last = ends[lengths > 0] - 1
        symbols[last] = self.v["last"][data[last]]
        widths = np.where(lengths > 0, 1 << np.maximum(1, np.ceil(np.log2(np.maximum(lengths, 1)))).astype(np.int64), 0)
        done: list[tuple] = [(np.array([i]), np.array(p), np.array([1])) for i, p in enumerate(pieces) if isinstance(p, tuple)]
        for width in np.unique(widths[widths > 0]):
            members = np.flatnonzero(widths == width)
            if len(members) <= FEW_ROWS:
                for k in members.tolist():
                    ids = self.merge_row(symbols[ends[k] - lengths[k]:ends[k]])
                    done.append((np.array([k]), ids, np.array([len(ids)])))
                continue
            step = max(1, TREE_CELLS // int(width))
            for k in range(0, len(members), step):
                part = members[k:k + step]
                cells = ragged(ends[part] - lengths[part], lengths[part])
                done.append((part, *self.merge(symbols[cells], lengths[part], int(width))))
        counts = np.zeros(len(pieces), np.int64)
        for part, _, n in done:
            counts[part] = n
        first = np.cumsum(counts) - counts
        flat = np.empty(int(counts.sum()), np.int64)
        for part, ids, n in done:
            flat[ragged(first[part], n)] = ids
        return flat, counts

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Flat ids, ids per text, and the decoded texts."""
        if len(self.index) > CACHE_PIECES:
            self.forget()
        known, number = len(self.index), self.index.__getitem__
        docs = [list(map(number, self.split(text))) for text in texts]
        if len(self.index) > known:
            flat, counts = self.encode_pieces(list(self.index)[known:])
            ends = np.cumsum(counts)
            self.starts = np.concatenate([self.starts, len(self.flat) + ends - counts])
            self.counts = np.concatenate([self.counts, counts])
            self.flat = np.concatenate([self.flat, flat])
            ids, strings = flat.tolist(), self.v["strings"]
            self.decoded += [decode(ids[e - n:e], strings) for e, n in zip(ends.tolist(), counts.tolist())]
        at = np.array([i for d in docs for i in d], np.int64)
        ids = self.flat[ragged(self.starts[at], self.counts[at])]
        ends = np.cumsum([0, *map(len, docs)])
        so_far = np.concatenate(([0], np.cumsum(self.counts[at])))
        string = self.decoded.__getitem__
        if (self.counts == 0).any():  # a piece of unknown symbols alone has no token
            docs = [[i for i in d if self.counts[i]] for d in docs]
        return ids, so_far[ends[1:]] - so_far[ends[:-1]], [" ".join(map(string, d)) for d in docs]


def decode(ids: list[int], strings: list[str]) -> str:
    """Without a decoder step the vocabulary's strings are joined by one blank, special ones too."""
    return " ".join([strings[i] for i in ids])


def bpe_encode(df: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Ids and decoded text of every whole text: ``id_col``, ``ids`` array<int>, ``decoded``.

    A null or empty text has no ids and decodes to the empty string. Repeated rows are each
    encoded; other columns of ``df`` are ignored, whatever their names. No shuffle.
    """
    vocabulary = df.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary_path))
    id_type = dict(df.dtypes)[id_col]
    source = df.select(F.col(id_col).alias("doc"), F.col(text_col).cast("string").alias("text"))

    def start():
        encoder = Encoder(vocabulary.value)

        def work(piece):
            ids, per_text, decoded = encoder.encode(texts_of(piece))
            ends = np.concatenate(([0], np.cumsum(per_text))).astype(np.int32)
            return [column(piece, "doc"), pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32))), decoded]
        return work

    return map_text(source, f"doc {id_type}, ids array<int>, decoded string", start).withColumnRenamed("doc", id_col)


def bpe_digest(df: DataFrame, vocabulary_path: str, keep_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by one blank), decoded_sha256; the ids
    as well if ``keep_ids``."""
    coded = bpe_encode(df, vocabulary_path)
    kept = ["ids"] if keep_ids else []
    return coded.select("doc_id", *kept, F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
