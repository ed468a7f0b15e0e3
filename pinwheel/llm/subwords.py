"""Hashed subword features of words, computed for many words at once.

A word is lower-cased and wrapped in two boundary marks; its features are its character
n-grams (each hashed to a bucket) and, if asked for, the whole word. All arithmetic is on
numpy arrays of code points, so the cost per word is small and equal words need one pass.
"""

from __future__ import annotations

import re

import numpy as np

from pinwheel.llm.common import WORD

WORDS = re.compile(WORD)
MARK = 0x110000  # no code point
# Words hashed together: bounds the memory of one pass.
WORDS_AT_ONCE = 20_000
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def marked_codes(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all words, each between two marks; start and length of each."""
    sep = "\n"  # no word holds a line feed
    joined = np.frombuffer((sep + sep.join(w + sep for w in words)).encode("utf-32-le", "surrogatepass"), np.uint32) if words \
        else np.zeros(0, np.uint32)
    codes = joined.astype(np.uint64)
    codes[joined == 10] = MARK
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    return codes, np.cumsum(lengths) - lengths, lengths


def gram_buckets(words: list[str], sizes: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of every n-gram (n in ``sizes``) of every word, word after word, and how many
    each word has (at least one: a word shorter than the smallest n gives one gram, itself)."""
    parts = [_gram_buckets(words[k:k + WORDS_AT_ONCE], sizes, buckets) for k in range(0, len(words), WORDS_AT_ONCE)]
    if not parts:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    return np.concatenate([g for g, _ in parts]), np.concatenate([n for _, n in parts])


def _gram_buckets(words: list[str], sizes: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    codes, starts, lengths = marked_codes(words)
    ends = starts + lengths
    owner = np.repeat(np.arange(len(words)), lengths)
    room = ends[owner] - np.arange(len(codes))  # code points from here to the end of the word
    hashed, whose = [], []
    rolling = np.zeros(len(codes), np.uint64)
    for n in range(1, max(sizes) + 1):
        step = codes[n - 1:]
        rolling = rolling[:len(step)] * _STEP + (step + np.uint64(1))
        if n in sizes:
            ok = room[:len(step)] >= n
            if n == min(sizes):
                short = np.flatnonzero(lengths < n)
            hashed.append(_mixed(rolling[ok] + np.uint64(n)))
            whose.append(owner[:len(step)][ok])
    if len(short):
        hashed.append(_mixed(np.add.reduceat(codes, starts)[short]))
        whose.append(short)
    hashed, whose = np.concatenate(hashed), np.concatenate(whose)
    order = np.argsort(whose, kind="stable")
    return (hashed[order] % np.uint64(buckets)).astype(np.int32), np.bincount(whose, minlength=len(words))


def word_buckets(words: list[str], buckets: int) -> np.ndarray:
    """One bucket per whole word."""
    codes, starts, lengths = marked_codes(words)
    if not len(codes):
        return np.zeros(0, np.int64)
    place = np.arange(len(codes)) - np.repeat(starts, lengths)
    weight = _mixed((place.astype(np.uint64) + np.uint64(1)) * _STEP) | np.uint64(1)
    return (_mixed(np.add.reduceat(codes * weight, starts)) % np.uint64(buckets)).astype(np.int64)


class Numbers(dict):
    """Numbers its keys in the order in which they are first asked for."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


def numbered_words(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct lower-cased words of the texts, the word number at every place of all texts in
    turn, and the words per text."""
    index = Numbers()
    number = index.__getitem__
    docs = [np.fromiter(map(number, WORDS.findall(t.lower())), np.int32) for t in texts]
    at = np.concatenate(docs).astype(np.int64) if docs else np.zeros(0, np.int64)
    return list(index), at, np.array([len(d) for d in docs], np.int64)
