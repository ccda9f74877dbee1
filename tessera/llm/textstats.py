"""Dense statistics of whole texts, computed for a block of texts at once."""

from __future__ import annotations

import numpy as np

from tessera.llm.blocks import PLAIN_WORDS, Words, mix, span_hashes, sums, word_table

PREFIXES = (4, 5, 6)  # bytes of a word that count as its stem
_LETTER = np.zeros(256, dtype=bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_PUNCT = ~(_LETTER | _DIGIT | _SPACE)
_MARK = np.zeros(256, dtype=bool)
_MARK[[33, 63]] = True
_SYMBOL = _PUNCT.copy()
_SYMBOL[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]] = False


def hash_words(words: list[str]) -> np.ndarray:
    """Hashes of given words, as ``Words`` makes them."""
    if not words:
        return np.zeros(0, dtype=np.uint64)
    raw = [w.lower().encode() for w in words]
    ends = np.cumsum([len(r) for r in raw])
    return span_hashes(np.frombuffer(b"".join(raw), np.uint8), ends - [len(r) for r in raw], ends)


def stem_hashes(words: Words) -> list[np.ndarray]:
    """For each prefix length the hash of each word's prefix (0 where the word is not longer)."""
    size = words.end - words.start
    out = []
    for k in PREFIXES:
        h = np.zeros(len(size), dtype=np.uint64)
        long = np.flatnonzero(size > k)
        if len(long):
            h[long] = mix(span_hashes(words.data, words.start[long], words.start[long] + k) ^ np.uint64(k))
        out.append(h)
    return out


def member(values: np.ndarray, sorted_set: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(sorted_set) or not len(values):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(sorted_set, values)
    at[at == len(sorted_set)] = 0
    return sorted_set[at] == values


def distinct_per_group(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Number of distinct values within each ``[bounds[i], bounds[i+1])``."""
    out = np.zeros(len(bounds) - 1, dtype=np.int64)
    for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        if b > a:
            s = np.sort(hashes[a:b])
            out[i] = 1 + int((s[1:] != s[:-1]).sum())
    return out


def plain_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    return Words(data, offsets, word_table(PLAIN_WORDS))


SHAPE = ["upper", "digit", "punct", "marks", "symbol", "run", "log_words", "word_size", "mixed"]


def shape_features(data: np.ndarray, offsets: np.ndarray, words: Words) -> np.ndarray:
    """Rates of letters, marks and word shapes; one row for each text (all 0 for an empty text)."""
    size = np.maximum(np.diff(offsets), 1)
    n = words.counts()
    letters = np.maximum(sums(_LETTER[data], offsets), 1)
    same = np.zeros(len(data), dtype=bool)
    if len(data) > 2:
        same[2:] = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2])
    # obfuscation: a digit or symbol between two letters
    mixed = np.zeros(len(data), dtype=bool)
    if len(data) > 2:
        odd = _DIGIT | _SYMBOL
        mixed[1:-1] = odd[data[1:-1]] & _LETTER[data[:-2]] & _LETTER[data[2:]]
    per = np.maximum(n, 1)
    length = np.zeros(len(words.start) + 1, dtype=np.int64)
    np.cumsum(words.end - words.start, out=length[1:])
    return np.stack([
        sums(_UPPER[data], offsets) / letters,
        sums(_DIGIT[data], offsets) / size,
        sums(_PUNCT[data], offsets) / size,
        sums(_MARK[data], offsets) / size,
        sums(_SYMBOL[data], offsets) / size,
        sums(same, offsets) / size,
        np.log1p(n),
        (length[words.bounds[1:]] - length[words.bounds[:-1]]) / per,
        sums(mixed, offsets) / per,
    ], axis=1).astype(np.float64)


REPETITION = ["distinct_words", "repeat_next", "distinct_lines", "line_words"]


def repetition_features(data: np.ndarray, offsets: np.ndarray, words: Words) -> np.ndarray:
    """How much a text repeats itself: words, neighbours, lines."""
    n = np.maximum(words.counts(), 1)
    again = np.zeros(len(words.start), dtype=bool)
    again[1:] = words.hash[1:] == words.hash[:-1]
    inner = words.bounds[:-1]
    again[inner[inner < len(again)]] = False
    lines = Words(data, offsets, word_table([(10, 10)]))
    m = np.maximum(lines.counts(), 1)
    return np.stack([
        distinct_per_group(words.hash, words.bounds) / n,
        sums(again, words.bounds) / n,
        distinct_per_group(lines.hash, lines.bounds) / m,
        np.log1p(n / m),
    ], axis=1)
