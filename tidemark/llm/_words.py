"""Vectorised splitting of UTF-8 text into words, with 64-bit hashes of words and of word n-grams.

A word is a longest run without the bytes 0x20 and 0x09-0x0D, with A-Z lower-cased; nothing else is normalised.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm._shared import text_bytes

SLICE = 1 << 20
_SEP = np.zeros(256, bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32
_random = np.random.default_rng(20240607)
_VALUE = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_P = 0x9E3779B97F4A7C15 | 1
_P_INVERSE = pow(_P, -1, 1 << 64)
_GRAM = 0xD6E8FEB86659FD93 | 1
_powers: dict[int, np.ndarray] = {}
#: Stands for the end of a text; no word hashes to it but by chance.
END_HASH = np.uint64(0x5851F42D4C957F2D)


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE + 1)
        with np.errstate(over="ignore"):
            have = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(size, base, np.uint64)]))
        _powers[base] = have
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each word in data; words never cross the rows that starts delimits."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    sep = _SEP[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[starts] = True
    before = np.concatenate([[True], sep[:-1]]) | edge[:-1]
    after = np.concatenate([sep[1:], [True]]) | edge[1:]
    return np.flatnonzero(~sep & before), np.flatnonzero(~sep & after) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, begin, end) of every word of the rows. Memory beside the words: a few times SLICE, or the longest word."""
    begin, end = word_spans(data, starts)
    row = np.searchsorted(starts, begin, "right") - 1
    return hash_spans(data, begin, end), row, begin, end


def hash_spans(data: np.ndarray, begin: np.ndarray, end: np.ndarray, lower: bool = True) -> np.ndarray:
    """Hashes of the bytes of ascending spans; lower: with A-Z lower-cased."""
    out = np.empty(len(begin), np.uint64)
    k = 0
    with np.errstate(over="ignore"):
        while k < len(begin):
            base = int(begin[k])
            stop = max(k + 1, int(np.searchsorted(end, base + SLICE, "right")))
            part = data[base : int(end[stop - 1])]
            sums = np.empty(len(part) + 1, np.uint64)
            sums[0] = 0
            np.cumsum(_VALUE[_LOWER[part] if lower else part] * _power(_P, len(part))[: len(part)], out=sums[1:])
            b = begin[k:stop] - base
            e = end[k:stop] - base
            out[k:stop] = (sums[e] - sums[b]) * _power(_P_INVERSE, len(part))[b] + (e - b).astype(np.uint64)
            k = stop
    return mix(out)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            out = out * np.uint64(_GRAM) + words[k : k + len(out)]
    return mix(out)


def row_grams(words: np.ndarray, row: np.ndarray, n: int, whole_if_short: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, first word) of the n-grams within rows. whole_if_short: a row of 1 to n-1 words counts as one gram."""
    grams = gram_hashes(words, n)
    inside = row[: len(grams)] == row[n - 1 :] if len(grams) else np.empty(0, bool)
    first = np.flatnonzero(inside)
    grams, rows = grams[first], row[first]
    if whole_if_short and len(words):
        begins = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        sizes = np.diff(np.concatenate([begins, [len(row)]]))
        short = [(gram_hashes(words[b : b + s], int(s))[0] ^ np.uint64(int(s) * 0x51ED2701), row[b], b) for b, s in zip(begins[sizes < n], sizes[sizes < n], strict=True)]
        if short:
            grams = np.concatenate([grams, np.array([x[0] for x in short], np.uint64)])
            rows = np.concatenate([rows, np.array([x[1] for x in short], rows.dtype)])
            first = np.concatenate([first, np.array([x[2] for x in short], first.dtype)])
            order = np.argsort(rows, kind="stable")
            grams, rows, first = grams[order], rows[order], first[order]
    return grams, rows, first


_NO_WORD = np.ones(256, bool)
_NO_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def plain_word_spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of the runs of ASCII letters, digits and non-ASCII bytes; a character of a script that is written without
    blanks (U+0E00-0EFF: Thai, Lao; U+3000-9FFF: kana and Han) is a word of its own."""
    begin, end = word_spans(np.where(_NO_WORD[data], np.uint8(0x20), data), starts)
    alone = (data >= 0xE3) & (data <= 0xE9)
    if len(data) > 1:
        alone[:-1] |= (data[:-1] == 0xE0) & (data[1:] >= 0xB8) & (data[1:] <= 0xBB)
    at = np.flatnonzero(alone)
    if not len(at):
        return begin, end
    # Such a character ends the run before it and begins one after it, within the run that it is in.
    run = np.searchsorted(begin, at, "right") - 1
    cuts = np.unique(np.concatenate([at[at > begin[run]], (at + 3)[at + 3 < end[run]]]))
    return np.sort(np.concatenate([begin, cuts])), np.sort(np.concatenate([end, cuts]))


def plain_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of these words in a string array without nulls, lower-cased letter by letter in any script, so that word k
    of a row is word k of plain_word_spans."""
    data, starts = text_bytes(pc.utf8_lower(texts))
    begin, end = plain_word_spans(data, starts)
    return hash_spans(data, begin, end, lower=False), np.searchsorted(starts, begin, "right") - 1


def plain_words_and_stems(texts: pa.Array, lengths: Iterable[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row) of these words, and (hash, row) of the stems of words: their first bytes, of each length that is less than
    the word's."""
    data, starts = text_bytes(pc.utf8_lower(texts))
    begin, end = plain_word_spans(data, starts)
    row = np.searchsorted(starts, begin, "right") - 1
    stems, rows = [np.empty(0, np.uint64)], [np.empty(0, row.dtype)]
    for n in lengths:
        longer = np.flatnonzero(end - begin > n)
        stems.append(hash_spans(data, begin[longer], begin[longer] + n, lower=False) ^ np.uint64(0x6A09E667F3BCC908))
        rows.append(row[longer])
    return hash_spans(data, begin, end, lower=False), row, np.concatenate(stems), np.concatenate(rows)
