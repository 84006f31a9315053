"""Token ids of whole texts by a public tokenizer file, with a bounded table of words.

The tokenizer's normaliser and splitter treat what stands between spaces or line feeds independently, cut a last full stop
or comma from a letter or digit, and lower-case. So texts are cut there, each distinct word is encoded once by the
library, and texts are put together from the words' ids; tests hold the result to the library's own for the whole text.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa

from tidemark.llm._shared import text_bytes
from tidemark.llm._words import hash_spans

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
#: Words in a worker's table, and bytes of text that are cut into words at a time.
WORDS, SLICE = 800_000, 1 << 20
#: Lower-case Latin letters, each one code point in composed form.
_PLAIN = re.compile("[a-zß-öø-ÿ]+")
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x0A]] = True
_LAST = np.zeros(256, bool)
_LAST[[0x2C, 0x2E]] = True
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def default_tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def read_tokenizer(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def _splits_at_blanks(spec: dict) -> bool:
    """Whether the tokenizer is of the kind that the cache is made for: it lower-cases, drops blanks, then cuts words from
    numbers and signs. Others encode each text in one call."""
    kinds = [x["type"] for x in (spec.get("normalizer") or {}).get("normalizers", [])]
    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return kinds == ["NFC", "Replace", "Lowercase"] and [x["type"] for x in cuts] == ["Split", "ByteLevel"] and cuts[0]["behavior"] == "Removed" and cuts[0]["invert"] and not cuts[1]["add_prefix_space"]


class Encoder:
    """Encodes texts to uint32 ids without special tokens."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.vocab_size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.by_word = _splits_at_blanks(json.loads(tokenizer_json))
        self.model = self.tokenizer.model
        to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.alphabet = {c: to_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100)}
        self._forget()

    def _forget(self) -> None:
        self.number: dict[int, int] = {}
        self.pool, self.used = np.empty(1 << 16, np.uint32), 0
        self.first, self.count = np.empty(1 << 16, np.int64), np.empty(1 << 16, np.int64)

    def _learn(self, hashes: list[int], words: list[str]) -> None:
        """Words of plain letters are one piece to normaliser and splitter, so the library's model takes them directly, in
        the byte alphabet; others go through the whole tokenizer."""
        plain, tokenize = _PLAIN.fullmatch, self.model.tokenize
        found: list[list[int] | None] = [[t.id for t in tokenize(w.translate(self.alphabet))] if plain(w) else None for w in words]
        others = [k for k, ids in enumerate(found) if ids is None]
        for k, e in zip(others, self.tokenizer.encode_batch_fast([words[k] for k in others], add_special_tokens=False), strict=True):
            found[k] = e.ids
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((i for ids in found for i in ids), np.uint32, int(sizes.sum()))
        n = len(self.number)
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        while n + len(words) > len(self.first):
            self.first, self.count = (np.concatenate([x, np.empty_like(x)]) for x in (self.first, self.count))
        self.pool[self.used : self.used + len(flat)] = flat
        self.first[n : n + len(words)] = self.used + np.cumsum(sizes) - sizes
        self.count[n : n + len(words)] = sizes
        self.used += len(flat)
        self.number.update(zip(hashes, range(n, n + len(words)), strict=True))

    def _slice(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, the row of each) of a slice; rows begin at starts."""
        blank, edge = _BLANK[data], np.zeros(len(data) + 1, bool)
        edge[starts] = True
        before, after = np.concatenate([[True], blank[:-1]]) | edge[:-1], np.concatenate([blank[1:], [True]]) | edge[1:]
        # A full stop or comma at a word's end is a word of its own after a letter or digit.
        last = _LAST[data] & after & ~before & np.concatenate([[False], _ALNUM[data[:-1]]])
        begin = np.flatnonzero(~blank & (before | last))
        end = np.flatnonzero((~blank & after) | np.concatenate([last[1:], [False]])) + 1
        # Special tokens are told by their case, so where one may stand nothing is taken for the same in another case.
        exact = bool((data == 0x3C).any())
        hashes = hash_spans(data, begin, end, lower=not exact)
        if exact:
            hashes ^= np.uint64(0x9E6C63D0876A9A47)
        distinct, at, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.number) + len(distinct) > WORDS:
            self._forget()
        keys = distinct.tolist()
        number = np.fromiter(map(self.number.get, keys, repeat(-1)), np.int64, len(keys))
        new = np.flatnonzero(number < 0)
        if len(new):
            raw = data.tobytes()
            words = [raw[begin[k] : end[k]].decode() for k in at[new].tolist()]
            self._learn([keys[k] for k in new.tolist()], words if exact else [w.lower() if w.isascii() or _PLAIN.fullmatch(w.lower()) and len(w.lower()) == len(w) else w for w in words])
            number[new] = np.arange(len(self.number) - len(new), len(self.number))
        word = number[inverse]
        count = self.count[word]
        place = np.repeat(self.first[word] - np.cumsum(count) + count, count) + np.arange(int(count.sum()))
        row = np.searchsorted(starts, begin, "right") - 1
        return self.pool[place], np.repeat(row, count)

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """One uint32 array for each text of a string array without nulls, in order."""
        if not self.by_word:
            yield from (np.array(self.tokenizer.encode(t, add_special_tokens=False).ids, np.uint32) for t in texts.to_pylist())
            return
        data, starts = text_bytes(texts)
        parts, counts, at = [], np.zeros(len(texts), np.int64), 0
        while at < len(data):
            stop = min(at + SLICE, len(data))
            if stop < len(data):
                cut = np.flatnonzero(_BLANK[data[at:stop]])
                row = int(np.searchsorted(starts, stop, "right")) - 1
                if starts[row] > at:
                    stop = max(int(starts[row]), at + int(cut[-1]) + 1 if len(cut) else 0)
                elif len(cut):
                    stop = at + int(cut[-1]) + 1
                else:  # one word longer than a slice
                    rest = np.flatnonzero(_BLANK[data[stop : starts[row + 1]]])
                    stop = stop + int(rest[0]) + 1 if len(rest) else int(starts[row + 1])
            low, high = int(np.searchsorted(starts, at, "right")) - 1, int(np.searchsorted(starts, stop, "left"))
            ids, row = self._slice(data[at:stop], np.maximum(starts[low:high] - at, 0))
            counts[low:high] += np.bincount(row, minlength=high - low)
            parts.append(ids)
            at = stop
        ids, ends = np.concatenate(parts) if parts else np.empty(0, np.uint32), np.cumsum(counts)
        for a, b in zip(ends - counts, ends, strict=True):
            yield ids[a:b]


_encoders: dict[int, Encoder] = {}


def encoder_of(tokenizer_json: str) -> Encoder:
    """One encoder for each worker and tokenizer."""
    key = hash(tokenizer_json)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(tokenizer_json)
    return _encoders[key]
