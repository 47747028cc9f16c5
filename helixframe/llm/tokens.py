"""Whole-text encoding with a public tokenizer file, cached by word.

The tokenizer drops white space and never joins characters across it, so a text's ids are the ids of
its chunks between ASCII white space, in order. Chunks repeat; each worker keeps a bounded table of those seen
and gathers whole batches from it with numpy. Only plain Latin words and runs of punctuation are
looked up piece by piece; every other chunk goes to the tokenizer as it is. Equality with
encoding the whole text is tested.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: A plain word (its NFC form and lower case are beyond doubt) and trailing punctuation without an apostrophe.
_PLAIN = re.compile(r'([A-Za-zÀ-ÖØ-öø-ÿ]+)([,.!?;:*#$%&|()"\-]*)').fullmatch


class _Chunks(dict):
    """chunk -> row number; a chunk not yet seen gets the next one and is noted."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, chunk):
        n = self[chunk] = len(self)
        self.fresh.append(chunk)
        return n


class ChunkEncoder:
    """``encode(texts)`` -> (ids of all texts in a row, ids per text).

    ``kept_bytes`` bounds the table kept between batches (it is emptied when full); it changes
    speed only.
    """

    JOIN = 2000

    def __init__(self, path: str, kept_bytes: int = 72_000_000):
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        suffix = spec["model"].get("end_of_word_suffix") or ""
        vocab = self.tok.get_vocab()
        self.vocab_size = max(vocab.values()) + 1
        self.ends = np.zeros(self.vocab_size, bool)
        if suffix:
            self.ends[[v for k, v in vocab.items() if k.endswith(suffix)]] = True
        self.kept_bytes = kept_bytes
        self._clear()

    def _clear(self):
        self.chunks = _Chunks()
        self.pieces: dict[str, int] = {"": 0}
        self.bytes = 0
        self.flat = np.empty(1 << 16, np.int32)
        self.used = 0
        self.start = np.zeros(1 << 12, np.int64)
        self.size = np.zeros(1 << 12, np.int32)
        self.parts = np.zeros((1 << 12, 2), np.int32)

    @staticmethod
    def _grown(a: np.ndarray, n: int) -> np.ndarray:
        if n <= len(a):
            return a
        b = np.zeros((max(n, 2 * len(a)), *a.shape[1:]), a.dtype)
        b[: len(a)] = a
        return b

    def _add(self, first: int, ids: np.ndarray, sizes: np.ndarray):
        self.flat = self._grown(self.flat, self.used + len(ids))
        self.flat[self.used: self.used + len(ids)] = ids
        last = first + len(sizes)
        self.start, self.size = self._grown(self.start, last), self._grown(self.size, last)
        self.size[first:last] = sizes
        self.start[first:last] = self.used + np.cumsum(sizes) - sizes
        self.used += len(ids)

    def _learn(self):
        """Encode the pieces of the chunks met for the first time."""
        fresh, self.chunks.fresh = self.chunks.fresh, []
        if not fresh:
            return
        # a chunk and its piece: two strings in two tables, and their ids
        self.bytes += 200 * len(fresh) + 4 * sum(map(len, fresh))
        plain: list[str] = []
        other: list[str] = []
        pairs: list[tuple[str, str]] = []
        known: set[str] = set()
        for c in fresh:
            m = _PLAIN(c)
            core, tail = (m[1].lower(), m[2]) if m else (c, "")
            pairs.append((core, tail))
            if core not in self.pieces and core not in known:
                known.add(core)
                (plain if m else other).append(core)
            if tail and tail not in self.pieces and tail not in known:
                known.add(tail)
                other.append(tail)
        for i in range(0, len(plain), self.JOIN):
            group = plain[i: i + self.JOIN]
            ids = np.array(self.tok.encode(" ".join(group), add_special_tokens=False).ids, np.int32)
            cut = np.flatnonzero(self.ends[ids]) + 1
            if len(cut) == len(group) and cut[-1] == len(ids):
                self._name(group, ids, np.diff(cut, prepend=0))
            else:
                other.extend(group)
        if other:
            got = [np.array(self.tok.encode(c, add_special_tokens=False).ids, np.int32) for c in other]
            self._name(other, np.concatenate(got), np.array([len(g) for g in got]))
        lo = len(self.chunks) - len(fresh)
        self.parts = self._grown(self.parts, len(self.chunks))
        get = self.pieces
        self.parts[lo: lo + len(fresh)] = [(get[a], get[b]) for a, b in pairs]

    def _name(self, names: list[str], ids: np.ndarray, sizes: np.ndarray):
        first = len(self.pieces)
        for i, x in enumerate(names):
            self.pieces[x] = first + i
        self._add(first, ids, sizes)

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """``texts``: an Arrow string array or a list; null counts as empty."""
        if self.bytes > self.kept_bytes:
            self._clear()
        arr = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        words = pc.ascii_split_whitespace(arr)
        counts = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = pc.dictionary_encode(words.flatten())
        look = self.chunks.__getitem__
        distinct = coded.dictionary.to_pylist()
        row = np.fromiter(map(look, distinct), np.int32, len(distinct))
        self._learn()
        if not len(coded):
            return np.empty(0, np.int32), np.zeros(len(arr), np.int64)
        pair = self.parts[row]
        n2 = self.size[pair]
        code = coded.indices.to_numpy()
        per_word = n2.sum(1)[code].astype(np.int64)
        sums = np.concatenate([[0], np.cumsum(per_word)])
        bounds = np.cumsum(counts)
        sizes = sums[bounds] - sums[bounds - counts]
        # the ids of each distinct chunk side by side, then one gather for all words
        flat2 = pair.reshape(-1)
        m = n2.reshape(-1).astype(np.int64)
        local = self.flat[np.repeat(self.start[flat2] - (np.cumsum(m) - m), m) + np.arange(int(m.sum()))]
        w = n2.sum(1).astype(np.int64)
        first = (np.cumsum(w) - w)[code]
        at = np.repeat(first - sums[:-1], per_word) + np.arange(int(sums[-1]))
        return local[at], sizes


def in_slices(arr: pa.Array, size: int = 8_000_000):
    """Slices of an Arrow string array of about so many bytes together, one text at least."""
    n = pc.fill_null(pc.binary_length(arr), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    first = got = 0
    for i, k in enumerate(n.tolist()):
        if i > first and got + k > size:
            yield arr.slice(first, i - first)
            first, got = i, 0
        got += k
    if first < len(arr):
        yield arr.slice(first)


#: Encoders by path, kept by the worker process between tasks.
_ENCODERS: dict[str, ChunkEncoder] = {}


def encoder(path: str) -> ChunkEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = ChunkEncoder(path)
    return _ENCODERS[path]


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")
