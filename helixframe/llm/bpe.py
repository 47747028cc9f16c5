"""BPE encoding and decoding by a bounded-lookahead streaming transducer (operator 13).

*Lookahead.* Merges are applied in the order of their ranks, leftmost first. Take two inputs that agree up to a
point p. At p the segments may differ, and a merge (u, v) carries the difference to the left by
``len(u)`` only if v begins where it stands, so v's left spine (v, its left part, that one's left part, ...) holds the
left part of the merge that carried it before, whose rank is lower. The longest such chain of merges,
``len(u)`` added up, is the sufficient lookahead: a boundary that far before the end of what was read stays,
whatever follows. ``Merges`` computes it from the merge list in one pass. It asks that the list is proper: each part of a
merge is a single byte or made by earlier merges.

*Encoding.* ``WordTransducer`` takes a word's symbols in pieces and holds at most a window of them; beyond that it
merges the window, emits the tokens that end before the lookahead and goes on with the rest. A final boundary is never
crossed by a merge, so the rest on its own gives the tokens it has in the whole word. Words come from the tokenizer file's own
normalizer and splitting rule, which ``Splitter`` feeds with whole white-space runs apart, and with parts of a run longer than
``LONGEST_RUN``, cut where neither normalization nor the splitting rule looks across. Texts so long are encoded
in constant memory. Words that were met before are looked up in a table of bounded size; that changes speed only.

*Decoding.* ``ByteDecoder`` is an incremental machine from ids to text: with a byte-level decoder in the file, ids
become bytes and a UTF-8 state machine turns these into text across all borders (an invalid sequence becomes U+FFFD as in whole
decoding); without a decoder, token strings are joined by one space. Unknown ids give nothing.

Defined results: null and empty text: no ids, empty decoded text; repeated rows are encoded each on its own; a special
token's string in a text is that token, as in the library; no rows give no rows.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import re
import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import id_text, release_memory
from helixframe.llm.tokens import default_tokenizer, in_slices

#: A merge is kept as rank << BITS | id of the merged symbol.
BITS = 24
ID, NONE = (1 << BITS) - 1, 1 << 62


class Merges:
    """A merge list over symbol ids and its sufficient lookahead, in symbols."""

    def __init__(self, pairs: list[tuple[int, int, int]], size: dict[int, int]):
        """``pairs``: (left, right, merged) in the order of ranks; ``size``: symbols of each id."""
        self.get = {}
        made: dict[int, int] = {}
        left: dict[int, list[int]] = {}
        reach: dict[int, int] = {}
        self.lookahead = 1
        self.longest = max(size.values(), default=1)
        for rank, (u, v, w) in enumerate(pairs):
            if size[w] != size[u] + size[v]:
                raise ValueError("a merge does not join its parts")
            spine, todo = set(), [v]
            while todo:
                x = todo.pop()
                if x not in spine:
                    spine.add(x)
                    todo += left.get(x, ())
            got = size[u] + max((reach.get(x, 0) for x in spine), default=0)
            reach[u] = max(reach.get(u, 0), got)
            self.lookahead = max(self.lookahead, got)
            left.setdefault(w, []).append(u)
            made[w] = rank
            self.get[u, v] = rank << BITS | w
        for rank, (u, v, _) in enumerate(pairs):
            if made.get(u, -1) >= rank or made.get(v, -1) >= rank:
                raise ValueError("the merge list is not proper: a part is made by a later merge")

    def apply(self, ids: list[int]) -> list[int]:
        """All merges on a run of symbols: lowest rank first, leftmost first."""
        get, ids = self.get.get, list(ids)
        found = [get(pair, NONE) for pair in zip(ids, ids[1:])]      # per place: rank and merged id, in one number
        while found:
            m = min(found)
            if m == NONE:
                break
            i = found.index(m)
            ids[i: i + 2] = [m & ID]
            del found[i]
            if i:
                found[i - 1] = get((ids[i - 1], ids[i]), NONE)
            if i < len(found):
                found[i] = get((ids[i], ids[i + 1]), NONE)
        return ids


class WordTransducer:
    """Tokens of one word from its symbols, given in pieces; ``window`` bounds what is held."""

    def __init__(self, merges: Merges, size: list[int], window: int | None = None):
        self.merges, self.size = merges, size
        self.window = max(window or 0, merges.lookahead + merges.longest + 1)
        self.held: list[int] = []

    def feed(self, symbols: list[int]) -> list[int]:
        """Tokens that are final after these symbols (not the last of the word)."""
        out: list[int] = []
        step = max(256, self.window)
        for i in range(0, len(symbols), step):
            self.held += symbols[i: i + step]
            if len(self.held) <= self.window:
                continue
            final, at = len(self.held) - self.merges.lookahead, 0
            for t in self.merges.apply(self.held):
                if at + self.size[t] > final:
                    break
                out.append(t)
                at += self.size[t]
            self.held = self.held[at:]
        return out

    def finish(self, symbols: list[int]) -> list[int]:
        """The remaining tokens, after the last symbols of the word."""
        out = self.feed(symbols)
        out += self.merges.apply(self.held)
        self.held = []
        return out


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself if it is printable
    Latin-1, otherwise the next one from U+0100 on."""
    out, extra = [], 0
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out.append(chr(b))
        else:
            out.append(chr(256 + extra))
            extra += 1
    return out


_JOINING: set[str] = set()


def joining() -> set[str]:
    """Characters that normalization may join to the one before although they have combining class 0."""
    if not _JOINING:
        _JOINING.update(map(chr, [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]))
        for c in range(0x110000):
            parts = unicodedata.decomposition(chr(c))
            if parts and parts[0] != "<":
                _JOINING.update(chr(int(x, 16)) for x in parts.split()[1:])
    return _JOINING


#: Characters of a run without ASCII white space that are split at once.
LONGEST_RUN = 1 << 16
#: ASCII words and Latin-1 letters in composed form: normalization is lower case, and the splitting rule needs no Unicode tables.
_SIMPLE = re.compile("[\x21-\x7eÀ-ÖØ-öø-ÿ]+").fullmatch
_SIMPLE_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-z0-9ß-öø-ÿ]+").findall
_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Splitter:
    """Normalized words of text, by the tokenizer's own normalizer and splitting rule."""

    def __init__(self, tok, special: list[str]):
        self.normal, self.split = tok.normalizer.normalize_str, tok.pre_tokenizer.pre_tokenize_str
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.lead = "".join({s[:1] for s in special})

    def words(self, run: str) -> list[str]:
        """Words of a run without special tokens, in the file's byte alphabet."""
        return [w for w, _ in self.split(self.normal(run))]

    def cuts(self, run: str):
        """Parts of a long run and whether the next one goes on with the word that this one ends in."""
        at, n = 0, len(run)
        while n - at > LONGEST_RUN:
            k = at + LONGEST_RUN
            while k < n and not self.safe(run, k):
                k += 1
            if k == n:
                break
            head = self.normal(run[max(at, k - 8): k])[-1:]
            goes_on = len(self.words(head + self.normal(run[k: k + 1])[:1])) == 1 if head.strip() else False
            yield run[at:k], goes_on
            at = k
        yield run[at:], False

    @staticmethod
    def safe(run: str, k: int) -> bool:
        """Whether text may be cut before position ``k``."""
        c = run[k]
        return (c != "'" and "'" not in run[k - 3: k] and not unicodedata.combining(c) and c not in joining()
                and unicodedata.is_normalized("NFC", c) and not unicodedata.combining(unicodedata.normalize("NFD", c)[0]))


class Transducer:
    """Encoder of a tokenizer file: ``encode(texts)`` gives (ids of all texts in a row, ids per text).

    ``kept_bytes`` bounds the table of runs and words met before; it is emptied between slices when full.
    """

    def __init__(self, path: str, kept_bytes: int = 96_000_000, window: int | None = None):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre, norm = spec["model"], spec.get("pre_tokenizer") or {}, spec.get("normalizer") or {}
        if model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("continuing_subword_prefix"):
            raise ValueError("not a plain byte-level BPE file")
        steps = pre.get("pretokenizers", [pre])
        rule = next((s["pattern"].get("Regex") for s in steps if s.get("type") == "Split"), None)
        kinds = [s["type"] for s in norm.get("normalizers", [])]
        if rule != _RULE or kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("the transducer reads files with lower-cased words split from white space")
        tok = Tokenizer.from_file(path)
        vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.splitter = Splitter(tok, list(self.special))
        end = model.get("end_of_word_suffix") or ""
        alphabet = byte_alphabet()
        self.first = {c: vocab[c] for c in alphabet}
        self.last = {c: vocab[c + end] for c in alphabet}
        size = {i: len(t) - len(end) if end and t.endswith(end) else len(t) for t, i in vocab.items()}
        pairs = [tuple(p.split(" ", 1)) if isinstance(p, str) else tuple(p) for p in model["merges"]]
        self.merges = Merges([(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], size)
        self.size = [size.get(i, 1) for i in range(max(vocab.values()) + 1)]
        self.window, self.kept_bytes = window, kept_bytes
        self.alphabet = dict(enumerate(alphabet))
        self.clear()

    def clear(self):
        self.words: dict[str, list[int]] = {}
        self.runs: dict[str, int] = {}
        self.bytes = 0
        self.flat, self.ends = array("I"), array("q", [0])

    def symbols(self, word: str, whole: bool = True) -> list[int]:
        """Symbols of a word in the byte alphabet; the last one is marked if the word ends here."""
        out = [self.first[c] for c in word]
        if whole:
            out[-1] = self.last[word[-1]]
        return out

    def word(self, word: str) -> list[int]:
        got = self.words.get(word)
        if got is None:
            got = WordTransducer(self.merges, self.size, self.window).finish(self.symbols(word))
            if len(word) < 256:
                self.words[word] = got
                self.bytes += 150 + 2 * len(word) + 16 * len(got)
        return got

    def stream(self, run: str):
        """Tokens of a run without ASCII white space, in pieces as they become final."""
        parts = self.splitter.special.split(run) if self.splitter.special and any(c in run for c in self.splitter.lead) else [run]
        for part in parts:
            if part in self.special:
                yield [self.special[part]]
            elif part:
                yield from self._stream(part)

    def _stream(self, run: str):
        if len(run) <= LONGEST_RUN:
            if _SIMPLE(run):
                text = run.lower()
                for w in _SIMPLE_WORDS(text):
                    yield self.word(w if w.isascii() else "".join(map(self.alphabet.__getitem__, w.encode())))
            else:
                for w in self.splitter.words(run):
                    yield self.word(w)
            return
        open_word: WordTransducer | None = None
        for piece, goes_on in self.splitter.cuts(run):
            words = self.splitter.words(piece)
            for i, w in enumerate(words):
                ends = not (goes_on and i == len(words) - 1)
                if open_word is None and ends:
                    yield self.word(w)
                    continue
                open_word = open_word or WordTransducer(self.merges, self.size, self.window)
                yield (open_word.finish if ends else open_word.feed)(self.symbols(w, ends))
                if ends:
                    open_word = None

    def _row(self, run: str) -> int:
        row = self.runs.get(run)
        if row is None:
            ids = [t for part in self.stream(run) for t in part]
            self.flat.extend(ids)
            self.ends.append(len(self.flat))
            row = self.runs[run] = len(self.runs)
            self.bytes += 120 + 2 * len(run) + 4 * len(ids)
        return row

    def encode(self, texts) -> tuple[np.ndarray, np.ndarray]:
        """``texts``: an Arrow string array or a list; null counts as empty."""
        if self.bytes > self.kept_bytes:
            self.clear()
        arr = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        runs = pc.ascii_split_whitespace(arr)
        counts = pc.list_value_length(runs).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = pc.dictionary_encode(runs.flatten())
        if not len(coded):
            return np.empty(0, np.uint32), np.zeros(len(arr), np.int64)
        row = np.array([self._row(r) for r in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy()]
        flat, ends = np.array(self.flat, np.uint32), np.array(self.ends, np.int64)
        n = ends[row + 1] - ends[row]
        sums = np.concatenate([[0], np.cumsum(n)])
        bounds = np.cumsum(counts)
        at = np.repeat(ends[row] - sums[:-1], n) + np.arange(sums[-1])
        return flat[at], sums[bounds] - sums[bounds - counts]


class ByteDecoder:
    """Incremental decoder of a tokenizer file's ids: ``feed(ids)`` gives text, ``finish()`` what is still open."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        tokens = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        kind = (spec.get("decoder") or {}).get("type")
        if kind not in (None, "ByteLevel"):
            raise ValueError(f"no state machine for the decoder {kind}")
        if kind:
            number = {c: b for b, c in enumerate(byte_alphabet())}
            raw = {i: bytes(number[c] for c in t) if all(c in number for c in t) else t.encode() for i, t in tokens.items()}
        else:
            raw = {i: b" " + t.encode() for i, t in tokens.items()}
        self.joined = kind is None                       # by one space before every token but the first
        top = max(raw, default=-1) + 1
        n = np.array([len(raw.get(i, b"")) for i in range(top)], np.int64)
        self.table, self.n = np.frombuffer(b"".join(raw.get(i, b"") for i in range(top)), np.uint8), n
        self.start = np.cumsum(n) - n
        self.reset()

    def reset(self):
        self.first = True
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: np.ndarray) -> str:
        ids = np.asarray(ids, np.int64)
        ids = ids[(ids >= 0) & (ids < len(self.n))]
        n = self.n[ids]
        raw = self.table[np.repeat(self.start[ids] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))].tobytes()
        if raw and self.first:
            self.first = False
            raw = raw[1:] if self.joined else raw
        return self.state.decode(raw)

    def finish(self) -> str:
        rest = self.state.decode(b"", True)
        self.reset()
        return rest


#: Ids that are decoded at once, and bytes of text that are encoded at once.
PIECE, SLICE = 1 << 16, 4_000_000

#: The loaded file of a worker process; its tables are emptied when a task ends.
_LOADED: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    if path not in _LOADED:
        _LOADED.clear()
        _LOADED[path] = Transducer(path)
    return _LOADED[path]


def decoded_digest(decoder: ByteDecoder, ids: np.ndarray) -> str:
    """SHA-256 of the decoded text, which is never held whole."""
    h = hashlib.sha256()
    for i in range(0, len(ids), PIECE):
        h.update(decoder.feed(ids[i: i + PIECE]).encode())
    h.update(decoder.finish().encode())
    return h.hexdigest()


def encoded(docs: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids of every whole text."""
    path = tokenizer or default_tokenizer()

    def run(batches):
        enc = transducer(path)
        try:
            for b in batches:
                at = 0
                for part in in_slices(b.column("text"), SLICE):
                    ids, n = enc.encode(part)
                    ends = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
                    yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(at, len(part)),
                                                      pa.ListArray.from_arrays(ends, pa.array(ids.astype(np.int32)))], names=["doc_id", "ids"])
                    at += len(part)
        finally:
            enc.clear()
            release_memory()

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids array<int>")


def decoded(tokens: DataFrame, tokenizer: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text of rows of ids."""
    path = tokenizer or default_tokenizer()

    def run(batches):
        dec = ByteDecoder(path)
        for b in batches:
            out = []
            for ids in b.column("ids").to_pylist():
                ids = np.array([i for i in ids or () if i is not None], np.int64)
                out.append("".join(dec.feed(ids[i: i + PIECE]) for i in range(0, len(ids), PIECE)) + dec.finish())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.string())], names=["doc_id", "text"])

    return (tokens.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
            .mapInArrow(run, "doc_id long, text string"))


def round_trip_digests(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of little-endian 32-bit ids), decoded_sha256 of every whole text."""
    path = tokenizer or default_tokenizer()

    def run(batches):
        enc, dec = transducer(path), ByteDecoder(path)
        try:
            for b in batches:
                at = 0
                for part in in_slices(b.column("text"), SLICE):
                    ids, n = enc.encode(part)
                    ids = ids.astype("<u4")
                    ends = np.cumsum(n).tolist()
                    cut = [ids[e - k: e] for e, k in zip(ends, n.tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [b.column("doc_id").slice(at, len(part)), pa.array(n), pa.array([hashlib.sha256(x).hexdigest() for x in cut]),
                         pa.array([decoded_digest(dec, x) for x in cut])], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                    at += len(part)
        finally:
            enc.clear()
            release_memory()

    return id_text(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
