"""Quality classifier on random-indexing word vectors (operator 4).

Every word has an index vector, sparse with entries -1 and 1, drawn from its hash. A word's
context vector is the sum of the index vectors of the words around it in the training sample,
normed; beside it stands the index vector of its shape (letter case, digits, trailing signs). Two marks
join the words of a text: one for a word that repeats the word before it, one for three words in
a row that the text had before. A document is the mean of its words' vectors and a few counts; a two-layer network in
numpy scores it, and a temperature fitted on training documents kept apart calibrates the
probability.

Defined results: null or empty text is the zero mean, scored like any other; every row keeps its
own score (repeated ids included); without labelled rows of both classes the score is the share of label 1 (0 if
there are none).
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import Words, fold, free_name, id_text, label_sample, map_arrow, own_name, sigmoid
from helixframe.llm.tokens import in_slices

DIM, SHAPE_DIM, NONZERO, WINDOW = 48, 32, 6, 2
SLICE = 1_500_000
#: Word pairs whose vectors are held at a time in training.
PAIRS = 100_000


def index_vector(word: str, dim: int) -> np.ndarray:
    rng = np.random.default_rng(zlib.crc32(word.encode("utf-8", "replace")))
    v = np.zeros(dim, np.float32)
    v[rng.choice(dim, NONZERO, replace=False)] = np.where(rng.random(NONZERO) < 0.5, -1, 1)
    return v


_TAIL = re.compile(r"[^\w\s]*$")


def shape(word: str) -> str:
    """Letter case, digits and the signs at the end; runs of a sign count as one or more."""
    tail = _TAIL.search(word)[0]
    core = word[: len(word) - len(tail)]
    kind = ("none" if not core else "digits" if core.isdigit() else "upper" if core.isupper() and len(core) > 1 else
            "title" if core[:1].isupper() else "lower" if core.islower() else "mixed")
    short = "".join(c * min(2, tail.count(c)) for c in dict.fromkeys(tail))
    size = "" if len(core) < 16 else "long" if len(core) < 40 else "huge"
    odd = "+" if any(c.isdigit() for c in core) and kind != "digits" else ""
    return f"{kind}{odd}{size}|{short}"


class WordVectors:
    """Context vectors of the words seen often enough in training; shape vectors of any word."""

    MAX_KEPT, MAX_SHAPES = 500_000, 50_000

    def __init__(self, vocabulary: dict[str, int], context: np.ndarray):
        self.vocabulary, self.context = vocabulary, context          # row 0: no context known
        self.clear()

    def clear(self):
        self.kept: dict[str, int] = {}
        self.shapes: dict[str, int] = {}
        self.shape_rows: list[np.ndarray] = []

    def __getstate__(self):
        return {"vocabulary": self.vocabulary, "context": self.context}

    def __setstate__(self, d):
        self.__init__(d["vocabulary"], d["context"])

    @classmethod
    def train(cls, texts: list[str], least: int = 3, size: int = 20_000) -> WordVectors:
        w = Words(pa.array(texts, pa.string()))
        n = np.bincount(w.codes, minlength=len(w.names))
        order = sorted(range(len(w.names)), key=lambda i: (-n[i], w.names[i]))[:size]
        chosen = [i for i in order if n[i] >= least]
        row = np.zeros(len(w.names), np.int64)
        row[chosen] = np.arange(1, len(chosen) + 1)
        index = np.zeros((len(chosen) + 1, DIM), np.float32)
        for k, i in enumerate(chosen, 1):
            index[k] = index_vector(w.names[i], DIM)
        rows, owner = row[w.codes], w.owner()
        context = np.zeros_like(index)
        for gap in range(1, WINDOW + 1):
            same = owner[gap:] == owner[:-gap]
            a, b = rows[:-gap][same], rows[gap:][same]
            for i in range(0, len(a), PAIRS):
                x, y = a[i: i + PAIRS], b[i: i + PAIRS]
                np.add.at(context, x, index[y])
                np.add.at(context, y, index[x])
        context[0] = 0
        norm = np.linalg.norm(context, axis=1, keepdims=True)
        context = np.where(norm > 0, context / np.maximum(norm, 1e-9), 0).astype(np.float32)
        return cls({w.names[i]: k for k, i in enumerate(chosen, 1)}, context)

    def rows(self, names: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(context row, shape row) of each word. Full caches are emptied between slices, so a word's vector never
        depends on what was met before."""
        if len(self.kept) > self.MAX_KEPT or len(self.shapes) > self.MAX_SHAPES:
            self.clear()
        get, known = self.kept.get, self.kept
        for x in names:
            if get(x) is None:
                s = shape(x)
                if s not in self.shapes:
                    self.shapes[s] = len(self.shape_rows)
                    self.shape_rows.append(index_vector(s, SHAPE_DIM))
                known[x] = self.vocabulary.get(x, 0) << 32 | self.shapes[s]
        got = np.fromiter(map(known.__getitem__, names), np.int64, len(names))
        return got >> 32, got & (1 << 32) - 1

    def pool(self, arr: pa.Array) -> np.ndarray:
        """Inputs of the network, one row per text."""
        w = Words(arr)
        n = w.counts.astype(np.float32)
        some = np.maximum(n, 1)[:, None]
        if len(w.codes):
            c, s = self.rows(w.names)
            table = np.stack(self.shape_rows)
            mean = np.hstack([w.per_text(np.add, self.context[c[w.codes]]), w.per_text(np.add, table[s[w.codes]])]) / some
            unknown = w.per_text(np.add, (c == 0).astype(np.float32)[w.codes])
        else:
            mean, unknown = np.zeros((len(n), DIM + SHAPE_DIM), np.float32), np.zeros(len(n), np.float32)
        again, seen = repeats(w)
        extra = np.column_stack([again, seen, unknown]) / some
        lines = np.array([t.count("\n") if t else 0 for t in arr.to_pylist()], np.float32)
        return np.hstack([mean, extra, (lines / some[:, 0])[:, None], np.log1p(n)[:, None] / 8, (n == 0).astype(np.float32)[:, None]])


def repeats(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Per text: words equal to the word before, and word triples that the text had before."""
    size = len(w.counts)
    if len(w.codes) < 2:
        return np.zeros(size, np.float32), np.zeros(size, np.float32)
    owner, c = w.owner(), w.codes.astype(np.uint64)
    again = np.bincount(owner[1:][(c[1:] == c[:-1]) & (owner[1:] == owner[:-1])], minlength=size)
    if len(c) < 3:
        return again.astype(np.float32), np.zeros(size, np.float32)
    with np.errstate(over="ignore"):
        key = c[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ (c[1:-1] + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F)
        key = (key ^ key >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) + c[2:]
        key = (key ^ key >> np.uint64(32)) * np.uint64(0x94D049BB133111EB) + owner[:-2].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    inside = owner[2:] == owner[:-2]
    key, own = key[inside], owner[:-2][inside]
    order = np.argsort(key, kind="stable")
    dup = order[1:][key[order[1:]] == key[order[:-1]]]
    return again.astype(np.float32), np.bincount(own[dup], minlength=size).astype(np.float32)


class Network:
    """inputs -> tanh layer -> logistic output, trained by Adam on the weighted log loss."""

    def __init__(self, width: int, hidden: int = 32, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.p = [rng.normal(0, 1 / np.sqrt(width), (width, hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
        self.mean, self.scale, self.temperature = np.zeros(width), np.ones(width), 1.0

    def logits(self, X: np.ndarray) -> np.ndarray:
        h = np.tanh(np.clip((X - self.mean) / self.scale, -8, 8) @ self.p[0] + self.p[1])
        return h @ self.p[2] + self.p[3][0]

    def fit(self, X: np.ndarray, y: np.ndarray, weight: np.ndarray, epochs: int = 400, rate: float = 0.01, l2: float = 1e-3):
        self.mean, self.scale = X.mean(0), X.std(0) + 0.02
        Z = np.clip((X - self.mean) / self.scale, -8, 8)
        weight = weight / weight.sum()
        m, v = [np.zeros_like(p) for p in self.p], [np.zeros_like(p) for p in self.p]
        for t in range(1, epochs + 1):
            h = np.tanh(Z @ self.p[0] + self.p[1])
            d = weight * (sigmoid(h @ self.p[2] + self.p[3][0]) - y)
            back = d[:, None] * self.p[2] * (1 - h * h)
            grads = [Z.T @ back + l2 * self.p[0], back.sum(0), h.T @ d + l2 * self.p[2], np.array([d.sum()])]
            for i, g in enumerate(grads):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                self.p[i] = self.p[i] - rate * (m[i] / (1 - 0.9 ** t)) / (np.sqrt(v[i] / (1 - 0.999 ** t)) + 1e-8)

    def calibrate(self, X: np.ndarray, y: np.ndarray, weight: np.ndarray):
        """The temperature with the least weighted log loss on documents kept apart."""
        z = self.logits(X)
        losses = {}
        for t in np.exp(np.linspace(np.log(0.5), np.log(10), 80)):
            p = np.clip(sigmoid(z / t), 1e-9, 1 - 1e-9)
            losses[t] = -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum()
        self.temperature = min(losses, key=losses.get)

    def probability(self, X: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(X) / self.temperature)


class Quality:
    def __init__(self, vectors: WordVectors | None, network: Network | None, prior: float):
        self.vectors, self.network, self.prior = vectors, network, prior

    def scores(self, arr: pa.Array) -> np.ndarray:
        if self.network is None:
            return np.full(len(arr), self.prior)
        return self.network.probability(self.vectors.pool(arr).astype(np.float64))


def train(sample: list[tuple[str, int]], prior: float) -> Quality:
    """``sample``: (text, 0/1); ``prior``: share of label 1 among all training labels."""
    sample = sorted(dict(sample).items())
    y = np.array([lab for _, lab in sample], float)
    if len(set(y.tolist())) < 2:
        return Quality(None, None, prior)
    texts = [t for t, _ in sample]
    vectors = WordVectors.train(texts)
    X = np.vstack([vectors.pool(s) for s in in_slices(pa.array(texts, pa.string()), SLICE)]).astype(np.float64)
    share = y.mean()
    weight = np.where(y == 1, prior / share, (1 - prior) / (1 - share))
    apart = np.array([zlib.crc32(t.encode("utf-8", "replace")) % 5 == 0 for t in texts])
    if len(set(y[~apart].tolist())) < 2 or len(set(y[apart].tolist())) < 2:
        apart = np.zeros(len(y), bool)
    net = Network(X.shape[1])
    net.fit(X[~apart], y[~apart], weight[~apart])
    if apart.any():
        net.calibrate(X[apart], y[apart], weight[apart])
    return Quality(vectors, net, prior)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", k: int = 3, held_out: int = 1, per_class: int = 1500) -> Quality:
    """Fit on at most ``per_class`` labelled documents of each class outside the held-out fold."""
    outside = fold("doc_id", k) != held_out
    share = labels.filter(outside & F.col(label).isin(0, 1)).agg(F.avg(label).alias("p")).first()["p"]
    return train(label_sample(docs, labels, label, outside, per_class), float(share or 0.0))


def score_texts(docs: DataFrame, model: Quality, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of each row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)        # a fixed number of weights
    text_col = own_name(docs, text_col)

    def make():
        m = shared.value

        def one(b):
            got = [m.scores(s) for s in in_slices(b.column(b.schema.get_field_index(text_col)), SLICE)]
            return {score_col: np.concatenate(got)}
        if m.vectors is not None:
            one.done = m.vectors.clear
        return one

    return map_arrow(docs, {score_col: "double"}, make)


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    d = id_text(docs)
    out = score_texts(d, fit(d, labels))
    return out.select("doc_id", F.coalesce(fold("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_low_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that score below ``threshold``; columns unchanged."""
    name = free_name(docs, "score")
    scored = score_texts(docs, fit(id_text(docs, text_col=text_col), labels), text_col, name)
    return scored.filter(F.col(name) >= threshold).select(*docs.columns)
