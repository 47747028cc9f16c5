"""Toxicity by a subsequence string-kernel machine with Nyström landmarks (operator 5).

A word is compared by its gapped subsequences: every three of its characters in order within a
span of ``SPAN`` count with a weight that decays with the gaps, so ``id.iot``, ``idxiot`` and ``i d i o t`` stay
close to ``idiot``. The kernel against a set of landmark words gives Nyström features, in which a linear support
vector machine (squared hinge) separates insults from other words.

Labels are of documents, so training is by instances, which are single words (not sentences: a phrase of
ordinary words is not learned): the words of clean documents are negatives, and the witnesses of
toxic documents are the words that set them apart, all those above one level of false discovery,
each weighted by its evidence (the level with the least out-of-fold loss is taken); words the machine wrongly accepts
in clean documents are added as negatives and it is fitted again. Inserted-character variants of the witnesses join
the positives. The document's score is a logistic function of its highest word margins,
fitted on margins from machines that did not see the document.

Because the machine is linear in the features, landmarks and weights fold into one weight per
subsequence: scoring a word is a sum over its subsequences, whatever the number of landmarks.

Defined results: null or empty text scores as a text without any witness; every row keeps its
own score (repeated ids included); without labelled rows of both classes the score is the constant
share of toxic labels (0 if there are none).
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import Words, fit_logistic, fold, free_name, id_text, label_sample, map_arrow, own_name, sigmoid
from helixframe.llm.tokens import in_slices

BASE, SPAN, DECAY, LONGEST = 32, 5, 0.6, 32
#: Places of subsequences: those of a to z and the end marks have one each, all others share the rest by a hash.
OWN, TABLE = BASE ** 3, 1 << 18
#: Words whose subsequences are held at a time.
BLOCK = 20_000
#: Bytes of text that are scored at a time.
SLICE = 3_000_000
#: (first gap, second gap, weight) of each shape of subsequence.
SHAPES = [(a, s - a, DECAY ** (s - 2)) for s in range(2, SPAN + 1) for a in range(1, s)]
#: Digits and signs that stand for letters.
LOOKS_LIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a"}


def _letter(c: str) -> bool:
    """Letters, and the signs without which other scripts' words are not told apart (vowel signs, voicing
    marks); accents and points are none."""
    return c.isalpha() or unicodedata.category(c) in ("Mn", "Mc") and unicodedata.combining(c) in (0, 8, 9) and not (
        c == "\u034f" or "\ufe00" <= c <= "\ufe0f" or c >= "\U000e0000")


class _Fold(dict):
    """Character table: letters of any script without accents, look-alikes as letters, all else deleted."""

    def __missing__(self, code):
        c = chr(code)
        out = LOOKS_LIKE.get(c) or "".join(filter(_letter, unicodedata.normalize("NFKD", c).lower())) or None
        self[code] = out
        return out


_FOLD = _Fold()


def fold_word(w: str) -> str:
    """Letters only; empty if the word holds no letter at all."""
    if not any(map(str.isalpha, w)):
        return ""
    return w.translate(_FOLD)


def scored(w: str) -> bool:
    """Whether a folded word is long enough to be judged; two signs are a word in other scripts."""
    return len(w) >= (3 if w.isascii() else 2)


def _codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letter codes with a mark at either end, zero-padded, and lengths."""
    n = np.array([len(w) for w in words], np.int64) + 2
    out = np.zeros((len(words), int(n.max(initial=2))), np.int32)
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int32)
    flat = np.where(flat < 128, flat - 96, flat)      # a..z: 1..26, other scripts: the code point
    at = np.cumsum(n - 2) - (n - 2)
    for k in range(out.shape[1] - 2):
        has = n - 2 > k
        out[has, k + 1] = flat[at[has] + k]
    out[:, 0] = 28
    out[np.arange(len(words)), n - 1] = 29
    return out, n


def _triples(c: np.ndarray, a: int, b: int) -> np.ndarray | None:
    m = c.shape[1] - a - b
    if m <= 0:
        return None
    x, y, z = c[:, :m], c[:, a: a + m], c[:, a + b: a + b + m]
    t = np.where(z > 0, x * (BASE * BASE) + y * BASE + z, 0)
    far = (z > 0) & ((x >= BASE) | (y >= BASE) | (z >= BASE))
    if far.any():
        u = [v[far].astype(np.uint64) for v in (x, y, z)]
        h = u[0] * np.uint64(0x9E3779B97F4A7C15) + u[1] * np.uint64(0xC2B2AE3D27D4EB4F) + u[2] * np.uint64(0x165667B19E3779F9)
        h = (h ^ h >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(32)
        t[far] = OWN + (h % np.uint64(TABLE - OWN)).astype(np.int32)
    return t


def _norms(n: np.ndarray) -> np.ndarray:
    """Norm of a word's subsequence weights by its length, each subsequence counted as a feature of its own (a word
    that repeats one is a little longer than its norm says)."""
    return np.sqrt(np.maximum(sum(w * w * np.maximum(n - a - b, 0) for a, b, w in SHAPES), 1e-9))


def apply_weights(words: list[str], betas: np.ndarray, place: np.ndarray | None = None) -> np.ndarray:
    """Per word (row) and weight vector (column): the sum of the vector over the word's subsequences, by the
    word's norm. Words of like length go together. ``place``: the vectors' entry of each table place, if they
    are not over the whole table."""
    out = np.zeros((len(words), len(betas)))
    size = np.array([len(w) for w in words])
    for lo, hi in ((0, 6), (6, 10), (10, 14), (14, 20), (20, LONGEST + 1)):
        like = np.flatnonzero((size >= lo) & (size < hi))
        for i in range(0, len(like), BLOCK):
            pick = like[i: i + BLOCK]
            c, n = _codes([words[j] for j in pick])
            norm = _norms(n)
            shapes = [(w, t if place is None else place[t]) for a, b, w in SHAPES if (t := _triples(c, a, b)) is not None]
            for k, beta in enumerate(betas):
                s = np.zeros(len(pick))
                for w, t in shapes:
                    s += w * beta[t].sum(1)
                out[pick, k] = s / norm
    return out


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The table places that the words hold (the first is padding), and each word's normed vector over them."""
    c, n = _codes(words)
    shapes = [(w, t) for a, b, w in SHAPES if (t := _triples(c, a, b)) is not None]
    used = np.unique(np.concatenate([np.zeros(1, np.int32), *(t.ravel() for _, t in shapes)]))
    out = np.zeros((len(words), len(used)), np.float32)
    for w, t in shapes:
        np.add.at(out, (np.arange(len(words))[:, None], np.searchsorted(used, t)), w)
    out[:, 0] = 0
    return used, out / _norms(n)[:, None].astype(np.float32)


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    used, phi = features(landmarks)
    place = np.zeros(TABLE, np.int32)
    place[used] = np.arange(len(used))
    return apply_weights(words, phi, place)


def pieces(word: str) -> list[str]:
    """A folded word, cut into overlapping parts if it is longer than the kernel's window."""
    if len(word) <= LONGEST:
        return [word]
    return [word[i: i + LONGEST] for i in range(0, len(word) - LONGEST // 2, LONGEST // 2)]


def fit_svm(X: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 10.0, steps: int = 30) -> tuple[np.ndarray, float]:
    """Primal squared-hinge machine by Newton steps on its active set; y is -1 or 1."""
    A = np.hstack([X, np.ones((len(y), 1))])
    w = np.zeros(A.shape[1])
    R = np.eye(A.shape[1])
    R[-1, -1] = 1e-4
    for _ in range(steps):
        act = y * (A @ w) < 1
        D = A[act] * weight[act, None]
        new = np.linalg.solve(R + c * (D.T @ A[act]), c * (D.T @ y[act]))
        if np.abs(new - w).max() < 1e-6:
            break
        w = new
    return w[:-1], w[-1]


def _variants(words: list[str], rng) -> list[str]:
    """Each word with a letter inserted, and with one doubled."""
    out = []
    for w in words:
        if len(w) >= 5:
            i, j = rng.integers(1, len(w), 2)
            out += [w[:i] + chr(97 + rng.integers(26)) + w[i:], w[:j] + w[j - 1] + w[j:]]
    return out


class WordMachine:
    """Margins of folded words."""

    def __init__(self, beta: np.ndarray, bias: float):
        self.beta, self.bias = beta, bias

    def margins(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.empty(0)
        cut = [pieces(w) for w in words]
        flat = [p for c in cut for p in c]
        m = apply_weights(flat, self.beta[None])[:, 0] + self.bias
        if len(flat) == len(words):
            return m
        return np.maximum.reduceat(m, np.cumsum([0] + [len(c) for c in cut[:-1]]))


_SENTENCE = re.compile(r"[.!?\n]+\s+|\n").split


def sentence_words(text: str) -> list[set[str]]:
    return [{f for f in map(fold_word, s.split()) if f} for s in _SENTENCE(text.lower()) if s.strip()]


#: Shares of false witnesses to choose from; the out-of-fold loss on the training documents decides.
LEVELS = (0.001, 0.01, 0.1, 0.3)


def witnesses(docs: list[set[str]], y: np.ndarray) -> tuple[dict[str, float], int, dict[str, int]]:
    """Evidence in nats of each word of toxic documents, the number of words tested, and the words of clean
    documents with their counts."""
    tox, cln = {}, {}
    for d, lab in zip(docs, y, strict=True):
        for w in d:
            t = tox if lab else cln
            t[w] = t.get(w, 0) + 1
    nt, nc = max(1, int((y == 1).sum())), max(1, int((y == 0).sum()))
    share = nt / (nt + nc)

    def evidence(w: str, k: int) -> float:
        """Nats against the word being as usual in clean documents (binomial, one-sided)."""
        n = k + cln.get(w, 0)
        x = k / n
        if x <= share:
            return 0.0
        return n * (x * np.log(x / share) + ((1 - x) * np.log((1 - x) / (1 - share)) if x < 1 else 0.0))

    # words in one document alone can show nothing, whatever its label
    tested = sum(scored(w) and k + cln.get(w, 0) >= 2 for w, k in tox.items()) + sum(scored(w) and k >= 2 and w not in tox for w, k in cln.items())
    return {w: evidence(w, k) for w, k in tox.items() if k >= 2 and scored(w)}, tested, cln


def above(found: dict[str, float], tested: int, level: float) -> list[str]:
    """The words, strongest first, among which a share of ``level`` is expected to be chance (Benjamini-Hochberg;
    exp(-evidence) bounds a word's binomial tail)."""
    order = sorted(found, key=lambda w: (-found[w], w))
    g = np.array([found[w] for w in order])
    ok = np.flatnonzero(g >= -np.log(level * np.arange(1, len(g) + 1) / max(tested, 1)))
    return order[: ok[-1] + 1] if len(ok) else []


def train_machine(learned: tuple[dict[str, float], int, dict[str, int]], level: float, seed: int, n_witness: int = 80, n_plain: int = 32, rounds: int = 3) -> WordMachine:
    """``learned``: what ``witnesses`` gives; all words above ``level`` are positives, weighted by their evidence."""
    rng = np.random.default_rng(seed)
    found, tested, cln = learned
    positive = above(found, tested, level)
    if not positive:
        return WordMachine(np.zeros(TABLE, np.float32), -1.0)
    plain = sorted(cln)
    few = [plain[i] for i in rng.choice(len(plain), min(len(plain), 5000), replace=False)] if plain else []
    common = sorted(cln, key=lambda w: (-cln[w], w))[:1000]
    negative = sorted(set(few) | set(common))
    landmarks = [*positive[:n_witness], *(w[:LONGEST] for w in rng.choice(negative, min(len(negative), n_plain), replace=False))] if negative else positive[:n_witness]
    landmarks = [str(w)[:LONGEST] for w in dict.fromkeys(landmarks)]
    used, phi = features(landmarks)
    val, vec = np.linalg.eigh(phi @ phi.T)
    keep = val > 1e-6 * val.max()
    root = vec[:, keep] / np.sqrt(val[keep])          # K_LL^(-1/2)
    extra = _variants(positive[:n_witness], rng)
    pos = [w[:LONGEST] for w in [*positive, *extra]]
    # a variant counts as its word: _variants gives two of each word that is long enough
    pw = np.array([found[w] for w in positive] + [found[w] for w in positive[:n_witness] if len(w) >= 5 for _ in range(2)])
    known = set(negative)
    for r in range(rounds):
        neg = [w[:LONGEST] for w in negative]
        X = kernel(pos + neg, landmarks) @ root
        lab = np.r_[np.ones(len(pos)), -np.ones(len(neg))]
        wt = np.r_[pw / pw.sum(), np.ones(len(neg)) / len(neg) * 2] * len(lab) / 3
        w, bias = fit_svm(X, lab, wt)
        beta = np.zeros(TABLE, np.float32)
        beta[used] = phi.T @ (root @ w)
        machine = WordMachine(beta, float(bias))
        if r + 1 < rounds:                             # clean words that it takes for insults
            rest = [x for x in plain if x not in known]
            m = machine.margins(rest) if rest else np.empty(0)
            wrong = [rest[i] for i in np.flatnonzero(m > -0.3)]
            wrong = wrong if len(wrong) <= 4000 else [wrong[i] for i in rng.choice(len(wrong), 4000, replace=False)]
            known |= set(wrong)
            negative = negative + wrong
    return machine


def _summary(top: np.ndarray, second: np.ndarray, over: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Calibrator inputs of each document."""
    c = lambda x: np.clip(x, -2, 2)
    return np.column_stack([c(top), c(second), np.log1p(over), over / np.maximum(n, 1) * 20, np.log1p(n) / 5, c(top) * np.log1p(n) / 5])


class Toxicity:
    """A fitted model: ``scores(Words)`` of a slice of texts. Word margins are kept up to a bound."""

    MAX_KEPT = 500_000

    def __init__(self, machine: WordMachine | None, calibrator: np.ndarray | None, prior: float):
        self.machine, self.calibrator, self.prior = machine, calibrator, prior
        self.level: float | None = None           # of the witnesses, chosen in training
        self.kept: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"kept": {}}

    def word_margins(self, names: list[str]) -> np.ndarray:
        if len(self.kept) > self.MAX_KEPT:
            self.kept.clear()
        new = [w for w in names if w not in self.kept]
        folded = [fold_word(w) for w in new]
        has = [i for i, f in enumerate(folded) if scored(f)]
        m = np.full(len(new), -2.0)
        m[has] = self.machine.margins([folded[i] for i in has])
        self.kept.update(zip(new, m.tolist(), strict=True))
        return np.fromiter(map(self.kept.__getitem__, names), np.float64, len(names))

    def spaced(self, w: Words) -> dict[int, float]:
        """Highest margin, per text, of words written letter by letter (``i d i o t``)."""
        single = np.array([len(fold_word(x)) == 1 and len(x) <= 3 for x in w.names], bool)[w.codes]
        if not single.any():
            return {}
        owner = w.owner()
        edge = np.flatnonzero(np.r_[True, (single[1:] != single[:-1]) | (owner[1:] != owner[:-1]), True])
        runs = [(a, b) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True) if single[a] and b - a >= 3]
        if not runs:
            return {}
        joined = ["".join(fold_word(w.names[c]) for c in w.codes[a:b].tolist()) for a, b in runs]
        out: dict[int, float] = {}
        for (a, _), m in zip(runs, self.machine.margins(joined).tolist(), strict=True):
            out[int(owner[a])] = max(m, out.get(int(owner[a]), -2.0))
        return out

    def summary(self, w: Words) -> np.ndarray:
        m = self.word_margins(w.names)[w.codes] if len(w.codes) else np.empty(0)
        top = w.per_text(np.maximum, m, -2.0)
        for i, v in self.spaced(w).items():
            top[i] = max(top[i], v)
        rest = np.where(m >= np.repeat(top, w.counts), -2.0, m)
        return _summary(top, w.per_text(np.maximum, rest, -2.0), w.per_text(np.add, (m > 0).astype(np.float64)), w.counts)

    def scores(self, w: Words) -> np.ndarray:
        if self.machine is None:
            return np.full(len(w.counts), self.prior)
        X = self.summary(w)
        return sigmoid(X @ self.calibrator[:-1] + self.calibrator[-1])


def train(sample: list[tuple[str, int]], prior: float, folds: int = 4) -> Toxicity:
    """``sample``: (text, 0/1). ``prior``: share of toxic labels among all training labels."""
    import pyarrow as pa
    y = np.array([lab for _, lab in sample])
    if len(set(y.tolist())) < 2:
        return Toxicity(None, None, prior)
    sample = sorted(dict(sample).items())             # copies of a text would count as independent evidence
    y = np.array([lab for _, lab in sample])
    names: dict[str, str] = {}                        # one string per word
    docs = [{names.setdefault(w, w) for s in sentence_words(t) for w in s} for t, _ in sample]
    del names
    part = np.arange(len(y)) % folds
    share = y.mean()
    weight = np.where(y == 1, prior / share, (1 - prior) / (1 - share))
    X = {q: np.zeros((len(y), 6)) for q in LEVELS}
    for f in range(folds):
        seen = part != f
        if len(set(y[seen].tolist())) < 2:
            return Toxicity(None, None, prior)
        learned = witnesses([docs[i] for i in np.flatnonzero(seen)], y[seen])
        apart = Words(pa.array([sample[i][0] for i in np.flatnonzero(~seen)], pa.string()), lower=True)
        last = None
        for q in LEVELS:
            if (now := above(*learned[:2], q)) != last:
                last, summary = now, Toxicity(train_machine(learned, q, f), None, prior).summary(apart)
            X[q][~seen] = summary
    best = None
    for q in LEVELS:
        c = fit_logistic(X[q], y.astype(float), 1e-3, weight=weight)
        p = np.clip(sigmoid(X[q] @ c[:-1] + c[-1]), 1e-9, 1 - 1e-9)
        loss = -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).mean()
        if best is None or loss < best[0]:
            best = loss, q, c
    model = Toxicity(train_machine(witnesses(docs, y), best[1], folds), best[2], prior)
    model.level = best[1]
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", k: int = 5, held_out: int = 0, per_class: int = 1500) -> Toxicity:
    """Fit on at most ``per_class`` labelled documents of each class outside the held-out fold."""
    outside = fold("doc_id", k) != held_out
    share = labels.filter(outside & F.col(label).isin(0, 1)).agg(F.avg(label).alias("p")).first()["p"]
    return train(label_sample(docs, labels, label, outside, per_class), min(max(float(share or 0.0), 0.0), 1.0))


def score_texts(docs: DataFrame, model: Toxicity, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of each row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)        # a fixed number of weights
    text_col = own_name(docs, text_col)

    def make():
        m = shared.value

        def one(b):
            got = [m.scores(Words(s, lower=True)) for s in in_slices(b.column(b.schema.get_field_index(text_col)), SLICE)]
            return {score_col: np.concatenate(got)}
        one.done = m.kept.clear
        return one

    return map_arrow(docs, {score_col: "double"}, make)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    d = id_text(docs)
    out = score_texts(d, fit(d, labels))
    return out.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """``docs`` without the documents whose score reaches ``threshold``; columns unchanged."""
    name = free_name(docs, "score")
    scored = score_texts(docs, fit(id_text(docs, text_col=text_col), labels), text_col, name)
    return scored.filter(F.col(name) < threshold).select(*docs.columns)
