"""Language identification with error-correcting output codes (operator 8).

Every language gets a codeword of bits, chosen so that codewords lie far apart. One binary
classifier per bit (logistic, on hashed character 1- to 3-grams) predicts it; a text's language is the
codeword with the least loss, each bit's loss weighted by how reliable its classifier was on training texts kept
apart. The score is the decoded language's share (softmax of the negative losses); texts whose two best
codewords are closer than ``margin`` are flagged as ambiguous.

Defined results: null texts and texts without a letter are ``und`` with score 0; every row keeps
its own answer (repeated ids included); with no training rows every text is ``und``; with one training
language every text with a letter is that language.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixframe.llm.common import fold, id_text, map_arrow, sigmoid
from helixframe.llm.tokens import in_slices

BUCKETS = 1 << 12
_NOT_LETTERS = re.compile(r"[\W\d_]+").sub


def codewords(k: int, bits: int = 0, seed: int = 2, tries: int = 200) -> np.ndarray:
    """k rows of -1/1 with large distances; every column splits the languages."""
    bits = bits or max(15, int(np.ceil(10 * np.log2(max(k, 2)))))
    rng = np.random.default_rng(seed)
    best, best_distance = None, -1
    for _ in range(tries if k <= 64 else 5):
        m = np.where(rng.random((k, bits)) < 0.5, -1, 1)
        if k > 1:
            flat = np.abs(m.sum(0)) == k
            m[0, flat] *= -1
            d = (bits - m @ m.T) // 2 + np.eye(k, dtype=int) * bits
            if d.min() > best_distance:
                best, best_distance = m, int(d.min())
        else:
            return m
    return best


def gram_counts(text: str) -> np.ndarray:
    """Normed hashed counts of the 1- to 3-grams of a text's letters (lower case, all else one blank)."""
    x = np.frombuffer(f" {_NOT_LETTERS(' ', text.lower()).strip()} ".encode("utf-32-le", "replace"), "<u4").astype(np.uint32)
    out = np.zeros(BUCKETS, np.float32)
    h = x * np.uint32(0x9E3779B1)
    for n in range(1, 4):
        if n > 1:
            h = (h[:-1] ^ h[:-1] >> np.uint32(15)) * np.uint32(0x85EBCA77) + x[n - 1:] * np.uint32(0x9E3779B1)
        if not len(h):
            break
        out += np.bincount((h ^ h >> np.uint32(16)) & np.uint32(BUCKETS - 1), minlength=BUCKETS)
    np.sqrt(out, out=out)
    return out / max(np.sqrt(out @ out), 1e-9)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


class LanguageModel:
    def __init__(self, langs: list[str], code: np.ndarray, W: np.ndarray, bias: np.ndarray, weight: np.ndarray, margin: float):
        self.langs, self.code, self.W, self.bias, self.weight, self.margin = langs, code, W, bias, weight, margin

    def losses(self, X: np.ndarray) -> np.ndarray:
        f = X @ self.W + self.bias
        return np.logaddexp(0, -f[:, None, :] * self.code[None]) @ self.weight

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, ambiguous) of each text."""
        names, score, unsure = ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        pick = [i for i, t in enumerate(texts) if t and has_letter(t)] if self.langs else []
        for lo in range(0, len(pick), 256):
            own = pick[lo: lo + 256]
            d = self.losses(np.stack([gram_counts(texts[i]) for i in own]))
            order = np.argsort(d, axis=1, kind="stable")
            p = np.exp(d.min(1, keepdims=True) - d)
            for r, i in enumerate(own):
                names[i] = self.langs[order[r, 0]]
                score[i] = 1 / p[r].sum()
                unsure[i] = len(self.langs) > 1 and d[r, order[r, 1]] - d[r, order[r, 0]] < self.margin
        return names, score, unsure


def _fit_bits(X: np.ndarray, B: np.ndarray, weight: np.ndarray, l2: float = 3e-5, steps: int = 100, rate: float = 4.0):
    """All bit classifiers at once, by accelerated gradient steps on the weighted log loss."""
    W, b = np.zeros((X.shape[1], B.shape[1]), np.float32), np.zeros(B.shape[1], np.float32)
    V, c = W.copy(), b.copy()
    weight = (weight / weight.sum()).astype(np.float32)[:, None]
    for t in range(1, steps + 1):
        g = (-weight * B * sigmoid(-B * (X @ V + c))).astype(np.float32)
        W2, b2 = V - rate * (X.T @ g + l2 * V), c - rate * g.sum(0)
        k = t / (t + 3)
        V, c, W, b = W2 + k * (W2 - W), b2 + k * (b2 - b), W2, b2
    return W, b


def train(sample: list[tuple[str, str]], margin: float = 2.0) -> LanguageModel:
    """``sample``: (text, language)."""
    sample = sorted({(t, lang) for t, lang in sample if t and has_letter(t)})
    langs = sorted({lang for _, lang in sample})
    if not langs:
        return LanguageModel([], np.zeros((0, 1)), np.zeros((BUCKETS, 1)), np.zeros(1), np.ones(1), margin)
    code = codewords(len(langs)).astype(np.float32)
    at = np.array([langs.index(lang) for _, lang in sample])
    # whole texts, and short parts of them so that short texts are met in training as well
    texts, own = [t for t, _ in sample], at.tolist()
    rng = np.random.default_rng(4)
    for (t, _), k in zip(sample, at.tolist(), strict=True):
        words = t.split()
        if len(words) > 12:
            i, n = int(rng.integers(len(words) - 8)), int(rng.integers(3, 12))
            part = " ".join(words[i: i + n])
            if has_letter(part):
                texts.append(part)
                own.append(k)
    X, own = np.stack([gram_counts(t) for t in texts]), np.array(own)
    weight = 1 / np.bincount(own, minlength=len(langs))[own]
    apart = np.arange(len(own)) % 5 == 0
    W, b = _fit_bits(X[~apart], code[own[~apart]], weight[~apart])
    right = (((X[apart] @ W + b) * code[own[apart]] > 0) * weight[apart, None]).sum(0) / max(weight[apart].sum(), 1e-9) if apart.any() else np.ones(code.shape[1])
    reliable = np.log(np.clip(right, 0.55, 0.995) / (1 - np.clip(right, 0.55, 0.995)))
    W, b = _fit_bits(X, code[own], weight)
    return LanguageModel(langs, code, W, b, (reliable / reliable.mean()).astype(np.float32), margin)


def fit(docs: DataFrame, lang_col: str = "lang", k: int = 4, held_out: int = 2, per_language: int = 400,
        max_chars: int = 50_000, max_languages: int = 1000) -> LanguageModel:
    """Fit on about ``per_language`` texts of each language (rows whose hashed id falls under the language's share; of these
    at most twice ``per_language``, the smallest by hash and text) outside the held-out fold, of at most ``max_chars``
    characters each. The bounds concern the sample alone."""
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                    F.col(lang_col).cast("string").alias("lang"))
    d = d.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & (fold("doc_id", k) != held_out))
    counts = d.groupBy("lang").count().orderBy("lang").limit(max_languages + 1).collect()
    if len(counts) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    if not counts:
        return train([])
    share = F.lit(0.0)
    for r in counts:
        share = F.when(F.col("lang") == r["lang"], F.lit(min(1.0, per_language / r["count"]))).otherwise(share)
    d = d.withColumn("place", F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(1_000_000)))
    picked = d.filter((F.col("place") < share * 1_000_000) & (F.length("text") <= max_chars))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("place", "text"))
    rows = picked.withColumn("first", first).filter(F.col("first") <= 2 * per_language).select("text", "lang").collect()
    return train([(r["text"], r["lang"]) for r in rows])


def language_predictions(docs: DataFrame, margin: float = 2.0, **kw) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous of every document."""
    model = fit(docs, **kw)
    model.margin = margin
    shared = docs.sparkSession.sparkContext.broadcast(model)      # a fixed number of weights per language

    def make():
        m = shared.value

        def one(b: pa.RecordBatch) -> dict:
            got = [m.predict(s.to_pylist()) for s in in_slices(b.column("text"))]
            return {"lang_pred": pa.array([x for g in got for x in g[0]], pa.string()),
                    "score": np.concatenate([g[1] for g in got]), "ambiguous": np.concatenate([g[2] for g in got])}
        return one

    out = map_arrow(id_text(docs), {"lang_pred": "string", "score": "double", "ambiguous": "boolean"}, make, keep=["doc_id"])
    return out.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "ambiguous")
