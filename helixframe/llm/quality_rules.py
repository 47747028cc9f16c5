"""Quality rules with a divergence test (operator 7).

Base rules count words, symbols, repeated lines and repeated 8-word windows of each whole text.
Then two histograms of each document are compared with its language's reference by the
Jensen-Shannon distance (base 2, square root of the divergence, 0 to 1): character classes, and common words
(each listed word, and all others together). References are the mean histograms of the corpus's
own documents that pass the base rules and are long enough. A document's nearest list is the one whose words it holds
most, signs around a word apart; that is its language only if the list's share of its words, and the lead over the second
list, reach half of what is usual among long documents nearest to the list (the median of the corpus), so that a few listed
words in a text of another language assign none. A document is rejected if either distance, or the mean of both, exceeds its
limit. Documents below the minimum lengths are not judged by distance.

Defined results: null or empty text has no words, so it fails the base rules; no rows give no
rows; a document whose language has no reference is judged by the base rules alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import id_text, map_arrow
from helixframe.session import scratch_path

# Frequent function words of four languages (public knowledge; a parameter of the operator).
COMMON_WORDS = {
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach".split(),
    "en": "the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which".split(),
    "es": "de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este sí porque".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec son elle".split(),
}
SYMBOLS = "#*$%&|<>"
WINDOW = 8
_SIGNS = (SYMBOLS + ".,;:!?'\"()-").encode()
CLASSES = ("lower", "upper", "digit", "space", "line end", "punctuation", "symbol", "beyond ASCII")


def _class_table() -> np.ndarray:
    t = np.full(256, 6, np.uint8)
    t[ord("a"): ord("z") + 1], t[ord("A"): ord("Z") + 1], t[ord("0"): ord("9") + 1] = 0, 1, 2
    for c in b" \t\x0b\x0c\r":
        t[c] = 3
    t[ord("\n")] = 4
    for c in b".,;:!?'\"()-":
        t[c] = 5
    t[0x80:0xC0] = 8            # later bytes of a character: not counted
    t[0xC0:] = 7
    return t


_CLASS = _class_table()
_SPACE_COUNT = [c.to_bytes(1, "big") for c in b" \t\n\r\x0b\x0c"]
_MULT = np.array([pow(0x9E3779B97F4A7C15, i, 2**64) for i in range(WINDOW)], np.uint64)


def repeated_window_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows of ``window`` words that occur twice or more (the first time included)."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(window):
        key += h[i: i + n] * _MULT[i]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    hit = np.zeros(n, bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    mark = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(hit)
    np.add.at(mark, at, 1)
    np.add.at(mark, at + window, -1)
    return int((np.cumsum(mark)[:-1] > 0).sum())


def document_stats(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one text."""
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    chars = len(text) - sum(raw.count(c) for c in _SPACE_COUNT)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in raw.split(b"\n") if x.strip(b" \t\n\r\x0b\x0c")]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_window_words(words)


def profile(docs: DataFrame, common: dict[str, list[str]]) -> DataFrame:
    """doc_id, base counts, language index, character-class and common-word counts of every text."""
    langs = sorted(common)
    width = max(map(len, common.values()))
    table: dict[bytes, list[tuple[int, int]]] = {}
    for i, name in enumerate(langs):
        for j, w in enumerate(common[name]):
            table.setdefault(w.encode(), []).append((i, j))

    def make():
        get = table.get

        def one(b: pa.RecordBatch) -> dict:
            base, lang, chars, words_, listed, lead = [], [], [], [], [], []
            for t in b.column("text").to_pylist():
                t = t or ""
                base.append(document_stats(t))
                low = t.lower().encode("utf-8", "replace")
                chars.append(np.bincount(_CLASS[np.frombuffer(t.encode("utf-8", "replace"), np.uint8)], minlength=9)[:8])
                seen = np.zeros((len(langs), width), np.int64)
                held = np.zeros(len(langs), np.int64)             # by list, signs around a word apart
                for w in low.split():
                    places = get(w)
                    if places is not None:
                        for i, j in places:
                            seen[i, j] += 1
                            held[i] += 1
                    elif w[-1] < 97 or w[0] < 97:
                        for i, _ in get(w.strip(_SIGNS), ()):
                            held[i] += 1
                best = int(held.argmax()) if held.any() else -1
                lang.append(best)
                listed.append(int(held.max()))
                lead.append(int(held.max() - np.delete(held, best).max(initial=0)) if best >= 0 else 0)
                words_.append(seen[max(best, 0)])
            cols = list(zip(*base, strict=True))
            out = {k: pa.array(v, pa.int64()) for k, v in zip(
                ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), cols, strict=True)}
            return out | {"lang_index": pa.array(lang, pa.int32()), "listed": pa.array(listed, pa.int64()), "lead": pa.array(lead, pa.int64()), "char_hist": pa.array([x.tolist() for x in chars], pa.list_(pa.int64())),
                          "word_hist": pa.array([x.tolist() for x in words_], pa.list_(pa.int64()))}
        return one

    new = {k: "long" for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    return map_arrow(docs, new | {"lang_index": "int", "listed": "long", "lead": "long", "char_hist": "array<long>", "word_hist": "array<long>"}, make, keep=["doc_id"])


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Row-wise Jensen-Shannon distance (base 2) of histograms that each sum to 1."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0.0).sum(1)
        b = np.where(q > 0, q * np.log2(q / m), 0.0).sum(1)
    return np.sqrt(np.clip((a + b) / 2, 0, 1))


def quality_rules(docs: DataFrame, common: dict[str, list[str]] | None = None, min_words: int = 20, max_repeat_pct: int = 30,
                  min_chars_divergence: int = 200, min_words_divergence: int = 50,
                  max_char_distance: float = 0.25, max_word_distance: float = 0.6,
                  max_mean_distance: float = 0.23) -> DataFrame:
    """doc_id, the base counts, base_failed, kept, char_distance, word_distance (null: not judged)."""
    common = common or COMMON_WORDS
    spark = docs.sparkSession
    path = scratch_path(spark, "rules")
    profile(id_text(docs), common).write.parquet(path)
    stats = spark.read.parquet(path)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_pct * F.col("n_words"))
    langs, width = len(common), max(map(len, common.values()))
    n_chars = F.expr("aggregate(char_hist, 0L, (a, x) -> a + x)")
    long_ones = stats.filter(~failed & (F.col("lang_index") >= 0) & (n_chars >= min_chars_divergence) & (F.col("n_words") >= min_words_divergence))
    # two numbers per list: the usual share of its words and the usual lead (in thousandths, so that few values are counted)
    usual = {r["lang_index"]: (r["share"], r["lead"]) for r in long_ones.groupBy("lang_index").agg(
        *[F.median(F.round(F.col(c) / F.col("n_words"), 3)).alias(name) for name, c in (("share", "listed"), ("lead", "lead"))]).collect()}
    sure = F.lit(False)
    for i, (share, lead) in sorted(usual.items()):
        sure = sure | ((F.col("lang_index") == i) & (F.col("listed") >= F.lit(share / 2) * F.col("n_words")) & (F.col("lead") >= F.lit(lead / 2) * F.col("n_words")))
    stats = stats.withColumn("lang_index", F.when(sure, F.col("lang_index")).otherwise(F.lit(-1)))
    good = long_ones.filter(sure)
    # mean histograms per language: a fixed number of rows (languages), whatever the corpus
    means = good.groupBy("lang_index").agg(
        *[F.avg(F.col("char_hist")[i] / n_chars).alias(f"c{i}") for i in range(8)],
        *[F.avg(F.col("word_hist")[j] / F.col("n_words")).alias(f"w{j}") for j in range(width)]).collect()
    ref_c, ref_w, known = np.zeros((langs, 8)), np.zeros((langs, width + 1)), np.zeros(langs, bool)
    for r in means:
        i = r["lang_index"]
        known[i] = True
        ref_c[i] = [r[f"c{k}"] for k in range(8)]
        ref_w[i, :width] = [r[f"w{k}"] for k in range(width)]
        ref_w[i, width] = max(0.0, 1 - ref_w[i, :width].sum())

    def make():
        def one(b: pa.RecordBatch) -> dict:
            col = lambda name: b.column(name).to_numpy(zero_copy_only=False)
            c = np.array(b.column("char_hist").to_pylist(), np.float64).reshape(b.num_rows, 8)
            w = np.array(b.column("word_hist").to_pylist(), np.float64).reshape(b.num_rows, width)
            n, lang = col("n_words").astype(np.int64), col("lang_index").astype(np.int64)
            rest = np.maximum(n - w.sum(1), 0)
            p = np.hstack([w, rest[:, None]])
            total = c.sum(1)
            at = np.maximum(lang, 0)
            judged = (lang >= 0) & known[at]
            dc = js_distance(c / np.maximum(total, 1)[:, None], ref_c[at])
            dw = js_distance(p / np.maximum(p.sum(1), 1)[:, None], ref_w[at])
            jc, jw = judged & (total >= min_chars_divergence), judged & (n >= min_words_divergence)
            bad = (jc & (dc > max_char_distance)) | (jw & (dw > max_word_distance)) | (jc & jw & ((dc + dw) / 2 > max_mean_distance))
            return {"char_distance": pa.array(dc, mask=~jc), "word_distance": pa.array(dw, mask=~jw), "diverges": pa.array(bad)}
        return one

    judged = map_arrow(stats, {"char_distance": "double", "word_distance": "double", "diverges": "boolean"}, make)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         failed.alias("base_failed"), (~failed & ~F.col("diverges")).alias("kept"), "char_distance", "word_distance")
