"""Phrase search against a plain scan, hypergeometric tails against exact integers, several contrasts at once."""

import math
import random
import re
from fractions import Fraction

import pytest

from helixframe.operators import enrich as E
from helixframe.operators import explore as X
from helixframe.operators.corpus import search_corpus

MESH = ["Colorectal Neoplasms"]
SCHEMA = "pmid string, year int, title string, abstract string, mesh_major_topics array<string>"


def _words(t):
    return [w for w in re.split(r"[^a-z0-9]+", (t or "").lower()) if w]


def _scan(corpus, genes, k):
    out = set()
    for gene, _ in genes:
        g = _words(gene)
        hits = {(y, p) for p, y, t, a, _ in corpus if g and a
                and any(ws[i:i + len(g)] == g for ws in (_words(t), _words(a)) for i in range(len(ws)))}
        best = sorted(hits, key=lambda h: (h[0] if h[0] is not None else -1, h[1]), reverse=True)[:k]
        out |= {(gene, i + 1, p) for i, (_, p) in enumerate(best)}
    return out


def test_phrases_of_any_length_match_a_plain_scan(spark):
    rnd = random.Random(4)
    def text(n):
        return " ".join(rnd.choice("abc") for _ in range(n))
    corpus = [(f"{i:03d}", rnd.choice([None, 2000, 2001, 2002]), rnd.choice([None, "", text(6)]), rnd.choice([None, "", text(25), "A-b, C. a;b"]), MESH)
              for i in range(120)]
    genes = [(g, i) for i, g in enumerate(sorted({text(n) for n in (1, 2, 2, 3, 4, 5, 6, 8, 25) for _ in range(4)}
                                                 | {"a a a", "a b a b a", "zz", "A-B c", "", "..."}))]
    for k in (3, 200):
        got = search_corpus(spark.createDataFrame(corpus, SCHEMA), spark.createDataFrame(genes, "gene string, gene_ord int"), max_results=k)
        assert {(r.gene, r.hit_ord, r.pmid) for r in got.collect()} == _scan(corpus, genes, k)


def test_parts_of_a_phrase_in_two_copies_or_places_are_no_hit(spark):
    corpus = [("1", 2000, "a b x b c", "x a b y b c d", MESH),                # each pair, never together
              ("2", 2000, "", "a b c", MESH), ("2", 2000, "", "a b c", MESH),  # one record twice: one hit
              ("3", 2000, "", "a b x", MESH), ("3", 2000, "", "x b c", MESH)]  # two texts of one id
    genes = spark.createDataFrame([("a b c", 0)], "gene string, gene_ord int")
    got = search_corpus(spark.createDataFrame(corpus, SCHEMA), genes).collect()
    assert [(r.pmid, r.hit_ord) for r in got] == [("2", 1)]


def test_search_without_rows(spark):
    corpus, genes = spark.createDataFrame([], SCHEMA), spark.createDataFrame([("a", 0)], "gene string, gene_ord int")
    assert search_corpus(corpus, genes).count() == 0
    assert search_corpus(spark.createDataFrame([("1", 1, "a", "a", MESH)], SCHEMA), genes.where("gene = 'b'")).count() == 0


def _tail(k, K, n, N):
    return float(Fraction(sum(math.comb(K, i) * math.comb(N - K, n - i) for i in range(k, min(K, n) + 1)), math.comb(N, n)))


def test_upper_tails_match_exact_integers(spark):
    rnd = random.Random(8)
    cases = [(0, 5, 5, 20), (5, 5, 5, 20), (1, 1, 1, 1), (20, 20, 20, 20), (1, 2000, 2000, 4000), (900, 2000, 2000, 4000),
             (1100, 2000, 2000, 4000), (1500, 2000, 2000, 4000), (10, 3000, 3000, 4000 + 1990), (40, 40, 3000, 20000)]
    for _ in range(150):
        N = rnd.randint(1, 900)
        K, n = rnd.randint(0, N), rnd.randint(0, N)
        cases.append((rnd.randint(max(0, n + K - N), min(K, n)), K, n, N))
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, k long, kk long, n long, nn long")
    got = {r.i: r.p for r in E.upper_tail(df, "k", "kk", "n", "nn", "p").collect()}
    for i, c in enumerate(cases):
        assert got[i] == pytest.approx(_tail(*c), rel=1e-8, abs=1e-300), c


def test_contrasts_together_equal_contrasts_alone(spark):
    rnd = random.Random(2)
    genes = [f"g{i}" for i in range(80)]
    bg = [(c, g) for c, share in (("x", 1.0), ("y", 0.7)) for g in genes if rnd.random() < share]
    lists = [(c, d, g) for c in "xyz" for d in ("up", "down") for g in rnd.sample(genes, 15)]
    sets = [(f"T{t}", g) for t in range(12) for g in rnd.sample(genes, 9)]
    L = spark.createDataFrame(lists, "contrast string, direction string, symbol string")
    B = spark.createDataFrame(bg, "contrast string, symbol string")
    S = spark.createDataFrame(sets, "term string, symbol string")
    both = E.ora(L, S, B, within="contrast")
    rows = {(r.contrast, r.direction, r.term): (r.overlap, r.set_size, r.list_size, r.pvalue, r.padj) for r in both.collect()}
    alone = {}
    for c in "xy":
        one = E.ora(L.where(f"contrast = '{c}'"), S, B.where(f"contrast = '{c}'")).collect()
        alone |= {(c, r.direction, r.term): (r.overlap, r.set_size, r.list_size, r.pvalue, r.padj) for r in one}
    assert set(rows) == set(alone) and len(rows) > 30
    for key, v in alone.items():
        assert rows[key] == pytest.approx(v, rel=1e-12)
    top = E.top_terms(both, 2, ["contrast", "direction"]).collect()
    assert len(top) == 8 and {r["rank"] for r in top} == {1, 2}


def test_heatmap_rows_of_every_contrast(spark):
    vst = spark.createDataFrame([(g, s, float(v)) for g, vs in (("a", (1, 2, 3)), ("b", (4, 4, 4)), ("c", (0, 1, 5)))
                                 for s, v in enumerate(vs)], "gene_id string, sample_id int, vst double")
    lists = spark.createDataFrame([("x", "a"), ("y", "a"), ("y", "b"), ("y", "q")], "contrast string, gene_id string")
    z = X.zscore_rows(X.rows_for(vst, lists, by="contrast"), ["contrast", "gene_id"]).collect()
    assert {(r.contrast, r.gene_id) for r in z} == {("x", "a"), ("y", "a"), ("y", "b")} and len(z) == 9
    assert all(r.z is None for r in z if r.gene_id == "b")
    assert sorted(round(r.z, 6) for r in z if r.gene_id == "a" and r.contrast == "y") == [-1.224745, 0.0, 1.224745]
