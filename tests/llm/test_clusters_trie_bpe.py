"""Centroid clusters, prefix trie and BPE transducer against brute force and the tokenizers library."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from helixframe.llm import bpe, centroid_clustering as cc, prefix_trie as pt
from helixframe.llm.tokens import default_tokenizer

# ---------------------------------------------------------------- operator 11


def brute_clusters(rows, k, rounds, dim, scale=256, seed=2):
    kept = []
    for i, v in rows:
        if v is None or len(v) != dim or any(x is None or not np.isfinite(x) for x in v):
            continue
        kept.append((i, [int(np.floor(scale * x)) for x in v]))
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cen = [list(x) for _, x in order[:k]]

    def near(x):
        return min((sum((p - q) ** 2 for p, q in zip(x, c, strict=True)), n) for n, c in enumerate(cen))

    for _ in range(rounds):
        own = defaultdict(list)
        for _, x in kept:
            own[near(x)[1]].append(x)
        for n, xs in own.items():
            cen[n] = [sum(col) // len(xs) for col in zip(*xs, strict=True)]
    got = [(i, *near(x)) for i, x in kept]
    inertia = defaultdict(int)
    for _, d, n in got:
        inertia[n] += d
    return sorted(((i, n, d, inertia[n], sum(inertia.values()), hashlib.sha256(",".join(map(str, cen[n])).encode()).hexdigest())
                   for i, d, n in got), key=repr)


def test_clusters_match_brute_force_with_odd_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 1, 4).round(1).tolist()) for i in range(300)]          # many ties
    rows += [(7, rows[7][1])] * 40 + [(None, [0.5] * 4), (None, [0.5] * 4), (900, None), (901, [1.0] * 3), (902, [1.0] * 5), (903, []),
             (904, [1.0, None, 0.0, 0.0]), (905, [1.0, float("nan"), 0.0, 0.0]), (906, [float("inf"), 0.0, 0.0, 0.0]), (907, [-2000.25, 0.0, 0.0, 99999.0])]
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<double>, cluster int, id string").repartition(5)
    got = sorted((tuple(r) for r in cc.centroid_clusters(df, k=9, rounds=3, dim=4).collect()), key=repr)
    assert got == brute_clusters(rows, 9, 3, 4)
    few = df.filter("vec_id < 3")
    assert sorted((tuple(r) for r in cc.centroid_clusters(few, k=9, rounds=2, dim=4).collect()), key=repr) == brute_clusters(
        [r for r in rows if r[0] is not None and r[0] < 3], 9, 2, 4)
    assert cc.centroid_clusters(df.limit(0), k=9, dim=4).collect() == []
    assert cc.centroid_clusters(df.filter("vec_id > 899 and vec_id < 907"), k=9, dim=4).collect() == []


def test_tournament_is_exact_for_wide_numbers():
    rng = np.random.default_rng(0)
    cen = rng.integers(-cc.LIMIT + 1, cc.LIMIT, (6, 64))
    cen = np.vstack([cen, cen[2], cen[0] + (np.arange(64) == 5)])                     # an equal and a nearly equal centroid
    x = np.vstack([rng.integers(-cc.LIMIT + 1, cc.LIMIT, (50, 64)), cen[[2, 7]]])
    t = cc.Tournament(cen)
    want = [min((sum((int(p) - int(q)) ** 2 for p, q in zip(v, c, strict=True)), n) for n, c in enumerate(cen)) for v in x]
    assert t.nearest(x).tolist() == [n for _, n in want]
    assert t.distance(x, t.nearest(x)).tolist() == [d for d, _ in want]


# ---------------------------------------------------------------- operator 12

def brute_trie(seqs):
    """``seqs``: conv_id -> list of (key, bytes)."""
    members, size = defaultdict(list), {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            p = tuple(k for k, _ in s[:d])
            members[p].append(c)
            size[p] = s[d - 1][1] if d else 0
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in kids[p]) if kids[p] else 1
        saved[p] = (len(members[p]) - 1) * size[p] + sum(saved[q] for q in kids[p])
    return sorted(((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
                    hashlib.sha256(",".join(str(c) for c in sorted(m) if len(seqs[c]) == len(p)).encode()).hexdigest())
                   for p, m in members.items()), key=repr)


def trie_rows(df):
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def stored(spark, seqs):
    key = lambda k: hashlib.sha256(str(k).encode()).digest()[:pt.KEY]
    return spark.createDataFrame([(c, b"".join(key(k) for k, _ in s), b"".join(int(n).to_bytes(8, "little") for _, n in s)) for c, s in seqs.items()],
                                 "conv_id long, path binary, sizes binary")


@pytest.mark.parametrize("block_turns", [3, 40, 10**6])
@pytest.mark.parametrize("seed", [0, 1])
def test_trie_matches_brute_force_across_blocks(spark, block_turns, seed):
    rng = random.Random(seed)
    seqs = {}
    for c in range(70):
        s = [rng.randrange(2 if d < 4 else 3) for d in range(rng.randint(0, 7))]
        if c % 3 == 0:
            s = [0, 1, 1, 0]                                       # a third are copies
        if c == 20:
            s = [0, 1, 1, 0] + [5] * 90                            # one long branch
        seqs[c * 7 - 50] = [(k, 3 + k + 10 * d) for d, k in enumerate(s)]
    if seed:
        seqs = {c: s for c, s in seqs.items() if s}
    got = trie_rows(pt.prefix_trie(stored(spark, seqs), block_turns))
    want = brute_trie({c: [((k, d), n) for d, (k, n) in enumerate(s)] for c, s in seqs.items()})
    assert got == want


def test_trie_of_one_conversation_and_of_none(spark):
    assert trie_rows(pt.prefix_trie(stored(spark, {5: []}))) == brute_trie({5: []})
    assert trie_rows(pt.prefix_trie(stored(spark, {5: [("a", 2)]}), 1)) == brute_trie({5: [("a", 2)]})
    assert trie_rows(pt.prefix_trie(stored(spark, {5: []}).limit(0))) == []


def test_paths_of_odd_turns_and_borrowed_heads(spark):
    rows = [(0, 1, "user", "a"), (0, 2, "assistant", "bb"), (0, None, "system", "s"), (0, 2, "assistant", "bb"), (None, 0, "user", "lost"),
            (1, 5, None, None), (1, 6, "user", ""), (3, 1, "user", "only"), (7, 1, "user", "no base"), (7, 2, "u", "ser|no base"), (10, 1, "user", "é"),
            (11, 1, "user", "x"), (14, 3, "user", "y" * 100_000)]
    rows += [(c, t, "r", f"{c} {t}") for c in (20, 21, 22, 23, 24) for t in range(12)]
    df = spark.createDataFrame([(*r, "other") for r in rows], "conv_id long, turn long, role string, text string, base string").repartition(3)
    turns = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            key = hashlib.sha256(f"{len(r.encode())}:{r}{x}".encode()).digest()[:pt.KEY]
            turns[c].append(((t is not None, t or 0, key), (key, len(x.encode()))))
    own = {c: [v for _, v in sorted(s)] for c, s in turns.items()}
    want = {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        want[c] = own.get(c - c % 5, [])[:h] + s[h:]
    from pyspark.sql import functions as F
    conv = F.col("conv_id")
    seqs = pt.paths(pt.turn_keys(df), 4, conv - conv % 5, pt.borrowed_head)
    assert {r.conv_id: (bytes(r.path), np.frombuffer(r.sizes, "<i8").tolist()) for r in seqs.collect()} == {
        c: (b"".join(k for k, _ in s), [n for _, n in s]) for c, s in want.items()}
    assert trie_rows(pt.prefix_trie(seqs, 5)) == brute_trie(want)
    plain = pt.paths(pt.turn_keys(df), 4)
    assert trie_rows(pt.prefix_trie(plain)) == brute_trie(own)


def test_range_minima_search():
    rng = np.random.default_rng(1)
    v = np.r_[-1, rng.integers(0, 5, 70)]
    t = pt.RangeMinima(v)
    at = np.repeat(np.arange(len(v)), 6)
    least = np.tile(np.arange(6), len(v))
    left, right = [], []
    for a, d in zip(at.tolist(), least.tolist(), strict=True):
        lo = hi = a
        while lo > 0 and v[lo] >= d:
            lo -= 1
        while hi + 1 < len(v) and v[hi + 1] >= d:
            hi += 1
        left.append(lo)
        right.append(hi)
    assert t.left(at, least).tolist() == left and t.right(at, least).tolist() == right
    assert t.minimum(np.array([3, 0, 9]), np.array([3, 70, 40])).tolist() == [v[3], -1, v[9:41].min()]


# ---------------------------------------------------------------- operator 13

ODD = ["", None, "a\x1cb  c d", "don't I'M we'RE 12345 ,.!é é İ <|endoftext|>x <|startoftext|> y", "Σ ΑΣ ςσ ﬁ ǅ 漢字 😀x", "x" * 5000, " 　 q\u0085w",
       "ß ẞ ÿ Ÿ µ ª º × ÷ a×b", " ", "\n", "A-B a--b (c) \"q\" 'tis o'clock d'll", "\x00a\x00 b\x0b\x0cc", "<|endoftext|><|endoftext|>"]
#: Longer than one run is split at: letters, signs, digits, marks that join the letter before, contractions, other white space.
LONG = ["abc" * 70000, "漢字假名" * 30000, "'ll" * 40000, "don't-" * 30000, "é" * 40000, "각" * 30000, "!!'s" * 40000, "1234" * 30000,
        "　" * 70000 + "x", "😀👍🏽" * 30000, "ก็" * 50000, "का" * 50000]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(default_tokenizer())


@pytest.mark.parametrize("texts,kept", [(ODD, 10**8), (ODD, 1), (LONG, 10**8)])
def test_transducer_gives_the_librarys_ids_and_text(library, texts, kept):
    enc, dec = bpe.Transducer(default_tokenizer(), kept_bytes=kept), bpe.ByteDecoder(default_tokenizer())
    for part in (texts[:3], texts[3:], []):
        ids, n = enc.encode(pa.array(part, pa.string()))
        for t, e, k in zip(part, np.cumsum(n).tolist(), n.tolist(), strict=True):
            want = library.encode(t or "", add_special_tokens=False).ids
            got = ids[e - k: e]
            assert got.tolist() == want
            piece = 7 if k < 5000 else 997
            assert "".join(dec.feed(got[i: i + piece]) for i in range(0, k, piece)) + dec.finish() == library.decode(want, skip_special_tokens=False)


def test_streams_hold_a_bounded_window(library):
    enc = bpe.Transducer(default_tokenizer())
    rng = random.Random(3)
    for _ in range(40):
        w = "".join(rng.choice("aeinthsr") for _ in range(rng.randint(1, 4000)))
        tr, symbols, out, i = bpe.WordTransducer(enc.merges, enc.size), enc.symbols(w), [], 0
        while len(symbols) - i > 60:
            k = rng.randint(1, 50)
            out += tr.feed(symbols[i: i + k])
            i += k
            assert len(tr.held) <= tr.window + 50
        assert out + tr.finish(symbols[i:]) == library.encode(w, add_special_tokens=False).ids


def test_lookahead_is_sufficient_and_needs_a_proper_list():
    """Small merge lists over two letters: boundaries the lookahead before the end stay for every continuation."""
    from itertools import product
    rng = random.Random(5)
    seen = set()
    for _ in range(60):
        size, pairs, known = {0: 1, 1: 1}, [], [0, 1]
        for w in range(2, 7):
            u, v = rng.choice(known), rng.choice(known)
            if any(p[:2] == (u, v) for p in pairs):
                continue
            size[w] = size[u] + size[v]
            pairs.append((u, v, w))
            known.append(w)
        m = bpe.Merges(pairs, size)
        seen.add(m.lookahead)

        def cuts(word):
            at, out = 0, set()
            for t in m.apply(list(word)):
                at += size[t]
                out.add(at)
            return out

        for word in product((0, 1), repeat=9):
            final = len(word) - m.lookahead
            base = {c for c in cuts(word) if c <= final}
            for more in product((0, 1), repeat=4):
                assert {c for c in cuts(word + more) if c <= final} == base
    assert len(seen) > 3
    with pytest.raises(ValueError):
        bpe.Merges([(2, 0, 3), (0, 1, 2)], {0: 1, 1: 1, 2: 2, 3: 3})


def test_decoder_of_a_byte_level_file_keeps_its_state_between_pieces():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    lib, dec = Tokenizer.from_file(path), bpe.ByteDecoder(path)
    rng = random.Random(2)
    for ids in [lib.encode("naïve 漢字 😀 text").ids, [rng.randrange(50257) for _ in range(400)], [], [rng.randrange(256) for _ in range(300)]]:
        assert "".join(dec.feed([i]) for i in ids) + dec.finish() == lib.decode(ids, skip_special_tokens=False)


def test_round_trip_of_rows(spark, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (3, "same"), (3, "same"), (99, "word " * 30_000)]
    df = spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id long, text string, n_tokens int, ids string").repartition(3)
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted((tuple(r) for r in bpe.round_trip_digests(df).collect()), key=repr) == sorted(want, key=repr)
    assert bpe.round_trip_digests(df.limit(0)).collect() == []
    back = {(r.doc_id, r.text) for r in bpe.decoded(bpe.encoded(df)).collect()}
    assert back == {(i, library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False)) for i, t in rows}
