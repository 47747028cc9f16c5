"""Encoding, id shards with their perfect hash, packing: exact round trips against plain tokenization."""

import zlib

import numpy as np
import pyarrow as pa
import pytest

from conftest import SF001
from helixframe.llm import packing, token_index
from helixframe.llm.tokens import ChunkEncoder, default_tokenizer
from helixframe.session import scratch_path

ODD = ["", "a\x1cb  c d", "don't I'M we'RE 12345 ,.!é é İ <|endoftext|>x <|startoftext|> y", "Σ ΑΣ ςσ ﬁ ǅ 漢字 😀x", "x" * 5000, " 　 q\u0085w",
       "ß ẞ ÿ Ÿ µ ª º × ÷ a×b", " ", "\n", "A-B a--b (c) \"q\" 'tis o'clock d'll", "\x00a\x00 b\x0b\x0cc"]


@pytest.fixture(scope="module")
def plain():
    enc = ChunkEncoder(default_tokenizer())
    return lambda t: [*enc.tok.encode(t or "", add_special_tokens=False).ids, 1]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("kept", [10**8, 5])
def test_cached_encoding_is_the_tokenizers_own(plain, kept):
    import duckdb
    texts = [r[0] for r in duckdb.sql(f"select text from read_parquet('{SF001}/documents.parquet')").fetchall()]
    enc = ChunkEncoder(default_tokenizer(), kept_bytes=kept)
    for part in (ODD, [None], texts[:60], texts[60:], []):
        ids, n = enc.encode(pa.array(part, pa.string()))
        ends = np.cumsum(n)
        assert [ids[e - k: e].tolist() for e, k in zip(ends, n, strict=True)] == [plain(t)[:-1] for t in part]


def test_perfect_hash_is_minimal_and_rejects_strangers():
    keys = np.unique(np.random.default_rng(0).integers(-2**62, 2**62, 20_000))
    mph = token_index.PerfectHash.build(keys)
    assert sorted(mph.slots(keys).tolist()) == list(range(len(keys)))
    assert len(mph.words) * 64 < 4 * len(keys)                    # a few bits per key
    assert token_index.PerfectHash.build(np.empty(0, np.int64)).slots(np.array([1])).tolist() == [-1]


@pytest.mark.parametrize("shards", [1, 5])
def test_shards_round_trip(spark, plain, shards):
    rows = [(i * 7 - 20, t) for i, t in enumerate(ODD)] + [(None, "null key"), (None, "a null key"), (8, None), (8, "twice"), (8, "twice")]
    rows += [(1000 + i, f"text number {i}") for i in range(50)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, shard int")
    want, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = plain(t)
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    got = [tuple(r) for r in token_index.token_file_digest(df, scratch_path(spark, "ids"), shards).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("hot", [7, None, -1, 10**6])
def test_a_hot_key_fills_files_of_its_own(spark, plain, hot):
    rows = [(i, f"own text {i}") for i in range(300)] + [(hot, f"hot text {i}") for i in range(300)] + [(7, "x"), (None, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    folder = scratch_path(spark, "ids")
    files = token_index.write_shards(df, folder, 10).orderBy("shard").collect()
    alone = [r for r in files if (r.nulls == r.rows if hot is None else r.first_key == r.last_key == hot)]
    assert len(alone) >= 3 and max(r.rows for r in files) < 200 and sum(r.rows for r in files) == len(rows)
    spans = [(r.first_key, r.last_key) for r in files if r.first_key is not None]
    assert spans == sorted(spans) and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    got = token_index.lookup(df.select("doc_id"), folder, payload=True).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(((r.doc_id, list(r.ids)) for r in got), key=key) == sorted(((i, plain(t)) for i, t in rows), key=key)
    at = 0
    for r in sorted(got, key=lambda r: r.start):              # no gap, no overlap, keys in order
        assert r.start == at
        at += r.n_tokens
    in_order = [(r.doc_id is not None, r.doc_id or 0) for r in sorted(got, key=lambda r: r.start)]
    assert in_order == sorted(in_order)


def test_lookup_reads_only_what_is_asked(spark, plain):
    folder = scratch_path(spark, "ids")
    df = spark.createDataFrame([(i, f"some words {i}") for i in range(0, 200, 2)], "doc_id long, text string")
    token_index.write_shards(df, folder, 4)
    keys = spark.createDataFrame([(4,), (5,), (-3,), (198,), (999,), (4,), (None,)], "doc_id long")
    got = {r.doc_id: list(r.ids) for r in token_index.lookup(keys, folder, payload=True).collect()}
    assert got == {i: plain(f"some words {i}") for i in (4, 198)}


def test_shards_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert token_index.token_file_digest(df, scratch_path(spark, "ids"), 3).collect() == []


def test_bounds_never_exceed_the_best_packing():
    from itertools import product
    rng = np.random.default_rng(2)

    def best(items, cap):                                          # exact, by trying every assignment
        for k in range(1, len(items) + 1):
            for a in product(range(k), repeat=len(items)):
                if all(sum(x for x, b in zip(items, a, strict=True) if b == j) <= cap for j in range(k)):
                    return k

    for _ in range(60):
        cap = int(rng.integers(5, 20))
        items = rng.integers(1, cap + 1, int(rng.integers(1, 6)))
        opt, used = best(items.tolist(), cap), packing.best_fit_decreasing(items, cap)[2]
        assert packing.lower_bound(items, cap) <= opt <= used
    assert packing.lower_bound(np.array([6, 6, 6]), 10) == 3       # the plain sum would say 2


def test_packing_is_whole_and_tight(spark, plain):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, None), (3, "repeated"), (3, "repeated"), (77, "word " * 300)]
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, sequence_id int")
    cap = 64
    got = [r.asDict() for r in packing.pack_documents(df, capacity=cap).collect()]
    want = []
    for i, t in rows:
        ids = plain(t)
        want += [(i, k, a, len(ids[a:a + cap]), crc(ids[a:a + cap])) for k, a in enumerate(range(0, len(ids), cap))]
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=repr) == sorted(want, key=repr)
    check_sequences(got, cap)
    assert packing.pack_documents(df.limit(0)).collect() == []


def check_sequences(rows, cap):
    seqs = {}
    for r in rows:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for s in seqs.values():
        at = 0
        for off, n in sorted(s):
            assert off == at
            at += n
        assert at <= cap
    return len(seqs)


def test_gap_partitions_exchange_documents(spark):
    rng = np.random.default_rng(5)
    lengths = rng.integers(150, 700, 3000)
    df = spark.createDataFrame([(int(i), int(n)) for i, n in enumerate(lengths)], "k long, length long").repartition(4)
    one = check_sequences([r.asDict() for r in packing.pack(df, 1000, part_rows=150, rounds=0).collect()], 1000)
    more = check_sequences([r.asDict() for r in packing.pack(df, 1000, part_rows=150, rounds=3).collect()], 1000)
    assert packing.lower_bound(lengths, 1000) <= more <= one
