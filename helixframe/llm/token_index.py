"""Token-ID shards with a minimal perfect hash index (operator 3).

``write_shards`` deals the documents into key ranges, sorts each, encodes whole texts and writes
one file per range: raw little-endian ids (2 bytes if the vocabulary fits, else 4) followed by the
index of its keys. The index is a minimal perfect hash of cascading bit levels: a key's slot is
the rank of its bit in the first level where it met no other key, so that a lookup takes a few
probes whatever the number of keys. Each slot stores a 32-bit fingerprint, which rejects almost
every key that was never stored, and the key's rows. ``lookup`` routes keys to files by range and reads only
their payloads.

Files are written under a name of the attempt's own and renamed when complete, so a lost executor
leaves nothing half written; a repeated task writes the same bytes.

Defined results: null text is an empty text (its row holds the end id only); rows with a null key
come first and are reached by the null key; rows that share a key are stored in order of their text and
all returned by one lookup; no rows: no files and an empty answer. Rows of one key share one file unless
they would fill several: then the text's hash deals them to files of that key alone (equal rows stay together), each
in order of text. Null keys likewise.
"""

from __future__ import annotations

import json
import posixpath
import uuid
import zlib
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import id_text
from helixframe.llm.tokens import default_tokenizer, encoder, in_slices

MAGIC = b"HXIDS001"
U64 = np.uint64


# ---------------------------------------------------------------- minimal perfect hash

def mix(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit bijection of the keys for each seed."""
    x = x.astype(U64) + U64((0x9E3779B97F4A7C15 * (seed + 1)) & (2**64 - 1))
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def fingerprint(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 977) >> U64(32)).astype(np.uint32)


class PerfectHash:
    """Distinct int64 keys -> 0..n-1. ``gamma`` bits per key and level."""

    def __init__(self, sizes: list[int], words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.base = np.concatenate([[0], np.cumsum([s // 64 for s in sizes])]).astype(np.int64)
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.cumsum(ones) - ones

    @classmethod
    def build(cls, keys: np.ndarray, gamma: float = 2.0) -> PerfectHash:
        sizes, words, left = [], [], keys.astype(np.int64)
        while len(left):
            size = max(64, -(-int(gamma * len(left)) // 64) * 64)
            at = (mix(left.view(U64), len(sizes)) % U64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            bits = np.packbits(alone, bitorder="little").view("<u8")
            sizes.append(size)
            words.append(bits)
            left = left[~alone[at]]
            if len(sizes) > 200:
                raise ValueError("keys are not distinct")
        return cls(sizes, np.concatenate(words) if words else np.empty(0, "<u8"))

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 where no level holds it (it was never stored)."""
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        k = keys.astype(np.int64).view(U64)
        for level, size in enumerate(self.sizes):
            if not len(open_):
                break
            at = (mix(k[open_], level) % U64(size)).astype(np.int64)
            word, bit = self.base[level] + at // 64, (at % 64).astype(U64)
            hit = (self.words[word] >> bit) & U64(1) == 1
            w, b = word[hit], bit[hit]
            below = self.words[w] & ((U64(1) << b) - U64(1))
            out[open_[hit]] = self.before[w] + np.bitwise_count(below)
            open_ = open_[~hit]
        return out


# ---------------------------------------------------------------- shard files

class ShardWriter:
    """Appends rows in key order; ``close`` writes the index and renames the file."""

    def __init__(self, folder: str, shard: int, width: int):
        self.fs, root = fs.FileSystem.from_uri(folder)
        self.final = posixpath.join(root, f"ids-{shard:06d}.bin")
        self.temp = f"{self.final}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.temp)
        self.out.write(MAGIC)
        self.shard, self.width = shard, width
        self.keys: list[np.ndarray] = []
        self.sizes: list[np.ndarray] = []
        self.nulls = 0

    def add(self, keys: pa.Array, sizes: np.ndarray, ids: np.ndarray):
        self.nulls += keys.null_count
        self.keys.append(pc.drop_null(keys).to_numpy(zero_copy_only=False).astype(np.int64))
        self.sizes.append(sizes)
        self.out.write(ids.astype(f"<u{self.width}").tobytes())

    def close(self) -> dict:
        keys, sizes = np.concatenate(self.keys), np.concatenate(self.sizes)
        if len(sizes) >= 1 << 32:
            raise ValueError(f"file {self.shard} has more rows than its index can number")
        distinct, first, count = np.unique(keys, return_index=True, return_counts=True)
        mph = PerfectHash.build(distinct)
        slot = mph.slots(distinct)
        prints, rows = np.zeros(len(distinct), "<u4"), np.zeros((len(distinct), 2), "<u4")
        prints[slot] = fingerprint(distinct.view(U64))
        rows[slot, 0], rows[slot, 1] = first + self.nulls, count
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype("<u8")
        parts = {"words": mph.words.astype("<u8"), "prints": prints, "rows": rows, "ends": ends}
        head = {"shard": self.shard, "width": self.width, "levels": mph.sizes, "nulls": int(self.nulls),
                "payload": len(MAGIC), "sections": {}}
        at = len(MAGIC) + int(sizes.sum()) * self.width
        for name, a in parts.items():
            raw = a.tobytes()
            head["sections"][name] = [at, len(raw)]
            self.out.write(raw)
            at += len(raw)
        raw = json.dumps(head).encode()
        self.out.write(raw + len(raw).to_bytes(8, "little") + MAGIC)
        self.out.close()
        self.fs.move(self.temp, self.final)
        return {"shard": self.shard, "rows": len(sizes), "tokens": int(sizes.sum()), "nulls": int(self.nulls),
                "first_key": int(distinct[0]) if len(distinct) else None, "last_key": int(distinct[-1]) if len(distinct) else None}


class ShardReader:
    """Keyed access to one file: its index is read once, payloads on demand."""

    def __init__(self, folder: str, shard: int):
        f, root = fs.FileSystem.from_uri(folder)
        self.file = f.open_input_file(posixpath.join(root, f"ids-{shard:06d}.bin"))
        size = self.file.size()
        tail = self.file.read_at(16, size - 16)
        if tail[8:] != MAGIC:
            raise ValueError(f"shard {shard} is not complete")
        n = int.from_bytes(tail[:8], "little")
        self.head = json.loads(self.file.read_at(n, size - 16 - n))
        sec = {k: self.file.read_at(length, at) for k, (at, length) in self.head["sections"].items()}
        self.mph = PerfectHash(self.head["levels"], np.frombuffer(sec["words"], "<u8"))
        self.prints = np.frombuffer(sec["prints"], "<u4")
        self.rows = np.frombuffer(sec["rows"], "<u4").reshape(-1, 2)
        self.ends = np.frombuffer(sec["ends"], "<u8").astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first row, number of rows) of each key; 0 rows where its fingerprint differs or it has no slot."""
        first, count = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        if not len(self.prints):
            return first, count
        slot = self.mph.slots(keys)
        ok = (slot >= 0) & (self.prints[np.maximum(slot, 0)] == fingerprint(keys.view(U64)))
        first[ok], count[ok] = self.rows[slot[ok], 0], self.rows[slot[ok], 1]
        return first, count

    def ids(self, row: int) -> np.ndarray:
        w = self.head["width"]
        raw = self.file.read_at(int(self.ends[row + 1] - self.ends[row]) * w, self.head["payload"] + int(self.ends[row]) * w)
        return np.frombuffer(raw, f"<u{w}")


# ---------------------------------------------------------------- Spark jobs

#: Text bytes of one file, about.
SHARD_BYTES = 256 << 20


def key_bounds(keys: DataFrame, parts: int) -> list[int]:
    """``parts - 1`` upper bounds that cut the keys into ranges of about equal size (a quantile sketch), in order; a key that
    fills several ranges is there several times."""
    if parts < 2:
        return []
    q = keys.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.2 / parts)
    return sorted(int(x) for x in q)


def shard_of(docs: DataFrame, shards: int | None) -> tuple[Column, int]:
    """(file number of a row, number of files). Files are ranges of keys in order, null keys first; a key or the null keys
    that would fill several files get as many of their own, and their rows are dealt to these by the text's hash.

    ``shards`` None: as many as the shuffle has partitions, and more where a file would exceed :data:`SHARD_BYTES`.
    """
    size = docs.agg(F.count("*").alias("n"), F.count("doc_id").alias("keys"), F.sum(F.octet_length("text")).alias("bytes")).first()
    if shards is None:
        shards = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(size["bytes"] or 0) // SHARD_BYTES))
    nulls = (size["n"] - size["keys"]) * shards // max(size["n"], 1)
    bounds = key_bounds(docs.select("doc_id").dropna(), shards - nulls) if size["keys"] else []
    part = lambda k: F.pmod(F.xxhash64("text"), k).cast("int")
    null_file = part(F.lit(nulls)) if nulls else F.lit(0)
    upper = sorted(set(bounds))
    if not upper:
        return F.when(F.col("doc_id").isNull(), null_file).otherwise(nulls), nulls + 1
    own = [bounds.count(b) if bounds.count(b) > 1 else 0 for b in upper]      # files of a hot key alone
    first = [nulls + k + sum(own[:k]) for k in range(len(upper) + 1)]
    longs = lambda xs: "array(" + ",".join(f"{x}L" for x in xs) + ")"
    at = f"size(filter({longs(upper)}, b -> doc_id > b))"
    start, hot = F.expr(f"{longs(first)}[{at}]").cast("int"), F.expr(f"IF(array_contains({longs(upper)}, doc_id), {longs([*own, 0])}[{at}], 0L)")
    file = F.when(F.col("doc_id").isNull(), null_file).when(hot > 0, start + 1 + part(F.greatest(hot, F.lit(1)))).otherwise(start)
    return file.cast("int"), first[-1] + 1


def write_shards(docs: DataFrame, folder: str, shards: int | None = None, tokenizer: str | None = None, end_id: int = 1) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into ``folder``; returns the manifest that ``lookup`` needs
    (one row per file: key range, rows, tokens, ids before it)."""
    spark, path = docs.sparkSession, tokenizer or default_tokenizer()
    shard, n_files = shard_of(docs, shards)
    fs_, root = fs.FileSystem.from_uri(folder)
    fs_.create_dir(root, recursive=True)
    dealt = (docs.withColumn("shard", shard).repartitionById(n_files, F.col("shard"))
             .sortWithinPartitions("shard", F.col("doc_id").asc_nulls_first(), "text"))
    fields = "shard int, rows long, tokens long, nulls long, first_key long, last_key long"

    def run(batches):
        enc = encoder(path)
        width = 2 if enc.vocab_size <= 1 << 16 else 4
        writer, done = None, []
        for b in batches:
            for s in sorted(set(b.column("shard").to_pylist())):
                part = b.filter(pc.equal(b.column("shard"), s))
                if writer is None or writer.shard != s:
                    if writer is not None:
                        done.append(writer.close())
                    writer = ShardWriter(folder, s, width)
                at = 0
                for piece in in_slices(part.column("text")):
                    ids, sizes = enc.encode(piece)
                    ids = np.insert(ids, np.cumsum(sizes), end_id)
                    writer.add(part.column("doc_id").slice(at, len(piece)), sizes + 1, ids)
                    at += len(piece)
        if writer is not None:
            done.append(writer.close())
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=pa.schema(
                [("shard", pa.int32()), ("rows", pa.int64()), ("tokens", pa.int64()), ("nulls", pa.int64()),
                 ("first_key", pa.int64()), ("last_key", pa.int64())]))

    files = sorted(dealt.mapInArrow(run, fields).collect(), key=lambda r: r["shard"])   # one row per file
    total, rows = 0, []
    for r in files:
        rows.append((*r, total))
        total += r["tokens"]
    manifest = spark.createDataFrame(rows, fields + ", before long")
    manifest.coalesce(1).write.parquet(posixpath.join(folder, "manifest"))
    return spark.read.parquet(posixpath.join(folder, "manifest"))


def lookup(keys: DataFrame, folder: str, key_col: str = "doc_id", payload: bool = False) -> DataFrame:
    """Stored rows of each distinct key: doc_id, start, n_tokens, ids_crc32 (and ``ids`` if ``payload``).

    Keys are dealt to the files by the manifest's ranges (a key of several files to each of them) and looked up by the
    perfect hash; a key that was not stored gives no row, but for one in 2^32 whose fingerprint agrees.
    """
    spark = keys.sparkSession
    files = spark.read.parquet(posixpath.join(folder, "manifest")).orderBy("shard").collect()   # one row per file
    ranged = [r for r in files if r["last_key"] is not None]
    skip = len(files) - len(ranged)                    # files of null keys alone come first
    cuts = "array(" + ",".join(f"{r['first_key']}L" for r in ranged) + ")" if ranged else "cast(array() as array<bigint>)"
    null_files = "cast(array(" + ",".join(str(i) for i, r in enumerate(files) if r["nulls"]) + ") as array<int>)"
    wanted = keys.select(F.col(key_col).cast("long").alias("doc_id")).distinct()
    # files that begin with the key, else the last one that begins below it
    below, upto = f"size(filter({cuts}, b -> b < doc_id))", f"size(filter({cuts}, b -> b <= doc_id))"
    places = F.expr(f"""CASE WHEN doc_id IS NULL THEN {null_files} WHEN {upto} = 0 THEN cast(array() as array<int>)
                        WHEN {below} < {upto} THEN sequence({skip} + {below}, {skip} + {upto} - 1) ELSE array({skip} + {upto} - 1) END""")
    n = max(1, len(files))
    before = {r["shard"]: r["before"] for r in files}
    fields = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<int>" if payload else "")
    names = [f.split()[0] for f in fields.split(", ")]
    numbers = [r["shard"] for r in files]
    types = [pa.int64()] * 4 + [pa.list_(pa.int32())] * payload

    def run(batches):
        readers: dict[int, ShardReader] = {}

        def reader(shard):
            if shard not in readers:
                readers.clear()          # keys come sorted: one file at a time
                readers[shard] = ShardReader(folder, shard)
            return readers[shard]

        def row(key, shard, r):
            f = reader(shard)
            ids = f.ids(r)
            return (key, before[shard] + int(f.ends[r]), len(ids), zlib.crc32(ids.astype("<u4").tobytes()),
                    *([ids.tolist()] if payload else []))

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names=names)

        def found(b):
            places_, keys_ = b.column("place").to_numpy(), b.column("doc_id")
            for p in np.unique(places_):
                own, shard = keys_.filter(pa.array(places_ == p)), numbers[p]
                if own.null_count:
                    yield from ((None, shard, r) for r in range(reader(shard).head["nulls"]))
                own = pc.drop_null(own).to_numpy(zero_copy_only=False).astype(np.int64)
                first, count = reader(shard).find(own)
                for k, a, c in zip(own.tolist(), first.tolist(), count.tolist(), strict=True):
                    yield from ((k, shard, r) for r in range(a, a + c))

        for b in batches:
            hits = found(b)
            while out := [row(*x) for x in islice(hits, 1000)]:
                yield batch(out)

    return (wanted.select(F.explode(places).alias("place"), "doc_id").repartitionById(n, F.col("place"))
            .sortWithinPartitions("place", "doc_id").mapInArrow(run, fields))


def token_file_digest(docs: DataFrame, folder: str, shards: int | None = None, tokenizer: str | None = None, end_id: int = 1) -> DataFrame:
    """Write ``docs`` as id shards and read every document back by its key."""
    d = id_text(docs)
    write_shards(d, folder, shards, tokenizer, end_id)
    return lookup(d.select("doc_id"), folder)
