"""Self-join on n-gram Jaccard similarity by MinHash banding (operator 9).

1. Every text's set of word 5-grams is hashed; texts with equal sets form a class (copies), and
   only one member of each goes on. Its MinHash signature is cut into bands; the numbers of bands and rows per
   band follow from the target recall at the threshold.
2. Band hashes are shuffled; classes that share a band value with another are candidates. They are linked to
   the smallest member of their bucket only, and the connected parts of that graph hold every candidate pair.
3. Each part is verified on the full n-gram sets. Parts of more than ``block_docs`` classes (or
   ``block_grams`` n-grams) are dealt into blocks and every pair of blocks is a unit of work of its own,
   so no task holds a whole part. A pair is compared if some band agrees; units return each class's number of
   links and a spanning forest, never the pairs.
4. Links are summed and the verified graph's components are the groups.

Texts become words as lower-cased runs of letters and digits. Defined results: a text of 1 to 4
words has one n-gram, all its words; an empty or null text has none and is linked to nothing, not even to other empty texts;
rows that share an id are separate documents; a null id takes part, and a group's ``class_id`` is
the smallest non-null id in it (null if there is none). No rows give no rows.
"""

from __future__ import annotations

import hashlib
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import free_name, id_text, own_name, release_memory
from helixframe.llm.components import components
from helixframe.llm.tokens import in_slices
from helixframe.session import scratch_path

U64 = np.uint64
WORD_BREAK = r"[^\p{L}\p{N}]+"


def banding(threshold: float, recall: float, max_hashes: int = 128) -> tuple[int, int]:
    """(bands, rows per band): the most selective choice of at most ``max_hashes`` hashes that finds a pair
    at the threshold with the target recall, 1 - (1 - t^rows)^bands >= recall."""
    best = None
    for rows in range(1, max_hashes + 1):
        p = threshold ** rows
        bands = max(1, int(np.ceil(np.log1p(-recall) / np.log1p(-p)))) if p < 1 else 1
        if bands * rows <= max_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("no banding of so few hashes reaches the recall")
    return best


def gram_hashes(arr: pa.Array, n: int = 5) -> list[np.ndarray]:
    """Sorted distinct 64-bit n-gram hashes of each text."""
    low = pc.utf8_lower(pc.fill_null(arr, ""))
    toks = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.replace_substring_regex(low, WORD_BREAK, " ")))
    counts = pc.list_value_length(toks).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = pc.dictionary_encode(toks.flatten())
    names = coded.dictionary.to_pylist()
    empty = np.array([w == "" for w in names], bool)       # what is left of a text without words
    value = pd.util.hash_array(np.array(names, object), categorize=False).astype(U64) if names else np.empty(0, U64)
    h = value[coded.indices.to_numpy()] if names else value
    mult = [U64(pow(0x9E3779B97F4A7C15, 2 * j + 1, 2**64)) for j in range(n)]
    with np.errstate(over="ignore"):
        full = np.zeros(max(0, len(h) - n + 1), U64)
        for j in range(n):
            x = (h[j: len(h) - n + 1 + j] ^ (h[j: len(h) - n + 1 + j] >> U64(29))) * mult[j]
            full += x
        full = _finish(full)
        out, at = [], 0
        for c in counts.tolist():
            if c >= n:
                out.append(np.unique(full[at: at + c - n + 1]))
            elif c == 0 or (c == 1 and empty[coded.indices[at].as_py()]):
                out.append(np.empty(0, U64))
            else:
                key = "\x01".join(names[coded.indices[at + i].as_py()] for i in range(c))
                out.append(np.frombuffer(hashlib.blake2b(key.encode(), digest_size=8).digest(), "<u8").astype(U64))
            at += c
    return out


def _finish(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(31))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class MinHash:
    """Band values of a set of hashes: ``rows`` minima of multiply-shift hashes each."""

    def __init__(self, bands: int, rows: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.a = (rng.integers(1, 2**32, bands * rows, dtype=np.uint64) | U64(1)).astype(np.uint32)
        self.b = rng.integers(0, 2**32, bands * rows, dtype=np.uint64).astype(np.uint32)

    def __call__(self, grams: np.ndarray) -> np.ndarray:
        lo = (grams ^ (grams >> U64(32))).astype(np.uint32)
        sig = np.full(len(self.a), 0xFFFFFFFF, np.uint32)
        for i in range(0, len(lo), 512):
            x = lo[i: i + 512, None] * self.a[None, :] + self.b[None, :]
            x ^= x >> np.uint32(15)
            x *= np.uint32(0x2C1B3C6D)
            x ^= x >> np.uint32(13)
            np.minimum(sig, x.min(0), out=sig)
        key = np.zeros(self.bands, U64)
        with np.errstate(over="ignore"):
            for j in range(self.rows):
                key = _finish(key * U64(0x100000001B3) + sig.reshape(self.bands, self.rows)[:, j].astype(U64) + U64(j + 1))
            key += np.arange(self.bands, dtype=U64)          # a value never meets one of another band by design
        return _finish(key).view(np.int64)


def signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """uid, doc_id, grams (count), digest (of the set; null if empty), bands of every document."""
    def run(batches):
        mh = MinHash(bands, rows)
        for b in batches:
            at = 0
            for part in in_slices(b.column("text"), 2_000_000):
                sets = gram_hashes(part, n)
                digest = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [b.column("uid").slice(at, len(part)), b.column("doc_id").slice(at, len(part)),
                     pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()),
                     pa.array([mh(s) if len(s) else None for s in sets], pa.list_(pa.int64()))],
                    names=["uid", "doc_id", "grams", "digest", "bands"])
                at += len(part)
        release_memory()
    return docs.select("uid", "doc_id", "text").mapInArrow(run, "uid long, doc_id long, grams long, digest binary, bands array<long>")


class _Unit:
    """The classes of one unit of work (a block, or a pair of blocks), compared when complete."""

    def __init__(self, first: int, second: int):
        self.one_block = first == second
        self.first, self.rows = first, []

    def compare(self, num: int, den: int) -> list[tuple[int, int, int]]:
        """(uid, links, smallest linked uid of its tree) of the classes with links; similarity at least num/den."""
        rows = sorted(self.rows, key=lambda r: (r[1], r[0]))
        uid = np.array([r[0] for r in rows], np.int64)
        block = np.array([r[1] for r in rows], np.int64)
        copies = np.array([r[2] for r in rows], np.int64)
        bands = np.array([r[3] for r in rows], np.int64)
        sizes = np.array([len(r[4]) for r in rows], np.int64)
        values, code = np.unique(np.concatenate([r[4] for r in rows]), return_inverse=True)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        mark = np.zeros(len(values), bool)
        links, parent = np.zeros(len(rows), np.int64), list(range(len(rows)))

        def find(i):
            while parent[i] != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        side = len(rows) if self.one_block else int((block == self.first).sum())
        for i in range(side):
            lo = i + 1 if self.one_block else side
            if lo >= len(rows):
                break
            near = sizes[lo:] * num <= sizes[i] * den
            near &= sizes[i] * num <= sizes[lo:] * den
            near &= (bands[lo:] == bands[i]).any(1)
            cand = lo + np.flatnonzero(near)
            if not len(cand):
                continue
            own = code[starts[i]: ends[i]]
            mark[own] = True
            if 4 * len(cand) > len(rows) - lo:
                both = np.add.reduceat(mark[code[starts[lo]:]].astype(np.int64), starts[lo:] - starts[lo])[cand - lo]
            else:
                both = np.array([np.count_nonzero(mark[code[starts[j]: ends[j]]]) for j in cand.tolist()])
            mark[own] = False
            hit = cand[den * both >= num * (sizes[i] + sizes[cand] - both)]
            if len(hit):
                links[i] += copies[hit].sum()
                links[hit] += copies[i]
                for j in hit.tolist():
                    a, b = find(i), find(j)
                    if a != b:
                        parent[max(a, b)] = min(a, b)
        lowest: dict[int, int] = {}
        linked = np.flatnonzero(links).tolist()
        for i in linked:
            r = find(i)
            lowest[r] = min(lowest.get(r, int(uid[i])), int(uid[i]))
        return [(int(uid[i]), int(links[i]), lowest[find(i)]) for i in linked]


def verify(members: DataFrame, num: int, den: int, parts: int) -> DataFrame:
    """uid, links, low: partial link counts and forest edges. ``members``: part, first, second, block, uid, copies, bands, grams."""
    def run(batches):
        key, unit, out = None, None, []

        def batch():
            cols = list(zip(*out, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["uid", "links", "low"])

        for b in batches:
            flat = b.column("bands").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) if b.num_rows else None
            grams = b.column("grams")
            cols = [b.column(c).to_pylist() for c in ("part", "first", "second", "block", "uid", "copies")]
            for r, (part, first, second, block, uid, copies) in enumerate(zip(*cols, strict=True)):
                if (part, first, second) != key:
                    if unit is not None and len(unit.rows) > 1:
                        out += unit.compare(num, den)
                    key, unit = (part, first, second), _Unit(first, second)
                unit.rows.append((uid, block, copies, flat[r].copy(), np.frombuffer(grams[r].as_py(), "<u8")))
            if len(out) >= 10_000:
                yield batch()
                out.clear()
        if unit is not None and len(unit.rows) > 1:
            out += unit.compare(num, den)
        if out:
            yield batch()
        del unit, out
        release_memory()

    return (members.repartition(parts, "part", "first", "second").sortWithinPartitions("part", "first", "second", "block", "uid")
            .select("part", "first", "second", "block", "uid", "copies", "bands", "grams")
            .mapInArrow(run, "uid long, links long, low long"))


def jaccard_links(docs: DataFrame, threshold: float = 0.8, n: int = 5, recall: float = 0.9999, max_hashes: int = 128,
                  block_docs: int = 2048, block_grams: int = 4_000_000) -> DataFrame:
    """uid, doc_id, class_id, copy_of, n_links, keeper of every row of ``docs`` (uid, doc_id, text: a
    stored table whose ``uid`` is distinct).

    ``class_id``: smallest doc_id of the group of documents connected by links; ``copy_of``: smallest doc_id
    with the same n-gram set; ``n_links``: number of other documents with similarity at or above the threshold
    (copies included); ``keeper``: true for exactly one document of each group.
    """
    spark = docs.sparkSession
    base = scratch_path(spark, "jaccard")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bands, rows = banding(threshold, recall, max_hashes)
    frac = Fraction(str(threshold))

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    sig = stored(signatures(docs, n, bands, rows), "signatures")
    classes = stored(sig.filter("digest is not null").groupBy("digest")
                     .agg(F.min("uid").alias("rep"), F.min("doc_id").alias("copy_of"), F.count("*").alias("copies")), "classes")
    # signatures of the representatives only
    reps = stored(sig.select(F.col("uid").alias("rep"), "grams", "bands")
                  .join(classes.select("rep", "copies"), "rep"), "representatives")
    band = reps.select("rep", F.explode("bands").alias("value"))
    full = band.groupBy("value").agg(F.min("rep").alias("low"), F.count("*").alias("c")).filter("c > 1").drop("c")
    near = components(band.join(full, "value").select(F.col("rep").alias("a"), F.col("low").alias("b")))

    part = near.select(F.col("node").alias("rep"), F.col("root").alias("part")).join(reps, "rep")
    part = stored(part, "candidates")
    size = (part.groupBy("part").agg(F.count("*").alias("docs"), F.sum("grams").alias("all_grams"))
            .select("part", F.greatest(F.ceil(F.col("docs") / block_docs), F.ceil(F.col("all_grams") / block_grams)).cast("int").alias("blocks")))
    dealt = part.join(size, "part").withColumn("block", F.pmod(F.xxhash64("rep", F.lit(3)), F.col("blocks")).cast("int"))

    def sets(batches):
        for b in batches:
            keep = [c for c in b.schema.names if c != "text"]
            at = 0
            for piece in in_slices(b.column("text"), 2_000_000):
                got = pa.array([s.astype("<u8").tobytes() for s in gram_hashes(piece, n)], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(c).slice(at, len(piece)) for c in keep] + [got], names=[*keep, "grams"])
                at += len(piece)
        release_memory()

    held = docs.select(F.col("uid"), "text").join(dealt.select(F.col("rep").alias("uid"), "part", "block", "blocks", "copies", "bands"), "uid")
    held = held.mapInArrow(sets, "uid long, part long, block int, blocks int, copies long, bands array<long>, grams binary")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    units = (held.select("*", other.alias("other"))
             .select("part", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"),
                     "block", "uid", "copies", "bands", "grams"))
    found = stored(verify(units, frac.numerator, frac.denominator, parts), "links")

    links = found.groupBy("uid").agg(F.sum("links").alias("links"))
    group = components(found.select(F.col("uid").alias("a"), F.col("low").alias("b")))
    cls = (classes.join(links.withColumnRenamed("uid", "rep"), "rep", "left")
           .join(group.withColumnRenamed("node", "rep"), "rep", "left")
           .withColumn("root", F.coalesce("root", "rep")))
    # rep is the least uid of its class, root the least rep of the group: that row is kept
    named = cls.groupBy("root").agg(F.min("copy_of").alias("class_id"))
    cls = (cls.join(named, "root")
           .select("digest", "copy_of", "class_id", F.col("root").alias("kept"),
                   (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    return (sig.select("uid", "doc_id", "digest").join(cls, "digest", "left")
            .select("uid", "doc_id", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("copy_of")).alias("copy_of"),
                    F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
                    F.coalesce(F.col("kept") == F.col("uid"), F.lit(True)).alias("keeper")))


def numbered(docs: DataFrame, uid: str = "uid") -> DataFrame:
    """``docs`` with a stored, distinct number per row (a written table: reading it again gives the same numbers)."""
    spark = docs.sparkSession
    path = scratch_path(spark, "numbered")
    docs.withColumn(uid, F.monotonically_increasing_id()).write.parquet(path)
    return spark.read.parquet(path)


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    d = numbered(id_text(docs, id_col, text_col))
    return jaccard_links(d, **kw)


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """``docs`` without all but one document of each group; columns unchanged."""
    uid = free_name(docs, "uid")
    d = numbered(docs, uid)
    report = jaccard_links(d.select(F.col(uid).alias("uid"), F.col(own_name(docs, id_col)).cast("long").alias("doc_id"),
                                    F.col(own_name(docs, text_col)).cast("string").alias("text")), **kw)
    path = scratch_path(docs.sparkSession, "dropped")
    report.filter(~F.col("keeper")).select(F.col("uid").alias(uid)).write.parquet(path)
    dropped = docs.sparkSession.read.parquet(path)
    return d.join(dropped, uid, "left_anti").select(*docs.columns)
