"""Bound-certified best-fit packing (operator 6).

Pieces are dealt at random into partitions of bounded size; each is packed by best-fit
decreasing and certified by dual-feasible-function lower bounds on its number of sequences.
Partitions whose count exceeds their bound exchange documents: they are dealt anew among fewer,
larger partitions (at most ``growth`` times as large each round) and packed again. A round's
packing of a set of rows is kept only if it uses no more sequences than the one before.

Defined results: null text is an empty text (the end id alone, one piece of length 1); repeated
rows are packed each on its own; no rows give no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.llm.common import free_name, id_text, own_name, release_memory
from helixframe.llm.tokens import default_tokenizer, encoder, in_slices
from helixframe.session import scratch_path


#: Bytes of text that are encoded at a time.
SLICE = 3_000_000


def token_pieces(docs: DataFrame, capacity: int = 4096, tokenizer: str | None = None, end_id: int = 1) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of at most ``capacity`` ids."""
    path = tokenizer or default_tokenizer()

    def run(batches):
        enc = encoder(path)
        for b in batches:
            keys, at = b.column("doc_id"), 0
            for part in in_slices(b.column("text"), SLICE):
                ids, sizes = enc.encode(part)
                ids = np.insert(ids, np.cumsum(sizes), end_id).astype("<u4")
                sizes = sizes + 1
                n = -(-sizes // capacity)
                own = np.repeat(np.arange(len(sizes)), n)
                piece = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
                start = piece * capacity
                length = np.minimum(sizes[own] - start, capacity)
                first = (np.cumsum(sizes) - sizes)[own] + start
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a: 4 * (a + k)]) for a, k in zip(first.tolist(), length.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(at, len(part)).take(pa.array(own)), pa.array(piece.astype(np.int32)), pa.array(start),
                     pa.array(length), pa.array(crc, pa.int64())], names=["doc_id", "piece", "start", "length", "ids_crc32"])
                at += len(part)
        release_memory()

    return id_text(docs).mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs: the largest of the sum bound and the bounds by two families
    of dual feasible functions (threshold and rounding), each over all its parameters.

    A function f is dual feasible if lengths that fit one sequence have f-values of at most 1
    together; then the sum of f over all lengths bounds the number of sequences from below.
    """
    h = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    x = np.arange(capacity + 1)
    best = -(-int(h @ x) // capacity)
    # threshold t: lengths over C - t count as C, those under t as 0
    ones, mass = np.concatenate([[0], np.cumsum(h)]), np.concatenate([[0], np.cumsum(h * x)])
    t = np.arange(1, capacity // 2 + 1)
    large = ones[-1] - ones[capacity - t + 1]
    middle = mass[capacity - t + 1] - mass[t]
    best = max(best, int(np.max(large - (-middle // capacity), initial=0)))
    # rounding with k: x if (k+1)x is a whole multiple of C, else floor((k+1)x / C) / k
    for k in range(1, 33):
        y = (k + 1) * x
        value = np.where(y % capacity == 0, k * x, (y // capacity) * capacity)      # times k * capacity
        best = max(best, -(-int(h @ value) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(sequence, offset) of each length and the number of sequences: longest first, each into the
    fullest sequence it fits."""
    seq, off = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    room: list[list[int]] = [[] for _ in range(capacity + 1)]    # sequences by the room left
    mask = n = 0                                                  # bit r: some sequence has room r
    for i in np.argsort(-lengths, kind="stable").tolist():
        k = int(lengths[i])
        above = mask >> k
        if above:
            r = k + (above & -above).bit_length() - 1
            s = room[r].pop()
            if not room[r]:
                mask ^= 1 << r
        else:
            r, s, n = capacity, n, n + 1
        seq[i], off[i] = s, capacity - r
        left = r - k
        if left:
            room[left].append(s)
            mask |= 1 << left
    return seq, off, n


RESULTS = ("sequence_id", "offset", "part_sequences", "part_bound")


def pack(pieces: DataFrame, capacity: int = 4096, part_rows: int = 8000, growth: int = 2, rounds: int = 3) -> DataFrame:
    """``pieces`` (any columns, ``length`` from 1 to ``capacity``) with sequence_id, offset, and
    per partition the certificate: part_sequences, part_bound.

    Only gap partitions are packed again; every round's rows are written to the shared folder, so
    a lost executor costs its tasks alone. A partition never holds more than about
    part_rows * growth^rounds rows.
    """
    spark = pieces.sparkSession
    cols = pieces.columns
    own = {x: free_name(pieces, x) for x in ("pack_uid", "pack_part")}
    uid, deal = own.values()
    # results replace columns of their names
    given = [c for c in cols if c.lower() not in RESULTS]
    size = own_name(pieces, "length")
    base = scratch_path(spark, "pack")
    # the row's number is written with it: later rounds read it, they don't number rows again
    pieces.select(*given).withColumn(uid, F.monotonically_increasing_id()).write.parquet(f"{base}/rows")
    todo = spark.read.parquet(f"{base}/rows")
    n = todo.count()
    parts = max(1, -(-n // part_rows))
    schema = todo.schema
    for name in (deal, *RESULTS):
        schema = schema.add(name, "long")
    done, tag = [], 0

    def packer(tag):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(uid, kind="stable").reset_index(drop=True)
            lengths = pdf[size].to_numpy(np.int64)
            seq, off, used = best_fit_decreasing(lengths, capacity)
            part = int(pdf[deal].iloc[0])
            pdf["sequence_id"] = ((tag << 24 | part) << 32) + seq
            pdf["offset"], pdf["part_sequences"], pdf["part_bound"] = off, used, lower_bound(lengths, capacity)
            return pdf[schema.names]
        return run

    frame, path = todo, None
    for r in range(rounds + 1):
        dealt = frame.withColumn(deal, F.pmod(F.xxhash64(uid, F.lit(r)), F.lit(parts)))
        path = f"{base}/round{r}"
        dealt.groupBy(deal).applyInPandas(packer(r), schema).write.parquet(path)
        out = spark.read.parquet(path)
        # one row per partition, summed in Spark: sequences now, and of which the ones with a gap
        head = (out.groupBy(deal).agg(F.first("part_sequences").alias("s"), F.first("part_bound").alias("b"))
                .agg(F.sum("s").alias("used"), F.sum(F.when(F.col("s") > F.col("b"), 1)).alias("gaps"),
                     F.sum(F.when(F.col("s") > F.col("b"), F.col("s"))).alias("gap_used")).first())
        used, gaps, gap_used = head["used"] or 0, head["gaps"] or 0, head["gap_used"] or 0
        if r and used >= before:            # no gain: the packing before stays
            done.append(previous)
            break
        gap = F.col("part_sequences") > F.col("part_bound")
        if gaps <= 1 or r == rounds:      # a single partition has nobody to exchange with
            done.append(out)
            break
        done.append(out.filter(~gap))
        previous, before = out.filter(gap), gap_used
        frame = previous.select(*todo.columns)
        parts = max(1, -(-gaps // growth))
    result = done[0]
    for d in done[1:]:
        result = result.unionByName(d)
    return result.select(*given, *RESULTS)


def pack_documents(docs: DataFrame, capacity: int = 4096, tokenizer: str | None = None) -> DataFrame:
    return pack(token_pieces(docs, capacity, tokenizer), capacity)
