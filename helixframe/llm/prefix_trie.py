"""Prefix trie of conversations by range minima over sorted neighbours (operator 12).

A conversation is the sequence of its turns' keys (16 bytes of the SHA-256 of role and text), so its
path is a binary value whose byte order keeps everything that shares a prefix together. Paths are sorted once, by
(path, conversation), into blocks; equal paths are told apart by the conversation, so a third of all
conversations may be copies of one and still spread over blocks.

Inside a block a sparse table of range minima over the longest common prefixes (LCPs) of neighbours answers
"how far does this prefix reach" for every candidate prefix (row, depth) on its own: one binary search to the left and one to the
right give its member interval. Nothing depends on another candidate, there is no stack. Counts are
differences of running sums over the interval, the smallest member is a second sparse table's minimum.

A prefix that touches its block's first or last row may go on in the next one. These pieces (at most two per depth and
block) are searched the same way one level up: a sparse table over blocks, each with its smallest inner LCP and its LCP with
the block before, gives the first and last block of the prefix; pieces with the same first block are one node.

Only three numbers a block reach the driver. A block holds about ``block_turns`` turns; turns without their texts are what is
shuffled. One conversation's turns must fit a task (about 300 bytes a turn).

Defined results: rows without a conversation id belong to none and are left out; turns are ordered by turn
(null first), equal turns by their key; null role or text is empty; repeated rows are turns of their own; no
conversations give no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.llm.common import release_memory
from helixframe.session import scratch_path

KEY = 16                       # bytes of a turn's key


class RangeMinima:
    """Sparse table: minima of all runs whose length is a power of two."""

    def __init__(self, values: np.ndarray):
        self.rows = [np.asarray(values)]
        while 2 << len(self.rows) - 1 <= len(values):
            last, half = self.rows[-1], 1 << len(self.rows) - 1
            self.rows.append(np.minimum(last[: len(last) - half], last[half:]))

    def minimum(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minimum over lo..hi (both inclusive, lo <= hi)."""
        k = np.frexp((hi - lo + 1).astype(np.float64))[1] - 1
        out = np.empty(len(lo), self.rows[0].dtype)
        for j in np.unique(k):
            own = k == j
            out[own] = np.minimum(self.rows[j][lo[own]], self.rows[j][hi[own] + 1 - (1 << j)])
        return out

    def left(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Smallest l such that the values at l+1..at are all ``least`` or more: the search halves its step."""
        out = at.copy()
        for j in range(len(self.rows) - 1, -1, -1):
            to = out - (1 << j)
            ok = to >= 0
            ok[ok] = self.rows[j][to[ok] + 1] >= least[ok]
            out = np.where(ok, to, out)
        return out

    def right(self, at: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Largest r such that the values at at+1..r are all ``least`` or more."""
        out = at.copy()
        for j in range(len(self.rows) - 1, -1, -1):
            ok = out + 1 < len(self.rows[j])
            ok[ok] = self.rows[j][out[ok] + 1] >= least[ok]
            out = np.where(ok, out + (1 << j), out)
        return out


def common_turns(a: bytes, b: bytes) -> int:
    """Turns that two paths share at their start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // KEY
    x, y = np.frombuffer(a, np.uint8, n), np.frombuffer(b, np.uint8, n)
    return int(np.argmax(x != y)) // KEY


# ---------------------------------------------------------------- turns to paths

def turn_keys(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, turn, key (of role and text), bytes (of the text) of every turn of a conversation."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    told_apart = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return (turns.filter(F.col(conv_col).isNotNull())
            .select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"),
                    F.substring(F.unhex(F.sha2(told_apart, 256)), 1, KEY).alias("key"), F.octet_length(text).cast("long").alias("bytes")))


def paths(keys: DataFrame, parts: int, base: Column | None = None, borrowed: Callable[[int], int] = lambda c: 0) -> DataFrame:
    """conv_id, path (the turns' keys in order), sizes (the turns' bytes as 64-bit numbers) of every conversation.

    With ``base`` (a column over conv_id; a base's base is itself) a conversation c takes the first ``borrowed(c)`` turns of its
    base conversation, if that exists, and its own turns after as many. One shuffle by the base; rows of a conversation stream
    through a task, which holds the turns of one.
    """
    base = F.col("conv_id") if base is None else base
    near = (keys.withColumn("base", base).withColumn("own", F.col("conv_id") != F.col("base")).repartition(parts, "base")
            .sortWithinPartitions("base", "own", "conv_id", F.col("turn").asc_nulls_first(), "key").select("base", "conv_id", "key", "bytes"))

    def run(batches):
        head: tuple[int, bytes, bytes] | None = None          # the base conversation met last
        now: tuple[int, int] | None = None
        keys_, sizes, out = [], [], []

        def close():
            nonlocal head
            group, conv = now
            path, size = b"".join(keys_), b"".join(sizes)
            if conv == group:
                head = (conv, path, size)
            n = borrowed(conv)
            if n:
                first = head if head is not None and head[0] == group else (group, b"", b"")
                path = first[1][: n * KEY] + path[n * KEY:]
                size = first[2][: n * 8] + size[n * 8:]
            out.append((conv, path, size))

        def batch():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(), pa.binary(), pa.binary()), strict=True)],
                                              names=["conv_id", "path", "sizes"])

        for b in batches:
            if not b.num_rows:
                continue
            group, conv = (b.column(c).to_numpy(zero_copy_only=False) for c in ("base", "conv_id"))
            flat = b"".join(b.column("key").to_pylist())
            size = b.column("bytes").to_numpy(zero_copy_only=False).astype("<i8").tobytes()
            edge = np.r_[0, np.flatnonzero(conv[1:] != conv[:-1]) + 1, len(conv)].tolist()
            for lo, hi in zip(edge[:-1], edge[1:], strict=True):
                here = (int(group[lo]), int(conv[lo]))
                if here != now:
                    if now is not None:
                        close()
                    now, keys_, sizes = here, [], []
                keys_.append(flat[lo * KEY: hi * KEY])
                sizes.append(size[lo * 8: hi * 8])
            if len(out) >= 1000:
                yield batch()
                out.clear()
        if now is not None:
            close()
        if out:
            yield batch()

    return near.mapInArrow(run, "conv_id long, path binary, sizes binary")


def borrowed_head(conv: int) -> int:
    """How many turns a conversation takes from its base: unsigned crc32 of its decimal id, modulo 9."""
    return zlib.crc32(str(conv).encode()) % 9


# ---------------------------------------------------------------- one block

NODE = [("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()), ("n_children", pa.int64()),
        ("n_leaves", pa.int64()), ("saved", pa.int64()), ("ends_sha256", pa.string())]
#: parent_side: the piece that a node's parent is, if that is one (then parent_conv_id is not final).
#: For pieces: side (first, last or both rows of the block), size of the last turn's text, decimal ids that end here.
PIECE = [("parent_side", pa.string()), ("side", pa.string()), ("bytes", pa.int64()), ("ends", pa.binary())]
#: For one row a block: its rows' smallest inner LCP, first and last path.
BLOCK = [("inner", pa.int64()), ("first_path", pa.binary()), ("last_path", pa.binary())]
SCHEMA = pa.schema([("kind", pa.string()), ("block", pa.int64()), *NODE, *PIECE, *BLOCK])
DDL = ("kind string, block long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved long, "
       "ends_sha256 string, parent_side string, side string, bytes long, ends binary, inner long, first_path binary, last_path binary")
FAR = 1 << 40
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _table(kind: str, block: int, n: int, **cols) -> pa.RecordBatch:
    whole = {"kind": pa.array([kind] * n), "block": pa.array(np.full(n, block))} | cols
    return pa.RecordBatch.from_arrays([pa.array(whole[f.name], f.type) if f.name in whole else pa.nulls(n, f.type) for f in SCHEMA], schema=SCHEMA)


def block_nodes(block: int, convs: np.ndarray, path: list[bytes], sizes: list[bytes]):
    """Batches of a block's whole nodes, its pieces and its one summary row; rows are in order of (path, conversation)."""
    n = len(convs)
    length = np.array([len(p) // KEY for p in path], np.int64)
    lcp = np.array([-1] + [common_turns(a, b) for a, b in zip(path, path[1:])], np.int64)
    yield _table("block", block, 1, inner=[int(lcp[1:].min()) if n > 1 else FAR], first_path=[path[0]], last_path=[path[-1]])
    minima = RangeMinima(lcp)
    low_conv = RangeMinima(convs)
    # candidates: every prefix that the row before does not have, shortest first within a row
    count = length - lcp
    at = np.repeat(np.arange(n), count)
    depth = np.arange(len(at)) - np.repeat(np.cumsum(count) - count, count) + lcp[at] + 1
    lo, hi = minima.left(at, depth), minima.right(at, depth)
    size = np.concatenate([np.concatenate([[0], np.frombuffer(s, "<i8")])[lcp[i] + 1:] for i, s in enumerate(sizes)])
    members = hi - lo + 1
    weight = (members - 1) * size
    first, last = lo == 0, hi == n - 1
    piece = first | last
    # what a whole node is worth to the nodes around it: running sums over candidates, which lie in row order
    own = np.where(piece, 0, weight)
    total = np.concatenate([[0], np.cumsum(own)])
    start = np.concatenate([[0], np.cumsum(count)])
    saved = total[start[hi + 1]] - total[np.arange(len(at))]         # its deeper prefixes, and the rows after it
    # rows that end a branch: the last copy of a path that the next row does not go on with (unknown yet for the last row)
    ends_branch = np.r_[lcp[1:] < length[:-1], False]
    leaves = np.concatenate([[0], np.cumsum(ends_branch)])
    n_leaves = leaves[hi + 1] - leaves[lo]
    # parent: the prefix one turn shorter, whose left end is searched for
    above = depth > 0
    up = minima.left(at[above], depth[above] - 1)
    parent = np.full(len(at), -1)
    parent[above] = start[up] + depth[above] - 1 - (lcp[up] + 1)
    whole_child = above & ~piece
    n_children = np.bincount(parent[whole_child], minlength=len(at))
    conv = low_conv.minimum(lo, hi)
    # members that end at the prefix: they are the first rows of its interval
    ends_at = np.flatnonzero(length[at] == depth)
    ended = np.zeros(len(at), np.int64)
    same = np.r_[False, (lcp[1:] == length[1:]) & (lcp[1:] == length[:-1])]
    copies = np.diff(np.r_[np.flatnonzero(~same), n])
    run_of = np.cumsum(~same) - 1
    ended[ends_at] = copies[run_of[at[ends_at]]]
    side = np.where(first & last, "both", np.where(first, "first", "last")).astype(object)
    side[~piece] = None
    parent_side = np.full(len(at), None, object)
    parent_side[above] = side[parent[above]]
    parent_conv = np.where(above, conv[np.maximum(parent, 0)], 0)
    texts = list(map(str, convs.tolist()))
    for kind, pick in (("node", np.flatnonzero(~piece)), ("piece", np.flatnonzero(piece))):
        if not len(pick):
            continue
        said = [",".join(texts[i: i + k]) if k else "" for i, k in zip(at[pick].tolist(), ended[pick].tolist(), strict=True)]
        known = above[pick]
        cols = dict(conv_id=conv[pick], depth=depth[pick], parent_conv_id=pa.array(parent_conv[pick], mask=~known), n_convs=members[pick],
                    n_children=n_children[pick], n_leaves=n_leaves[pick], saved=saved[pick], parent_side=parent_side[pick].tolist())
        if kind == "node":
            cols["ends_sha256"] = [hashlib.sha256(s.encode()).hexdigest() if s else NO_ENDS for s in said]
        else:
            cols |= {"side": side[pick].tolist(), "bytes": size[pick], "ends": [s.encode() if s else None for s in said]}
        yield _table(kind, block, len(pick), **cols)


def sorted_blocks(stored: DataFrame, blocks: int) -> DataFrame:
    """Rows of ``block_nodes`` for all blocks of the sorted paths (conv_id, path, sizes: a written table)."""
    def run(batches):
        convs, path, sizes = [], [], []
        for b in batches:
            convs += b.column("conv_id").to_pylist()
            path += b.column("path").to_pylist()
            sizes += b.column("sizes").to_pylist()
        if convs:
            yield from block_nodes(TaskContext.get().partitionId(), np.array(convs, np.int64), path, sizes)
        del convs, path, sizes
        release_memory()

    return (stored.repartitionByRange(blocks, "path", "conv_id").sortWithinPartitions("path", "conv_id")
            .select("conv_id", "path", "sizes").mapInArrow(run, DDL))


# ---------------------------------------------------------------- across blocks

class Borders:
    """First and last block of prefixes that touch their block's edges. Blocks are numbered without gaps."""

    def __init__(self, number: np.ndarray, border: np.ndarray, inner: np.ndarray, last: np.ndarray):
        """``border[i]``: LCP of block i's first path with the block before (-1 for the first); ``inner[i]``: its smallest
        inner LCP; ``last[i]``: turns of its last path."""
        self.number = number
        self.ends_branch = np.append(border[1:], -1)[: len(last)] < last      # nothing goes on with the last path
        # a run of values border[1], inner[1], border[2], ...: value 2i is crossed on the way into block i, 2i+1 through it
        self.minima = RangeMinima(np.column_stack([border, inner]).reshape(-1))

    def first_block(self, block: np.ndarray, depth: np.ndarray, touches: np.ndarray) -> np.ndarray:
        """The block in which the prefix begins, if it touches its block's first row (else its own)."""
        left = self.minima.left(2 * block, depth)
        return np.where(touches, left // 2, block)

    def last_block(self, block: np.ndarray, depth: np.ndarray, touches: np.ndarray) -> np.ndarray:
        right = self.minima.right(2 * block + 1, depth)
        return np.where(touches, right // 2, block)


def prefix_trie(sequences: DataFrame, block_turns: int = 100_000) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node;
    ``sequences``: conv_id, path, sizes as ``paths`` gives them."""
    spark = sequences.sparkSession
    folder = scratch_path(spark, "trie")
    sequences.write.parquet(f"{folder}/paths")
    stored = spark.read.parquet(f"{folder}/paths")
    turns = stored.agg(F.sum(F.octet_length("path") / KEY + 1)).first()[0] or 0
    sorted_blocks(stored, max(1, -(-int(turns) // block_turns))).write.partitionBy("kind").parquet(f"{folder}/blocks")
    made = spark.read.schema(DDL).parquet(f"{folder}/blocks")
    return whole_nodes(made, folder)


def whole_nodes(made: DataFrame, folder: str) -> DataFrame:
    """All nodes from the blocks' rows: whole ones as they are, pieces joined."""
    spark = made.sparkSession
    heads = made.filter("kind = 'block'")
    facts = {r["block"]: r for r in heads.select("block", "inner", (F.octet_length("last_path") / KEY).cast("long").alias("last")).collect()}
    number = np.array(sorted(facts), np.int64)                                                # three numbers a block
    follow = spark.createDataFrame([(int(a), int(b)) for a, b in zip(number, number[1:])], "block long, next long")

    @F.arrow_udf("long")
    def lcp(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([common_turns(x, y) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.int64())

    border = {r["next"]: r["n"] for r in                                                      # two numbers a block
              heads.select("block", "last_path").join(follow, "block")
              .join(heads.select(F.col("block").alias("next"), "first_path"), "next")
              .select("next", lcp("last_path", "first_path").alias("n")).collect()}
    column = lambda f: np.array([f(b) for b in number.tolist()], np.int64)
    borders = spark.sparkContext.broadcast(Borders(number, column(lambda b: border.get(b, -1)), column(lambda b: facts[b]["inner"]),
                                                   column(lambda b: facts[b]["last"])))
    pieces = made.filter("kind = 'piece'")

    def place(batches):
        t = borders.value
        for b in batches:
            block = np.searchsorted(t.number, b.column("block").to_numpy())
            depth = b.column("depth").to_numpy()
            side = np.array(b.column("side").to_pylist(), object)
            lo = t.first_block(block, depth, side != "last")
            hi = t.last_block(block, depth, side != "first")
            # a node is told by its first block, its depth, and whether it reaches that block's last row there
            tail = (side != "first") | (lo < block)
            leaf = (side != "first") & t.ends_branch[block]
            cols = dict(zip(b.schema.names, b.columns, strict=True)) | {"at": pa.array(block), "lo": pa.array(lo), "hi": pa.array(hi), "tail": pa.array(tail)}
            cols["n_leaves"] = pa.array(b.column("n_leaves").to_numpy() + leaf)
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    fields = "at long, lo long, hi long, tail boolean"
    cols = pieces.select("block", "depth", "side", "conv_id", "n_convs", "n_children", "n_leaves", "saved", "bytes", "ends", "parent_side")
    cols.mapInArrow(place, "block long, depth long, side string, conv_id long, n_convs long, n_children long, n_leaves long, saved long, "
                           f"bytes long, ends binary, parent_side string, {fields}").write.parquet(f"{folder}/pieces")
    placed = spark.read.parquet(f"{folder}/pieces")
    key = ["lo", "tail", "depth"]
    sums = (placed.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("n_children"),
                                     F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"), F.max("bytes").alias("bytes"),
                                     F.max("hi").alias("hi"),
                                     F.max(F.when(F.col("at") == F.col("hi"), F.col("side") != "first")).alias("fills_last"),
                                     F.max(F.when(F.col("at") == F.col("lo"), F.col("side") == "both")).alias("spans"),
                                     F.max(F.when(F.col("at") == F.col("lo"), F.col("parent_side"))).alias("parent_side"))
            .withColumn("weight", (F.col("n_convs") - 1) * F.col("bytes")))
    sums.write.parquet(f"{folder}/joined")
    joined = spark.read.parquet(f"{folder}/joined")
    ends = _joined_ends(placed.filter("ends is not null").select(*key, "at", "ends"), key)
    # the parent of a joined node is a piece of the node's first block, one turn shorter
    named = (placed.select(*key, F.col("block"), F.col("at"), F.col("side"))
             .join(joined.select(*key, "conv_id", F.col("lo").alias("p_lo"), F.col("tail").alias("p_tail")), key))
    parents = named.select(F.col("at").alias("lo"), (F.col("depth") + 1).alias("depth"), F.col("side").alias("parent_side"),
                           F.col("conv_id").alias("parent_conv_id"), "p_lo", "p_tail")
    linked = joined.join(parents, ["lo", "depth", "parent_side"], "left")
    kids = (linked.filter("p_lo is not null").groupBy(F.col("p_lo").alias("lo"), F.col("p_tail").alias("tail"), (F.col("depth") - 1).alias("depth"))
            .agg(F.count("*").alias("joined_kids")))
    linked = linked.join(kids, key, "left").join(ends, key, "left")
    whole = _with_saved(linked, joined, len(number)).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", (F.col("n_children") + F.coalesce("joined_kids", F.lit(0))).alias("n_children"), "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
    nodes = made.filter("kind = 'node'")
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256"]
    inside = nodes.filter("parent_side is null").select(*out)
    under = (nodes.filter("parent_side is not null").drop("parent_conv_id")
             .join(named.select("block", F.col("side").alias("parent_side"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id")),
                   ["block", "parent_side", "depth"]).select(*out))
    return whole.unionByName(inside).unionByName(under)


def _joined_ends(said: DataFrame, key: list[str]) -> DataFrame:
    """ends_sha256 of the pieces' decimal ids, in block order: a stream, one piece held at a time."""
    def run(batches):
        now, h, out = None, None, []
        for b in batches:
            for *k, text in zip(*(b.column(c).to_pylist() for c in (*key, "ends")), strict=True):
                if k != now:
                    if now is not None:
                        out.append((*now, h.hexdigest()))
                    now, h = k, hashlib.sha256()
                else:
                    h.update(b",")
                h.update(text)
        if now is not None:
            out.append((*now, h.hexdigest()))
        for i in range(0, len(out), 1000):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out[i: i + 1000], strict=True)], names=[*key, "ends_sha256"])

    return (said.repartition(*key).sortWithinPartitions(*key, "at").select(*key, "ends")
            .mapInArrow(run, "lo long, tail boolean, depth long, ends_sha256 string"))


def _with_saved(linked: DataFrame, joined: DataFrame, blocks: int) -> DataFrame:
    """``saved`` with the weights of the joined nodes in the subtree added.

    These begin in the node's first block, deeper and on the same edge, or in a later block up to its last one. Sums
    by block (two numbers a block) are shipped; sums over deeper nodes of an edge are a window of one edge of one block.
    """
    spark = linked.sparkSession
    per = joined.groupBy("lo", "tail").agg(F.sum(F.col("weight").cast("decimal(38,0)")).alias("w")).collect()
    edge = {True: np.zeros(blocks + 1, np.int64), False: np.zeros(blocks + 1, np.int64)}
    for r in per:
        edge[r["tail"]][r["lo"]] = int(r["w"])
    both = np.concatenate([[0], np.cumsum(edge[True] + edge[False])])
    shared = spark.sparkContext.broadcast((edge, both))

    @F.arrow_udf("long")
    def later(lo: pa.Array, hi: pa.Array, tail: pa.Array, fills: pa.Array, spans: pa.Array) -> pa.Array:
        edge, both = shared.value
        lo, hi = (x.to_numpy(zero_copy_only=False) for x in (lo, hi))
        tail, fills, spans = (x.to_numpy(zero_copy_only=False).astype(bool) for x in (tail, fills, spans))
        more = hi > lo
        out = np.where(more, both[hi] - both[np.minimum(lo + 1, hi)] + edge[False][hi] + np.where(fills, edge[True][hi], 0), 0)
        # a node that fills its first block from its first row has that block's other edge inside as well
        return pa.array(out + np.where(tail & spans, edge[False][lo], 0))

    deeper = F.sum("weight").over(Window.partitionBy("lo", "tail").orderBy(F.col("depth").desc()))
    flag = lambda c: F.coalesce(F.col(c), F.lit(False))
    return linked.withColumn("saved", F.col("saved") + deeper + later("lo", "hi", "tail", flag("fills_last"), flag("spans")))
