"""Helpers the operators share: projections, folds, Arrow row mapping, bounded label samples."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words as runs of bytes other than space and \t..\r; ``bytes.split()`` splits at exactly these.
ASCII_SPACE = b" \t\n\r\x0b\x0c"


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names, so that other columns of the
    input (whatever their names) are neither scanned nor able to clash."""
    # by the frame's own spelling: an alias that differs from it in case alone would be dropped as redundant
    return df.select(F.col(own_name(df, id_col)).cast("long").alias("doc_id"), F.col(own_name(df, text_col)).cast("string").alias("text"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or that with underscores added until no column has it in any letter case (Spark's names ignore case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def own_name(df: DataFrame, name: str) -> str:
    """The column's name as the frame writes it; Arrow batches are asked by that."""
    return name if name in df.columns else next((c for c in df.columns if c.lower() == name.lower()), name)


def fold(id_col: str, k: int) -> Column:
    """crc32 of the id's text, modulo ``k`` (null id: null)."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(k)


def release_memory() -> None:
    """Give freed memory back to the system: worker processes live on into later stages."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):                # another C library
        pass


def map_arrow(df: DataFrame, new: dict[str, str], make: Callable[[], Callable[[pa.RecordBatch], dict]],
              keep: list[str] | None = None) -> DataFrame:
    """Append columns computed from each Arrow batch.

    ``new`` maps added column names to DDL types; ``make`` runs once per task and returns the
    batch function; if that has a ``done`` attribute it is called when the task ends, to free what a
    shared model keeps (worker processes live on into later stages). Kept columns of the same name as a
    new one, in any letter case, are replaced.
    """
    taken = {c.lower() for c in new}
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
    schema = T.StructType([df.schema[c] for c in keep])
    for name, ddl in new.items():
        schema = schema.add(T.StructType.fromDDL(f"`{name}` {ddl}")[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        try:
            for b in batches:
                if b.num_rows == 0:
                    continue
                out = f(b)
                cols = [b.column(b.schema.get_field_index(c)) for c in keep] + [_arrow(out[c]) for c in new]
                yield pa.RecordBatch.from_arrays(cols, names=[*keep, *new])
        finally:
            getattr(f, "done", lambda: None)()
            release_memory()

    return df.mapInArrow(run, schema)


def _arrow(x):
    return x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x)


def texts(b: pa.RecordBatch, col: str = "text") -> list[str]:
    """The batch's texts; null counts as empty."""
    return [t or "" for t in b.column(b.schema.get_field_index(col)).to_pylist()]


def label_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, per_class: int,
                 max_chars: int = 200_000) -> list[tuple[str, int]]:
    """A bounded sample of labelled training texts, fetched to the driver.

    At most ``per_class`` rows of each label value (0 and 1), taken in the order of a hash of the
    id, among training rows (``train``, a column over ``doc_id``) whose text has at most
    ``max_chars`` characters: the driver holds at most 2 * per_class * max_chars characters. The
    bound concerns this sample alone; scoring reads every row. An id labelled twice with the
    same value counts once; ids with both values are left out, as are null ids and labels.
    """
    picked = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
              .filter(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & train)
              .groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("y2"))
              .filter(F.col("y") == F.col("y2")).select("doc_id", "y"))
    h = F.xxhash64(F.col("doc_id"), F.lit(11))
    top = (picked.filter("y = 0").orderBy(h, "doc_id").limit(per_class)
           .union(picked.filter("y = 1").orderBy(h, "doc_id").limit(per_class)))
    # at most 2 * per_class rows of 12 bytes
    rows = (id_text(docs).filter(F.length("text") <= max_chars)
            .join(F.broadcast(top), "doc_id").select("doc_id", "text", "y").collect())
    seen: dict[int, tuple[str, int]] = {}
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["text"])):
        seen.setdefault(r["doc_id"], (r["text"], r["y"]))
    return [seen[k] for k in sorted(seen)]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def fit_logistic(X: np.ndarray, y: np.ndarray, l2: float = 1e-2, steps: int = 60,
                 weight: np.ndarray | None = None) -> np.ndarray:
    """Weights (last one the bias) of an L2 logistic regression by damped Newton steps."""
    n = len(y)
    A = np.hstack([X, np.ones((n, 1))])
    s = np.ones(n) if weight is None else weight
    w = np.zeros(A.shape[1])
    R = np.full(A.shape[1], l2)
    R[-1] = 1e-6
    for _ in range(steps):
        p = sigmoid(A @ w)
        g = A.T @ (s * (p - y)) / n + R * w
        H = (A.T * (s * p * (1 - p) + 1e-9)) @ A / n + np.diag(R)
        d = np.linalg.solve(H, g)
        d *= min(1.0, 10.0 / max(1e-12, np.abs(d).max()))
        w = w - d
        if np.abs(d).max() < 1e-7:
            break
    return w


class Words:
    """White-space words of a slice of texts, as codes into their distinct strings."""

    def __init__(self, arr: pa.Array, lower: bool = False):
        arr = pc.fill_null(arr, "")
        lists = pc.ascii_split_whitespace(pc.ascii_trim_whitespace(pc.utf8_lower(arr) if lower else arr))
        coded = pc.dictionary_encode(lists.flatten())
        self.names: list[str] = coded.dictionary.to_pylist()
        codes = coded.indices.to_numpy(zero_copy_only=False)
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        if "" in self.names:                       # a text without words comes as one empty word
            gone = codes == self.names.index("")
            counts -= np.bincount(np.repeat(np.arange(len(counts)), counts)[gone], minlength=len(counts))
            codes = codes[~gone]
        self.codes, self.counts = codes, counts
        self.ends = np.cumsum(counts)
        self.starts = self.ends - counts

    def owner(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def per_text(self, ufunc, values: np.ndarray, empty: float = 0.0) -> np.ndarray:
        """``ufunc`` (add, maximum) of the words' values, rows of a 1- or 2-d array, per text."""
        out = np.full((len(self.counts), *values.shape[1:]), empty, values.dtype)
        some = self.counts > 0
        if some.any():
            out[some] = ufunc.reduceat(values, self.starts[some], axis=0)
        return out
