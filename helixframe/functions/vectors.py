"""Vector column functions: V2 (L2 normalise), V3 (dot / cosine), hashed buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_DIM = 64


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_double(v) -> Column:
    return F.transform(_c(v), lambda x: x.cast("double"))


def norm2(v) -> Column:
    return F.sqrt(F.aggregate(as_double(v), F.lit(0.0), lambda a, x: a + x * x))


def l2_normalize(v) -> Column:
    """V2: v / ||v||; a zero (or NULL) vector gives NULL."""
    n = norm2(v)
    return F.when(n > 0, F.transform(as_double(v), lambda x: x / n))


def dot(a, b) -> Column:
    """V3: dot product in double; equal lengths required (zip_with pads with NULL)."""
    return F.aggregate(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y), F.lit(0.0),
                       lambda acc, x: acc + x)


def token_bucket(tok: Column, dim: int = HASH_DIM) -> Column:
    """Hash bucket of a token: first 16 bits of its md5, modulo ``dim``.

    Defined through md5 so any engine reproduces it (Spark's own hash
    functions differ from other engines').
    """
    return (F.conv(F.substring(F.md5(tok), 1, 4), 16, 10).cast("int") % F.lit(dim))
