"""Tables kept as versions that are only ever added (the caches S7, S8; manifests of collections).

A version is a folder of its own plus a manifest naming it; the manifest is renamed into place when whole, and
the highest one is live. Reading a table while its next version is computed from it is safe, and a writer that
dies leaves the version before it live.
"""

from __future__ import annotations

import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        while True:
            line = reader.readLine()
            if line is None:
                break
            lines.append(line)
        return "\n".join(lines)
    finally:
        stream.close()


def add_text(spark: SparkSession, path: str, text: str) -> None:
    """Add a file that appears whole or not at all; an existing one is never replaced."""
    fs, tmp = hadoop_path(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, False)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    _, final = hadoop_path(spark, path)
    if fs.exists(final) or not fs.rename(tmp, final):
        raise RuntimeError(f"{path} was added by another writer")


def highest(spark: SparkSession, base: str) -> int:
    """Number of the live version; -1 if there is none."""
    fs, p = hadoop_path(spark, base)
    if not fs.exists(p):
        return -1
    found = [re.fullmatch(r"manifest-(\d+)\.txt", f.getPath().getName()) for f in fs.listStatus(p)]
    return max((int(x[1]) for x in found if x), default=-1)


def load(spark: SparkSession, base: str, schema, fmt: str = "parquet") -> DataFrame:
    """The live version of a table; no rows (of ``schema``) if it was never saved."""
    v = highest(spark, base)
    if v < 0:
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).load(read_text(spark, os.path.join(base, f"manifest-{v}.txt")).strip())


def save(df: DataFrame, base: str, fmt: str = "parquet") -> None:
    """Add ``df`` (which may read the live version) as the next version."""
    spark = df.sparkSession
    v = highest(spark, base) + 1
    folder = os.path.join(base, f"v={v}-{uuid.uuid4().hex[:8]}")
    df.write.format(fmt).save(folder)
    add_text(spark, os.path.join(base, f"manifest-{v}.txt"), folder)
