"""Benchmark decontamination by MinHash containment search (operator 2, DataFrame functions only).

Texts become words (lower-cased runs of letters and digits) and sets of 5-word shingles. An item
is found in a document if the document holds at least ``threshold`` of the item's shingles.

Items are short and documents long, so the Jaccard similarity of the two says nothing; the sketch is taken
from the item alone: the ``k`` shingles of an item with the smallest hash are its MinHash
minima, an even sample of its set, and a document that holds one of them is a candidate. Items are
partitioned by size (powers of two); k is set per partition as the number of shingles that an
item of that size may lack, and one more, so that a document at or above the threshold must hold
one: no true pair is missed. Documents are partitioned by size too: an item is only looked for in
partitions whose documents are large enough to hold its share. Candidates are then verified on
the full shingle sets, as text.

Documents stream past the sketch; only matches are shuffled. The sketch is broadcast if its counted rows
stay within ``broadcast_rows`` (16 bytes each), otherwise both sides are shuffled by shingle.

Defined results: in the report rows that share an id are one document (one item), null ids included for
documents; the filter judges each row by its own text. Items with a null id, null texts and texts of
fewer than 5 words have no shingles and are never reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.llm.common import free_name
from helixframe.llm.jaccard_join import numbered
from helixframe.session import scratch_path

WORD_BREAK = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), WORD_BREAK), "")


def _windows(w: Column, n: int, f) -> Column:
    """``f`` of each run of ``n`` words; an empty array for shorter texts."""
    starts = F.when(F.size(w) >= n, F.sequence(F.lit(0), F.size(w) - n)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: f([F.get(w, i + j) for j in range(n)]))


def shingle_hashes(w: Column, n: int = 5) -> Column:
    return _windows(w, n, lambda x: F.xxhash64(*x))


def shingle_texts(w: Column, n: int = 5) -> Column:
    return _windows(w, n, lambda x: F.concat_ws(" ", *x))


def item_sketch(items: DataFrame, threshold: float) -> DataFrame:
    """h, item_id, need: the MinHash minima of every item. ``items``: item_id, sh (distinct), size."""
    part = F.floor(F.log2(F.col("size").cast("double")))
    most = F.pow(F.lit(2.0), part + 1) - 1                      # largest size in the partition
    # floor with a margin against rounding: one minimum more than may be lacking
    k = F.floor(most * (1 - threshold) + 1e-6).cast("int") + 1
    order = Window.partitionBy("item_id").orderBy(F.xxhash64("sh", F.lit(7)), "sh")
    return (items.withColumn("k", k).withColumn("rank", F.row_number().over(order)).filter("rank <= k")
            .select("h", "item_id", F.ceil(F.col("size") * threshold - 1e-6).cast("int").alias("need")))


def contained_items(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, n: int = 5, doc_col: str = "doc_id",
                    text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                    broadcast_rows: int = 2_000_000) -> DataFrame:
    """doc_id, item_id, n_shared, n_item, containment of every pair at or above ``threshold``."""
    spark = docs.sparkSession
    base = scratch_path(spark, "decontaminate")

    def small(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if df.count() <= broadcast_rows else df

    item_words = benchmark.select(F.col(item_col).alias("item_id"), words(F.col(item_text_col)).alias("w")).filter("item_id is not null")
    (item_words.select("item_id", F.explode(shingle_texts(F.col("w"), n)).alias("sh")).distinct()
     # the same hash as the documents' shingles get from their words
     .withColumn("h", F.xxhash64(*[F.get(F.split("sh", " "), F.lit(i)) for i in range(n)]))
     .withColumn("size", F.count("*").over(Window.partitionBy("item_id")).cast("int")).write.parquet(f"{base}/items"))
    items = spark.read.parquet(f"{base}/items")
    item_sketch(items, threshold).write.parquet(f"{base}/sketch")
    sketch = spark.read.parquet(f"{base}/sketch")

    d = docs.select(F.col(doc_col).alias("doc_id"), F.col(text_col).alias("text"))
    # no filter on the arrays: it would be pushed below the projection that makes the words, and
    # split each text anew for every shingle
    w = d.select("doc_id", words(F.col("text")).alias("w"))
    # size partition of the document: its shingles lie below 2^(part+1)
    below = F.pow(F.lit(2.0), F.floor(F.log2((F.size("w") - n + 1).cast("double"))) + 1)
    stream = w.select("doc_id", below.alias("below"), F.explode(shingle_hashes(F.col("w"), n)).alias("h"))
    hit = stream.join(small(sketch), "h").filter(F.col("need") < F.col("below"))
    hit.select("doc_id", "item_id").distinct().write.parquet(f"{base}/candidates")
    pairs = spark.read.parquet(f"{base}/candidates")

    ids = small(pairs.select(F.col("doc_id").alias("id")).distinct())
    held = d.join(ids, F.col("doc_id").eqNullSafe(F.col("id")), "left_semi")
    held = (held.select("doc_id", words(F.col("text")).alias("w"))
            .select("doc_id", F.explode(F.array_distinct(shingle_texts(F.col("w"), n))).alias("sh")))
    shared = (held.join(small(items.select("item_id", "sh", "size")), "sh")
              .groupBy("doc_id", "item_id").agg(F.count_distinct("sh").alias("n_shared"), F.first("size").alias("n_item")))
    p = pairs.select(F.col("doc_id").alias("pd"), F.col("item_id").alias("pi"))
    return (shared.filter(F.col("n_shared") >= F.col("n_item") * threshold - 1e-6)
            .join(p, F.col("doc_id").eqNullSafe(F.col("pd")) & (F.col("item_id") == F.col("pi")), "left_semi")
            .select("doc_id", "item_id", "n_shared", F.col("n_item").cast("long").alias("n_item"),
                    (F.col("n_shared") / F.col("n_item")).alias("containment")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                      broadcast_rows: int = 2_000_000, **kw) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; columns unchanged. Every row is judged by its own
    text, whatever its id: rows are numbered and searched by their numbers."""
    spark = docs.sparkSession
    uid = free_name(docs, "uid")
    d = numbered(docs, uid)
    path = scratch_path(spark, "contaminated")
    (contained_items(d, benchmark, doc_col=uid, text_col=text_col, broadcast_rows=broadcast_rows, **kw)
     .select(F.col("doc_id").alias(uid)).distinct().write.parquet(path))
    bad = spark.read.parquet(path)
    bad = F.broadcast(bad) if bad.count() <= broadcast_rows else bad
    return d.join(bad, uid, "left_anti").select(*docs.columns)
