"""Named vector collections as hash-bucketed, versioned Parquet.

Layout under ``<root>/<name>/``::

    v=<n>/bucket=<b>/part-*.parquet   rows of bucket b written by version n
    manifest-<n>.txt                  bucket count, and per bucket the path that holds it

Rows are assigned to ``bucket = pmod(xxhash64(id), n_buckets)``. An upsert
touches only the buckets its ids hash to: for those it anti-joins the old
bucket rows against the new ids, unions the new rows and writes them under
``v=<n+1>``; untouched buckets keep pointing at their older files. Manifests are only ever
added: one is written under another name and renamed when whole, and the live version
is the highest there is. A job that dies at any point leaves the version before it live. Reading never
creates anything. The bucket count follows the first batch's size, and the collection is dealt anew when its rows
outgrow it.

Rows: id, document, embedding, metadata struct<year, journal, gene>.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from helixframe.session import cut_lineage
from helixframe.sources.versioned import add_text, highest, hadoop_path, read_text

COLLECTION_SCHEMA = ("id string, document string, embedding array<double>, "
                     "metadata struct<year:int, journal:string, gene:string>")
BROADCAST_HITS = 100_000   # hits (ids and distances) sent to every task; more are joined by a shuffle
BUCKET_ROWS = 50_000   # rows per bucket to start with; four times as many before the rows are dealt anew


def bucket_of(id_col, n_buckets: int):
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.pmod(F.xxhash64(c), F.lit(n_buckets)).cast("int")


def _manifest(spark: SparkSession, base: str) -> tuple[int, dict[int, str]]:
    """(live version, bucket -> path); version -1 and no buckets for a name never written. The bucket count is entry -1."""
    v = highest(spark, base)
    text = read_text(spark, os.path.join(base, f"manifest-{v}.txt")) if v >= 0 else None
    m = {}
    for line in (text or "").splitlines():
        if line.strip():
            b, path = line.split("\t", 1)
            m[int(b)] = path
    return v, m


def _paths(m: dict) -> list[str]:
    return sorted({p for b, p in m.items() if b >= 0})


def open_collection(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The live rows of a collection; a name never written has none (and reading does not create it)."""
    _, m = _manifest(spark, os.path.join(root, name))
    if not _paths(m):
        return spark.createDataFrame([], COLLECTION_SCHEMA)
    return spark.read.schema(COLLECTION_SCHEMA).parquet(*_paths(m))


def upsert(spark: SparkSession, root: str, name: str, rows: DataFrame, order_col: str | None = None,
           n_buckets: int | None = None) -> DataFrame:
    """Insert-or-replace by id, rewriting only the touched buckets; returns the live rows.

    Within the batch the last row per id wins (by ``order_col``; among equals, or without it, the greatest
    document). ``n_buckets`` sets the bucket count of a new collection.
    """
    base = os.path.join(root, name)
    v, m = _manifest(spark, base)
    order = ([F.col(order_col).desc()] if order_col else []) + [F.col("document").desc(), F.xxhash64("embedding", "metadata")]
    rows = rows.withColumn("__rn", F.row_number().over(Window.partitionBy("id").orderBy(*order))).where("__rn = 1")
    # the batch is used three times: written once
    new = cut_lineage(rows.select("id", "document", F.col("embedding").cast("array<double>").alias("embedding"), "metadata"))
    added = new.count()
    if not added:
        return open_collection(spark, root, name)
    live = spark.read.parquet(*_paths(m)).count() if _paths(m) else 0       # from file footers
    count = int(m.get(-1, 0))
    wanted = max(1, -(-(live + added) // BUCKET_ROWS))
    anew = not count or (live + added) > 4 * BUCKET_ROWS * count
    if anew:
        count = n_buckets if n_buckets and not count else wanted
    new = new.withColumn("bucket", bucket_of("id", count))
    touched = None if anew else sorted(r[0] for r in new.select("bucket").distinct().collect())  # at most one per bucket
    old_paths = _paths(m) if anew else sorted({m[b] for b in touched if b in m})
    out = new
    if old_paths:
        old = spark.read.schema(COLLECTION_SCHEMA).parquet(*old_paths).withColumn("bucket", bucket_of("id", count))
        if not anew:
            old = old.where(F.col("bucket").isin(touched))
        out = old.join(new.select("id"), "id", "left_anti").unionByName(new)
    # a folder of its own: one that a dead job left behind under this version is never read
    vdir = os.path.join(base, f"v={v + 1}-{uuid.uuid4().hex[:8]}")
    # no repartition by bucket: one hot bucket must not become one writer task;
    # rows stay spread by id and each task writes its share of every bucket
    out.write.partitionBy("bucket").parquet(vdir)
    if anew:
        fs, p = hadoop_path(spark, vdir)
        names = [f.getPath().getName() for f in fs.listStatus(p)]
        m = {int(x.split("=")[1]): os.path.join(vdir, x) for x in names if x.startswith("bucket=")}
    else:
        m |= {b: os.path.join(vdir, f"bucket={b}") for b in touched}
    m[-1] = str(count)
    add_text(spark, os.path.join(base, f"manifest-{v + 1}.txt"), "\n".join(f"{b}\t{p}" for b, p in sorted(m.items())))
    return open_collection(spark, root, name)


def live_ids(spark: SparkSession, root: str, name: str, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Ids of ``ids`` already in the collection, reading only the buckets they hash to."""
    _, m = _manifest(spark, os.path.join(root, name))
    if not _paths(m):
        return spark.createDataFrame([], "id string")
    b = ids.select(bucket_of(id_col, int(m[-1])).alias("b")).distinct()
    paths = sorted({m[r[0]] for r in b.collect() if r[0] in m})
    if not paths:
        return spark.createDataFrame([], "id string")
    return spark.read.schema(COLLECTION_SCHEMA).parquet(*paths).select("id")


def query_text(spark: SparkSession, root: str, name: str, queries: DataFrame, k: int = 5, query_id: str = "query_id",
               text_col: str = "text", encoder=None) -> DataFrame:
    """Text queries against a stored collection: each text is embedded like the stored documents (by the hashed encoder, or by
    the ``encoder`` that the collection's vectors were made with) and answered by the exact nearest rows: query_id, rank, id,
    distance, document, metadata."""
    from helixframe.operators import vectors as V
    texts = queries.select(F.col(query_id).cast("string").alias("query_id"), F.col(text_col).alias("__text"))
    vectors = V.embed_hashed(texts, "__text", "query_id") if encoder is None else V.embed_with(texts, "__text", encoder)
    rows = open_collection(spark, root, name)
    # documents stay out of the search: the hits, k a query, fetch theirs by id, which a collection holds once
    hits = cut_lineage(V.knn_exact(rows.select("id", "embedding"), vectors, k))
    if hits.count() <= BROADCAST_HITS:
        hits = F.broadcast(hits)
    found = rows.select(F.col("id").cast("string").alias("__id"), "document", "metadata")
    return found.join(hits, F.col("__id").eqNullSafe(F.col("id"))).select("query_id", "rank", "id", "distance", "document", "metadata")
