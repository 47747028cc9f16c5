"""Registered streaming query: incremental ingest must equal the one-shot result."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from helixframe.plans import adapters as A
from helixframe.plans.oracle import cte

Q: dict = {}


def register(name, sql=None):
    def deco(fn):
        Q[name] = (fn, sql)
        return fn
    return deco


@register("incremental_upsert", cte("corpus") + """
SELECT pmid AS id, md5(title || chr(10) || chr(10) || abstract) AS doc_md5, year, journal FROM corpus""")
def q_incremental_upsert(spark, d):
    """ST1: three XML drops (English documents, the rest, then a re-send of the
    2024 documents) ingested by an availableNow stream in two runs that
    restart from the same checkpoint; the final collection holds every
    pmid once."""
    from helixframe.session import scratch_path
    from helixframe.streaming.incremental import ingest_increment
    base = scratch_path(spark, "ingest")
    drops, root, ckpt = os.path.join(base, "drops"), os.path.join(base, "collections"), os.path.join(base, "ckpt")
    xml = A.corpus_xml(spark, d).join(A.corpus_records(spark, d).select(F.col("pmid").cast("bigint").alias("doc_id"), "year"),
                                      "doc_id")
    docs = xml.join(spark.read.parquet(os.path.join(d, "documents.parquet")).select("doc_id", "lang"), "doc_id")
    docs.where(F.col("lang") == "en").select("xml").write.parquet(os.path.join(drops, "d1"))
    docs.where(F.col("lang") != "en").select("xml").write.parquet(os.path.join(drops, "d2"))
    ingest_increment(spark, drops, root, "abstracts", ckpt)
    docs.where(F.col("year") == 2024).select("xml").write.parquet(os.path.join(drops, "d3"))
    live = ingest_increment(spark, drops, root, "abstracts", ckpt)
    return live.select("id", F.md5("document").alias("doc_md5"), "metadata.year", "metadata.journal")
