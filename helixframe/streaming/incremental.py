"""ST1: incremental corpus ingest with Structured Streaming.

New citation XML (one article string per row, in Parquet drops) lands in a folder; a file-source stream picks up
only files it has not seen (its checkpoint remembers them), and each
micro-batch runs the batch operators through ``foreachBatch``:

    parse (S5) -> keep the first row of every pmid (keyed state of the stream)
    -> drop pmids already in the collection (J4, anti-join)
    -> embed (V1) -> upsert (S10, new version + pointer swap)

An article that is sent again, however late, finds its pmid in the state
and is neither embedded nor looked up; the anti-join covers rows that
came into the collection on other ways. Rows that are no records keep
their file and row as key and go to a side table by batch.

``trigger(availableNow=True)`` processes everything present and stops,
so the same code serves scheduled catch-up runs and continuous runs.
Replaying a batch after a failure changes nothing: its pmids are in the
collection already, and its rejects replace the folder of that batch id.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.functions import text as T
from helixframe.operators import vectors as V
from helixframe.sources import collection as COL
from helixframe.session import cut_lineage
from helixframe.sources import xml_corpus as X


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def corpus_stream(spark: SparkSession, drop_dir: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming rows (xml, reason, record) from Parquet drops holding one citation XML string per row, the first of every
    pmid and all rejects.

    Each row is parsed with ``from_xml`` under the declared article schema
    (the same path as the batch job), so a drop may hold any number of
    articles and files split freely across tasks. The state holds one key per pmid.
    """
    raw = (spark.readStream.format("parquet").schema("xml string")
           .option("maxFilesPerTrigger", max_files_per_trigger)
           .option("recursiveFileLookup", "true").load(drop_dir))
    place = F.concat_ws(":", F.lit("row"), "_metadata.file_path", F.col("_metadata.row_index").cast("string"))
    parsed = X.parse_articles(raw.select("xml", place.alias("place")), "xml")
    key = F.when(F.col("reason").isNull(), F.concat(F.lit("pmid:"), "record.pmid")).otherwise(F.col("place"))
    return parsed.withColumn("key", key).dropDuplicates(["key"]).select("xml", "reason", "record")


def upsert_batch(spark: SparkSession, root: str, name: str, text_builder=T.text_base, rejects: str | None = None):
    """foreachBatch body on rows of :func:`corpus_stream`: only unseen pmids are embedded and upserted; the rows that are no
    records are written to ``rejects``/batch_id=N."""
    def run(batch: DataFrame, batch_id: int) -> None:
        parsed = cut_lineage(batch)      # the stream's rows are parsed and matched with its state once
        if rejects:
            X.rejected(parsed).write.mode("overwrite").parquet(os.path.join(rejects, f"batch_id={batch_id}"))
        batch = X.records(parsed).dropDuplicates(["pmid"])
        seen = COL.live_ids(spark, root, name, batch, "pmid")   # only the buckets this batch touches
        fresh = batch.join(seen.select(F.col("id").alias("pmid")), "pmid", "left_anti")
        meta = F.struct(F.col("year"), F.col("journal"), F.lit(None).cast("string").alias("gene")).alias("metadata")
        rows = fresh.select(F.col("pmid").alias("id"), text_builder().alias("document"), text_builder().alias("__text"), meta)
        # embedded once; the merge reads the written rows
        COL.upsert(spark, root, name, cut_lineage(V.embed_hashed(rows, "__text", "id")))
    return run


def ingest_increment(spark: SparkSession, drop_dir: str, root: str, name: str, checkpoint: str,
                     text_builder=T.text_base, rejects: str | None = None) -> DataFrame:
    """Run the stream over everything available, then return the live collection."""
    if spark.conf.get(STATE_STORE, None) is None:
        spark.conf.set(STATE_STORE, ROCKSDB)     # keys on disk, not on the heap
    q = (corpus_stream(spark, drop_dir).writeStream
         .foreachBatch(upsert_batch(spark, root, name, text_builder, rejects))
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return COL.open_collection(spark, root, name)
