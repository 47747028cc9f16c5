"""Registered source / sink queries: delimited files written from the study tables and read back."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from helixframe.functions import text as T
from helixframe.operators import reshape as R
from helixframe.plans import adapters as A
from helixframe.plans.oracle import cte
from helixframe.session import scratch_path
from helixframe.sources import tabular as TB

Q: dict = {}


def register(name, sql=None):
    def deco(fn):
        Q[name] = (fn, sql)
        return fn
    return deco


def _write_lines(df, path: str) -> None:
    """Write one text column as ordered lines of one file (small metadata tables only)."""
    df.orderBy("__o").select("line").coalesce(1).write.text(path)


@register("read_counts_long", cte("counts_long") + """
SELECT g.gene_id, s.sample_id, coalesce(c.count, 0) AS count
FROM (SELECT DISTINCT gene_id FROM counts_long) g
JOIN (SELECT DISTINCT sample_id FROM counts_long) s ON TRUE
LEFT JOIN counts_long c ON c.gene_id = g.gene_id AND c.sample_id = s.sample_id""")
def q_read_counts_long(spark, d):
    """The count matrix written as a wide CSV (gene id first, one column per sample),
    read back with a declared schema and unpivoted to long form (zeros included)."""
    cells = A.study_cells(spark, d)
    c = A.counts_long(spark, d, cells)
    levels = sorted(r[0] for r in c.select("sample_id").distinct().collect())
    path = scratch_path(spark, "counts_csv")
    R.to_wide(c, levels).write.option("header", "true").csv(path)
    return TB.read_counts(spark, path, sep=",", n_partitions=8)


@register("read_tsv_comments", cte("study_metadata") + """
SELECT external_id, sample_attributes, experiment_title || ' #1' AS experiment_title FROM study_metadata""")
def q_read_tsv_comments(spark, d):
    """Study metadata as TSV with '#' comment lines and a mid-line '#', read back.
    Whole comment lines are dropped; the '#' inside a value is kept."""
    m = A.study_metadata(spark, d)
    head = spark.createDataFrame([(0, "#comment: study metadata export"), (1, "external_id\tsample_attributes\texperiment_title"),
                                  (2, "# another comment")], "__o int, line string")
    body = m.select(F.lit(3).alias("__o"),
                    F.concat_ws("\t", "external_id", "sample_attributes",
                                F.concat(F.col("experiment_title"), F.lit(" #1"))).alias("line"))
    path = scratch_path(spark, "meta_tsv")
    # header first: comment lines may sit anywhere, the header must be the first data line
    lines = head.where("__o = 1").unionByName(head.where("__o <> 1").withColumn("__o", F.lit(2))).unionByName(body)
    _write_lines(lines, path)
    return TB.read_tsv(spark, path, comment="#")


@register("read_samples", cte("samples") + """
SELECT sample_id, patient, condition FROM samples""")
def q_read_samples(spark, d):
    """S3: the sample sheet written as CSV keyed by its first column, read back with a uniqueness check."""
    s = A.samples(spark, d).select(F.col("sample_id").alias("run"), "patient", "condition")
    path = scratch_path(spark, "samples_csv")
    s.coalesce(1).write.option("header", "true").csv(path)
    return TB.read_samples(spark, path).select("sample_id", "patient", "condition")


@register("sample_profile", cte("study_metadata") + """
SELECT * FROM (
  SELECT 'external_id' AS "column", count(external_id) AS non_null FROM study_metadata
  UNION ALL SELECT 'sample_attributes', count(sample_attributes) FROM study_metadata
  UNION ALL SELECT 'experiment_title', count(experiment_title) FROM study_metadata
  UNION ALL SELECT 'region', count(region) FROM study_metadata)""")
def q_sample_profile(spark, d):
    """A10: non-null count per metadata column."""
    return R.profile(A.study_metadata(spark, d))
