"""Connected components of an edge table by alternating star contraction.

Each round links every node's larger neighbours to its smallest one, first over all neighbours,
then over the smaller ones; the number of rounds grows with the logarithm of the longest path. Every
round is two aggregations and two joins over the edge table, written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.session import scratch_path


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges``: a, b (long). Returns node, root (the component's smallest node) for every node of
    an edge between different nodes."""
    spark = edges.sparkSession
    base = scratch_path(spark, "components")

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{base}/{name}")
        return spark.read.parquet(f"{base}/{name}")

    def mark(df: DataFrame):
        return df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()

    cur = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "r0")
    seen = mark(cur)
    for r in range(1, max_rounds + 1):
        both = cur.select("a", "b").union(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, both["a"] == low["u"]).filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        large = stored(large.distinct(), f"large{r}")
        low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = (large.join(low, large["a"] == low["u"]).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .union(low.select(F.col("u").alias("a"), F.col("m").alias("b"))))
        cur = stored(small.distinct(), f"r{r}")
        now = mark(cur)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return cur.select(F.col("a").alias("node"), F.col("b").alias("root")).union(cur.select("b", "b").distinct())
