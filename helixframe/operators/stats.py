"""Distributed exact quantiles (no group gathered into one task)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_quantiles(df: DataFrame, value: str, qs: list[float], group: str | None = None,
                    n_parts: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (same as ``percentile`` / ``quantile_cont``).

    Returns (group?, q, value). Rows are counted by distinct (group, value), so a
    value held by any number of rows is one row; these are dealt into stored ranges of (group, value), a
    one-row-per-(range, group) summary gives each range its rank offset, and only the (at
    most 2 per q) target ranks are kept. No task holds a whole group, however large it is.
    """
    from helixframe.operators.results import ranged
    g = F.col(group) if group else F.lit(0)
    counted = (df.select(g.alias("__g"), F.col(value).cast("double").alias("__v")).where(F.col("__v").isNotNull())
               .groupBy("__g", "__v").agg(F.count(F.lit(1)).alias("__c")))
    r = ranged(counted, ["__g", "__v"], n_parts)
    summ = r.groupBy("__part", "__g").agg(F.sum("__c").alias("__n"))
    wg = Window.partitionBy("__g")
    before = wg.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    summ = summ.select(F.col("__part").alias("__sp"), F.col("__g").alias("__sg"),
                       F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"), F.sum("__n").over(wg).alias("__all"))
    local = Window.partitionBy("__part", "__g").orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    # ranks [__first, __next) of the group hold this value
    loc = (r.withColumn("__run", F.sum("__c").over(local))
           .join(summ, (F.col("__part") == F.col("__sp")) & F.col("__g").eqNullSafe(F.col("__sg")))
           .withColumn("__next", F.col("__off") + F.col("__run")).withColumn("__first", F.col("__next") - F.col("__c")))
    qa = F.array(*[F.lit(float(q)) for q in qs])
    hit = (loc.withColumn("__t", F.filter(qa, lambda q: (F.ceil(q * (F.col("__all") - 1)) >= F.col("__first"))
                                          & (F.floor(q * (F.col("__all") - 1)) < F.col("__next"))))
           .select("__g", "__v", "__first", "__next", "__all", F.explode("__t").alias("q")))
    pos = F.col("q") * (F.col("__all") - 1)
    holds = lambda rank: (rank >= F.col("__first")) & (rank < F.col("__next"))
    out = (hit.withColumn("__pos", pos)
           .groupBy("__g", "q", "__pos").agg(F.max(F.when(holds(F.floor("__pos")), F.col("__v"))).alias("__lo"),
                                             F.max(F.when(holds(F.ceil("__pos")), F.col("__v"))).alias("__hi")))
    out = out.select(F.col("__g"), "q", (F.col("__lo") + (F.col("__pos") - F.floor("__pos")) * (F.col("__hi") - F.col("__lo"))).alias(value))
    return out.withColumnRenamed("__g", group) if group else out.drop("__g")


def exact_median(df: DataFrame, value: str, group: str | None = None) -> DataFrame:
    """(group?, value) medians; see :func:`exact_quantiles`."""
    return exact_quantiles(df, value, [0.5], group).drop("q")
