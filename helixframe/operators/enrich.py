"""Gene-set over-representation (D15, J10) and term comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions.mathx import log_choose
from helixframe.operators.results import bh_adjust



def ora(gene_lists: DataFrame, gene_sets: DataFrame, background: DataFrame,
        list_key: str = "direction", gene: str = "symbol", within: str | None = None) -> DataFrame:
    """D15 + J10: hypergeometric upper tail per (list, term), BH over terms per list.

    gene_lists: (list_key, gene); gene_sets: (term, gene); background: (gene). ``within`` names a column of lists
    and background (a contrast): each of its values is analysed against its own background, all in one job.
    Lists and sets are first restricted to the background. With N the
    background size, K the set size, n the list size and k the overlap:
    ``p = sum_{i=k..min(K,n)} C(K,i) C(N-K,n-i) / C(N,n)`` (:func:`upper_tail`). Only terms sharing at least one gene
    with the list are reported (and adjusted), as enrichment services do; an empty list gives no row.
    Output: within (if given), list_key, term, overlap, set_size, list_size, pvalue, padj.
    """
    group = F.col(within) if within else F.lit(0)
    bg = background.select(group.alias("w"), F.col(gene).alias("g")).distinct()
    lists = gene_lists.select(group.alias("w"), F.col(list_key).alias("lk"), F.col(gene).alias("g")).distinct() \
        .join(bg, ["w", "g"], "left_semi")
    sets = gene_sets.select("term", F.col(gene).alias("g")).distinct().join(bg, "g").select("w", "term", "g")
    n = lists.groupBy("w", "lk").agg(F.count(F.lit(1)).alias("n"))
    K = sets.groupBy("w", "term").agg(F.count(F.lit(1)).alias("kk"))  # Spark names are case-insensitive
    N = bg.groupBy("w").agg(F.count(F.lit(1)).alias("nn"))
    k = lists.join(sets, ["w", "g"]).groupBy("w", "lk", "term").agg(F.count(F.lit(1)).alias("k"))
    # (list, term) pairs with at least one shared gene; a pair without overlap has p = 1
    pairs = k.join(n, ["w", "lk"]).join(K, ["w", "term"]).join(N, "w")
    keys = ([F.col("w").alias(within)] if within else []) + [F.col("lk").alias(list_key)]
    tail = upper_tail(pairs, "k", "kk", "n", "nn", "p").select(
        *keys, "term", F.col("k").alias("overlap"), F.col("kk").alias("set_size"), F.col("n").alias("list_size"),
        F.col("p").alias("pvalue"))
    return bh_adjust(tail, "pvalue", [within, list_key] if within else list_key, "padj")


def upper_tail(df: DataFrame, k: str, K: str, n: str, N: str, out: str) -> DataFrame:
    """``df`` with P(X >= k) of a hypergeometric X (K marked of N, n drawn) in ``out``; integer columns,
    max(0, n + K - N) <= k <= min(K, n).

    One probability is taken from log-gammas, at the mode or at k if k lies beyond it, where it is the largest of
    the tail; the others follow by the ratio of neighbours, upwards and down to k, inside one ``aggregate`` each
    that stops adding once a term is below 1e-18 of the sum (all further ones are smaller still). No row is
    made per term, and a tail whose first term would underflow still sums to its value.
    """
    ck, cK, cn, cN = (F.col(c).cast("bigint") for c in (k, K, n, N))
    top, at, first, up = (F.col(f"__t_{c}") for c in ("top", "at", "first", "up"))
    d = df.withColumn("__t_top", F.least(cK, cn))
    mode = F.floor((cn + 1).cast("double") * (cK + 1) / (cN + 2)).cast("bigint")
    d = d.withColumn("__t_at", F.greatest(ck, F.least(top, mode)))
    d = d.withColumn("__t_first", F.exp(log_choose(cK, at) + log_choose(cN - cK, cn - at) - log_choose(cN, cn)))
    none = F.array().cast("array<bigint>")

    def walk(steps, total, ratio):
        start = F.struct(first.alias("t"), total.alias("s"))

        def add(acc, i):
            t = acc["t"] * ratio(i.cast("double"))
            return F.when(acc["t"] < acc["s"] * F.lit(1e-18), acc).otherwise(F.struct(t.alias("t"), (acc["s"] + t).alias("s")))
        return F.aggregate(steps, start, add, lambda acc: acc["s"])

    d = d.withColumn("__t_up", walk(F.when(at < top, F.sequence(at + 1, top)).otherwise(none), first,
                                    lambda i: (cK - i + 1) * (cn - i + 1) / (i * (cN - cK - cn + i))))
    down = walk(F.when(ck < at, F.sequence(at, ck + 1, F.lit(-1).cast("bigint"))).otherwise(none), up,
                lambda i: i * (cN - cK - cn + i) / ((cK - i + 1) * (cn - i + 1)))
    return d.withColumn(out, F.least(F.lit(1.0), down)).select(*df.columns, out)


def top_terms(res: DataFrame, n: int = 10, by: str | list[str] = "direction") -> DataFrame:
    """N terms with the smallest adjusted p per list (ties by term)."""
    w = Window.partitionBy(by).orderBy(F.col("padj").asc_nulls_last(), F.col("term"))
    return res.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def compare_terms(a: DataFrame, b: DataFrame, alpha: float = 0.05, by: str = "direction") -> DataFrame:
    """Terms significant in exactly one of two enrichment results: (by, term, only_in)."""
    sa = a.where(F.col("padj") < alpha).select(by, "term", F.lit(True).alias("in_a"))
    sb = b.where(F.col("padj") < alpha).select(by, "term", F.lit(True).alias("in_b"))
    j = sa.join(sb, [by, "term"], "full_outer")
    return j.where(F.col("in_a").isNull() | F.col("in_b").isNull()).select(
        by, "term", F.when(F.col("in_a").isNotNull(), F.lit("a")).otherwise(F.lit("b")).alias("only_in"))
