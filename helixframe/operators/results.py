"""Operators over a DE-result table and gene annotation.

Result table columns: contrast, gene_id, base_mean, log2_fold_change,
lfc_se, stat, pvalue, padj, symbol. Every ranking breaks ties by
``gene_id`` (pandas keeps the earlier row; Spark has no row order).
Missing values are NULL (NaN is turned into NULL on read, see
:func:`nan_to_null`): Spark orders NaN above every number, so a NaN LFC
would otherwise count as up-regulated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from helixframe.functions import text as T
from helixframe.session import cut_lineage
from helixframe.sources import versioned

LFC_THRESHOLD = 1.0
ALPHA = 0.05


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating column (ingest rule)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (Ty.DoubleType, Ty.FloatType)):
            cols.append(F.when(F.isnan(f.name), F.lit(None).cast(f.dataType)).otherwise(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


# ------------------------------------------------------------- J3 / W5 / J4

def first_per_key(hits: DataFrame, key: str = "gene_id", order: str = "hit_ord") -> DataFrame:
    """Keep the first row per key by an explicit order column."""
    w = Window.partitionBy(key).orderBy(F.col(order).asc())
    return hits.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def annotate(df: DataFrame, symbols: DataFrame, id_col: str = "gene_id",
             sym_key: str = "gene_id", sym_col: str = "symbol") -> DataFrame:
    """Left-join symbols on the version-stripped id; the original id is kept.

    Every versioned form of one gene gets that gene's symbol; unmapped or
    absent ids get NULL. The symbol table must be unique per key (see
    :func:`first_per_key`).
    """
    s = symbols.select(F.col(sym_key).alias("__k"), F.col(sym_col).alias("symbol"))
    base = df.drop("symbol") if "symbol" in df.columns else df
    return base.join(s, T.strip_version(F.col(id_col)) == F.col("__k"), "left").drop("__k")


def cache_misses(requested: DataFrame, cache: DataFrame, key: str, cache_key: str | None = None) -> DataFrame:
    """Distinct requested keys the cache does not hold (anti-join)."""
    ck = cache_key or key
    return requested.select(key).distinct().join(
        cache.select(F.col(ck).alias(key)), key, "left_anti")


def merge_cache(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keyed merge, the new side wins; NULL-valued rows are kept
    (a negative cache entry stops asking for that id again)."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


SYMBOL_SCHEMA = "gene_id string, symbol string"


def load_symbols(spark, path: str) -> DataFrame:
    """The stored symbol cache (gene_id, symbol; a null symbol is a known miss); empty if never saved."""
    return versioned.load(spark, path, SYMBOL_SCHEMA)


def update_symbols(spark, path: str, requested: DataFrame, look_up) -> DataFrame:
    """Answer ``requested`` (gene_id) through the stored cache: only ids it lacks go to ``look_up`` (a one-column
    frame in, gene_id and symbol out); ids without an answer are stored as known misses."""
    cache = load_symbols(spark, path)
    missing = cut_lineage(cache_misses(requested, cache, "gene_id"))
    if missing.limit(1).count():
        answers = missing.join(look_up(missing).select("gene_id", "symbol"), "gene_id", "left")
        versioned.save(merge_cache(cache, first_per_key(answers, order="symbol"), "gene_id"), path)
        cache = load_symbols(spark, path)
    return cache.join(requested.select("gene_id").distinct(), "gene_id", "left_semi")


# ------------------------------------------------------------- P8 / P9 / P10

def neg_log10(col) -> Column:
    """-log10(p); p == 0 gives +inf (Spark's log of 0 is NULL)."""
    c = F.col(col) if isinstance(col, str) else col
    # 0 - log10(p), not -log10(p): p = 1 gives +0.0 rather than -0.0
    return F.when(c == 0, F.lit(float("inf"))).otherwise(F.lit(0.0) - F.log10(c))


def volcano_category(lfc="log2_fold_change", padj="padj", lfc_thr: float = LFC_THRESHOLD,
                     alpha: float = ALPHA) -> Column:
    """P9: 'up' / 'down' / 'ns', both comparisons strict; NULL LFC is 'ns'."""
    l, p = F.col(lfc), F.col(padj)
    sig = p < alpha
    return (F.when(sig & (l > lfc_thr), F.lit("up"))
            .when(sig & (l < -lfc_thr), F.lit("down")).otherwise(F.lit("ns")))


def volcano_points(df: DataFrame, lfc_thr: float = LFC_THRESHOLD, alpha: float = ALPHA) -> DataFrame:
    """P8 + P9: rows with a padj, their -log10(padj) and category."""
    return (df.where(F.col("padj").isNotNull())
            .withColumn("neg_log10_padj", neg_log10("padj"))
            .withColumn("category", volcano_category(lfc_thr=lfc_thr, alpha=alpha)))


def gene_labels(df: DataFrame) -> DataFrame:
    """P10: plot label = symbol, else the last 15 characters of the id."""
    return df.withColumn("label", T.gene_label("symbol", "gene_id"))


# ------------------------------------------------------------- F3 / F4 / F5 / F7 / F8

def significant(df: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """padj < alpha (NULL is not significant)."""
    return df.where(F.col("padj") < alpha)


def sig_mapped(df: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """significant and mapped to a symbol."""
    return significant(df, alpha).where(F.col("symbol").isNotNull())


def de_lists(df: DataFrame, lfc_thr: float = LFC_THRESHOLD, alpha: float = ALPHA) -> DataFrame:
    """up and down gene lists in one pass: (contrast, direction, gene_id, symbol)."""
    cat = volcano_category(lfc_thr=lfc_thr, alpha=alpha)
    return (df.where(F.col("symbol").isNotNull()).withColumn("direction", cat)
            .where(F.col("direction") != "ns").select("contrast", "direction", "gene_id", "symbol"))


def by_category(points: DataFrame, category: str) -> DataFrame:
    """subset of one category / level."""
    return points.where(F.col("category") == category)


def drop_markers(df: DataFrame, markers: DataFrame, col: str = "symbol") -> DataFrame:
    """F8: drop genes whose symbol is on a marker list (anti-join)."""
    return df.join(markers.select(F.col(col)).distinct(), col, "left_anti")


# ------------------------------------------------------------- A5 / A6 / A9

def significant_counts(df: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """A5: significant genes per contrast."""
    return df.groupBy("contrast").agg(F.count_if(F.col("padj") < alpha).alias("n_significant"))


def mapping_rate(df: DataFrame) -> DataFrame:
    """Mapped count, total and percent per contrast."""
    return df.groupBy("contrast").agg(
        F.count("symbol").alias("n_mapped"), F.count(F.lit(1)).alias("n_total"),
        (F.lit(100.0) * F.count("symbol") / F.count(F.lit(1))).alias("pct_mapped"))


def category_sizes(points: DataFrame, group: str = "category") -> DataFrame:
    """Rows per (contrast, category)."""
    return points.groupBy("contrast", group).agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------- W1-W4, U1, U2

def top_by_padj(df: DataFrame, n: int = 20, by: str = "contrast") -> DataFrame:
    """N smallest padj per contrast, missing padj last, ties by gene_id.

    ``row_number() <= n`` plans a WindowGroupLimit, so each partition keeps
    at most n rows per contrast before the shuffle: a contrast holding most
    of the rows cannot overload one task.
    """
    w = Window.partitionBy(by).orderBy(F.col("padj").asc_nulls_last(), F.col("gene_id"))
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def top_up_down(df: DataFrame, n: int = 20, alpha: float = ALPHA, require_symbol: bool = False,
                by: str = "contrast") -> DataFrame:
    """W2 + U2: n largest and n smallest LFC among significant rows, concatenated
    (a gene can appear in both halves when there are fewer than 2n rows)."""
    s = sig_mapped(df, alpha) if require_symbol else significant(df, alpha)
    s = s.where(F.col("log2_fold_change").isNotNull())
    up = s.withColumn("rank", F.row_number().over(
        Window.partitionBy(by).orderBy(F.col("log2_fold_change").desc(), F.col("gene_id")))) \
        .where(F.col("rank") <= n).withColumn("direction", F.lit("up"))
    down = s.withColumn("rank", F.row_number().over(
        Window.partitionBy(by).orderBy(F.col("log2_fold_change").asc(), F.col("gene_id")))) \
        .where(F.col("rank") <= n).withColumn("direction", F.lit("down"))
    return up.unionByName(down)


def heatmap_genes(df: DataFrame, n: int = 20) -> DataFrame:
    """N mapped genes with the smallest padj per contrast."""
    return top_by_padj(df.where(F.col("symbol").isNotNull()), n)


def sig_overlap(df: DataFrame, a: str, b: str, alpha: float = ALPHA) -> DataFrame:
    """Genes significant in both contrasts, only in a, only in b: (gene_id, part)."""
    sa = significant(df.where(F.col("contrast") == a), alpha).select("gene_id")
    sb = significant(df.where(F.col("contrast") == b), alpha).select("gene_id")
    both = sa.intersect(sb).withColumn("part", F.lit("both"))
    only_a = sa.subtract(sb).withColumn("part", F.lit("lost"))
    only_b = sb.subtract(sa).withColumn("part", F.lit("gained"))
    return both.unionByName(only_a).unionByName(only_b)


def compare_models(df: DataFrame, a: str, b: str, alpha: float = ALPHA) -> DataFrame:
    """Significant counts of two models, difference, % change, overlap, gained, lost.

    One full-outer join on gene of the two significance flags, one aggregate.
    """
    fa = df.where(F.col("contrast") == a).select("gene_id", (F.col("padj") < alpha).alias("sa"))
    fb = df.where(F.col("contrast") == b).select("gene_id", (F.col("padj") < alpha).alias("sb"))
    j = fa.join(fb, "gene_id", "full_outer").select(
        F.coalesce("sa", F.lit(False)).alias("sa"), F.coalesce("sb", F.lit(False)).alias("sb"))
    g = j.agg(F.count_if("sa").alias("n_a"), F.count_if("sb").alias("n_b"),
              F.count_if(F.col("sa") & F.col("sb")).alias("overlap"),
              F.count_if(~F.col("sa") & F.col("sb")).alias("gained"),
              F.count_if(F.col("sa") & ~F.col("sb")).alias("lost"))
    return g.select("n_a", "n_b", (F.col("n_b") - F.col("n_a")).alias("diff"),
                    (F.lit(100.0) * F.try_divide(F.col("n_b") - F.col("n_a"), F.col("n_a"))).alias("pct_change"),
                    "overlap", "gained", "lost")


# ------------------------------------------------------------- D10

def ranged(df: DataFrame, keys: list[str], n_parts: int | None = None) -> DataFrame:
    """``df`` dealt into ranges of ``keys`` and stored with its range number ``__part``.

    Stored, because every plan that reads the ranges must see the same ones: a range exchange that is
    planned twice samples its borders twice. Equal keys share a range; number order is key order.
    """
    n = n_parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return cut_lineage(df.repartitionByRange(n, *[F.col(k) for k in keys]).withColumn("__part", F.spark_partition_id()))


def bh_adjust(df: DataFrame, p: str = "pvalue", by: str | list[str] | None = "contrast", out: str = "padj_bh",
              n_parts: int | None = None) -> DataFrame:
    """Benjamini-Hochberg adjusted p per group; NULL p stays NULL.

    ``padj_i = min(1, min_{j >= i} p_(j) * m / j)`` over p sorted ascending; ties share a value.
    Rows are first counted by distinct p (so ties of any number are one row), then
    dealt into ranges of (group, p); one-row-per-range summaries give each range its rank
    offset and the least value of the ranges after it. No task holds a whole group.
    """
    keys = [by] if isinstance(by, str) else list(by or [])
    counted = df.where(F.col(p).isNotNull()).groupBy(*keys, F.col(p).alias("__p")).agg(F.count(F.lit(1)).alias("__c"))
    d = ranged(counted, [*keys, "__p"], n_parts)
    # one row per range and group that meets it
    sizes = d.groupBy("__part", *keys).agg(F.sum("__c").alias("__n"))
    over = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    up = over.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("__off", F.coalesce(F.sum("__n").over(up), F.lit(0))).withColumn("__m", F.sum("__n").over(over))
    local = Window.partitionBy("__part", *keys)
    same = [F.col(f"d.{k}").eqNullSafe(F.col(f"s.{k}")) for k in ["__part", *keys]]
    on = same[0]
    for c in same[1:]:
        on = on & c
    q = (d.alias("d").join(sizes.alias("s"), on).select("d.*", "s.__off", "s.__m")
         .withColumn("__r", F.col("__off") + F.sum("__c").over(local.orderBy("__p").rowsBetween(Window.unboundedPreceding, 0)))
         .withColumn("__q", F.col("__p") * F.col("__m") / F.col("__r")))
    least = q.groupBy("__part", *keys).agg(F.min("__q").alias("__least"))
    down = over.orderBy(F.col("__part").desc()).rowsBetween(Window.unboundedPreceding, -1)
    least = least.withColumn("__after", F.min("__least").over(down)).drop("__least")
    adj = (q.alias("d").join(least.alias("s"), on).select("d.*", "s.__after")
           .withColumn(out, F.least(F.lit(1.0), F.min("__q").over(local.orderBy(F.col("__p").desc())
                                                                  .rowsBetween(Window.unboundedPreceding, 0)), F.coalesce("__after", F.lit(1.0)))))
    adj = adj.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__p", out)
    on = df[p] == adj["__p"]
    for i, k in enumerate(keys):
        on = on & df[k].eqNullSafe(adj[f"__k{i}"])
    return df.join(adj, on, "left").select(*[df[c] for c in df.columns], adj[out])


def bh_adjust_ranged(df: DataFrame, p: str = "pvalue", out: str = "padj_bh", n_parts: int = 64) -> DataFrame:
    """D10 for one list of p-values: :func:`bh_adjust` without a group."""
    return bh_adjust(df, p, None, out, n_parts)
