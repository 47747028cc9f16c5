"""Size factors, normalised counts, base means and the variance-stabilising transform.

D1, D2, D12 and the moment part of D3, all as Catalyst aggregates over the
long count table (no Python worker).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixframe.operators.reshape import with_sample_array



def size_factors(counts: DataFrame, n_samples: int, gene: str = "gene_id", sample: str = "sample_id",
                 value: str = "count", exact: bool = True) -> DataFrame:
    """Median-of-ratios size factor per sample: (sample_id, size_factor).

    Reference genes are those with a positive count in every sample. For a
    gene, ``r_ij = ln y_ij - mean_j ln y_ij``; ``s_j = exp(median_i r_ij)``.
    The per-gene geometric mean is one aggregate keyed by gene; the median
    is exact and distributed (range-partitioned ranks, see
    ``operators.stats``), so no task holds a whole sample's gene list;
    ``exact=False`` uses ``percentile_approx`` instead.
    Raises when no gene is positive in every sample.
    """
    pos = counts.where(F.col(value) > 0).select(gene, sample, F.ln(F.col(value).cast("double")).alias("lv"))
    lgm = (pos.groupBy(gene).agg(F.count(F.lit(1)).alias("n"), F.avg("lv").alias("lgm"))
           .where(F.col("n") == n_samples).select(gene, "lgm"))
    ratios = pos.join(lgm, gene).select(sample, (F.col("lv") - F.col("lgm")).alias("r"))
    if exact:
        from helixframe.operators.stats import exact_median
        med = exact_median(ratios, "r", sample)
        return med.select(sample, F.exp("r").alias("size_factor"))
    return ratios.groupBy(sample).agg(F.exp(F.percentile_approx("r", 0.5, 100_000)).alias("size_factor"))


def vector_size_factors(gene_vec: DataFrame, n_samples: int) -> DataFrame:
    """D1 on gene arrays: (sample_idx, size_factor), as :func:`size_factors` of the long table they were made from. A gene's
    ratios come from its own array, so the only shuffle is that of the medians."""
    from helixframe.operators.stats import exact_median
    pos = gene_vec.where(F.array_min("y") > 0).select(F.transform("y", lambda v: F.ln(v)).alias("__l"))
    lgm = F.aggregate("__l", F.lit(0.0), lambda a, x: a + x) / F.lit(float(n_samples))
    ratios = pos.withColumn("__g", lgm).select("__g", F.posexplode("__l").alias("sample_idx", "lv")).select("sample_idx", (F.col("lv") - F.col("__g")).alias("r"))
    return exact_median(ratios, "r", "sample_idx").select("sample_idx", F.exp("r").alias("size_factor"))


def normalized_counts(counts: DataFrame, sf: DataFrame, sample: str = "sample_id",
                      value: str = "count") -> DataFrame:
    """Long normalised counts ``y / s`` (null for a sample without a size factor). The planner broadcasts the
    per-sample table when its size allows."""
    s = sf.select(F.col(sample).alias("__s"), "size_factor")
    return (counts.join(s, counts[sample] == s["__s"], "left")
            .select(*[c for c in counts.columns if c != value],
                    F.col(value), (F.col(value) / F.col("size_factor")).alias("norm")))


def base_mean(counts: DataFrame, sf: DataFrame, n_samples: int, gene: str = "gene_id",
              sample: str = "sample_id", value: str = "count") -> DataFrame:
    """baseMean = mean over all samples of normalised counts.

    Absent cells are zeros, so a sum over the sparse table divided by the
    sample count is exact without densifying.
    """
    nc = normalized_counts(counts, sf, sample, value)
    return nc.groupBy(gene).agg((F.sum("norm") / F.lit(float(n_samples))).alias("base_mean"))


def group_means(counts: DataFrame, sf: DataFrame, samples: DataFrame, factor: str,
                gene: str = "gene_id", sample: str = "sample_id", value: str = "count") -> DataFrame:
    """Mean normalised count per (gene, level); absent cells count as zero."""
    sizes = samples.groupBy(factor).agg(F.count(F.lit(1)).alias("n_level"))
    lv = samples.select(F.col(sample).alias("__s2"), factor)
    nc = normalized_counts(counts, sf, sample, value)
    g = (nc.join(lv, nc[sample] == lv["__s2"]).groupBy(gene, factor).agg(F.sum("norm").alias("sum_norm")))
    return g.join(sizes, factor).select(gene, factor, (F.col("sum_norm") / F.col("n_level")).alias("mean_norm"))


def dispersion_moments(gene_vec: DataFrame, sf_array: list[float]) -> DataFrame:
    """D3 start value: ``max((var - mean * avg(1/s)) / mean^2, 1e-8)`` per gene
    on normalised counts (sample variance, m - 1)."""
    m = len(sf_array)
    inv_mean = sum(1.0 / s for s in sf_array) / m
    gene_vec = with_sample_array(gene_vec, "__sf", sf_array)
    q = F.zip_with("y", "__sf", lambda y, s: y / s)
    mean = F.aggregate(q, F.lit(0.0), lambda a, x: a + x) / F.lit(float(m))
    return (gene_vec.withColumn("__q", q).withColumn("__mu", mean)
            .withColumn("__var", F.aggregate("__q", F.lit(0.0), lambda a, x: a + (x - F.col("__mu")) * (x - F.col("__mu")))
                        / F.lit(float(m - 1)))
            .select("gene_id", F.col("__mu").alias("mean_norm"), F.col("__var").alias("var_norm"),
                    F.when(F.col("__mu") > 0,
                           F.greatest((F.col("__var") - F.col("__mu") * F.lit(inv_mean)) / (F.col("__mu") * F.col("__mu")),
                                      F.lit(1e-8))).alias("disp_moment")))


def vst_value(q, a0: float, a1: float):
    """D12 for one normalised count q under the parametric trend a1/mu + a0."""
    q = F.col(q) if isinstance(q, str) else q
    return F.log2((F.lit(1.0 + a1) + F.lit(2.0 * a0) * q
                   + F.lit(2.0) * F.sqrt(F.lit(a0) * q * (F.lit(1.0 + a1) + F.lit(a0) * q))) / F.lit(4.0 * a0))


def vst(gene_vec: DataFrame, sf_array: list[float], a0: float, a1: float) -> DataFrame:
    """Variance-stabilised values, long form (gene_id, sample_idx, vst).

    Works on the dense gene arrays so zero cells get their transformed
    value too; the output is one row per gene x sample by definition.
    """
    gene_vec = with_sample_array(gene_vec, "__sf", sf_array)
    v = F.zip_with("y", "__sf", lambda y, s: vst_value(y / s, a0, a1))
    return gene_vec.select("gene_id", F.posexplode(v).alias("sample_idx", "vst"))
