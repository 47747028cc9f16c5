"""Registered queries over the DE-result table, annotation and caches."""

from __future__ import annotations

from pyspark.sql import functions as F

from helixframe.operators import results as RS
from helixframe.plans import adapters as A
from helixframe.plans.oracle import cte
from helixframe.sources import tabular as TB

Q: dict = {}


def register(name, sql=None):
    def deco(fn):
        Q[name] = (fn, sql)
        return fn
    return deco


def de_results(spark, d):
    """DE-result adapter joined to the de-duplicated symbol table (J3 + W5)."""
    return RS.annotate(A.de_results_raw(spark, d), RS.first_per_key(A.symbol_hits(spark, d)))


def _r6(c):
    return F.round(c, 6)


@register("first_mapping", cte("symbol_map") + "SELECT gene_id, symbol FROM symbol_map")
def q_first_mapping(spark, d):
    return RS.first_per_key(A.symbol_hits(spark, d)).select("gene_id", "symbol")


@register("annotate_symbols", cte("de_results") + """
SELECT contrast, gene_id, split_part(gene_id, '.', 1) AS gene_key, symbol FROM de_results""")
def q_annotate_symbols(spark, d):
    from helixframe.functions.text import strip_version
    return de_results(spark, d).select("contrast", "gene_id", strip_version("gene_id").alias("gene_key"), "symbol")


@register("cache_misses", cte("counts_long", "symbol_map") + """
SELECT DISTINCT split_part(gene_id, '.', 1) AS gene_id FROM counts_long
WHERE split_part(gene_id, '.', 1) NOT IN (SELECT gene_id FROM symbol_map WHERE size <= 25)""")
def q_cache_misses(spark, d):
    """Ids of the count table not yet in a partial symbol cache (parts of size <= 25)."""
    from helixframe.functions.text import strip_version
    req = A.counts_long(spark, d).select(strip_version("gene_id").alias("gene_id"))
    cache = RS.first_per_key(A.symbol_hits(spark, d)).where(F.col("size") <= 25)
    return RS.cache_misses(req, cache, "gene_id")


@register("symbol_cache_merge", cte("symbol_map") + """
SELECT gene_id, symbol FROM symbol_map WHERE size <= 25 AND NOT size > 20
UNION ALL
SELECT gene_id, lower(symbol) FROM symbol_map WHERE size > 20""")
def q_symbol_cache_merge(spark, d):
    """Old cache (parts of size <= 25), stored; merged with a fresh answer for sizes > 20
    (lower-cased symbols, NULL entries kept), stored as the next version and loaded back; the fresh answer wins."""
    from helixframe.session import scratch_path
    from helixframe.sources import versioned
    path = scratch_path(spark, "symbol_cache")
    m = RS.first_per_key(A.symbol_hits(spark, d))
    versioned.save(m.where(F.col("size") <= 25).select("gene_id", "symbol"), path)
    new = m.where(F.col("size") > 20).select("gene_id", F.lower("symbol").alias("symbol"))
    versioned.save(RS.merge_cache(RS.load_symbols(spark, path), new, "gene_id"), path)
    return RS.load_symbols(spark, path)


@register("volcano_points", cte("de_results") + """
SELECT contrast, gene_id,
       CASE WHEN padj = 0 THEN CAST('Infinity' AS DOUBLE) ELSE round(0.0 - log10(padj), 6) END AS neg_log10_padj,
       CASE WHEN padj < 0.05 AND log2_fold_change > 1 THEN 'up'
            WHEN padj < 0.05 AND log2_fold_change < -1 THEN 'down' ELSE 'ns' END AS category
FROM de_results WHERE padj IS NOT NULL""")
def q_volcano_points(spark, d):
    v = RS.volcano_points(de_results(spark, d))
    return v.select("contrast", "gene_id", _r6("neg_log10_padj").alias("neg_log10_padj"), "category")


@register("gene_labels", cte("de_results") + """
SELECT contrast, gene_id, coalesce(symbol, right(gene_id, 15)) AS label FROM de_results""")
def q_gene_labels(spark, d):
    return RS.gene_labels(de_results(spark, d)).select("contrast", "gene_id", "label")


@register("significant_genes", cte("de_results") + """
SELECT contrast, gene_id FROM de_results WHERE padj < 0.05""")
def q_significant_genes(spark, d):
    return RS.significant(de_results(spark, d)).select("contrast", "gene_id")


@register("de_gene_lists", cte("de_results") + """
SELECT contrast, CASE WHEN log2_fold_change > 1 THEN 'up' ELSE 'down' END AS direction, gene_id, symbol
FROM de_results WHERE symbol IS NOT NULL AND padj < 0.05 AND (log2_fold_change > 1 OR log2_fold_change < -1)""")
def q_de_gene_lists(spark, d):
    return RS.de_lists(de_results(spark, d))


_TOP_UD_SQL = """
SELECT contrast, gene_id, symbol, round(log2_fold_change, 6) AS log2_fold_change, direction, rank FROM (
  SELECT *, 'up' AS direction, CAST(row_number() OVER (PARTITION BY contrast ORDER BY log2_fold_change DESC, gene_id) AS INTEGER) AS rank
  FROM de_results WHERE padj < 0.05 AND log2_fold_change IS NOT NULL {sym}
  UNION ALL
  SELECT *, 'down', CAST(row_number() OVER (PARTITION BY contrast ORDER BY log2_fold_change ASC, gene_id) AS INTEGER)
  FROM de_results WHERE padj < 0.05 AND log2_fold_change IS NOT NULL {sym}) WHERE rank <= {n}"""


@register("top_de_genes", cte("de_results") + _TOP_UD_SQL.format(sym="AND symbol IS NOT NULL", n=5))
def q_top_de_genes(spark, d):
    """F5 + W2 + U2: 5 most up and 5 most down significant mapped genes (the retrieval gene list)."""
    t = RS.top_up_down(de_results(spark, d), 5, require_symbol=True)
    return t.select("contrast", "gene_id", "symbol", _r6("log2_fold_change").alias("log2_fold_change"),
                    "direction", "rank")


@register("top_up_down", cte("de_results") + _TOP_UD_SQL.format(sym="", n=20))
def q_top_up_down(spark, d):
    t = RS.top_up_down(de_results(spark, d), 20)
    return t.select("contrast", "gene_id", "symbol", _r6("log2_fold_change").alias("log2_fold_change"),
                    "direction", "rank")


@register("points_by_category", cte("de_results") + """
SELECT contrast, gene_id FROM de_results WHERE padj IS NOT NULL AND padj < 0.05 AND log2_fold_change > 1""")
def q_points_by_category(spark, d):
    return RS.by_category(RS.volcano_points(de_results(spark, d)), "up").select("contrast", "gene_id")


@register("drop_markers", cte("de_results") + """
SELECT contrast, gene_id, symbol FROM de_results
WHERE symbol IS NOT NULL AND symbol NOT IN (SELECT upper(replace(p_name, ' ', '')) || CAST(p_partkey AS VARCHAR)
                                            FROM part WHERE p_name LIKE '%rod%')""")
def q_drop_markers(spark, d):
    """F8: drop genes whose symbol is a marker (marker list = symbols of the 'rod' parts)."""
    from helixframe.sources.tables import read_table
    p = read_table(spark, d, "part", "p_partkey", "p_name")
    markers = p.where(F.col("p_name").contains("rod")).select(
        F.concat(F.upper(F.regexp_replace("p_name", " ", "")), F.col("p_partkey").cast("string")).alias("symbol"))
    res = de_results(spark, d).where(F.col("symbol").isNotNull())
    return RS.drop_markers(res, markers).select("contrast", "gene_id", "symbol")


@register("significant_counts", cte("de_results") + """
SELECT contrast, count(*) FILTER (WHERE padj < 0.05) AS n_significant FROM de_results GROUP BY contrast""")
def q_significant_counts(spark, d):
    return RS.significant_counts(de_results(spark, d))


@register("mapping_rate", cte("de_results") + """
SELECT contrast, count(symbol) AS n_mapped, count(*) AS n_total, round(100.0 * count(symbol) / count(*), 6) AS pct_mapped
FROM de_results GROUP BY contrast""")
def q_mapping_rate(spark, d):
    m = RS.mapping_rate(de_results(spark, d))
    return m.select("contrast", "n_mapped", "n_total", _r6("pct_mapped").alias("pct_mapped"))


@register("category_sizes", cte("de_results") + """
SELECT contrast, category, count(*) AS n FROM (
  SELECT contrast, CASE WHEN padj < 0.05 AND log2_fold_change > 1 THEN 'up'
                        WHEN padj < 0.05 AND log2_fold_change < -1 THEN 'down' ELSE 'ns' END AS category
  FROM de_results WHERE padj IS NOT NULL) GROUP BY ALL""")
def q_category_sizes(spark, d):
    return RS.category_sizes(RS.volcano_points(de_results(spark, d)))


@register("top_by_padj", cte("de_results") + """
SELECT contrast, gene_id, padj, rank FROM (
  SELECT contrast, gene_id, round(padj, 6) AS padj,
         CAST(row_number() OVER (PARTITION BY contrast ORDER BY padj ASC NULLS LAST, gene_id) AS INTEGER) AS rank
  FROM de_results) WHERE rank <= 20""")
def q_top_by_padj(spark, d):
    t = RS.top_by_padj(de_results(spark, d), 20)
    return t.select("contrast", "gene_id", _r6("padj").alias("padj"), "rank")


@register("heatmap_genes", cte("de_results") + """
SELECT contrast, gene_id, symbol, rank FROM (
  SELECT contrast, gene_id, symbol,
         CAST(row_number() OVER (PARTITION BY contrast ORDER BY padj ASC NULLS LAST, gene_id) AS INTEGER) AS rank
  FROM de_results WHERE symbol IS NOT NULL) WHERE rank <= 20""")
def q_heatmap_genes(spark, d):
    return RS.heatmap_genes(de_results(spark, d), 20).select("contrast", "gene_id", "symbol", "rank")


@register("sig_overlap", cte("de_results") + """
SELECT gene_id, CASE WHEN a AND b THEN 'both' WHEN a THEN 'lost' ELSE 'gained' END AS part FROM (
  SELECT gene_id, bool_or(contrast = 'single' AND padj < 0.05) AS a, bool_or(contrast = 'blocked' AND padj < 0.05) AS b
  FROM de_results GROUP BY gene_id) WHERE a OR b""")
def q_sig_overlap(spark, d):
    return RS.sig_overlap(de_results(spark, d), "single", "blocked")


@register("compare_models", cte("de_results") + """
SELECT n_a, n_b, n_b - n_a AS diff, round(100.0 * (n_b - n_a) / n_a, 6) AS pct_change, overlap, gained, lost FROM (
  SELECT count(*) FILTER (WHERE a) AS n_a, count(*) FILTER (WHERE b) AS n_b,
         count(*) FILTER (WHERE a AND b) AS overlap, count(*) FILTER (WHERE b AND NOT a) AS gained,
         count(*) FILTER (WHERE a AND NOT b) AS lost
  FROM (SELECT gene_id, coalesce(bool_or(contrast = 'single' AND padj < 0.05), false) AS a,
               coalesce(bool_or(contrast = 'blocked' AND padj < 0.05), false) AS b
        FROM de_results GROUP BY gene_id))""")
def q_compare_models(spark, d):
    c = RS.compare_models(de_results(spark, d), "single", "blocked")
    return c.select("n_a", "n_b", "diff", _r6("pct_change").alias("pct_change"), "overlap", "gained", "lost")


_BH_SQL = cte("de_results") + """
SELECT contrast, gene_id, round(least(1.0, min(pvalue * m / r) OVER (
         PARTITION BY contrast ORDER BY pvalue DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 6) AS padj_bh
FROM (SELECT contrast, gene_id, pvalue, count(*) OVER (PARTITION BY contrast) AS m,
             count(*) OVER (PARTITION BY contrast ORDER BY pvalue RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS r
      FROM de_results WHERE pvalue IS NOT NULL)
UNION ALL SELECT contrast, gene_id, NULL FROM de_results WHERE pvalue IS NULL"""


@register("bh_adjust", _BH_SQL)
def q_bh_adjust(spark, d):
    b = RS.bh_adjust(de_results(spark, d), "pvalue", "contrast")
    return b.select("contrast", "gene_id", _r6("padj_bh").alias("padj_bh"))


@register("bh_adjust_ranged", _BH_SQL)
def q_bh_adjust_ranged(spark, d):
    """D10, range-partitioned form (no single-task window), one contrast at a time."""
    res = de_results(spark, d)
    parts = [RS.bh_adjust_ranged(res.where(F.col("contrast") == c), "pvalue", n_parts=8)
             for c in ("single", "blocked")]
    out = parts[0].unionByName(parts[1])
    return out.select("contrast", "gene_id", _r6("padj_bh").alias("padj_bh"))


@register("results_roundtrip", cte("de_results") + """
SELECT contrast, gene_id, round(base_mean, 6) AS base_mean, round(log2_fold_change, 6) AS log2_fold_change,
       round(pvalue, 6) AS pvalue, round(padj, 6) AS padj, symbol FROM de_results""")
def q_results_roundtrip(spark, d):
    """Write the result table (CSV, gene id as a named column), read it back typed."""
    from helixframe.session import scratch_path
    path = scratch_path(spark, "de_results_csv")
    TB.write_results(de_results(spark, d), path)
    back = TB.read_results(spark, path)
    return back.select("contrast", "gene_id", _r6("base_mean").alias("base_mean"),
                       _r6("log2_fold_change").alias("log2_fold_change"), _r6("pvalue").alias("pvalue"),
                       _r6("padj").alias("padj"), "symbol")
