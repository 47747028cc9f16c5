"""Count-table reshapes, sample bookkeeping and metadata operators.

P1, P2, P4, F1, F2, J1, J2, W6, A1, A2, A3, A10 and the gene-major
array form every model operator consumes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from helixframe.functions import text as T

# Design tables are one row per sample; a few hundred thousand is far above
# any study and still cheap to broadcast.
MAX_SAMPLES = 200_000


def to_long(wide: DataFrame, id_col: str = "gene_id", var_name: str = "sample_id",
            value_name: str = "count") -> DataFrame:
    """Genes x samples wide table -> long (id, sample, value); zero cells kept."""
    values = [c for c in wide.columns if c != id_col]
    return wide.unpivot([id_col], values, var_name, value_name)


def to_wide(long: DataFrame, levels: list[str], id_col: str = "gene_id", var_col: str = "sample_id",
            value_col: str = "count", fill=0) -> DataFrame:
    """P1 inverse: long -> wide for a known, small list of sample ids.

    The level list is passed so Spark needs no extra distinct job; missing
    cells are filled with ``fill``.
    """
    w = long.groupBy(id_col).pivot(var_col, levels).agg(F.first(value_col))
    return w.fillna(fill, subset=levels) if fill is not None else w


def coverage_to_counts(coverage: DataFrame, qc: DataFrame, sample_col: str = "sample_id",
                       qc_key: str = "external_id", length_col: str = "avg_len") -> DataFrame:
    """P2 + J2: read count = round-half-even(coverage / average read length), as bigint.

    A sample without a QC row keeps its cells with a null count.
    """
    q = qc.select(F.col(qc_key).alias("__s"), F.col(length_col).alias("__len"))
    return (coverage.join(q, coverage[sample_col] == q["__s"], "left")
            .select(*[c for c in coverage.columns if c != "coverage"],
                    F.bround(F.col("coverage") / F.col("__len"), 0).cast("bigint").alias("count")))


def promote_attrs(df: DataFrame, attrs_col: str = "attrs", keys: list[str] | None = None) -> DataFrame:
    """Map entries -> columns named ``lower(key)`` with spaces as ``_``.

    With ``keys`` None the key list is read from the data (one distinct
    over map keys, which is a small set). A name clash with an existing
    column raises instead of producing duplicate columns.
    """
    if keys is None:
        keys = [r[0] for r in df.select(F.explode(F.map_keys(attrs_col)).alias("k")).distinct()
                .orderBy("k").collect()]
    names = [T.attr_key_to_column_name(k) for k in keys]
    clash = set(names) & set(df.columns)
    if clash or len(set(names)) != len(names):
        raise ValueError(f"attribute columns clash: {sorted(clash) or names}")
    return df.select("*", *[F.col(attrs_col).getItem(k).alias(n) for k, n in zip(keys, names)])


def index_samples(samples: DataFrame, key: str = "sample_id") -> DataFrame:
    """Stable 0-based ``sample_idx`` by sorted sample id.

    The window has no partition key, which is fine for a design table
    (one row per sample, bounded by MAX_SAMPLES).
    """
    return samples.withColumn("sample_idx", (F.dense_rank().over(Window.orderBy(key)) - 1).cast("int"))


def keep_samples(counts: DataFrame, samples: DataFrame, factor: str, key: str = "sample_id"):
    """keep samples whose factor is present, in both counts and metadata."""
    s = samples.where(F.col(factor).isNotNull())
    return counts.join(s.select(key), key, "left_semi"), s


def gene_totals(counts: DataFrame, gene: str = "gene_id", value: str = "count") -> DataFrame:
    """A1: total count per gene (partial sums on the map side, then one shuffle)."""
    return counts.groupBy(gene).agg(F.sum(value).alias("total"))


def keep_genes(counts: DataFrame, min_total: int = 10, gene: str = "gene_id", value: str = "count") -> DataFrame:
    """keep genes whose total count over the kept samples is >= ``min_total``.

    The semi-join reuses the hash partitioning of the totals aggregate.
    """
    keep = gene_totals(counts, gene, value).where(F.col("total") >= min_total).select(gene)
    return counts.join(keep, gene, "left_semi")


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A2: rows per factor level."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def design_balance(samples: DataFrame, row: str, col: str, levels: list[str]) -> DataFrame:
    """A3: row x col contingency table, 0-filled, with a per-row ``balanced`` flag.

    ``balanced`` is true when every cell of that row is exactly 1; the
    design is balanced when all rows are.
    """
    t = samples.groupBy(row).pivot(col, levels).agg(F.count(F.lit(1))).fillna(0, subset=levels)
    cells = [F.col(f"`{l}`") for l in levels]
    return t.withColumn("balanced", F.least(*cells) == 1) \
        .withColumn("balanced", F.col("balanced") & (F.greatest(*cells) == 1))


def check_alignment(counts_samples: DataFrame, samples: DataFrame, qc: DataFrame,
                    key: str = "sample_id") -> DataFrame:
    """Per sample id, which of counts / metadata / QC carry it.

    Presence bits of all three sides in one aggregate: no join, one row per
    sample leaves a map task. The caller raises on any row where a side is
    missing (see :func:`assert_aligned`).
    """
    sides = {"in_counts": counts_samples, "in_metadata": samples, "in_qc": qc}
    rows = [df.select(F.col(key), *[F.lit(s == side).alias(s) for s in sides]) for side, df in sides.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).groupBy(key).agg(*[F.bool_or(s).alias(s) for s in sides])


def assert_aligned(alignment: DataFrame, key: str = "sample_id") -> None:
    bad = alignment.where(~(F.col("in_counts") & F.col("in_metadata") & F.col("in_qc"))).limit(5).collect()
    if bad:
        raise ValueError(f"sample sets differ between counts, metadata and QC: {[r[key] for r in bad]}")


def matrix_stats(counts: DataFrame, qc: DataFrame, gene: str = "gene_id", sample: str = "sample_id",
                 value: str = "count", length_col: str = "avg_len") -> DataFrame:
    """A10: summary in long form (stat, value): samples, genes, max count, min / max read length."""
    c = counts.agg(F.countDistinct(sample).cast("double").alias("n_samples"),
                   F.countDistinct(gene).cast("double").alias("n_genes"),
                   F.max(value).cast("double").alias("max_count"))
    q = qc.agg(F.min(length_col).cast("double").alias("min_len"), F.max(length_col).cast("double").alias("max_len"))
    return (c.unpivot([], c.columns, "stat", "value")
            .unionByName(q.unpivot([], q.columns, "stat", "value")))


def profile(df: DataFrame) -> DataFrame:
    """A10: non-null count per column, long form (column, non_null)."""
    aggs = [F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]
    one = df.agg(*aggs)
    return one.unpivot([], df.columns, "column", "non_null")


def with_sample_array(df: DataFrame, name: str, values: list, ddl: str = "array<double>") -> DataFrame:
    """``df`` with the per-sample values, in sample order, as one array column: a one-row table behind a scalar subquery, so
    that the plan keeps its size for any number of samples."""
    return df.withColumn(name, df.sparkSession.createDataFrame([(values,)], f"v {ddl}").scalar())


def gene_vectors(counts: DataFrame, samples: DataFrame, n_samples: int, gene: str = "gene_id",
                 sample: str = "sample_id", value: str = "count", min_total: int | None = None) -> DataFrame:
    """Gene-major arrays: (gene_id, y array<double>) with y[sample_idx], zeros filled.

    One shuffle by gene; every sample's cell lands in its fixed slot, so a
    sparse long table densifies inside the array and never as a genes x
    samples exploded table. Each group holds at most ``n_samples`` values. With ``min_total`` the genes are those of
    :func:`keep_genes`, whose total is summed in the same group.
    """
    s = samples.select(F.col(sample).alias("__s"), "sample_idx")
    if min_total is not None:
        counts = counts.where(F.col(gene).isNotNull())
    cells = counts.join(s, counts[sample] == s["__s"]).select(gene, "sample_idx", F.col(value).alias("v"))
    g = cells.groupBy(gene).agg(F.collect_list(F.struct("sample_idx", F.col("v").cast("double").alias("v"))).alias("__l"), F.sum("v").alias("__total"))
    if min_total is not None:
        g = g.where(F.col("__total") >= min_total)
    g = g.select(gene, F.map_from_entries("__l").alias("__m"))
    return g.select(gene, F.transform(F.sequence(F.lit(0), F.lit(n_samples - 1)),
                                      lambda i: F.coalesce(F.try_element_at("__m", i), F.lit(0.0))).alias("y"))


def collect_design(samples: DataFrame) -> list[dict]:
    """The design on the driver, in sample order: one small row per sample, at most MAX_SAMPLES."""
    rows = samples.orderBy("sample_idx").limit(MAX_SAMPLES + 1).collect()
    if len(rows) > MAX_SAMPLES:
        raise ValueError(f"the design has more than {MAX_SAMPLES} samples")
    return [r.asDict() for r in rows]
