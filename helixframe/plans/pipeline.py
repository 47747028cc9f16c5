"""Shared preparation of the expression study: design, filters, size factors, gene arrays."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.operators import normalize as N
from helixframe.operators import reshape as R
from helixframe.plans import adapters as A
from helixframe.session import cut_lineage


@dataclass
class ExpressionInputs:
    counts: DataFrame        # long counts after the low-count filter (F2)
    samples: DataFrame       # sample_id, sample_idx, patient, condition
    n_samples: int
    size_factors: DataFrame  # sample_id, size_factor
    sf_array: list[float]    # size factors by sample_idx (m scalars on the driver)
    gene_vec: DataFrame      # gene_id, y array<double> (dense, by sample_idx)
    design: list[dict]       # sample rows by sample_idx (m small dicts)


def expression_inputs(spark: SparkSession, d: str, min_total: int = 10) -> ExpressionInputs:
    """F1 -> F2 -> D1 -> gene arrays for the region x flag study.

    Driver-side values are per-sample only (m of them). The gene arrays
    are the unit every model job consumes: one row per gene.
    """
    cells = A.study_cells(spark, d)
    counts = A.counts_long(spark, d, cells)
    samples = A.samples(spark, d, cells)
    design = R.collect_design(samples)
    n = len(design)
    # the design is m rows already on the driver: reuse it as a local relation
    # instead of re-deriving it from the cells in every later join / size check
    samples = spark.createDataFrame([tuple(r[c] for c in samples.columns) for r in design], samples.schema)
    # Counts, metadata and QC must describe the same samples (fails fast)
    qc = A.qc_table(spark, d, cells).withColumnRenamed("external_id", "sample_id")
    R.assert_aligned(R.check_alignment(counts, samples, qc))
    counts, samples = R.keep_samples(counts, samples, "condition")
    # the gene arrays are made once, written, and read by the size factors and every model job
    gv = cut_lineage(R.gene_vectors(counts, samples, n, min_total=min_total))
    by_idx = {r["sample_idx"]: r["size_factor"] for r in N.vector_size_factors(gv, n).collect()}
    if len(by_idx) != n:
        raise ValueError("size factors need at least one gene with a positive count in every sample")
    sf_array = [float(by_idx[r["sample_idx"]]) for r in design]
    kept = R.keep_genes(counts, min_total)
    sf = spark.createDataFrame([(r["sample_id"], s) for r, s in zip(design, sf_array)], "sample_id string, size_factor double")
    return ExpressionInputs(kept, samples, n, sf, sf_array, gv, design)


@dataclass
class DEFit:
    fit: DataFrame           # per-gene fit table (checkpointed)
    names: list[str]         # model-matrix column names, a blocked design's blocks last
    n_blocks: int            # how many of them are blocks
    trend: dict
    prior: dict
    disp: DataFrame          # gene-wise dispersions (checkpointed)


def deseq(ctx: ExpressionInputs, factors: list[str], ref: dict | None = None) -> DEFit:
    """D3 -> D4 -> D5 -> D6/D7 -> D8 for one design.

    The two model tables are checkpointed to the shared checkpoint folder
    (lineage cut, so a lost executor recomputes from the written table,
    not from the raw scans); the trend and the prior are a few Spark
    aggregates whose scalars drive the next job.
    """
    from helixframe.operators import glm as G
    if len(factors) > 1:   # the factor with most levels (patients) is eliminated, whatever their number
        X = G.blocked_design(ctx.design, factors, max(factors, key=lambda f: len({r[f] for r in ctx.design})), ref)
        names, n_blocks = X.names, X.n_blocks
    else:
        (X, names), n_blocks = G.design_matrix(ctx.design, factors, ref), 0
    # keep one Arrow batch of gene arrays around 2M cells, however many samples
    spark = ctx.gene_vec.sparkSession
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(max(64, min(10_000, 2_000_000 // X.shape[0]))))
    try:
        disp = cut_lineage(G.genewise_dispersion(ctx.gene_vec, X, ctx.sf_array))
        trend = G.dispersion_trend(disp)
        prior = G.dispersion_prior(disp, trend, X.shape[0], X.shape[1])
        fit = cut_lineage(G.fit_genes(disp, X, ctx.sf_array, trend, prior))
    finally:  # both kernels ran inside the eager checkpoints
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
    return DEFit(fit, names, n_blocks, trend, prior, disp)


def de_table(spark: SparkSession, d: str, factors: list[str], contrast: tuple[str, str, str],
             ref: dict | None = None, name: str | None = None, ctx: ExpressionInputs | None = None):
    """Full DE table for one design and contrast: Wald + independent filtering + BH + symbols."""
    from helixframe.operators import glm as G
    from helixframe.operators import results as RS
    ctx = ctx or expression_inputs(spark, d)
    m = deseq(ctx, factors, ref)
    c = G.contrast_vector(m.names, *contrast)
    res = G.wald(m.fit, c, name or "_".join(factors), m.n_blocks)
    res, theta = G.independent_filter(res)
    res = RS.annotate(res, RS.first_per_key(A.symbol_hits(spark, d)))
    return res, m, theta
