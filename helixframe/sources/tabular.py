"""Delimited-text sources and sinks: S1 (wide counts), S2 (commented TSV),
S3 (sample sheet), S4 (result table round trip)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from helixframe.operators.reshape import to_long

RESULT_SCHEMA = Ty.StructType([
    Ty.StructField("contrast", Ty.StringType()),
    Ty.StructField("gene_id", Ty.StringType()),
    Ty.StructField("base_mean", Ty.DoubleType()),
    Ty.StructField("log2_fold_change", Ty.DoubleType()),
    Ty.StructField("lfc_se", Ty.DoubleType()),
    Ty.StructField("stat", Ty.DoubleType()),
    Ty.StructField("pvalue", Ty.DoubleType()),
    Ty.StructField("padj", Ty.DoubleType()),
    Ty.StructField("symbol", Ty.StringType()),
])


def _header(spark: SparkSession, path: str, sep: str, comment: str | None) -> list[str]:
    """Column names as the CSV reader sees them: quotes taken off, comment lines skipped (one small job)."""
    opts = {"header": "true", "sep": sep} | ({"comment": comment} if comment else {})
    names = spark.read.options(**opts).csv(path).columns
    if not names:
        raise ValueError(f"{path}: empty file")
    return names


def read_counts(spark: SparkSession, path: str, sep: str = ",", comment: str | None = None,
                value_type: Ty.DataType = Ty.LongType(), id_col: str | None = None,
                n_partitions: int | None = None) -> DataFrame:
    """Wide gene x sample count file -> long (gene_id, sample_id, count).

    The header is read once and a schema declared (string id, one numeric
    column per sample), so no inference pass runs. gzip input is not
    splittable; pass ``n_partitions`` to spread the rows before the
    unpivot multiplies them.
    """
    names = _header(spark, path, sep, comment)
    schema = Ty.StructType([Ty.StructField(names[0], Ty.StringType())] +
                           [Ty.StructField(n, value_type) for n in names[1:]])
    opts = {"header": "true", "sep": sep, "mode": "FAILFAST"}
    if comment:
        opts["comment"] = comment
    wide = spark.read.options(**opts).schema(schema).csv(path)
    if n_partitions:
        wide = wide.repartition(n_partitions)
    wide = wide.withColumnRenamed(names[0], id_col or "gene_id")
    return to_long(wide, id_col or "gene_id", "sample_id", "count")


def read_tsv(spark: SparkSession, path: str, comment: str | None = "#") -> DataFrame:
    """Tab-separated table with header; whole-line comments skipped.

    Spark drops only lines that start with the comment character; a ``#``
    inside a value is kept (pandas would cut the line there).
    """
    opts = {"header": "true", "sep": "\t", "inferSchema": "false"}
    if comment:
        opts["comment"] = comment
    return spark.read.options(**opts).csv(path)


def read_samples(spark: SparkSession, path: str, key: str | None = None, sep: str = ",") -> DataFrame:
    """S3: sample sheet keyed by its first column (or ``key``), renamed ``sample_id``.

    Raises on a duplicate key: every later join treats the sheet as one row per sample.
    """
    df = spark.read.options(header="true", sep=sep).csv(path)
    k = key or df.columns[0]
    df = df.withColumnRenamed(k, "sample_id")
    dup = df.groupBy("sample_id").count().where("count > 1").limit(1).collect()
    if dup:
        raise ValueError(f"duplicate sample id {dup[0][0]} in {path}")
    return df


def write_results(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Write a result table; the gene id stays a named column."""
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", "true").csv(path)
    else:
        w.parquet(path)


def read_results(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Read a result table back with the declared schema; NaN becomes NULL."""
    from helixframe.operators.results import nan_to_null
    if fmt == "csv":
        df = spark.read.option("header", "true").schema(RESULT_SCHEMA).csv(path)
    else:
        df = spark.read.parquet(path)
    return nan_to_null(df)
