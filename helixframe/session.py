"""Session settings and the few guards every job shares."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at cluster scale; each is only applied when the
# session has not set it already (a cluster's own config wins).
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # batches to Python are bounded in bytes: 10,000 long texts are no small batch
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "helixframe") -> SparkSession:
    """Return the active session, or build a local one (tests, bench)."""
    active = SparkSession.getActiveSession()
    if active is not None:
        configure(active)
        return active
    builder = (SparkSession.builder.appName(app_name)
               .master(master or os.environ.get("HELIX_MASTER", "local[*]"))
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.driver.memory", os.environ.get("HELIX_DRIVER_MEM", "16g"))
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8)))
    for k, v in _DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> None:
    """Apply the defaults the operators rely on, where the session left them unset,
    and ship this package to the Python workers."""
    for k, v in _DEFAULTS.items():
        if spark.conf.get(k, None) is None:
            spark.conf.set(k, v)
    checkpoint_dir(spark)
    ship_package(spark)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``helixframe`` importable in every Python worker (pandas UDFs, mapInPandas).

    The package is zipped once per application and added with ``addPyFile``
    (the programmatic ``--py-files``); executors then import it no matter
    where the driver was started from.
    """
    import zipfile

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    zpath = os.path.join(tempfile.mkdtemp(prefix="helix-pyfiles-"), "helixframe.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(sc.applicationId)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables.

    Read from ``spark.checkpoint.dir``. Only a local session without one gets a scratch folder;
    on a cluster a folder of one machine would be lost to the others, so a missing setting is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="helix-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared checkpoint folder for a written table."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def require_small(df: DataFrame, max_rows: int, what: str) -> int:
    """Count ``df`` and raise when it is larger than a proven bound."""
    n = df.limit(max_rows + 1).count()
    if n > max_rows:
        raise ValueError(f"{what} has more than {max_rows} rows; this operator needs a bounded side")
    return n


def cut_lineage(df: DataFrame) -> DataFrame:
    """Eager reliable checkpoint into the shared folder (``spark.checkpoint.dir``).

    The one place where lineage is cut: later actions and any recomputation
    after an executor loss read the written files, not the upstream scans.
    (``Dataset.checkpoint(eager=True)`` writes in a single job; persisting
    first only added a cache round trip when measured.)
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
