"""Session helpers.

Cluster settings (shuffle partitions, checkpoint dir, memory) belong to the
deployment; the helpers here only fill in values that are unset, so the same
code runs on a laptop and on a large cluster.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  UTC keeps epoch <-> timestamp conversions
# stable across executors in different zones.
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

# Removes the shuffle files of a query at its end.
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "rankforge", driver_memory: str | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if driver_memory:
        # In local mode the driver JVM is the only executor: its heap is the
        # executor memory.  Only effective when this call starts the JVM.
        builder = builder.config("spark.driver.memory", driver_memory)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    builder = builder.config("spark.sql.execution.arrow.pyspark.enabled", "true")
    # Reliable checkpoints of materialised intermediates are removed once
    # their DataFrame is garbage collected.
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    for k, v in _REQUIRED.items():
        spark.conf.set(k, v)
    ship_package(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``rankforge`` importable in executor Python workers (pandas UDFs
    pickle functions by module reference): zip the package once per
    SparkContext and ``addPyFile`` it, the programmatic form of
    ``--py-files``.  The zip is a driver-side file that Spark itself serves
    to every executor; no data goes through it."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile

    import rankforge
    pkg_dir = os.path.dirname(os.path.abspath(rankforge.__file__))
    base = os.path.dirname(pkg_dir)
    out = os.path.join(tempfile.mkdtemp(prefix="rankforge-pyfiles-"), "rankforge.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, base))
    sc.addPyFile(out)
    _SHIPPED.add(app)


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint root: the context's checkpoint directory, else the
    cluster's ``spark.checkpoint.dir``.  When neither is set a private
    temporary directory serves in local mode; on a cluster, where executors
    would write to their own disks, this raises ``ValueError``.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="rankforge-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint root and read it
    back: cuts lineage, and keeps column pruning and filter push-down.

    What the write has shuffled is removed once it is done: nothing reads it
    again, and the files of all steps of a job would lie on the disks together."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_DROP_SHUFFLES)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh directory below the shared checkpoint root."""
    root = checkpoint_dir(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")
