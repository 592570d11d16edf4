"""SparkSession construction with the settings the library relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
import weakref
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job wants: AQE (runtime coalescing, skew-join splitting,
# runtime broadcast only when the measured side is small), UTC session time
# so that timestamps compare with other engines, no UI server.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Cluster sizing (tens of TB): start shuffles wide and let AQE coalesce small
# partitions to ~256 MB; split skewed ones; scan files in 256 MB splits.
# Explicit settings passed in ``extra`` (or by spark-submit) win.
CLUSTER_DEFAULTS = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
}


def build_session(master: str | None = None, app_name: str = "wardflow",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; tests and
    the bench pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    conf = dict(_DEFAULTS)
    if master:
        builder = builder.master(master)
    if master and master.startswith("local"):
        # Local mode: the driver JVM is the only executor.
        conf["spark.driver.memory"] = os.environ.get("WARDFLOW_DRIVER_MEMORY", "16g")
    else:
        conf.update(CLUSTER_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    from pyspark import SparkConf
    submitted = SparkConf()  # values given to spark-submit / spark-defaults
    for k, v in conf.items():
        if k in CLUSTER_DEFAULTS and submitted.contains(k):
            continue
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting one only when none is configured.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that value is
    always kept. Only a bare local session (tests) gets a scratch folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="wardflow-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.sparkContext.setCheckpointDir(path)
    return path


@contextmanager
def compiled_methods(spark):
    """Generated code in methods of at most 8,000 bytes: longer ones (tables of many
    columns) are never compiled by the JVM, and run several times slower."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def shuffles_dropped(spark):
    """What is run inside gives its shuffle files back as soon as it ends: for large
    shuffles of a stage that is stored and not run again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def materialize(df, label: str = "stage"):
    """Cut the lineage: write ``df`` as Parquet under the checkpoint folder
    and return a scan of it.

    Used where a table feeds several statistics passes (quantiles, medians,
    modes, self-joins): later plans scan the stored columns (with pruning
    and filter pushdown) instead of recomputing the upstream joins, and the
    stored files survive executor loss because the folder is shared.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/wardflow-{label}-{uuid.uuid4().hex}"
    with compiled_methods(spark):
        df.write.mode("overwrite").parquet(path)
    _STORED.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    _READS.add(out)
    return out


_STORED: list[str] = []
_READS: weakref.WeakSet = weakref.WeakSet()


def is_stored(df) -> bool:
    """Whether ``df`` is what :func:`materialize` returned, so that reading it again costs a scan."""
    return df in _READS


def stored_stages() -> list[str]:
    """Folders written by :func:`materialize` in this process."""
    return list(_STORED)


def release_stored_stages(spark) -> int:
    """Delete the folders written by :func:`materialize` (call when a job's
    results are written; DataFrames read from them become invalid).
    Uses the Hadoop file system of each path, so it works on shared storage."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _STORED:
        p = jvm.org.apache.hadoop.fs.Path(_STORED.pop())
        if p.getFileSystem(conf).delete(p, True):
            n += 1
    return n
