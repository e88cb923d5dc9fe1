"""Session helpers: building a session, the shared checkpoint folder, lineage cuts."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "longtab") -> SparkSession:
    """Session for tests, tools and the benchmark.  On a cluster the operator's
    own session (with its own spark.checkpoint.dir) is used instead."""
    master = master or os.environ.get("LONGTAB_MASTER", "local[8]")
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only a local session that names none (tests) gets a scratch folder; on a cluster that is an error.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext._jsc.sc().getCheckpointDir()
        d = d.get() if d.isDefined() else None
    if not d:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="longtab-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scan_partitions(spark: SparkSession, path: str) -> int:
    """Input splits of a plain file scan (a listing; no stage is executed)."""
    return spark.read.parquet(path).rdd.getNumPartitions()


def spread(df: DataFrame, input_partitions: int, *keys: str) -> DataFrame:
    """Hash-spread rows over the task slots when the input arrived in fewer partitions than
    slots (e.g. a few large files of long sequences), before CPU-heavy per-row steps.  Inputs that
    are already well split — the cluster case — are returned untouched.  ``input_partitions`` is
    measured on the raw scan (``scan_partitions``): asking a derived DataFrame for its partition
    count would run its shuffle stages under adaptive execution."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    if input_partitions >= slots:
        return df
    return df.repartition(slots, *keys) if keys else df.repartition(slots)


def cut_lineage(df: DataFrame, tag: str, free: bool = False) -> DataFrame:
    """Write ``df`` as a Parquet table under the shared checkpoint folder and read it back.

    Same purpose as ``checkpoint()`` (a lineage cut that survives executor loss, stored in
    ``spark.checkpoint.dir``), but the plan runs once: an eager checkpoint computes it to count
    and again to write it unless it was cached first.  ``free``: shuffle files of the write go as it ends
    (nothing reads them again), not when the driver happens to collect its garbage."""
    import uuid
    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/longtab-tables/{tag}-{uuid.uuid4().hex}"
    conf, before = df.sparkSession.conf, None
    if free:
        before = conf.get(FREE_SHUFFLES, None)
        conf.set(FREE_SHUFFLES, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        if free:
            conf.unset(FREE_SHUFFLES) if before is None else conf.set(FREE_SHUFFLES, before)
    return df.sparkSession.read.parquet(path)
