"""Spark session and checkpoint-directory helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, app: str = "quarry",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    AQE (partition coalescing + skew-join splitting) is on, the UI is off,
    Arrow is used for the few pandas UDFs.  ``master`` is only for local runs;
    on a cluster the launcher sets it.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         # checkpoint files go when nothing refers to them any more
         .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting it only when unset.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that is
    used as is.  Only a local-mode session without one (tests) gets a fresh
    directory under the system temp folder; a cluster session without one is
    an error, since a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="quarry-ckpt-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame, cache: bool = True) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint directory (survives executor loss).

    The frame is persisted first so that the checkpoint write does not compute it
    a second time; the cache is dropped once the files exist.  Rows too wide for the
    executors' memory go straight to the files (``cache=False``), also in one pass.
    """
    from pyspark import StorageLevel
    ensure_checkpoint_dir(df.sparkSession)
    if not cache:
        return df.checkpoint(eager=True)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out
