"""Session settings and lineage cutting.

The library never creates its own storage: iterative jobs cut lineage with
``DataFrame.checkpoint()`` into the shared folder the cluster names in
``spark.checkpoint.dir``.  Only a local session without that setting (tests,
laptops) gets a fresh folder under the system temp directory.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings a user would put on a cluster session; sizes are per partition.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Arrow batches for the two Python helpers (HTML, BPE encode) stay small
    # because a row can hold a whole web page.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2048",
    # ... and bounded in bytes, so a batch of large pages stays a few MB.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(32 * 1024 * 1024),
    "spark.ui.enabled": "false",
    # Checkpoints that nothing refers to any more are deleted.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "textkiln") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", "16g")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, reading it from the session.

    A cluster names a shared folder in ``spark.checkpoint.dir``; it is used as
    is.  Only a local-mode session without the setting gets a temp folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; iterative jobs need a shared checkpoint folder")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="textkiln-ckpt-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (survives executor loss), never a local one."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def materialised(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table in the shared checkpoint area: later uses read
    the columns they need, and Spark knows its size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder for materialised intermediate tables inside the shared checkpoint area."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/textkiln-{name}-{uuid.uuid4().hex[:12]}"
