"""Session construction and shared-storage helpers."""

from __future__ import annotations


import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings the library is written against.  AQE re-plans joins and
# coalesces shuffle partitions from runtime sizes, and splits skewed join
# partitions; UTC keeps timestamp <-> date conversions reproducible.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.host": "127.0.0.1",
    "spark.driver.bindAddress": "127.0.0.1",
    # A table bucketed by id is in place for a join on the id and more.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Remove checkpoint files once their DataFrame is no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Suggested settings for a large cluster (~1000 executors, ~100 TB input).
# Passed through ``build_session(**SCALE_CONF)`` or the cluster's own conf;
# nothing in the library depends on them for correctness.
SCALE_CONF = {
    # Start with many shuffle partitions and let AQE coalesce them to the
    # advisory size from runtime statistics, so neither tiny nor huge
    # stages are mis-sized by a single static number.
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32m",
    # Split a join partition that is 5x the median and over 512 MB (one
    # author or term holding a large share of rows).
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    # Runtime (AQE) broadcast of a join side measured small after a stage.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # Scan splits: one task per 256 MB of Parquet.
    "spark.sql.files.maxPartitionBytes": "256m",
    # Bucketed stages are read as already partitioned.
    "spark.sql.sources.bucketing.enabled": "true",
}


def build_session(master: str = "local[*]", app: str = "chorus",
                  shuffle_partitions: int = 8, **conf) -> SparkSession:
    """A session for tests and local runs; clusters pass their own conf."""
    b = SparkSession.builder.master(master).appName(app)
    for k, v in {**DEFAULT_CONF,
                 "spark.sql.shuffle.partitions": str(shuffle_partitions),
                 **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset (local tests) is a scratch
    folder created and registered, so that ``DataFrame.checkpoint`` and the
    staged writes below always land in storage every executor can see.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder shared by all executors")
        d = tempfile.mkdtemp(prefix="chorus-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-path of the shared folder, unique per call."""
    base = shared_dir(spark)
    sep = "" if base.endswith("/") else "/"
    return f"{base}{sep}chorus/{name}-{uuid.uuid4().hex}"


def cut_lineage(df):
    """Materialise ``df`` in the shared checkpoint folder (reliable, survives
    executor loss) and return a DataFrame that reads it back."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


