"""Spark session helpers.

The library never builds its own cluster session in library code paths: every
operator takes the caller's ``SparkSession``. ``local_session`` exists for
tests, the bench and the driver contract.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults sized for one 8-core box; on a cluster the submitter's settings win
# because ``getOrCreate`` keeps an existing session's configuration.
LOCAL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for a large cluster run (about 100 TB of log, ~1000 executors).
# They are what a submitter would pass with --conf; the library never sets
# them itself. Start with many shuffle partitions and let AQE coalesce them to
# ~256 MB; split files into 256 MB input partitions; split skewed join
# partitions; keep checkpoints and written tables on shared storage
# (spark.checkpoint.dir is the cluster's).
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.shuffle.partitions": "40000",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    # several joins of one key follow each other: split a skewed one even if that costs a shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    # tables bucketed by user serve joins on the user and more columns as they are
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "learnlog", memory: str | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in LOCAL_CONF.items():
        builder = builder.config(k, v)
    if memory:
        builder = builder.config("spark.driver.memory", memory)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the operator of the cluster sets this to a shared file
    system; we only read it, and without it there is an error: in a folder of
    its own each executor would write what no other one sees. In local mode
    (tests) a scratch folder is taken, which goes when the process ends.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="learnlog-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        atexit.register(shutil.rmtree, path, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_root(spark: SparkSession) -> str:
    """This application's own sub-folder of the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/learnlog-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A place for a written table of this application."""
    return f"{scratch_root(spark)}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table of its own, read back: the lineage ends there."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder on whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def remove_scratch(spark: SparkSession) -> None:
    """Delete all tables this application wrote under the checkpoint folder;
    to be called when their results have been used."""
    delete_path(spark, scratch_root(spark))
