"""Session construction and lineage helpers."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job assumes: AQE re-plans joins and coalesces partitions at
# run time, UTC session clock so dates match the SQL oracle, ANSI left on (the
# library uses try_* where a NULL result is wanted).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # checkpoints that nothing refers to any more are removed
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Python call-site capture for error messages costs ~30 % of plan build time
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_spark(app: str = "tempolith", master: str | None = None,
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for cutting lineage.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset, a
    local master gets a fresh temp folder (tests); any other master is refused,
    because a folder on the driver's disk is not visible to the executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError(f"spark.checkpoint.dir is unset and {sc.master} needs a folder that all executors share")
    local = tempfile.mkdtemp(prefix="tempolith-ckpt-")
    sc.setCheckpointDir(local)
    return local


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def keep_rows(df: DataFrame, key: str) -> DataFrame:
    """``df`` computed once for many passes, dealt by ``key`` over twice as many partitions as there are cores (small
    shuffled rows would otherwise be put together into a few partitions, and each pass run in as few tasks)."""
    return cut_lineage(df.repartition(2 * df.sparkSession.sparkContext.defaultParallelism, key))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written intermediate tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch table that nothing reads any more."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jvm_path, True)
