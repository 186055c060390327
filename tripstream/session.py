"""Session helpers: a local session for tests/bench, and the shared work folder.

Library functions never create a session; they take the caller's. Work files
(landing files, stream outputs, checkpoints) go below the folder the cluster
names in ``spark.checkpoint.dir``; only when that is unset (local tests) do we
set one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tripstream") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        # large join/dedup state lives off-heap and checkpoints incrementally
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        # commit a changelog per micro-batch instead of a full state snapshot
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide checkpoint folder; set a local one only when unset."""
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="tripstream-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def children(spark: SparkSession, path: str) -> list:
    """Hadoop file statuses directly below ``path`` (none if it is missing)."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return list(fs.listStatus(p)) if fs.exists(p) else []


def materialized(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared folder and read it back.

    The input behind it is scanned once however often the result is used, and its size
    on disk is what Spark's own broadcast threshold then goes by.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def work_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared folder (never a machine-local temp dir)."""
    base = shared_dir(spark).rstrip("/")
    return "/".join([base, "tripstream-work", uuid.uuid4().hex, *parts])
