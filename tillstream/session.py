"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: settings the plans rely on; all can be changed on a running session
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


#: keyed stream state on disk with change logs, so it may outgrow executor memory
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def local_session(cores: int | str = 8, name: str = "tillstream", **extra: str) -> SparkSession:
    """A session on this machine, for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**SQL_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_state_settings(spark: SparkSession) -> None:
    """State backend for new queries, unless the session names one itself."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(provider, None) is None:
        for key, value in STATE_SETTINGS.items():
            spark.conf.set(key, value)


def apply_settings(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path itself."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def is_single_file(spark: SparkSession, path: str) -> bool:
    fs, at = file_system(spark, path)
    return fs.exists(at) and fs.getFileStatus(at).isFile()


def file_bytes(spark: SparkSession, path: str) -> int:
    fs, at = file_system(spark, path)
    return fs.getFileStatus(at).getLen()


def scratch_root(spark: SparkSession) -> str:
    """The folder the cluster shares (`spark.checkpoint.dir`).

    Only a session on one machine may fall back to a temporary folder: on a cluster that folder
    would be different on every executor.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    root = configured or sc.getCheckpointDir()
    if root is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tillstream-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def pinned(df: DataFrame) -> DataFrame:
    """Write the rows once to the shared folder, so later reads see the same partitions again
    even when executors are lost."""
    scratch_root(df.sparkSession)
    return df.checkpoint()
