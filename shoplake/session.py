"""Spark session setup and the shared scratch location.

Every job in this package needs three session settings to be right, whatever session it is given:
UTC as the session time zone (date parts and partition values depend on it), no type inference for
partition columns (``month=09`` must stay the string ``"09"``) and adaptive execution with skew
handling (a single user or session may hold a large share of all rows).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings every job relies on. They are session-scoped and safe to set on a live session.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that costs one more shuffle downstream (for example
    # when an aggregation follows the join): one hot user must not become one straggler task.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Streaming state (open windows, sessions, dedup keys) lives in RocksDB on local disk instead of
    # the executor heap, and commits write only the changes; the provider is pinned per checkpoint.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Python workers hand batches over through Arrow wherever a pandas function is used.
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings of ``REQUIRED_CONF`` to an existing session and return it."""
    for key, value in REQUIRED_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(master: str = "local[8]", app: str = "shoplake", shuffle_partitions: int = 8,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for tests and local runs. On a cluster, use the cluster's session and call ``configure``."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("SHOPLAKE_DRIVER_MEMORY", "8g"))
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def _checkpoint_root(spark: SparkSession) -> str | None:
    try:
        current = spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect has no SparkContext
        current = None
    if current:
        return current
    return spark.conf.get("spark.checkpoint.dir", None) or None


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory for intermediate tables, below the cluster's shared checkpoint folder.

    The cluster names that folder in ``spark.checkpoint.dir``; it is read from the session. Only when
    it is unset (local runs and tests) a temporary folder is created and registered as the
    checkpoint directory, so ``DataFrame.checkpoint()`` and written tables share one place.
    """
    root = _checkpoint_root(spark)
    if not root:
        master = spark.conf.get("spark.master", "") or ""
        if not master.startswith("local"):
            # A machine-local folder is invisible to executors on other hosts.
            raise RuntimeError("spark.checkpoint.dir is not set; set it to a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="shoplake-")
        try:
            spark.sparkContext.setCheckpointDir(root)
            root = spark.sparkContext.getCheckpointDir() or root
        except Exception:
            spark.conf.set("spark.checkpoint.dir", root)
    root = root.rstrip("/")
    return f"{root}/shoplake/{name}-{uuid.uuid4().hex[:12]}"


def _on_storage(spark: SparkSession, path: str):
    """The Hadoop path and its file system, so that any store Spark can read will do."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def folder_exists(spark: SparkSession, path: str) -> bool:
    at, store = _on_storage(spark, path)
    return store.exists(at)


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder and what is in it; an absent one is fine."""
    at, store = _on_storage(spark, path)
    store.delete(at, True)
