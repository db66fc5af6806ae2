"""Session helpers: a tuned builder for tests and benches, and the shared
checkpoint folder that lineage cuts and snapshots are written under."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession


# State store for large streaming state and for timers; a session setting, never changed in the session that
# the library is given.
STATE_STORE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str = "local[8]", partitions: int = 8, app: str = "tallyfold") -> SparkSession:
    """Session for local runs.  On a cluster, pass the cluster's own session to
    the operators instead; they take no global settings from here."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(map=STATE_STORE)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_root(spark)
    return spark


def with_state_store(spark: SparkSession) -> SparkSession:
    """A session whose streams can keep several states with timers.

    Spark's default state store holds one state per operator only.  A session that
    has it is left as it is, and one beside it, of the same context and settings but
    with ``STATE_STORE``, is returned; any other session is returned itself."""
    default = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", default) != default:
        return spark
    own = spark.newSession()
    given = own.conf.getAll
    for key, value in spark.conf.getAll.items():
        if given.get(key) != value:
            own.conf.set(key, value)
    for key, value in STATE_STORE.items():
        own.conf.set(key, value)
    return own


def scale_settings(spark: SparkSession, input_bytes: int, partition_bytes: int = 256 << 20,
                   min_partitions: int = 8) -> int:
    """Size shuffles for an input of ``input_bytes``: one shuffle partition
    per ``partition_bytes`` of input (so each task's share fits executor
    memory and spills little), AQE coalescing towards the same size, and
    scan splits of the same size.  Returns the partition count set."""
    n = max(min_partitions, -(-input_bytes // partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(partition_bytes))
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(partition_bytes))
    return n


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names storage every executor can reach, and it is
    used as is.  Only when it is unset and the master is known to be local (tests)
    is a private folder made; on a cluster, and in a Connect session, whose master
    is not known, that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
        if not root:
            jdir = sc._jsc.sc().getCheckpointDir()
            root = jdir.get() if jdir.isDefined() else None
    except Exception:  # noqa: BLE001  (no SparkContext, e.g. a Connect session)
        sc = None
    if not root:
        if sc is None or not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to storage that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tallyfold-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None and not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tallyfold/{name}-{uuid.uuid4().hex}"


def local_path(path: str) -> str | None:
    """The local file path of a ``file:`` or plain path, else None."""
    if path.startswith("file:"):
        return path[len("file:"):]
    if "://" in path:
        return None
    return os.path.abspath(path)


def materialize(df, name: str):
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    read it back: a lineage cut for an expensive result that is read more
    than once (the two-level running scan reads its input twice).  Written
    by Spark tasks, so a lost executor only reruns its tasks."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that ``scratch_path`` named, through Spark's own file
    system, so it works wherever the shared folder lies.  Other paths are refused."""
    root = f"{checkpoint_root(spark).rstrip('/')}/tallyfold/"
    if not path.startswith(root) or not path[len(root):].strip("/"):
        raise ValueError(f"not a scratch folder: {path}")
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
