"""Spark session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import hashlib
import os
import tempfile

from pyspark.sql import SparkSession

# Settings every trendlens job relies on.  Timestamps are interpreted in UTC
# (window boundaries and day cut-offs must not depend on the host zone), AQE
# re-plans joins and coalesces shuffle partitions from runtime statistics, and
# streaming state lives in RocksDB so large keyword state spills to disk
# instead of filling the executor heap.
BASE_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "trendlens",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the trendlens defaults.

    On a cluster leave ``master`` unset so spark-submit decides; tests pass
    ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``.

    Only when the setting is absent (a local test session) a private scratch
    folder is created and registered; on a cluster the configured shared
    folder is always used.
    """
    sc = spark.sparkContext
    path = (sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
            or _local_dirs.get(sc.applicationId))
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder (HDFS/object store) "
                               "that every executor can reach")
        path = tempfile.mkdtemp(prefix="trendlens-ckpt-")
        _local_dirs[sc.applicationId] = path
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path


_local_dirs: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediate
    tables (used to cut lineage or stage an overwrite)."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{os.getpid()}-{next(_counter)}"


def default_checkpoint(spark: SparkSession, name: str, *targets: str) -> str:
    """Stream checkpoint folder under ``spark.checkpoint.dir``, one per job
    name and set of targets, so that two streams never share one."""
    key = hashlib.sha256("\n".join(targets).encode()).hexdigest()[:12]
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{key}"


def _hadoop_path(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or URI exists; any other failure is raised."""
    hadoop, fs = _hadoop_path(spark, path)
    return fs.exists(hadoop)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds, if it exists."""
    hadoop, fs = _hadoop_path(spark, path)
    fs.delete(hadoop, True)


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders directly under a path, none if it does not exist."""
    hadoop, fs = _hadoop_path(spark, path)
    return sorted(s.getPath().toString() for s in fs.listStatus(hadoop) if s.isDirectory()) if fs.exists(hadoop) else []


def list_files(spark: SparkSession, path: str) -> dict[str, int]:
    """The data files under a path (relative names, without marks and files
    in the making) with their times; none if it does not exist."""
    hadoop, fs = _hadoop_path(spark, path)
    if not fs.exists(hadoop):
        return {}
    root, out, found = fs.makeQualified(hadoop).toString().rstrip("/") + "/", {}, fs.listFiles(hadoop, True)
    while found.hasNext():
        status = found.next()
        name = status.getPath().toString().removeprefix(root)
        if not any(p.startswith(("_", ".")) for p in name.split("/")):
            out[name] = status.getModificationTime()
    return out


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    """Move a path to one that does not exist yet."""
    hadoop, fs = _hadoop_path(spark, source)
    if path_exists(spark, target) or not fs.rename(hadoop, _hadoop_path(spark, target)[0]):
        raise OSError(f"cannot move {source} to {target}")


def _count():
    n = 0
    while True:
        n += 1
        yield n


_counter = _count()
