"""Session helpers.

The library never creates its own scratch location on a cluster: it reads
``spark.checkpoint.dir`` from the session (the shared folder the cluster
names). Only a local-mode session without that setting (tests, laptops)
gets a fresh temporary folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tablefit", driver_memory: str | None = None) -> SparkSession:
    """Return the active session or build one with settings that suit this
    library: AQE on (coalesces the small metric shuffles, splits skewed
    partitions), UTC session time, UI off."""
    active = SparkSession.getActiveSession()
    if active is not None and master is None:
        return active
    builder = (SparkSession.builder.appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
               .config("spark.sql.adaptive.skewJoin.enabled", "true")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        # only takes effect when this call starts the JVM (local mode)
        builder = builder.config("spark.driver.memory", driver_memory)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The session's checkpoint folder, set from ``spark.checkpoint.dir``
    when needed (a fresh local folder only for local mode)."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster run needs a shared folder for "
            "intermediate tables")
    local = tempfile.mkdtemp(prefix="tablefit-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A new, unique folder under the session's checkpoint directory for
    intermediate tables written by a job (never a machine-local folder on a
    cluster). Nothing is created here; Spark writers create it."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tablefit/{name}-{uuid.uuid4().hex[:12]}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that a job wrote, once nothing reads it any more."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(jpath, True)


def local_path(uri: str) -> str:
    """Strip a ``file:`` scheme for code that needs an OS path (tests)."""
    if uri.startswith("file:"):
        return "/" + uri[len("file:"):].lstrip("/")
    return uri


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem, so it works on any
    storage the cluster reads (HDFS, object stores, local)."""
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return bool(jpath.getFileSystem(hconf).exists(jpath))


def list_files(spark: SparkSession, directory: str) -> list[str]:
    """Plain file names directly inside ``directory`` (no recursion)."""
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    jpath = jvm.org.apache.hadoop.fs.Path(directory)
    fs = jpath.getFileSystem(hconf)
    if not fs.exists(jpath):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(jpath) if st.isFile())


def list_directories(spark: SparkSession, directory: str) -> list[str]:
    """Names of the directories directly inside ``directory``."""
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(directory)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(st.getPath().getName() for st in fs.listStatus(jpath) if st.isDirectory()) if fs.exists(jpath) else []


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default
