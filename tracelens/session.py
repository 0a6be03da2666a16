"""Session construction and shared scratch locations."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of the library should have.  On a cluster these
# come from spark-defaults; ``build_session`` applies them for local runs.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "tracelens",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    Without ``master`` the one of ``spark-submit`` (or spark-defaults) holds, and
    without ``shuffle_partitions`` the cluster's setting: a value given here
    would win over both.  ``shuffle_partitions`` is the *initial* partition
    count; AQE coalesces small partitions at run time, so on a cluster set it
    high (thousands) rather than risking spills with too few.
    """
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
        conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext, or None where there is none (Spark Connect clients)."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect: no context on the client
        return None


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    sc = _context(spark)
    return sc.getCheckpointDir() if sc is not None else None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    A cluster names a shared (distributed file system) folder in
    ``spark.checkpoint.dir``; it is read from the session and never
    replaced.  Only when nothing is configured and everything runs in this
    one process (``local[n]``, as in tests) a folder of our own is created and
    registered, and removed at exit; on a cluster, ``local-cluster`` included,
    a missing setting is an error.
    """
    configured = _configured_checkpoint_dir(spark)
    sc = _context(spark)
    if configured:
        if sc is not None and sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if str(master) != "local" and not str(master).startswith("local["):
        # A folder on this machine is invisible to the other executors.
        raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder "
                           "(e.g. on HDFS or an object store) for checkpoints and "
                           "written intermediate tables")
    local = tempfile.mkdtemp(prefix="tracelens-ckpt-")
    atexit.register(shutil.rmtree, local, ignore_errors=True)
    if sc is not None:
        sc.setCheckpointDir(local)
    else:
        spark.conf.set("spark.checkpoint.dir", local)
    return local


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint location.

    Used for written intermediate tables and round-trip sinks, so that
    every executor (and a re-run after executor loss) sees the same data.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/tracelens/{name}-{uuid.uuid4().hex}"


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder, on whatever file system it is, when the session's JVM ends."""
    sc = _context(spark)
    if sc is not None:
        folder = sc._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(sc._jsc.hadoopConfiguration()).deleteOnExit(folder)
