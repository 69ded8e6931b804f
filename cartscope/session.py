"""Session construction and the shared work folder.

Everything that must outlive a task (materialised tables, landed payloads,
lineage cuts) is written under the folder the cluster names in
``spark.checkpoint.dir``. The setting is read from the running session; a
private folder is chosen only when it is unset *and* the session is local
(tests, laptops). A cluster session without the setting is an error, because a
machine-local folder would not be visible to other executors.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_ROOT: dict[str, str] = {}


def get_spark(master: str | None = None, app: str = "cartscope",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings this library relies on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # AQE converts a join to a broadcast only when the *measured* size of a
        # side is under this bound, so no plan broadcasts an unchecked side.
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.files.maxPartitionBytes": "128MB",
        # AQE merges small shuffle partitions up to this size
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
        # reliable checkpoints (lineage cuts) are removed once unreferenced
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def work_root(spark: SparkSession) -> str:
    """Shared folder for written tables and lineage cuts.

    Reads ``spark.checkpoint.dir``; sets a private one only when unset and local.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir")
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # not set anywhere
            root = None
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: cartscope needs a shared folder "
                "(HDFS/object store) to write tables and cut lineage on a cluster")
        key = sc.applicationId
        if key not in _LOCAL_ROOT:
            _LOCAL_ROOT[key] = tempfile.mkdtemp(prefix="cartscope-")
        root = _LOCAL_ROOT[key]
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique path under the shared work folder (never reused)."""
    return "/".join([work_root(spark), "cartscope", *parts, uuid.uuid4().hex])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem of the path (works for any scheme)."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def make_dirs(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)


def rename_path(spark: SparkSession, src: str, dst: str) -> bool:
    """Publish a finished directory under its final name (atomic on HDFS-like stores)."""
    jvm = spark._jvm
    s = jvm.org.apache.hadoop.fs.Path(src)
    d = jvm.org.apache.hadoop.fs.Path(dst)
    fs = s.getFileSystem(spark._jsc.hadoopConfiguration())
    parent = d.getParent()
    if parent is not None and not fs.exists(parent):
        fs.mkdirs(parent)
    return bool(fs.rename(s, d))


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Total size of the files under ``paths`` (Hadoop content summary)."""
    jvm = spark._jvm
    total = 0
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        total += int(fs.getContentSummary(p).getLength())
    return total


#: Each output file is sorted by one task, whose rows in memory take 15 to 36 times
#: their compressed bytes in the input.
TARGET_FILE_BYTES = 8 * 1024 * 1024


def file_count(spark: SparkSession, paths: list[str], bytes_per_file: int = TARGET_FILE_BYTES) -> int:
    """Output files for a table derived from ``paths``: about one per
    ``bytes_per_file`` of input, so that a file's rows are sorted in memory, and at
    least one per default parallelism slot."""
    n = -(-input_bytes(spark, paths) // bytes_per_file)
    return max(int(n), spark.sparkContext.defaultParallelism, 1)
