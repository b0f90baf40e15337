"""Session settings and the shared work folder.

Everything the library has to materialise (the parsed stage, test corpora for
the file sources) goes to the folder named by ``spark.checkpoint.dir``, which on
a cluster is shared storage: a lost executor never takes such data with it.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job over a large corpus wants. Codemap joins carry no broadcast
# hint: Catalyst broadcasts a side only if its size estimate (or, under AQE, its
# measured shuffle size) is below the threshold, and otherwise runs a shuffle
# join in which AQE splits the hot codes.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    # A corpus has many small files; do not count each as 4 MB.
    "spark.sql.files.openCostInBytes": str(256 * 1024),
    # The casts of a wide table can outgrow 8000 bytes of bytecode, beyond which the
    # JVM only interprets a method. Spark then splits the projection instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

_CHECKPOINT_CONF = "spark.checkpoint.dir"
_local_dirs: dict[str, str] = {}


def build_session(app_name: str = "docmart", master: str | None = None, **conf: str) -> SparkSession:
    """A session with :data:`RECOMMENDED_CONF`; keyword settings use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = RECOMMENDED_CONF | {k.replace("__", "."): v for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster, or a temporary folder in local mode."""
    shared = spark.conf.get(_CHECKPOINT_CONF, None)
    if shared:
        return shared.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"set {_CHECKPOINT_CONF} to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="docmart-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, label: str, keep: bool = False) -> str:
    """A fresh path below :func:`work_dir`; never one that exists already. What is written there
    goes when the driver ends, unless ``keep``: then the caller deletes it."""
    path = f"{work_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if keep:
        return path
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(folder)
    fs.deleteOnExit(folder)
    return f"{path}/data"


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder through the file system that owns it (local, HDFS, object store)."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.delete(hadoop_path, True))


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hadoop_path))
