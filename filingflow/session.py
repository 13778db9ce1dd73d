"""Session settings and the shared work folder.

Every job in the package is lazy DataFrame code; the session only fixes the
knobs that decide how the plans run at scale:

* AQE on, with runtime partition coalescing and skew-join splitting, so that a
  symbol that owns a large share of the rows is split at run time instead of
  landing in one task.
* Broadcast joins only through ``spark.sql.autoBroadcastJoinThreshold``; AQE
  checks the real size of the small side after its stage ran and falls back to
  a sort-merge join when it is larger.
* UTC session time zone: log times and submission times carry no zone.
"""

from __future__ import annotations

import ctypes
import os
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str = "local[*]",
    shuffle_partitions: int = 8,
    app_name: str = "filingflow",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Local session for tests and the bench; clusters pass their own conf."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_root(spark: SparkSession) -> str:
    """Shared folder for written tables and checkpoints.

    On a cluster this is ``spark.checkpoint.dir`` as configured by the
    cluster.  Only when it is unset (local tests) a private folder is created
    and registered, so later ``DataFrame.checkpoint()`` calls use it as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="filingflow-work-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    if "://" not in root and not root.startswith("file:"):
        # A root without a scheme belongs to the cluster's default file system.
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        root = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
        root = "/" + root[len("file:"):].lstrip("/") if root.startswith("file:") else root
    return root.rstrip("/")


def new_work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of :func:`work_root` for one job's written tables."""
    root = work_root(spark)
    if root.startswith("file:") or "://" not in root:
        local = root[len("file:"):] if root.startswith("file:") else root
        os.makedirs(local, exist_ok=True)
        return tempfile.mkdtemp(prefix=f"{name}-", dir=local)
    # Remote file systems: a unique name; Spark writers create it.
    import uuid

    return f"{root}/{name}-{uuid.uuid4().hex}"


def give_back() -> None:
    """Memory that was freed goes back to the system (the C library keeps it)."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for a cluster run over ``input_bytes`` of input.

    Scan splits and shuffle partitions of about ``target_partition_bytes``
    (fit in an executor core's memory share with room for sort buffers), at
    least three waves of tasks over all cores; AQE coalesces small shuffle
    partitions and splits skewed ones at run time.
    """
    shuffle = max(3 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }
