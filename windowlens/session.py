"""Session helpers.

Operators never create sessions; only entry points (bench, tests, the
command line) call :func:`build_session`.  :func:`work_path` hands out
output folders under the cluster's shared checkpoint folder.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every run wants.  AQE coalesces small shuffles at run time (so no
# hard-coded partition count is needed for the tiny window tables) and splits
# skewed join partitions.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str = "local[*]", app_name: str = "windowlens",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting must point at shared storage and is only read
    here; without it an error is raised, because a folder of the driver's
    machine is not shared.  Only a local master (tests), where driver and
    tasks are one machine, gets a fresh folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    local = tempfile.mkdtemp(prefix="windowlens-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    """A new, unique output folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/windowlens/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Remove a work folder through the file system Spark uses."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def size_shuffles(spark: SparkSession, input_bytes: int, target_partition_bytes: int = 256 << 20,
                  min_partitions: int = 8) -> int:
    """Set ``spark.sql.shuffle.partitions`` so that a shuffle of the whole
    input would give partitions of about ``target_partition_bytes`` (AQE
    then coalesces smaller shuffles to ``advisoryPartitionSizeInBytes``).
    For 100 TB of logs and 256 MB this is about 400k.  Returns the value
    set."""
    n = max(min_partitions, -(-input_bytes // target_partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(min(target_partition_bytes, 256 << 20)))
    return n


def input_size(spark: SparkSession, path: str) -> int:
    """Total bytes of the files under ``path``, from a file listing (the
    ``binaryFile`` source with only its ``length`` column; contents are not
    read)."""
    from pyspark.sql import functions as F
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .agg(F.sum("length").alias("bytes")))
    return int(files.first()["bytes"] or 0)
