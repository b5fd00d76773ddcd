"""Session helpers: a tuned local session for tests and benches, and the
shared scratch location taken from ``spark.checkpoint.dir``."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at every scale: AQE re-plans joins and partition
# counts from runtime sizes and splits skewed join partitions.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot key even where that costs a further shuffle: of two joins in a
    # row on one key, the first would otherwise keep the key in one task
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int = 4,
                 shuffle_fraction: float = 0.05, target_partition_bytes: int = 256 << 20,
                 partitions: int | None = None) -> dict[str, str]:
    """Settings sized for a cluster run over ``input_bytes`` of input.

    The questions shuffle narrow per-key summaries (a key plus one or two
    columns), a few percent of the input bytes, so shuffle partitions start at
    about one per ``target_partition_bytes`` of that (at least two waves of
    tasks), or at ``partitions`` if given.  AQE coalesces them to the advisory size at run time and splits skewed
    join partitions.  Scan splits stay at the same size so a task's share
    fits comfortably in executor memory.
    """
    slots = executors * cores_per_executor
    wanted = -(-int(input_bytes * shuffle_fraction) // target_partition_bytes)
    partitions = partitions or max(2 * slots, wanted)
    return {
        **ADAPTIVE_CONF,
        "spark.sql.shuffle.partitions": str(partitions),
        # on a shared cluster, coalesce to the advisory size rather than to the
        # default parallelism: fewer, fuller tasks for small post-aggregation stages
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 << 20),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "postlake", extra: dict | None = None) -> SparkSession:
    """Session for tests and the bench (``local[cores]``, UI off)."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               # remove reliable checkpoints (median weights) once their DataFrames are gone
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("POSTLAKE_DRIVER_MEMORY", "8g")))
    for k, v in {**ADAPTIVE_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a shared file system or object store);
    only a local-mode session gets a temporary folder when it is unset, and
    later calls return that same folder.
    """
    sc = spark.sparkContext
    root = (spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
            or sc.getCheckpointDir())
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
        root = tempfile.mkdtemp(prefix="postlake-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under ``<checkpoint root>/postlake/<application id>/``.

    ``unique=True`` appends a fresh suffix so repeated calls never collide.
    """
    app = spark.sparkContext.applicationId
    tail = "/".join(parts)
    if unique:
        tail = f"{tail}-{uuid.uuid4().hex[:10]}"
    return f"{checkpoint_root(spark)}/postlake/{app}/{tail}"
