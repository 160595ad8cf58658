"""Session helpers: building a session and the shared checkpoint folder.

On a cluster the folder that survives executor loss is the one the cluster
names in ``spark.checkpoint.dir``; it is read from the session and only set
here when it is unset (local tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str = "local[*]", shuffle_partitions: int = 8,
              app: str = "vehiscope", extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests. On a cluster use the provided session."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def submitted_session(app: str = "vehiscope", master: str | None = None) -> SparkSession:
    """The session of a submitted program: master, executors and partition counts
    are those of the submission; only settings that results depend on are made."""
    b = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC")
    return (b.master(master) if master else b).getOrCreate()


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Total size of files, folders and glob patterns (file system metadata)."""
    total, conf = 0, spark._jsc.hadoopConfiguration()
    for p in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(p)
        fs = at.getFileSystem(conf)
        total += sum(fs.getContentSummary(s.getPath()).getLength() for s in fs.globStatus(at) or [])
    return total


def size_shuffles(spark: SparkSession, total_bytes: int, target_partition_bytes: int = 256 << 20) -> int:
    """Set the shuffle partitions from the input's size and the slots of the
    cluster, but where the submission names a number; the number in use."""
    name = "spark.sql.shuffle.partitions"
    if not spark.sparkContext.getConf().contains(name):
        slots = spark.sparkContext.defaultParallelism
        spark.conf.set(name, str(max(slots, -(-total_bytes // target_partition_bytes))))
    return int(spark.conf.get(name))


def cluster_conf(total_input_bytes: int, executors: int, cores_per_executor: int = 4,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized to the data for a large cluster (apply at session build).

    Shuffle partitions are sized so that a shuffle of the whole input gives
    ``target_partition_bytes`` per partition (at least 3 waves of tasks); AQE
    then coalesces small partitions and splits skewed ones at runtime, and
    broadcasts a join side only when its measured size is under the
    threshold (a runtime size check with sort-merge join as the fallback).
    """
    slots = executors * cores_per_executor
    parts = max(3 * slots, total_input_bytes // target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(int(parts)),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # split a hot join key even when the join's output partitioning is
        # reused downstream (e.g. P4's distinct on a superset of the join key);
        # costs one extra shuffle instead of one straggler task
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when none is set."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="vehiscope-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder (for materialised layers), in a
    folder of its own for each call: two runs never overwrite each other."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, "vehiscope", uuid.uuid4().hex, *parts])


def materialize(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write ``df`` as Parquet and read it back: cuts lineage durably.

    Unlike ``localCheckpoint`` the result survives executor loss, because it
    lives in shared storage and a lost task re-reads files, not lineage.
    """
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.parquet(path)
