"""Incremental load (documented capability X11) as a Structured Streaming job.

New snapshot files of a dataset land in a folder; each micro-batch is written as
one delta below the published dataset and merged when the dataset is read: per
key the latest row by ``order_by`` wins, on a tie the row of the newer delta.
`compact` folds all deltas into one when a reader asks for it; nothing is
rewritten per batch.

A delta is numbered after the target's own finished versions (a finished write
has its ``_SUCCESS`` file), never after the stream's batch ids, so a stream with a
new checkpoint continues the dataset. A batch that is replayed after a failure
writes its rows once more, which the merge makes one again. One writer per
dataset at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedupe import dedupe_first


def _listing(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the finished versions below ``root`` (names only, no data)."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = []
    for s in fs.listStatus(path):
        name = s.getPath().getName()
        if name.startswith("version=") and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")):
            found.append(int(name.partition("=")[2]))
    return sorted(found)


def snapshot_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/version={int(version)}"


def _live(spark: SparkSession, root: str) -> tuple[list[str], int]:
    """Paths of the newest compacted base and of the deltas after it, oldest
    first, and the newest version number (0: nothing is published)."""
    root = root.rstrip("/")
    bases, deltas = _listing(spark, f"{root}/base"), _listing(spark, f"{root}/delta")
    since = bases[-1] if bases else 0
    paths = [snapshot_path(f"{root}/base", since)] if bases else []
    paths += [snapshot_path(f"{root}/delta", v) for v in deltas if v > since]
    return paths, max([0, *bases, *deltas])


def read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    """One delta as written; a version that is not there is an error."""
    if version not in _listing(spark, f"{root.rstrip('/')}/delta"):
        raise ValueError(f"{root} has no finished version {version}")
    return spark.read.parquet(snapshot_path(f"{root.rstrip('/')}/delta", version))


def append_delta(batch: DataFrame, root: str) -> int:
    """Publish the rows of a batch as the next version; returns its number."""
    _, newest = _live(batch.sparkSession, root)
    # an unfinished write of the same number is overwritten
    batch.write.mode("overwrite").parquet(snapshot_path(f"{root.rstrip('/')}/delta", newest + 1))
    return newest + 1


def merge_latest(parts: Sequence[DataFrame], keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """Per key, the latest row by ``order_by`` over all parts (oldest first): a
    late-arriving older row does not overwrite a newer one; on a tie the later
    part wins, within a part the first by all columns. Keep-first runs as a
    partial ``WindowGroupLimit`` before its shuffle."""
    names = set(parts[0].columns)
    union = None
    for k, p in enumerate(parts):
        if set(p.columns) != names:
            raise ValueError(f"the columns differ: {sorted(names ^ set(p.columns))}")
        p = p.withColumn("_vs_part", F.lit(k))
        union = p if union is None else union.unionByName(p)
    rest = [c for c in parts[0].columns if c not in keys]
    order = [*order_by, F.col("_vs_part").desc(), *[F.col(c).asc_nulls_last() for c in rest]]
    return dedupe_first(union, list(keys), order).drop("_vs_part")


def latest_version(spark: SparkSession, root: str, keys: Sequence[str],
                   order_by: Sequence[Column]) -> DataFrame:
    """The dataset as of now: the base and the deltas after it, merged."""
    paths, _ = _live(spark, root)
    if not paths:
        raise ValueError(f"nothing is published at {root}")
    return merge_latest([spark.read.parquet(p) for p in paths], keys, order_by)


def compact(spark: SparkSession, root: str, keys: Sequence[str], order_by: Sequence[Column]) -> int:
    """Write the merged dataset as a new base; readers use it once it is finished."""
    _, newest = _live(spark, root)
    merged = latest_version(spark, root, keys, order_by)
    merged.write.mode("overwrite").parquet(snapshot_path(f"{root.rstrip('/')}/base", newest))
    return newest


def start_incremental_load(spark: SparkSession, source_dir: str, schema: T.StructType,
                           target_root: str, checkpoint: str, available_now: bool = True,
                           max_files_per_trigger: int | None = None,
                           publish: Callable[[DataFrame], object] | None = None):
    """Start the streaming load; returns the ``StreamingQuery``. ``publish`` takes
    each micro-batch, by default as a delta of ``target_root``.

    ``available_now`` processes everything present and stops (a scheduled
    incremental run); otherwise the query keeps running on new files.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)

    def each(batch: DataFrame, batch_id: int) -> None:
        publish(batch) if publish else append_delta(batch, target_root)

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
