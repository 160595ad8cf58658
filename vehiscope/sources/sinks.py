"""Sinks and publishing: S6, S7, S9 and L1-L4.

Every write is a full overwrite (re-running a job is idempotent, which is
what makes retried tasks and lost executors harmless); published tables are
versions of a log, so a reader sees one load or the next. CSV is produced only
at an edge, with header and ``"`` as quote and escape.
"""

from __future__ import annotations

import logging
import math
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from . import versions

_LOG = logging.getLogger(__name__)
TARGET_FILE_BYTES = 256 << 20


def write_layer(df: DataFrame, path: str, fmt: str = "parquet",
                partition_by: Sequence[str] | None = None) -> str:
    """Write a dataset with full overwrite (no index column exists)."""
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        # keep edge whitespace: Spark's CSV writer trims it by default
        w = (w.option("header", True).option("quote", '"').option("escape", '"')
             .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def write_layers(frames: Mapping[str, DataFrame], root: str, fmt: str = "parquet") -> dict[str, str]:
    """Write several datasets below ``root``; returns name -> path."""
    return {n: write_layer(df, f"{root.rstrip('/')}/{n}", fmt) for n, df in frames.items()}


def layer_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """Rows per written dataset, read back from storage: (name, rows)."""
    parts = [spark.read.parquet(p).agg(F.count(F.lit(1)).alias("rows"))
             .select(F.lit(n).alias("name"), "rows") for n, p in paths.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _bytes(spark: SparkSession, path: str) -> DataFrame:
    """Total bytes of the data files below ``path`` (file metadata only: the
    binary content column is never read)."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True)
             .option("pathGlobFilter", "part-*").load(path))
    return files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def compare_formats(df: DataFrame, out_dir: str) -> DataFrame:
    """Write ``df`` as CSV and as Parquet; (format, rows read back, bytes,
    pct_smaller_than_csv, smaller_than_csv)."""
    spark = df.sparkSession
    root = out_dir.rstrip("/")
    write_layer(df, f"{root}/csv", "csv")
    write_layer(df, f"{root}/parquet", "parquet")
    back = {"csv": spark.read.option("header", True).option("multiLine", True).option("quote", '"')
            .option("escape", '"').schema(df.schema).csv(f"{root}/csv"), "parquet": spark.read.parquet(f"{root}/parquet")}
    size = {n: _bytes(spark, f"{root}/{n}") for n in back}
    csv_bytes = size["csv"].select("bytes").scalar()
    parts = [df_.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(n).alias("format"), "rows", size[n].select("bytes").scalar().alias("bytes")) for n, df_ in back.items()]
    return parts[0].unionByName(parts[1]).withColumns({
        "pct_smaller_than_csv": (1 - F.try_divide(F.col("bytes"), csv_bytes)) * 100,
        "smaller_than_csv": F.col("bytes") < csv_bytes})


# ----------------------------------------------------------------- publishing
# Data goes to new folders, one log entry makes all tables of a load visible
# (`sources.versions`), then the catalog's tables are pointed to the folders.
def _root(spark: SparkSession, path: str | None, name: str) -> str:
    return path.rstrip("/") if path else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}.versions"


def schema_changes(before: T.StructType, after: T.StructType) -> list[tuple[str, str | None, str | None]]:
    """(column, type before, type now) of columns that came, went or changed."""
    old, new = ({f.name: f.dataType.simpleString() for f in s} for s in (before, after))
    return [(c, old.get(c), new.get(c)) for c in dict.fromkeys([*old, *new]) if old.get(c) != new.get(c)]


class SchemaChanged(ValueError):
    """The columns of a table differ from those of its published version."""


def _checked(name: str, before: dict | None, df: DataFrame, on_schema_change: str) -> None:
    """Report columns that differ from the published ones, or refuse them."""
    if on_schema_change not in ("replace", "fail"):
        raise ValueError("on_schema_change is 'replace' or 'fail'")
    found = schema_changes(T.StructType.fromJson(before["schema"]), df.schema) if before else []
    if found and on_schema_change == "fail":
        raise SchemaChanged(f"{name}: {found}")
    if found:
        _LOG.warning("the columns of %s change: %s", name, found)


def point_table(spark: SparkSession, table: str, published: dict) -> None:
    """Let a catalog table show a published version. The location of a table with
    the same columns is switched in one step; only a table whose columns change is
    dropped and created (readers that must not see that gap use
    `versions.read_release`)."""
    path, fmt = published["paths"][0], published["format"]
    schema = T.StructType.fromJson(published["schema"])
    if spark.catalog.tableExists(table):
        if not schema_changes(spark.table(table).schema, schema):
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
            return
        spark.sql(f"DROP TABLE {table}")  # external: its files stay
    spark.catalog.createTable(table, path=path, source=fmt, schema=schema)


def publish_table(df: DataFrame, table: str, fmt: str = "parquet",
                  path: str | None = None, observe: Observation | None = None,
                  on_schema_change: str = "replace", keep: int | None = None) -> str:
    """L1: full refresh: create or replace ``table`` from ``df``; the schema
    comes from the data, nothing is merged. The data goes to a new folder below
    ``path`` (by default one of the table's own in the warehouse) and is published
    as the next version there, to which the table is then switched; a load that
    fails changes nothing. ``observe`` counts the rows while they are written;
    ``keep`` is the number of versions whose files stay (None: all)."""
    spark = df.sparkSession
    root = _root(spark, path, table)
    if observe is not None:
        df = df.observe(observe, F.count(F.lit(1)).alias("rows"))
    parent = versions.entry(spark, root)
    _checked(table, parent["tables"].get(versions.DATA) if parent else None, df, on_schema_change)
    new = versions.commit(spark, root, {versions.DATA: versions.write_data(df, root, fmt)}, "publish", parent)
    point_table(spark, table, new["tables"][versions.DATA])
    if keep is not None:
        versions.vacuum(spark, root, keep)
    return table


def analyze_table(spark: SparkSession, table: str) -> None:
    """L2: refresh table statistics for the optimizer."""
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")


def files_for(total_bytes: int, target_file_bytes: int = TARGET_FILE_BYTES) -> int:
    """Number of files of about the target size."""
    return max(1, math.ceil(total_bytes / target_file_bytes))


def compact_table(spark: SparkSession, table: str, path: str,
                  target_file_bytes: int = TARGET_FILE_BYTES, keep: int | None = None) -> int:
    """L3: rewrite ``table`` into files of about ``target_file_bytes``, published
    as the next version at ``path``, to which the table is then switched.
    Returns the number of files asked for."""
    files = spark.table(table).inputFiles()
    size = (spark.read.format("binaryFile").load(files).agg(F.sum("length")).first()[0] or 0) if files else 0
    n = files_for(size, target_file_bytes)
    publish_table(spark.table(table).repartition(n), table, path=path, keep=keep)
    return n


def load_all(spark: SparkSession, datasets: Mapping[str, str], database: str | None = None,
             fmt: str = "parquet", location: str | None = None, on_schema_change: str = "replace",
             keep: int | None = None) -> DataFrame:
    """L4: publish the datasets (name -> Parquet path) as one version, and each as
    a table; a missing input fails only that dataset, and so do changed columns
    with ``on_schema_change="fail"``: what was published of it stays. Returns
    (dataset, ok, rows, status) where status is SUCCESS or PARTIAL FAILURE for the
    whole load. Rows are counted while they are written, the writes are submitted
    together, and an error of one of them publishes nothing."""
    root = _root(spark, location, database or "default")
    parent = versions.entry(spark, root)
    before = parent["tables"] if parent else {}

    def load(item: tuple[str, str]) -> dict | None:
        name, path = item
        try:
            src = spark.read.parquet(path)
            _checked(name, before.get(name), src, on_schema_change)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        except SchemaChanged as e:
            _LOG.warning("not loaded: %s", e)
            return None
        return versions.write_data(src, root, fmt)

    with ThreadPoolExecutor(max_workers=max(1, min(8, len(datasets)))) as pool:
        loaded = {n: t for n, t in zip(datasets, pool.map(load, datasets.items())) if t}
    if loaded:
        versions.commit(spark, root, {**before, **loaded}, "load", parent)
    for name, published in loaded.items():
        table = f"{database}.{name}" if database else name
        point_table(spark, table, published)
        analyze_table(spark, table)
    if keep is not None and loaded:
        versions.vacuum(spark, root, keep)
    status = "SUCCESS" if len(loaded) == len(datasets) else "PARTIAL FAILURE"
    return spark.createDataFrame([(n, n in loaded, loaded[n]["rows"] if n in loaded else None, status) for n in datasets],
                                 "dataset string, ok boolean, rows long, status string")
