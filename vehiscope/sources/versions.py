"""A log of versions for published data (X12, and what L1-L4 and X11 stand on).

A dataset, or a set of tables that belong together, lives below one root: data
folders that are written once and never changed, and a log with one small JSON
entry a version. An entry names the folders of every table, so it alone defines
what a reader sees; it is written after the data, by a rename that fails if the
version is there already. Hence a version is there as a whole or not at all, a
second writer of the same version gets `Conflict`, and a reader that has chosen a
version never sees another one's files. Restoring an older version adds an entry
that names its folders again; no data moves.

Folders are only deleted by `vacuum`, which keeps those of the newest versions.
Object stores without an atomic rename need one that supports it for the log.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The table of a log that holds one dataset.
DATA = "data"

_HISTORY = ("version long, parent long, time string, kind string, restored long, "
            "tables map<string, struct<rows: long>>")


class Conflict(RuntimeError):
    """Another writer has published the version first."""


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path, and the path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _log(root: str) -> str:
    return f"{root.rstrip('/')}/_log"


def numbers(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the published versions, in order (names only)."""
    fs, at = _hadoop(spark, _log(root))
    if not fs.exists(at):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _entry_path(root: str, version: int) -> str:
    return f"{_log(root)}/{version:012d}.json"


def entry(spark: SparkSession, root: str, version: int | None = None) -> dict | None:
    """The entry of a version, by default of the newest (None: no version)."""
    if version is None:
        found = numbers(spark, root)
        if not found:
            return None
        version = found[-1]
    fs, at = _hadoop(spark, _entry_path(root, version))
    if not fs.exists(at):
        raise ValueError(f"{root} has no version {version}")
    lines = spark._jvm.org.apache.commons.io.IOUtils.toString(fs.open(at), "UTF-8")
    return json.loads(lines)


def entry_at(spark: SparkSession, root: str, time: str | dt.datetime) -> dict:
    """The entry of the newest version published at a time or before it. The log
    is searched by halves: times never decrease."""
    stamp = _stamp(time)
    found = numbers(spark, root)
    low, high = 0, len(found)
    while low < high:
        mid = (low + high) // 2
        if entry(spark, root, found[mid])["time"] <= stamp:
            low = mid + 1
        else:
            high = mid
    if not low:
        raise ValueError(f"{root} has no version at {stamp}")
    return entry(spark, root, found[low - 1])


def _stamp(time: str | dt.datetime | None) -> str:
    if time is None:
        time = dt.datetime.now(dt.timezone.utc)
    if isinstance(time, str):
        time = dt.datetime.fromisoformat(time)
    if time.tzinfo is None:
        time = time.replace(tzinfo=dt.timezone.utc)
    return time.astimezone(dt.timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f")


def commit(spark: SparkSession, root: str, tables: Mapping[str, dict], kind: str, parent: dict | None,
           time: str | dt.datetime | None = None, **facts) -> dict:
    """Publish the version after ``parent``; `Conflict` if it is there already."""
    number = parent["version"] + 1 if parent else 1
    stamp = max(_stamp(time), parent["time"] if parent else "")
    new = {"version": number, "parent": parent["version"] if parent else None, "time": stamp, "kind": kind,
           "tables": dict(tables), **facts}
    fs, temp = _hadoop(spark, f"{_log(root)}/.{uuid.uuid4().hex}.tmp")
    out = fs.create(temp, False)
    out.write(bytearray(json.dumps(new).encode()))
    out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    options = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.NONE  # never over an entry
    context = hadoop.FileContext.getFileContext(temp.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(temp, hadoop.Path(_entry_path(root, number)), options)
    except Py4JJavaError as e:
        fs.delete(temp, False)
        if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
            raise Conflict(f"version {number} of {root} is there already") from e
        raise
    return new


def new_folder(root: str) -> str:
    return f"{root.rstrip('/')}/data/{uuid.uuid4().hex}"


def write_data(df: DataFrame, root: str, fmt: str = "parquet") -> dict:
    """Write the data of a table that a later `commit` may publish; its rows are
    counted by the write itself."""
    path, seen = new_folder(root), Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format(fmt).save(path)
    return {"schema": df.schema.jsonValue(), "format": fmt, "paths": [path], "rows": seen.get["rows"]}


def write(df: DataFrame, root: str, kind: str = "write", time: str | dt.datetime | None = None) -> int:
    """Publish ``df`` as the next version of a single dataset; its number."""
    spark = df.sparkSession
    parent = entry(spark, root)
    return commit(spark, root, {DATA: write_data(df, root)}, kind, parent, time)["version"]


def write_release(frames: Mapping[str, DataFrame], root: str, time: str | dt.datetime | None = None,
                  fmt: str = "parquet") -> dict:
    """Publish several tables as one version: all data is written, then one entry
    makes it visible. If a write fails, the old version stays the newest."""
    spark = next(iter(frames.values())).sparkSession
    parent = entry(spark, root)
    with ThreadPoolExecutor(max_workers=min(8, len(frames))) as pool:
        tables = dict(zip(frames, pool.map(lambda df: write_data(df, root, fmt), frames.values())))
    return commit(spark, root, tables, "release", parent, time)


def frame(spark: SparkSession, table: dict) -> DataFrame:
    """The rows that an entry's table names."""
    schema = T.StructType.fromJson(table["schema"])
    if not table["paths"]:
        return spark.createDataFrame([], schema)
    return spark.read.format(table.get("format", "parquet")).schema(schema).load(table["paths"])


def _chosen(spark: SparkSession, root: str, version: int | None, as_of: str | dt.datetime | None) -> dict:
    found = entry_at(spark, root, as_of) if as_of is not None else entry(spark, root, version)
    if found is None:
        raise ValueError(f"nothing is published at {root}")
    return found


def read(spark: SparkSession, root: str, version: int | None = None, as_of: str | dt.datetime | None = None) -> DataFrame:
    """A dataset as of a version or a time, by default the newest."""
    return frame(spark, _chosen(spark, root, version, as_of)["tables"][DATA])


def read_release(spark: SparkSession, root: str, version: int | None = None,
                 as_of: str | dt.datetime | None = None) -> dict[str, DataFrame]:
    """All tables of one version."""
    return {name: frame(spark, t) for name, t in _chosen(spark, root, version, as_of)["tables"].items()}


def restore(spark: SparkSession, root: str, version: int, time: str | dt.datetime | None = None) -> int:
    """Make an older version the newest again: one entry, no data is moved."""
    old = entry(spark, root, version)
    keep = {k: v for k, v in old.items() if k not in ("version", "parent", "time", "kind", "tables", "restored")}
    return commit(spark, root, old["tables"], "restore", entry(spark, root), time, **{**keep, "restored": version})["version"]


def history(spark: SparkSession, root: str) -> DataFrame:
    """``version, parent, time, kind, restored, table, rows``: one row a version
    and table."""
    log = spark.read.schema(_HISTORY).option("pathGlobFilter", "*.json").json(_log(root))
    return log.select("version", "parent", "time", "kind", "restored", F.explode("tables").alias("table", "t")).select(
        "version", "parent", "time", "kind", "restored", "table", "t.rows")


def _folders(entries: list[dict]) -> set[str]:
    return {p for e in entries for t in e["tables"].values() for p in t["paths"]}


def vacuum(spark: SparkSession, root: str, keep: int) -> list[str]:
    """Forget all but the newest ``keep`` versions: their entries go first, then
    the folders that no kept version names. Returns these folders."""
    if keep < 1:
        raise ValueError("at least one version stays")
    found = numbers(spark, root)
    gone, stay = found[:-keep], found[-keep:]
    old = _folders([entry(spark, root, v) for v in gone])
    for v in gone:
        fs, at = _hadoop(spark, _entry_path(root, v))
        fs.delete(at, False)
    # read after the entries went: a restore in between names its folders again
    folders = sorted(old - _folders([entry(spark, root, v) for v in numbers(spark, root) if v >= (stay or [0])[0]]))
    for p in folders:
        fs, at = _hadoop(spark, p)
        fs.delete(at, True)
    return folders
