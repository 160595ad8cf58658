"""Upserts at scale (documented capability X11): touched buckets only.

A dataset is kept in buckets by the hash of its key, one folder a bucket, and
published through the version log (`vehiscope.sources.versions`). An upsert
writes the changed rows alone, in the same buckets, and its log entry names the
buckets that it touches. Reading the newest state takes the untouched buckets of
the base as they are, without any shuffle, and merges base and deltas in the
touched ones. `compact` rewrites only the touched buckets. Per key the row with
the greatest ``order_by`` values wins, on a tie the one of the newer delta.

Rows are reduced to one a key before they are dealt to buckets, so a key that
holds a third of an update costs one row a task. Concurrent upserts are added one
after the other; a compaction that meets an upsert keeps its delta.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedupe import dedupe_first
from ..sources import versions as V
from .incremental import merge_latest, start_incremental_load

BUCKET = "_vs_bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _newest(order_by: Sequence[str]) -> list[Column]:
    return [F.col(c).desc_nulls_last() for c in order_by]


def _written(df: DataFrame, root: str, keys: Sequence[str], order_by: Sequence[str], buckets: int) -> dict:
    """Write one row a key into bucket folders; the folder and its buckets."""
    rest = [F.col(c).asc_nulls_last() for c in df.columns if c not in keys]
    rows = dedupe_first(df, list(keys), [*_newest(order_by), *rest])
    return _dealt(rows, root, keys, buckets)


def _dealt(rows: DataFrame, root: str, keys: Sequence[str], buckets: int) -> dict:
    folder = V.new_folder(root)
    (rows.withColumn(BUCKET, bucket_of(keys, buckets)).repartition(BUCKET)
     .write.partitionBy(BUCKET).parquet(folder))
    fs, at = V._hadoop(rows.sparkSession, folder)
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    return {"folder": folder, "buckets": sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{BUCKET}="))}


def _table(spec: dict, base: list[dict], deltas: list[dict]) -> dict:
    """A log table; ``base`` and ``deltas`` are folders with buckets. A bucket is
    in the base at most once."""
    own = {**spec, "base": [b for b in base if b["buckets"]], "deltas": deltas}
    return {**own, "paths": sorted({p["folder"] for p in [*own["base"], *deltas]}), "rows": None}


def create(df: DataFrame, root: str, keys: Sequence[str], order_by: Sequence[str], buckets: int = 256) -> int:
    """Publish a dataset as the next version at ``root``; its number."""
    spark = df.sparkSession
    spec = {"schema": df.schema.jsonValue(), "keys": list(keys), "order_by": list(order_by), "n_buckets": buckets}
    base = _written(df, root, keys, order_by, buckets)
    return V.commit(spark, root, {V.DATA: _table(spec, [base], [])}, "create", V.entry(spark, root))["version"]


def _state(spark: SparkSession, root: str, version: int | None = None) -> tuple[dict, dict]:
    entry = V.entry(spark, root, version)
    if entry is None:
        raise ValueError(f"nothing is published at {root}")
    return entry, entry["tables"][V.DATA]


def _spec(table: dict) -> dict:
    return {k: table[k] for k in ("schema", "keys", "order_by", "n_buckets")}


def upsert(updates: DataFrame, root: str, tries: int = 20) -> int:
    """Add changed rows as a delta; the number of the version. The columns must
    be those of the dataset."""
    spark = updates.sparkSession
    _, table = _state(spark, root)
    names = [f["name"] for f in table["schema"]["fields"]]
    if set(names) != set(updates.columns):
        raise ValueError(f"the columns differ: {sorted(set(names) ^ set(updates.columns))}")
    kinds = {f.name: f.dataType for f in T.StructType.fromJson(table["schema"])}
    own = updates.select(*[F.col(c).cast(kinds[c]).alias(c) for c in names])
    delta = _written(own, root, table["keys"], table["order_by"], table["n_buckets"])
    for _ in range(tries):
        entry, now = _state(spark, root)
        if _spec(now) != _spec(table):
            raise V.Conflict(f"{root} was created anew")
        try:
            return V.commit(spark, root, {V.DATA: _table(_spec(now), now["base"], [*now["deltas"], delta])},
                            "upsert", entry)["version"]
        except V.Conflict:
            continue
    raise V.Conflict(f"no version of {root} was free in {tries} tries")


def _paths(parts: Iterable[dict], wanted: set[int] | None = None, but: set[int] = frozenset()) -> list[str]:
    """Bucket folders, of ``wanted`` buckets (None: all) that are not in ``but``."""
    return [f"{p['folder']}/{BUCKET}={b}" for p in parts for b in p["buckets"]
            if (wanted is None or b in wanted) and b not in but]


def _read(spark: SparkSession, table: dict, paths: list[str]) -> DataFrame:
    return V.frame(spark, {"schema": table["schema"], "paths": paths})


def _merged(spark: SparkSession, table: dict, wanted: set[int]) -> DataFrame:
    """The state of some buckets, from the base and the deltas after it."""
    parts = [_read(spark, table, _paths(table["base"], wanted))]
    parts += [_read(spark, table, _paths([d], wanted)) for d in table["deltas"] if wanted & set(d["buckets"])]
    return merge_latest(parts, table["keys"], _newest(table["order_by"])) if len(parts) > 1 else parts[0]


def _touched(table: dict) -> set[int]:
    return {b for d in table["deltas"] for b in d["buckets"]}


def current(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The dataset as of a version: untouched buckets as they lie, touched ones
    merged."""
    _, table = _state(spark, root, version)
    touched = _touched(table)
    still = _read(spark, table, _paths(table["base"], but=touched))
    return still.unionByName(_merged(spark, table, touched)) if touched else still


def compact(spark: SparkSession, root: str, tries: int = 20) -> int:
    """Rewrite the touched buckets as part of the base; the number of the version."""
    entry, table = _state(spark, root)
    touched = _touched(table)
    if not touched:
        return entry["version"]
    new = _dealt(_merged(spark, table, touched), root, table["keys"], table["n_buckets"])
    for _ in range(tries):
        entry, now = _state(spark, root)
        done = len(table["deltas"])
        if now["base"] != table["base"] or now["deltas"][:done] != table["deltas"]:
            raise V.Conflict(f"the base of {root} was rewritten by another writer")
        base = [{**b, "buckets": [k for k in b["buckets"] if k not in touched]} for b in table["base"]] + [new]
        try:
            return V.commit(spark, root, {V.DATA: _table(_spec(now), base, now["deltas"][done:])}, "compact", entry)["version"]
        except V.Conflict:
            continue
    raise V.Conflict(f"no version of {root} was free in {tries} tries")


def _lists(table: dict) -> dict[int, list[str]]:
    """The folders that define each bucket."""
    out: dict[int, list[str]] = {}
    for p in [*table["base"], *table["deltas"]]:
        for b in p["buckets"]:
            out.setdefault(b, []).append(p["folder"])
    return out


def versions_of_changed_buckets(spark: SparkSession, root: str, old: int, new: int) -> tuple[DataFrame, DataFrame]:
    """The rows of both versions in the buckets that differ, for
    `vehiscope.plans.maintenance.signed_changes`: the other buckets are not read."""
    (_, a), (_, b) = _state(spark, root, old), _state(spark, root, new)
    if _spec(a) != _spec(b):
        raise ValueError(f"versions {old} and {new} of {root} have different keys, buckets or columns")
    la, lb = _lists(a), _lists(b)
    differ = {k for k in set(la) | set(lb) if la.get(k) != lb.get(k)}
    return _merged(spark, a, differ), _merged(spark, b, differ)


def start_upsert_load(spark: SparkSession, source_dir: str, schema: T.StructType, root: str, checkpoint: str, **options):
    """Structured Streaming: every micro-batch of new files is one upsert into a
    dataset that `create` has published. A replayed batch changes nothing, for
    its rows merge with themselves."""
    return start_incremental_load(spark, source_dir, schema, root, checkpoint,
                                  publish=lambda batch: upsert(batch, root), **options)
