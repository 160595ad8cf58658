"""Helpers shared by the training-data operators.

Intermediate tables go to a fresh folder below the shared folder that the
cluster names in ``spark.checkpoint.dir`` (see ``vehiscope.session``), so a
lost executor re-reads files and two runs never meet in one folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vehiscope.session import ensure_checkpoint_dir

#: The word patterns of the operators' contracts.
BLANK = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder, never used before, in the cluster's shared folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/vehiscope-llm/{name}-{uuid.uuid4().hex}"


_SCOPES: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Inside, `written` tables are only needed until the end, where their
    folders are deleted, but for those that are written with ``keep``."""
    made: list[str] = []
    _SCOPES.append(made)
    try:
        yield
    finally:
        _SCOPES.pop()
        for folder in made:
            _delete(spark, folder)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(*tables: DataFrame) -> None:
    """Delete `written` tables that no later step reads. Only inside `scratch`:
    elsewhere a result may still be read from them."""
    for t in tables:
        folder = getattr(t, "_vehiscope_folder", None)
        if folder and _SCOPES and folder in _SCOPES[-1]:
            _SCOPES[-1].remove(folder)
            _delete(t.sparkSession, folder)


def written(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` to a fresh shared folder and read it back: a durable cut of
    the lineage that survives the loss of executors."""
    spark = df.sparkSession
    path = run_folder(spark, name)
    df.write.parquet(path)
    scopes = _SCOPES[:-1] if keep else _SCOPES
    if scopes:
        scopes[-1].append(path)
    # the shuffle files of the job are of no use any more; Spark deletes them as
    # soon as a collection on the driver finds them out of reach, which may
    # otherwise take half an hour
    spark._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out._vehiscope_folder = path
    return out


def words_of(text: Column) -> Column:
    """The blank-separated words of a text as an array (null or blank: empty)."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), BLANK), lambda w: w != "")


def lower_ascii(text: Column) -> Column:
    """A-Z lower-cased, every other character unchanged."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


#: Bits of a set that spares a shuffle the rows that are surely not wanted.
BITSET = 1 << 23


def bit_set(keys: DataFrame, name: str) -> Column:
    """A set of the long column ``name`` as a scalar subquery: an array of
    BITSET / 64 longs, of the same size for any number of keys. It only ever
    lets too much through; an exact join follows."""
    at = F.pmod(F.xxhash64(name), F.lit(BITSET))
    words = keys.groupBy(F.floor(at / 64).alias("i")).agg(
        F.expr(f"bit_or(shiftleft(1L, cast(pmod(xxhash64(`{name}`), 64L) as int)))").alias("v"))
    full = keys.sparkSession.range(BITSET // 64).select(F.col("id").alias("i")).join(words, "i", "left")
    return full.agg(F.transform(F.array_sort(F.collect_list(
        F.struct("i", F.coalesce("v", F.lit(0).cast("long")).alias("v")))), lambda x: x["v"]).alias("a")).scalar()


def in_bit_set(bits: Column, name: str) -> Column:
    """Whether ``name`` may be in the set (never false for a member)."""
    at = F.floor(F.pmod(F.xxhash64(name), F.lit(BITSET)) / 64).cast("int")
    bit = F.expr(f"shiftleft(1L, cast(pmod(xxhash64(`{name}`), 64L) as int))")
    return bit.bitwiseAND(F.get(bits, at)) != 0


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected graph.

    ``edges`` has two columns ``a`` and ``b`` of one orderable type. Returns
    ``node, root`` for every node of an edge, ``root`` being the smallest node
    of its component. Self-loops, repeated and null-ended edges are allowed
    (null-ended ones are ignored); an empty table gives an empty result.

    Alternating large-star and small-star rounds: each joins the edges with the
    smallest neighbour of a node, which is a partial aggregate, so the
    neighbours of a node are never collected; the join on a busy node is a plain
    join that skew handling splits. Each round is checkpointed to the shared
    folder.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    e = (edges.select("a", "b").where("a is not null and b is not null and a <> b")
         .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
         .distinct().checkpoint())
    mark = None
    for _ in range(max_rounds):
        # large star: the larger neighbours of a node move to its smallest one
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = (both.where("v > u").join(low, F.col("u") == F.col("c"))
                 .select(F.col("v").alias("a"), F.col("m").alias("b")).distinct())
        # small star: a node and its smaller neighbours move to the smallest
        low = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), "m")
        e = (large.join(low, F.col("a") == F.col("c"))
             .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")),
                                       F.struct(F.col("b").alias("a"), F.col("m").alias("b"))))
                     .alias("e")).select("e.a", "e.b").where("a <> b").distinct().checkpoint())
        seen = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        mark = tuple(seen)
    raise RuntimeError("the components did not settle; raise max_rounds")


def fresh(df: DataFrame, *bases: str) -> list[str]:
    """Column names that do not occur in ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for base in bases:
        name = base
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
