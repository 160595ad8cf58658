"""Skew-safe join of rows to a keyed table (at most one right row per key).

When the right side is an aggregate on the join key, its shuffle already
partitions the join, so AQE's skew-join splitting cannot apply and a key that
holds a third of the rows would be joined in one task. Here only the hot keys
are salted:

* a key is hot when it holds more than ``HOT_FACTOR`` times the mean share
  ``total / P`` (``P`` = shuffle partitions), as in AQE; fewer than
  ``P / HOT_FACTOR`` keys can be hot, so the hot-key table is broadcast with a
  proven bound (at 100,000 partitions under 20,000 keys, a few MB);
* a hot key's left rows are spread over ``ceil(n * P / total)`` buckets by a
  deterministic row hash (stable under task retries) and its right row is
  replicated once per bucket, so every bucket is about one partition's share;
  the replication adds at most ``2 * P`` right rows in total. Rows that agree
  in every column share a bucket, so callers with many identical rows collapse
  them first (`dedupe.flag_duplicates`);
* all other keys keep bucket 0, i.e. a plain equi-join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_FACTOR = 5


def _cond(left: DataFrame, right: DataFrame, lk: Sequence[str], rk: Sequence[str],
          null_safe: bool) -> Column:
    cond = None
    for a, b in zip(lk, rk):
        c = left[a].eqNullSafe(right[b]) if null_safe else (left[a] == right[b])
        cond = c if cond is None else cond & c
    return cond


def hot_keys(counts: DataFrame, keys: Sequence[str], n_col: str,
             partitions: int | None = None) -> DataFrame:
    """(keys, buckets) of the keys holding more than ``total / partitions``
    times
    HOT_FACTOR rows; the total is an uncorrelated scalar subquery."""
    spark = counts.sparkSession
    p = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.sum(n_col)).scalar()
    buckets = F.least(F.ceil(F.col(n_col) * p / total), F.lit(p)).cast("int")
    return counts.filter(F.col(n_col) * p > HOT_FACTOR * total).select(*keys, buckets.alias("_vs_b"))


def skew_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], hot: DataFrame,
                   how: str = "left", null_safe: bool = False) -> DataFrame:
    """Join ``left`` to ``right`` (unique per key) on ``keys``, salting the
    ``hot`` keys (output of ``hot_keys``) across buckets."""
    hk = [f"_vs_h{i}" for i in range(len(keys))]
    rk = [f"_vs_r{i}" for i in range(len(keys))]
    # bounded: fewer than P hot keys (see hot_keys)
    h = F.broadcast(hot.select(*[F.col(k).alias(x) for k, x in zip(keys, hk)], "_vs_b"))
    lt = left.join(h, _cond(left, h, keys, hk, null_safe), "left")
    row_hash = F.xxhash64(*[F.col(c) for c in left.columns])
    lt = (lt.withColumn("_vs_s", F.when(F.col("_vs_b").isNotNull(),
                                        F.pmod(row_hash, F.col("_vs_b"))).otherwise(F.lit(0))
                        .cast("int"))
            .drop("_vs_b", *hk))
    others = [c for c in right.columns if c not in keys]
    r0 = right.select(*[F.col(k).alias(x) for k, x in zip(keys, rk)], *others)
    rt = r0.join(h, _cond(r0, h, rk, hk, null_safe), "left")
    salts = F.when(F.col("_vs_b").isNotNull(), F.sequence(F.lit(0), F.col("_vs_b") - 1)) \
             .otherwise(F.array(F.lit(0)))
    rt = rt.select(*rk, *others, F.explode(salts).alias("_vs_rs"))
    cond = _cond(lt, rt, keys, rk, null_safe) & (lt["_vs_s"] == rt["_vs_rs"])
    return lt.join(rt, cond, how).drop("_vs_s", "_vs_rs", *rk)
