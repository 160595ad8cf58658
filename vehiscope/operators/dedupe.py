"""De-duplication (K1-K6) and group-size attachment.

Keep-first needs a declared total order (trap T4): a bare ``dropDuplicates``
keeps an arbitrary row. ``row_number() = 1`` lets Catalyst insert a partial
``WindowGroupLimit`` BEFORE the shuffle, so each map task forwards at most one
row per key: a key holding a third of all rows costs one row per task, not a
third of the data in one reducer.

Group sizes (A2, K6) are computed with a partial aggregate joined back instead
of an unbounded window (which would put a whole hot group in one task); the
join back salts the hot keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .skew import hot_keys, skew_safe_join


def _order(order_by: Sequence) -> list[Column]:
    if not order_by:
        raise ValueError("keep-first needs an explicit order_by (a total order)")
    return [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_by]


def dedupe_first(df: DataFrame, keys: Sequence[str], order_by: Sequence | None) -> DataFrame:
    """K1/K2/K3/K5: keep the first row per key (nulls in keys compare equal).

    ``order_by=None`` orders by every column, a total order up to identical
    rows (whose choice does not change the result)."""
    if order_by is None:
        order_by = [c for c in df.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*_order(order_by))
    return (df.withColumn("_vs_rn", F.row_number().over(w))
              .filter(F.col("_vs_rn") == 1)
              .drop("_vs_rn"))


def distinct(df: DataFrame) -> DataFrame:
    """K4: whole-row distinct (nulls compare equal)."""
    return df.distinct()


def attach_group_count(df: DataFrame, keys: Sequence[str], name: str,
                       null_keys_match: bool = True,
                       counts_from: DataFrame | None = None) -> DataFrame:
    """Attach the row count of each key group to every row.

    The counts are a partial aggregate (one row per key and task before the
    shuffle); the join back salts hot keys (``operators.skew``), so a key
    holding a third of the rows is spread over many tasks. ``null_keys_match``
    groups null keys together (pandas ``duplicated``); otherwise a null key
    gets no count (pandas ``groupby`` + ``merge``). ``counts_from`` counts
    another DataFrame with the same rows per key (e.g. the input of a
    row-preserving join), so the counting jobs do not re-run that join.
    """
    src = df if counts_from is None else counts_from
    counts = src.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    hot = hot_keys(counts, keys, name)
    return skew_safe_join(df, counts, keys, hot, "left", null_safe=null_keys_match)


def flag_duplicates(df: DataFrame, keys: Sequence[str], name: str = "dup_count") -> DataFrame:
    """K6: every member of a duplicate group (``keep=False``) with the group size.

    Identical rows are counted first (a partial aggregate) and come apart again
    after the join, so a group of identical rows is never one task's load."""
    once = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_vs_times"))
    counts = once.groupBy(*keys).agg(F.sum("_vs_times").alias(name))
    hot = hot_keys(once.groupBy(*keys).agg(F.count(F.lit(1)).alias("_vs_n")), keys, "_vs_n")
    found = skew_safe_join(once, counts, keys, hot, "left", null_safe=True).filter(F.col(name) > 1)
    # two steps keep the arrays short for a row repeated very often
    step = F.lit(65_536).cast("bigint")
    first = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_vs_times"), step))
    found = found.withColumn("_vs_from", first)
    upto = F.least(F.col("_vs_from") + step - 1, F.col("_vs_times"))
    return (found.withColumn("_vs_i", F.explode(F.sequence("_vs_from", upto)))
            .drop("_vs_times", "_vs_from", "_vs_i"))
