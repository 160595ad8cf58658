"""Row expansion (E1-E3): the dual-fuel explosion.

E1 is one generator over one scan (``inline`` of a filtered 2-element array)
instead of the reference's self-union, so the input is read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_ranked(df: DataFrame, primary: str = "primary_fuel",
                   secondary: str = "secondary_fuel", value: str = "fuel_used",
                   rank: str = "fuel_rank") -> DataFrame:
    """Always emit (primary, 1), even when primary is null; emit
    (secondary, 2) only when secondary is not null."""
    pair = F.array(
        F.struct(F.col(primary).alias(value), F.lit(1).alias(rank)),
        F.struct(F.col(secondary).alias(value), F.lit(2).alias(rank)),
    )
    kept = F.filter(pair, lambda x: (x[rank] == 1) | x[value].isNotNull())
    return df.select("*", F.inline(kept))


def explode_by_union(df: DataFrame, primary: str = "primary_fuel",
                     secondary: str = "secondary_fuel", value: str = "fuel_used",
                     rank: str = "fuel_rank") -> DataFrame:
    """The same result as a bag UNION ALL by column name (two scans)."""
    first = df.withColumns({value: F.col(primary), rank: F.lit(1)})
    second = df.filter(F.col(secondary).isNotNull()).withColumns(
        {value: F.col(secondary), rank: F.lit(2)})
    return first.unionByName(second)


def explosion_metrics(df: DataFrame, secondary: str = "secondary_fuel") -> DataFrame:
    """Rows before, dual-fuel rows n, rows after (= before + n), one pass."""
    n: Column = F.count_if(F.col(secondary).isNotNull())
    before = F.count(F.lit(1))
    return df.agg(before.alias("rows_before"), n.alias("dual_fuel"),
                  (before + n).alias("rows_after"))
