"""Sorts, top-k and samples.

``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: every task keeps
only its own k best rows, so no global sort of the input happens. pandas
``nlargest``/``nsmallest`` never return a row whose sort value is missing,
and break ties by position; here ties are broken by a declared ``tie_break``
(trap T4).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _tb(tie_break: Sequence) -> list[Column]:
    if not tie_break:
        raise ValueError("a tie_break is needed: equal values would come in any order")
    return [F.col(c).asc_nulls_first() if isinstance(c, str) else c for c in tie_break]


def top_k(df: DataFrame, col: str, k: int, tie_break: Sequence = (),
          ascending: bool = False) -> DataFrame:
    """R1 (largest first) / R2 (``ascending=True``)."""
    key = F.col(col).asc() if ascending else F.col(col).desc()
    return df.filter(F.col(col).isNotNull()).orderBy(key, *_tb(tie_break)).limit(k)


def bottom_k(df: DataFrame, col: str, k: int, tie_break: Sequence = ()) -> DataFrame:
    """R2: the k smallest."""
    return top_k(df, col, k, tie_break, ascending=True)


def order(df: DataFrame, col: str, tie_break: Sequence = ()) -> DataFrame:
    """Full ascending sort (range-partitioned sort, no single task)."""
    return df.orderBy(F.col(col).asc_nulls_last(), *_tb(tie_break))


def sample_violations(df: DataFrame, pred: Column, k: int, order_by: Sequence) -> DataFrame:
    """The first k offending rows in a declared order."""
    return df.filter(F.coalesce(pred, F.lit(False))).orderBy(*_tb(order_by)).limit(k)
