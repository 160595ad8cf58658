"""Incremental maintenance (documented capability X11, changed rows carried on).

A1, A3 and P4 are kept up to date from changed rows alone: what they need of the
unchanged ones is held in states of one row a group, whose sums and counts can be
taken back. A changed row counts -1 as it was and +1 as it is now; a state and the
state of a change set add up to the new state, and a group without rows leaves it.
Averages follow from sums and counts of whole numbers, the distinct vehicle rows
of P4 from how often each occurs. The unchanged complaints and vehicles are not
read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.scalar import norm_key
from .integration import analysis_of, normalized_complaints

SIGN = "_vs_sign"
#: Rows of a group, in every state.
ROWS = "_vs_rows"
ROLLUP_KEYS = ("year", "make_norm", "model_norm")
FUEL_KEYS = ("year", "fuel_type_code")
RAW_KEYS = ("year", "make", "model")


def signed_changes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that were deleted, or changed, as they were (-1), and rows that were
    inserted, or changed, as they are (+1). Null keys compare equal; a key is
    there at most once a side."""
    if set(before.columns) != set(after.columns):
        raise ValueError(f"the columns differ: {sorted(set(before.columns) ^ set(after.columns))}")
    names = before.columns

    def side(df: DataFrame, mark: str) -> DataFrame:
        return df.select(F.struct(*keys).alias(f"_k{mark}"), F.struct(*names).alias(f"_v{mark}"))

    j = side(before, "b").join(side(after, "a"), F.col("_kb").eqNullSafe(F.col("_ka")), "full_outer")
    rows = F.filter(F.array(F.struct(F.lit(-1).alias(SIGN), F.col("_vb").alias("_v")),
                            F.struct(F.lit(1).alias(SIGN), F.col("_va").alias("_v"))), lambda x: x["_v"].isNotNull())
    return (j.where(~F.col("_vb").eqNullSafe(F.col("_va"))).select(F.explode(rows).alias("_r"))
            .select("_r._v.*", f"_r.{SIGN}"))


def _sign(df: DataFrame) -> Column:
    """The sign of a row; 1 in a table without signs."""
    return F.col(SIGN).cast("bigint") if SIGN in df.columns else F.lit(1).cast("bigint")


def _sums(df: DataFrame, keys: Sequence[Column], values: dict[str, Column]) -> DataFrame:
    s = _sign(df)
    zero = F.lit(0)
    return df.groupBy(*keys).agg(F.sum(s).alias(ROWS), *[
        F.sum(F.coalesce(v, zero) * s).cast("bigint").alias(n) for n, v in values.items()])


def merged(state: DataFrame, change: DataFrame) -> DataFrame:
    """A state and the state of a change set added up (null keys compare equal):
    one aggregate over rows of one a group."""
    sums = [c for c in state.columns if c.startswith("_vs_")]
    keys = [c for c in state.columns if c not in sums]
    return (state.unionByName(change).groupBy(*keys).agg(*[F.sum(c).cast("bigint").alias(c) for c in sums])
            .where(F.col(ROWS) != 0))


def _flag(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False)).cast("bigint")


# A1 ------------------------------------------------------------------------
def complaint_state(complaints: DataFrame, key: Callable = norm_key) -> DataFrame:
    """The state of A1, of a table or of signed changes; null keys are dropped."""
    c = normalized_complaints(complaints, key)
    keys = {"year": "YEARTXT", "make_norm": "make_norm", "model_norm": "model_norm"}
    return _sums(c.na.drop("any", subset=list(keys.values())), [F.col(v).alias(k) for k, v in keys.items()], {
        "_vs_complaints": _flag(F.col("CMPLID").isNotNull()), "_vs_crash": _flag(F.col("CRASH") == "Y"),
        "_vs_fire": _flag(F.col("FIRE") == "Y"), "_vs_injured": F.col("INJURED"), "_vs_deaths": F.col("DEATHS"),
        "_vs_mileage": F.col("MILEAGE"), "_vs_with_mileage": _flag(F.col("MILEAGE").isNotNull())})


def rollup_of(state: DataFrame) -> DataFrame:
    """A1 from its state."""
    return state.select(*ROLLUP_KEYS, F.col("_vs_complaints").alias("total_complaints"),
                        F.col("_vs_crash").alias("crash_incidents"), F.col("_vs_fire").alias("fire_incidents"),
                        F.col("_vs_injured").alias("total_injured"), F.col("_vs_deaths").alias("total_deaths"),
                        F.try_divide("_vs_mileage", "_vs_with_mileage").alias("avg_complaint_mileage"))


# A3 ------------------------------------------------------------------------
_MPG = {"avg_combined_mpg": "comb08", "avg_city_mpg": "city08", "avg_highway_mpg": "highway08"}


def fuel_state(vehicles: DataFrame) -> DataFrame:
    """The state of A3 over vehicle rows with ``fuel_type_code``; null keys are
    dropped. The MPG columns hold whole numbers."""
    values = {"_vs_ids": _flag(F.col("id").isNotNull())}
    for c in _MPG.values():
        values |= {f"_vs_{c}": F.col(c), f"_vs_with_{c}": _flag(F.col(c).isNotNull())}
    return _sums(vehicles.na.drop("any", subset=list(FUEL_KEYS)), [F.col(k) for k in FUEL_KEYS], values)


def fuel_rollup_of(state: DataFrame) -> DataFrame:
    """A3 from its state."""
    return state.select(*FUEL_KEYS, F.col("_vs_ids").alias("vehicle_count"), *[
        F.try_divide(f"_vs_{c}", f"_vs_with_{c}").alias(n) for n, c in _MPG.items()])


# P4 ------------------------------------------------------------------------
def _own() -> list[str]:
    return [c for c in K.ANALYSIS_COLUMNS if c not in K.COMPLAINT_MEASURES]


def vehicle_state(vehicles: DataFrame) -> DataFrame:
    """Distinct projected vehicle rows with the number of rows of each."""
    return _sums(vehicles, [F.col(c) for c in _own()], {})


def analysis_from(vehicles: DataFrame, complaints: DataFrame, key: Callable = norm_key) -> DataFrame:
    """P4 from the states of its two sides."""
    groups = vehicles.groupBy(*RAW_KEYS).agg(F.sum(ROWS).alias("vehicle_variants"))
    return analysis_of(vehicles.select(*_own()), groups, rollup_of(complaints), key)


def touched_keys(vehicle_changes: DataFrame, complaint_changes: DataFrame, key: Callable = norm_key) -> DataFrame:
    """Normalised (year, make, model) of two change states, once each. A null
    stands for itself."""
    raw = vehicle_changes.select("year", key("make").alias("make_norm"), key("model").alias("model_norm"))
    return raw.unionByName(complaint_changes.select(*ROLLUP_KEYS)).distinct()


def updated_analysis(old: DataFrame, vehicles: DataFrame, complaints: DataFrame, touched: DataFrame,
                     key: Callable = norm_key) -> DataFrame:
    """P4 after a change set: rows of untouched keys stay as they are, those of
    ``touched`` keys are made anew from the (merged) states."""
    marks = touched.select(F.struct(*ROLLUP_KEYS).alias("_vs_touched"))

    def of(df: DataFrame, how: str) -> DataFrame:
        own = F.struct("year", key("make").alias("make_norm"), key("model").alias("model_norm"))
        return (df.withColumn("_vs_key", own)
                .join(marks, F.col("_vs_key").eqNullSafe(F.col("_vs_touched")), how).drop("_vs_key"))

    keys = touched.na.drop()
    again = analysis_from(of(vehicles, "left_semi"), complaints.join(keys, list(ROLLUP_KEYS), "left_semi"), key)
    return of(old, "left_anti").unionByName(again)
