"""Left equi-joins of the integration step.

Join strategy is left to Catalyst + AQE (runtime size check: broadcast when
the built side is small, sort-merge otherwise). J1's right side is an
aggregate on the join key, so AQE cannot split a hot key there; hot keys are
salted instead (``operators.skew``).
An explicit broadcast is opt-in (``broadcast_right``) and used by the jobs
only for the station-by-fuel sides, whose size is bounded by construction: the
jobs restrict the stations to the fuel codes of the mapping before they are
grouped by code, so these sides have at most one row per mapped code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.scalar import norm_key
from .skew import hot_keys, skew_safe_join


def join_complaints(vehicles: DataFrame, rollup: DataFrame,
                    measures=K.COMPLAINT_MEASURES) -> DataFrame:
    """LEFT join vehicles to the complaint roll-up on (year, normalised
    make, normalised model); the right side is unique per key (no fan-out);
    vehicles without complaints get 0 in all six measures."""
    keys = ["year", "make_norm", "model_norm"]
    v = vehicles.withColumns({"make_norm": norm_key("make"), "model_norm": norm_key("model")})
    # the roll-up's shuffle partitions this join, so AQE cannot split a hot
    # vehicle key: hot keys are found with a partial aggregate and salted
    hot = hot_keys(v.groupBy(*keys).agg(F.count(F.lit(1)).alias("_vs_n")), keys, "_vs_n")
    j = skew_safe_join(v, rollup, keys, hot, "left")
    return j.na.fill(0, subset=list(measures)).drop("make_norm", "model_norm")


def join_stations(vehicle_counts: DataFrame, by_fuel: DataFrame,
                  broadcast_right: bool = False) -> DataFrame:
    """LEFT join (year, fuel) vehicle counts to station counts per fuel, fill 0."""
    right = F.broadcast(by_fuel) if broadcast_right else by_fuel
    j = vehicle_counts.join(right, on="fuel_type_code", how="left")
    return j.na.fill(0, subset=["total_stations", "available_stations"])


def join_nationwide(df: DataFrame, nationwide: DataFrame,
                    broadcast_right: bool = False) -> DataFrame:
    """LEFT join rows to nationwide station counts by fuel code; a null
    code never matches (trap T12) and gets 0."""
    right = F.broadcast(nationwide) if broadcast_right else nationwide
    j = df.join(right, on="fuel_type_code", how="left")
    return j.na.fill(0, subset=["stations_nationwide"])
