"""Integrated analysis tables P4-P6.

Physical shape of P4: complaints (A1) and vehicles are both rolled up to their
keys and joined there (J1, A2; AQE picks broadcast or sort-merge); the distinct
projected vehicle rows (K4) are joined to these keys once, hot keys salted. P6
reuses P4 instead of recomputing it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.scalar import map_code, norm_key, ratio_zero_as_one, round_even
from ..operators.aggregates import (
    complaint_rollup, fuel_year_rollup, stations_by_fuel, stations_nationwide,
)
from ..operators.dedupe import distinct
from ..operators.filters import project_analysis
from ..operators.joins import join_complaints, join_nationwide, join_stations
from ..operators.skew import hot_keys, skew_safe_join


def normalized_complaints(complaints: DataFrame, key: Callable = norm_key) -> DataFrame:
    """F1 on the complaint side (or another ``key``, such as X3's)."""
    return complaints.withColumns({"make_norm": key("MAKETXT"), "model_norm": key("MODELTXT")})


def vehicle_complaints_joined(vehicles: DataFrame, complaints: DataFrame) -> DataFrame:
    """F1 + A1 + J1 + F4 + C15 (before the group size and the distinct)."""
    rollup = complaint_rollup(normalized_complaints(complaints))
    return project_analysis(join_complaints(vehicles, rollup))


def vehicle_complaints_analysis(vehicles: DataFrame, complaints: DataFrame,
                                key: Callable = norm_key) -> DataFrame:
    """P4 (22 columns): vehicles with their complaint measures.

    ``vehicle_variants`` counts vehicle-fuel rows per RAW (year, make, model)
    after the explosion and BEFORE the distinct (trap T16); the distinct then
    collapses rows that differed only in unprojected columns (trap T17).

    Measures and variants depend on (year, make, model) alone, so they are
    worked out on one row per such key and joined once to the distinct vehicle
    rows: these move twice, for the distinct and for the salted join. ``key``
    normalises make and model on both sides (X3: ``aggressive_key``).
    """
    groups = vehicles.groupBy("year", "make", "model").agg(F.count(F.lit(1)).alias("vehicle_variants"))
    own = [c for c in K.ANALYSIS_COLUMNS if c not in K.COMPLAINT_MEASURES]
    return analysis_of(distinct(vehicles.select(*own)), groups,
                       complaint_rollup(normalized_complaints(complaints, key)), key)


def analysis_of(rows: DataFrame, groups: DataFrame, rollup: DataFrame, key: Callable = norm_key) -> DataFrame:
    """P4 from its distinct vehicle rows, the variants of each raw key and A1."""
    raw, measures = ["year", "make", "model"], list(K.COMPLAINT_MEASURES)
    keyed = (groups.filter(F.col("year").isNotNull() & F.col("make").isNotNull() & F.col("model").isNotNull())
             .withColumns({"make_norm": key("make"), "model_norm": key("model")})
             .join(rollup, ["year", "make_norm", "model_norm"], "left").drop("make_norm", "model_norm"))
    hot = hot_keys(groups, raw, "vehicle_variants")
    joined = skew_safe_join(rows, keyed, raw, hot, "left").na.fill(0, subset=measures)
    return joined.select(*K.ANALYSIS_COLUMNS, "vehicle_variants")


def _mapped(stations: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return stations.filter(F.col("fuel_type_code").isin(sorted(set(mapping.values()))))


def fuel_infrastructure_analysis(vehicles: DataFrame, stations: DataFrame,
                                 mapping: Mapping[str, str] = K.FUEL_CODE_MAP) -> DataFrame:
    """P5 (9 columns): vehicle-fuel rows per (year, fuel code) against the
    stations of that fuel. Unmapped fuels are dropped (trap T13); a fuel
    without stations divides by 1 (trap T14). Station counts exclude stations
    without a state (trap T3)."""
    v = vehicles.withColumn("fuel_type_code", map_code("fuel_used", mapping))
    vc = fuel_year_rollup(v)
    # bounded: one row per fuel code of the mapping, whatever the stations hold
    j = join_stations(vc, stations_by_fuel(_mapped(stations, mapping)), broadcast_right=True)
    return j.select(
        "year", "fuel_type_code", "vehicle_count",
        round_even("avg_combined_mpg", 1).alias("avg_combined_mpg"),
        round_even("avg_city_mpg", 1).alias("avg_city_mpg"),
        round_even("avg_highway_mpg", 1).alias("avg_highway_mpg"),
        F.col("total_stations").cast("bigint").alias("total_stations"),
        F.col("available_stations").cast("bigint").alias("available_stations"),
        round_even(ratio_zero_as_one("vehicle_count", "total_stations"), 1)
        .alias("vehicles_per_station"))


def comprehensive_vehicle_analysis(vca: DataFrame, stations: DataFrame,
                                   mapping: Mapping[str, str] = K.FUEL_CODE_MAP) -> DataFrame:
    """P6 (24 columns): P4 plus fuel code and nationwide station count; here
    stations without a state ARE counted (trap T3)."""
    b = vca.withColumn("fuel_type_code", map_code("fuel_used", mapping))
    # bounded: one row per fuel code of the mapping, whatever the stations hold
    j = join_nationwide(b, stations_nationwide(_mapped(stations, mapping)), broadcast_right=True)
    return j.select(*vca.columns, "fuel_type_code",
                    F.col("stations_nationwide").cast("bigint").alias("stations_nationwide"))
