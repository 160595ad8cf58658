"""Analytical questions Q1-Q12 over the integrated tables.

Each answer is a DataFrame; verdicts the reference printed after branching on
a computed scalar are columns here (``when``), so nothing is collected to the
driver. Thresholds are parameters (defaults are the reference's).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import icontains, label, pct_diff, per, rate
from ..operators.aggregates import (
    brand_rollup, class_rollup, fuel_summary as _fuel_summary, having, mean_where,
)
from ..operators.dedupe import dedupe_first
from ..operators.ranking import bottom_k, order, top_k

# output columns of the row-level top-k reports
Q7_COLS = ["year", "make", "model", "fuel_used", "fuel_rank", "comb08", "total_complaints",
           "crash_incidents", "fire_incidents"]
Q8_COLS = ["year", "make", "model", "fuel_used", "fuel_rank", "comb08", "city08", "highway08"]
Q11_COLS = ["year", "make", "model", "fuel_used", "fuel_rank", "comb08", "total_complaints",
            "stations_nationwide"]
Q12_COLS = ["year", "make", "model", "fuel_used", "fuel_rank", "total_complaints",
            "crash_incidents", "stations_nationwide"]
Q10_COLS = ["year", "fuel_type_code", "vehicle_count", "total_stations",
            "vehicles_per_station", "avg_combined_mpg"]
# keep-first order inside a (year, make, model) group of the analysis table
# (the reference's row order puts primary-fuel rows first)
ANALYSIS_ROW_ORDER = ["fuel_rank", "fuel_used", "VClass", "drive", "cylinders", "displ",
                      "primary_fuel", "secondary_fuel", "city08", "highway08", "comb08",
                      "co2TailpipeGpm", "total_complaints", "crash_incidents",
                      "fire_incidents", "total_injured", "total_deaths",
                      "avg_complaint_mileage", "vehicle_variants"]


def _others(cols: Sequence[str], key: str) -> list[str]:
    return [c for c in cols if c != key]


def efficiency_vs_complaints(vca: DataFrame, mpg: float = 30) -> DataFrame:
    """Q1: mean complaints of efficient (comb08 > mpg) vs other (<= mpg)
    vehicles; a null MPG is in neither group."""
    m = mean_where(vca, "total_complaints",
                   {"high_mpg": F.col("comb08") > mpg, "low_mpg": F.col("comb08") <= mpg})
    fewer = F.col("high_mpg_avg") < F.col("low_mpg_avg")
    return m.select(
        "high_mpg_avg", "high_mpg_count", "low_mpg_avg", "low_mpg_count",
        (F.col("low_mpg_avg") - F.col("high_mpg_avg")).alias("difference"),
        F.when(fewer, F.lit("efficient vehicles have fewer complaints"))
         .otherwise(F.lit("no clear correlation")).alias("verdict"))


def brands_by_complaint_rate(vca: DataFrame, min_vehicles: int = 50, k: int = 5) -> DataFrame:
    """Q2: top-k makes by complaints per vehicle among makes with more than
    ``min_vehicles`` rows (ties: make ascending)."""
    b = brand_rollup(vca).withColumn(
        "complaints_per_vehicle", rate("total_complaints", "vehicle_count"))
    return top_k(having(b, "vehicle_count", min_vehicles), "complaints_per_vehicle", k,
                 tie_break=["make"])


def electric_vs_gasoline(vca: DataFrame) -> DataFrame:
    """Q3: EV vs gasoline mean complaints (by ``fuel_used`` text), counts,
    and % fewer for EVs when they have fewer."""
    m = mean_where(vca, "total_complaints",
                   {"ev": icontains("fuel_used", "Electricity"),
                    "gas": icontains("fuel_used", "Gasoline")})
    fewer = F.col("ev_avg") < F.col("gas_avg")
    return m.select(
        "ev_avg", "ev_count", "gas_avg", "gas_count",
        F.when(fewer, pct_diff("gas_avg", "ev_avg")).alias("ev_pct_fewer"),
        F.when(fewer, F.lit("EVs have fewer complaints"))
         .otherwise(F.lit("EVs do not have fewer complaints")).alias("verdict"))


def infrastructure_status(infra: DataFrame, year: int = 2024,
                          per_1000: float = 10) -> DataFrame:
    """Q4: stations per 1000 vehicles for one year with a status label,
    sorted ascending (ties by fuel code)."""
    i = infra.filter(F.col("year") == year).withColumn(
        "stations_per_1000_vehicles", per("total_stations", "vehicle_count", 1000))
    i = i.withColumn("status", label("stations_per_1000_vehicles", per_1000,
                                     "constrained", "adequate"))
    return order(i.select("year", "fuel_type_code", "total_stations", "vehicle_count",
                          "stations_per_1000_vehicles", "status"),
                 "stations_per_1000_vehicles", tie_break=["fuel_type_code"])


def infrastructure_gaps(infra: DataFrame, year: int = 2024, per_1000: float = 10) -> DataFrame:
    """Q4: the constrained fuels of that year as one sorted list. The list is
    bounded by the number of fuel codes of the lookup."""
    s = infrastructure_status(infra, year, per_1000)
    c = F.col("status") == "constrained"
    return s.agg(F.count_if(c).alias("n_constrained"),
                 F.array_join(F.array_sort(F.collect_list(F.when(c, F.col("fuel_type_code")))),
                              ", ").alias("constrained_fuels"))


def infrastructure_vs_complaints(comp: DataFrame, stations: int = 10000,
                                 mapped_only: bool = False) -> DataFrame:
    """Q5: mean complaints with good (> stations) vs poor (<=) infrastructure.
    Unmapped fuels have 0 stations, so they count as poor (trap T15), as in
    the reference; ``mapped_only=True`` leaves rows without a fuel code out."""
    if mapped_only:
        comp = comp.filter(F.col("fuel_type_code").isNotNull())
    m = mean_where(comp, "total_complaints",
                   {"good_infra": F.col("stations_nationwide") > stations,
                    "poor_infra": F.col("stations_nationwide") <= stations})
    more = F.col("poor_infra_avg") > F.col("good_infra_avg")
    return m.select(
        "good_infra_avg", "good_infra_count", "poor_infra_avg", "poor_infra_count",
        F.when(more, F.try_divide(F.col("poor_infra_avg") - F.col("good_infra_avg"),
                                  F.col("good_infra_avg")) * 100).alias("poor_pct_more"),
        F.when(more, F.lit("poor infrastructure has more complaints"))
         .otherwise(F.lit("no clear correlation")).alias("verdict"))


def class_performance(comp: DataFrame, min_count: int = 100, k: int = 5) -> DataFrame:
    """Q6: the k most efficient and the k most reliable classes among classes
    with more than ``min_count`` rows (ties by class)."""
    s = having(class_rollup(comp), "count", min_count)
    eff = top_k(s, "comb08", k, tie_break=["VClass"]).withColumn("list", F.lit("efficient"))
    rel = bottom_k(s, "total_complaints", k, tie_break=["VClass"]).withColumn(
        "list", F.lit("reliable"))
    return eff.unionByName(rel)


def top_complaints(vca: DataFrame, k: int = 10) -> DataFrame:
    """Q7: rows with the most complaints (complaints > 0)."""
    d = vca.filter(F.col("total_complaints") > 0).select(*Q7_COLS)
    return top_k(d, "total_complaints", k, tie_break=_others(Q7_COLS, "total_complaints"))


def efficient_without_complaints(vca: DataFrame, k: int = 10) -> DataFrame:
    """Q8: highest MPG among rows with zero complaints."""
    d = vca.filter(F.col("total_complaints") == 0).select(*Q8_COLS)
    return top_k(d, "comb08", k, tie_break=_others(Q8_COLS, "comb08"))


def fuel_summary(infra: DataFrame) -> DataFrame:
    """Q9: infrastructure summary per fuel."""
    return _fuel_summary(infra)


def coverage_extremes(infra: DataFrame, k: int = 10) -> DataFrame:
    """Q10: worst k (most vehicles per station) and best k (fewest, with
    vehicle_count > 0) (year, fuel) rows; ties by (year, fuel)."""
    d = infra.select(*Q10_COLS)
    worst = top_k(d, "vehicles_per_station", k, tie_break=["year", "fuel_type_code"])
    best = bottom_k(d.filter(F.col("vehicle_count") > 0), "vehicles_per_station", k,
                    tie_break=["year", "fuel_type_code"])
    return (worst.withColumn("list", F.lit("worst"))
            .unionByName(best.withColumn("list", F.lit("best"))))


def best_overall(comp: DataFrame, strict=(35, 10, 1000), relaxed=(30, 50, 500),
                 k: int = 10) -> DataFrame:
    """Q11: MPG > a, complaints < b, stations > c, top k by MPG; when no row
    meets the strict rule, the relaxed rule applies.

    The branch is decided inside the plan by an uncorrelated scalar subquery
    (the strict count), evaluated once; no driver round trip, no join.
    """
    def rule(a, b, c):
        return ((F.col("comb08") > a) & (F.col("total_complaints") < b)
                & (F.col("stations_nationwide") > c))
    strict_p, relaxed_p = rule(*strict), rule(*relaxed)
    n_strict = comp.agg(F.count_if(strict_p)).scalar()
    use_strict = n_strict > 0
    pred = F.when(use_strict, strict_p).otherwise(relaxed_p)
    d = comp.filter(F.coalesce(pred, F.lit(False))).select(*Q11_COLS)
    return (top_k(d, "comb08", k, tie_break=_others(Q11_COLS, "comb08"))
            .withColumn("rule", F.when(use_strict, F.lit("strict")).otherwise(F.lit("relaxed"))))


def problem_vehicles(comp: DataFrame, min_complaints: int = 100, max_stations: int = 5000,
                     k: int = 10) -> DataFrame:
    """Q12: many complaints and poor infrastructure; first row per (year, make,
    model) (K5, primary fuel first), then the top k by complaints."""
    d = comp.filter((F.col("total_complaints") > min_complaints)
                    & (F.col("stations_nationwide") < max_stations))
    d = dedupe_first(d, ["year", "make", "model"], ANALYSIS_ROW_ORDER)
    return top_k(d.select(*Q12_COLS), "total_complaints", k,
                 tie_break=["year", "make", "model"])
