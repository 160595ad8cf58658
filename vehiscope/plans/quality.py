"""Data-quality jobs D1-D9: rule tables as long DataFrames.

Each dataset is checked in ONE scan: rules are ``count_if`` aggregates. Rules
that need duplicate groups (pandas ``duplicated(keep=False)``) use a first
aggregation level keyed by the duplicate key (nulls grouped together, as
pandas), whose partial aggregation keeps hot keys cheap, and a second level
that sums; no window, no self-join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions.scalar import icontains, row_max, row_min
from ..operators.filters import _as_date


def _rules_long(wide: DataFrame, dataset: str, rules: Sequence[str],
                scored: Sequence[str] | None = None) -> DataFrame:
    """(dataset, rule, violations, passed, scored) from a one-row aggregate."""
    scored = list(rules) if scored is None else list(scored)
    items = [F.struct(F.lit(r).alias("rule"), F.col(r).cast("bigint").alias("violations"),
                      F.lit(r in scored).alias("scored")) for r in rules]
    return (wide.select(F.inline(F.array(*items)))
            .select(F.lit(dataset).alias("dataset"), "rule", "violations",
                    (F.col("violations") == 0).alias("passed"), "scored"))


def _null_cells(cols: Sequence[str]) -> Column:
    """Number of null cells among ``cols`` in a row."""
    total = None
    for c in cols:
        e = F.col(c).isNull().cast("int")
        total = e if total is None else total + e
    return total


def _with_dups(df: DataFrame, keys: Sequence[str], rules: Mapping[str, Column],
               dup_rule: str, sums: Mapping[str, Column] | None = None) -> DataFrame:
    """One scan: per-key partial counts of each rule (``count_if``) and sums
    (``sums``), then totals plus the number of rows in duplicate groups
    (pandas ``duplicated(keep=False)``; null keys form one group)."""
    sums = dict(sums or {})
    lvl1 = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.coalesce(p, F.lit(False))).alias(r) for r, p in rules.items()],
        *[F.sum(e).alias(r) for r, e in sums.items()])
    return lvl1.agg(*[F.coalesce(F.sum(r), F.lit(0)).alias(r) for r in [*rules, *sums]],
                    F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0))
                    .alias(dup_rule))


# D1 -----------------------------------------------------------------------
def contract(tables: Mapping[str, DataFrame],
             spec: Mapping[str, tuple[list[str], int]] = K.CONTRACT) -> DataFrame:
    """Required columns present (schema metadata) and row count >= minimum."""
    parts = []
    for name, df in tables.items():
        req, min_rows = spec[name]
        missing = [c for c in req if c not in df.columns]
        parts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("table"), "rows", F.lit(",".join(missing)).alias("missing_columns"),
            F.lit(min_rows).cast("bigint").alias("min_rows"),
            ((F.col("rows") >= min_rows) & F.lit(not missing)).alias("passed")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# D2 -----------------------------------------------------------------------
def vehicle_rules(vca: DataFrame, year_range=K.VALIDATION_YEAR_RANGE) -> DataFrame:
    """Validator rules on the analysis table (year range, MPG > 0, keys)."""
    lo, hi = year_range
    wide = vca.agg(
        F.count_if((F.col("year") < lo) | (F.col("year") > hi)).alias("year_in_range"),
        F.count_if(F.col("comb08") <= 0).alias("positive_mpg"),
        F.count_if(F.col("year").isNull()).alias("year_not_null"),
        F.count_if(F.col("make").isNull()).alias("make_not_null"),
        F.count_if(F.col("model").isNull()).alias("model_not_null"))
    return _rules_long(wide, "vehicle_complaints_analysis",
                       ["year_in_range", "positive_mpg", "year_not_null", "make_not_null",
                        "model_not_null"])


# D3 / D4 ------------------------------------------------------------------
def mpg_inconsistent(df: DataFrame) -> Column:
    lo, hi = row_min("city08", "highway08"), row_max("city08", "highway08")
    return (F.col("comb08") < lo) | (F.col("comb08") > hi)


def vehicle_checks(vehicles: DataFrame, as_of=K.DEFAULT_AS_OF,
                   min_year: int = K.VEHICLE_MIN_YEAR, mpg_cap=K.VEHICLE_MPG_CAP) -> DataFrame:
    """D3 (6 scored checks) + D4 (MPG consistency, reported only) on P1."""
    y = _as_date(as_of).year
    rules = {
        "no_pre_min_year": F.col("year") < min_year,
        "no_zero_mpg": F.col("comb08") == 0,
        "no_high_mpg_non_electric": (F.col("comb08") > mpg_cap)
        & ~icontains("fuel_used", K.ELECTRIC_NEEDLE),
        "no_future_year": F.col("year") > y,
        "mpg_consistency": mpg_inconsistent(vehicles),
    }
    wide = _with_dups(vehicles, ["id", "fuel_rank"], rules, "no_duplicate_id_rank",
                      sums={"no_missing_critical": _null_cells(["year", "make", "model",
                                                                 "comb08"])})
    order = ["no_pre_min_year", "no_missing_critical", "no_zero_mpg",
             "no_high_mpg_non_electric", "no_future_year", "no_duplicate_id_rank",
             "mpg_consistency"]
    return _rules_long(wide, "vehicles", order, scored=order[:-1])


def sample_inconsistent(vehicles: DataFrame, k: int = 5,
                        order_by: Sequence[str] = ("id", "fuel_rank")) -> DataFrame:
    """The first k vehicles whose combined MPG lies outside [city, highway]."""
    from ..operators.ranking import sample_violations
    return sample_violations(vehicles.select("id", "fuel_rank", "year", "make", "model",
                                             "city08", "highway08", "comb08"),
                             mpg_inconsistent(vehicles), k, list(order_by))


# D5 -----------------------------------------------------------------------
def complaint_checks(complaints: DataFrame, as_of=K.DEFAULT_AS_OF) -> DataFrame:
    """D5 (4 scored checks) on P2."""
    d = _as_date(as_of)
    rules = {"no_future_date": F.col("DATEA") > F.lit(d),
             "no_future_year": F.col("YEARTXT") > d.year}
    wide = _with_dups(complaints, ["ODINO"], rules, "no_duplicate_odino",
                      sums={"no_missing_critical": _null_cells(K.COMPLAINT_REQUIRED)})
    return _rules_long(wide, "complaints", ["no_missing_critical", "no_duplicate_odino",
                                            "no_future_date", "no_future_year"])


# D6 -----------------------------------------------------------------------
def station_checks(stations: DataFrame, box=K.STATION_BBOX,
                   fuel_codes: Sequence[str] = K.ALT_FUEL_CODES) -> DataFrame:
    """D6 (4 scored checks) on P3; bounds = latitude out + longitude out +
    exact (0, 0)."""
    lat_lo, lat_hi, lon_lo, lon_hi = box
    lat, lon = F.col("latitude"), F.col("longitude")
    bad_geo = (F.coalesce((lat < lat_lo) | (lat > lat_hi), F.lit(False)).cast("int")
               + F.coalesce((lon < lon_lo) | (lon > lon_hi), F.lit(False)).cast("int")
               + F.coalesce((lat == 0) & (lon == 0), F.lit(False)).cast("int"))
    rules = {"allowed_fuel_codes": ~F.coalesce(F.col("fuel_type_code").isin(list(fuel_codes)),
                                               F.lit(False))}
    wide = _with_dups(stations, ["id"], rules, "no_duplicate_id",
                      sums={"no_missing_critical": _null_cells(K.STATION_REQUIRED),
                            "coordinates_in_bounds": bad_geo})
    return _rules_long(wide, "stations", ["no_missing_critical", "coordinates_in_bounds",
                                          "allowed_fuel_codes", "no_duplicate_id"])


# D7 -----------------------------------------------------------------------
def scorecard(*rule_tables: DataFrame) -> DataFrame:
    """Scored checks passed / total per dataset."""
    u = rule_tables[0]
    for r in rule_tables[1:]:
        u = u.unionByName(r)
    s = u.filter("scored")
    return s.groupBy("dataset").agg(F.count_if("passed").alias("tests_passed"),
                                    F.count(F.lit(1)).alias("tests_total"))


# D8 -----------------------------------------------------------------------
def numeric_types(df: DataFrame, cols: Sequence[str] = K.NUMERIC_CHECK_COLUMNS) -> list[tuple]:
    """(column, type, is_numeric) from the schema; metadata only."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    return [(c, fields[c].simpleString(), isinstance(fields[c], T.NumericType))
            for c in cols if c in fields]


def numeric_check(df: DataFrame, cols: Sequence[str] = K.NUMERIC_CHECK_COLUMNS) -> DataFrame:
    """D8 on the table: (column, type, is_numeric, non_null), one aggregate."""
    kinds = numeric_types(df, cols)
    g = df.agg(*[F.count(c).alias(f"_n{i}") for i, (c, _t, _n) in enumerate(kinds)],
               *[F.first(F.typeof(c)).alias(f"_t{i}") for i, (c, _t, _n) in enumerate(kinds)])
    return g.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.coalesce(F.col(f"_t{i}"), F.lit(t)).alias("type"),
                 F.lit(num).alias("is_numeric"), F.col(f"_n{i}").alias("non_null"))
        for i, (c, t, num) in enumerate(kinds)])))


# D9 -----------------------------------------------------------------------
def source_profile(sources: Mapping[str, DataFrame]) -> DataFrame:
    """Rows, columns and types per source (the last two from the schema),
    and a row for all of them together."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(n).alias("source"), "rows", F.lit(len(df.columns)).alias("columns"),
        F.lit(", ".join(f"{c} {t}" for c, t in df.dtypes)).alias("dtypes"))
        for n, df in sources.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    # one row per source: at most len(sources) rows
    total = out.agg(F.lit("total").alias("source"), F.sum("rows").alias("rows"),
                    F.sum("columns").cast("int").alias("columns"), F.lit("").alias("dtypes"))
    return out.unionByName(total)
