"""Cleaning jobs P1-P3 and their one-pass stage audits.

Each job is one lazy plan, in the reference's step order. The clock is the
explicit ``as_of`` parameter (trap T6) and keep-first takes a declared
``order_by`` (trap T4).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.scalar import parse_num, parse_ymd, require_int, to_nullable_int
from ..operators import filters as C
from ..operators.dedupe import dedupe_first
from ..operators.expand import explode_ranked


def _all(preds) -> Column:
    """AND of the step predicates as ONE filter (Catalyst would merge
    adjacent filters anyway; one call keeps driver-side planning short)."""
    out = None
    for p in preds:
        out = p if out is None else out & p
    return out


# ------------------------------------------------------------------ P1
def vehicle_filter_steps(as_of=K.DEFAULT_AS_OF, min_year: int = K.VEHICLE_MIN_YEAR,
                         mpg_cap=K.VEHICLE_MPG_CAP) -> list[tuple[str, Column]]:
    """C1..C6 as named predicates, in order."""
    return [
        ("min_year", C.min_year_pred("year", min_year)),
        ("required_fields", C.all_present_pred(K.VEHICLE_REQUIRED)),
        ("any_measure", C.any_present_pred(K.VEHICLE_MEASURES)),
        ("nonzero_mpg", C.not_zero_pred("comb08")),
        ("mpg_cap_unless_electric",
         C.cap_unless_pred("comb08", mpg_cap, "fuelType", K.ELECTRIC_NEEDLE)),
        ("not_future_year", C.not_after_year_pred("year", as_of, keep_null=False)),
    ]


def clean_vehicles_unexploded(raw: DataFrame, as_of=K.DEFAULT_AS_OF,
                              order_by: Sequence = ("id",),
                              min_year: int = K.VEHICLE_MIN_YEAR,
                              mpg_cap=K.VEHICLE_MPG_CAP) -> DataFrame:
    """P1 up to (not including) the dual-fuel explosion: C1-C6, K1, C13, C14."""
    df = raw.filter(_all(p for _n, p in vehicle_filter_steps(as_of, min_year, mpg_cap)))
    # K1 runs BEFORE the projection and keys on the raw combined fuelType
    df = dedupe_first(df, K.VEHICLE_DEDUPE_KEYS, list(order_by))
    df = C.select_existing(df, K.VEHICLE_KEEP_COLUMNS)
    return C.rename(df, K.VEHICLE_RENAMES)


def clean_vehicles(raw: DataFrame, as_of=K.DEFAULT_AS_OF, order_by: Sequence = ("id",),
                   min_year: int = K.VEHICLE_MIN_YEAR, mpg_cap=K.VEHICLE_MPG_CAP) -> DataFrame:
    """One row per vehicle x fuel (17 columns)."""
    return explode_ranked(clean_vehicles_unexploded(raw, as_of, order_by, min_year, mpg_cap))


# ------------------------------------------------------------------ P2
def _complaints_typed(raw: DataFrame, as_of) -> DataFrame:
    """C2, V1, V2, C8, C9, C7 (everything before the keep-first)."""
    df = C.require_all(raw, K.COMPLAINT_REQUIRED)
    df = df.withColumns({"DATEA": parse_ymd("DATEA"), "YEARTXT": parse_num("YEARTXT")})
    df = C.not_after(df, "DATEA", as_of, keep_null=True)
    df = C.cap(df, "MILEAGE", K.COMPLAINT_MAX_MILEAGE, keep_null=True)
    return C.not_after_year(df, "YEARTXT", as_of, keep_null=True)


def _complaints_deduped(raw: DataFrame, as_of, order_by: Sequence | None) -> DataFrame:
    return dedupe_first(_complaints_typed(raw, as_of), ["ODINO"],
                        None if order_by is None else list(order_by))


def clean_complaints(raw: DataFrame, as_of=K.DEFAULT_AS_OF,
                     order_by: Sequence | None = ("CMPLID",)) -> DataFrame:
    """S2 -> C2 -> V1 -> V2 -> C8 -> C9 -> C7 -> K2 -> V4 -> V5.

    Departures (stated): DATEA stays a DATE; a year that is still null at V4
    (the reference raises there, trap T7) is routed to
    ``complaint_rejects`` instead of failing the job.
    """
    df = _complaints_deduped(raw, as_of, order_by)
    df = df.filter(F.col("YEARTXT").isNotNull())
    integral = dict(df.dtypes).get("MILEAGE") in ("tinyint", "smallint", "int", "bigint")
    mileage = F.col("MILEAGE").cast("bigint") if integral else to_nullable_int("MILEAGE")
    df = df.withColumns({"YEARTXT": require_int("YEARTXT"), "MILEAGE": mileage})
    return df.select(*K.COMPLAINT_NAMES)


def complaint_rejects(raw: DataFrame, as_of=K.DEFAULT_AS_OF,
                      order_by: Sequence | None = ("CMPLID",)) -> DataFrame:
    """V4 reject set: complaints whose model year cannot become an integer."""
    df = _complaints_deduped(raw, as_of, order_by).filter(F.col("YEARTXT").isNull())
    return df.select("ODINO", "CMPLID", "MAKETXT", "MODELTXT",
                     F.lit("YEARTXT is not numeric").alias("reason"))


# ------------------------------------------------------------------ P3
def station_filter_steps(box=K.STATION_BBOX) -> list[tuple[str, Column]]:
    return [
        ("required_fields", C.all_present_pred(K.STATION_REQUIRED)),
        ("in_bbox", C.bbox_pred("latitude", "longitude", box)),
        ("not_null_island", C.not_null_island_pred("latitude", "longitude")),
    ]


def clean_stations(raw: DataFrame, order_by: Sequence | None = None, box=K.STATION_BBOX,
                   fuel_codes: Sequence[str] = K.ALT_FUEL_CODES) -> DataFrame:
    """C2 -> C10 -> C11 -> K3 -> C12 -> C13.

    K3 runs BEFORE the fuel filter: a station whose first row has an excluded
    fuel disappears even if a later row has an allowed one. Catalyst does not
    push the C12 filter below the keep-first window (not a partition key).
    """
    df = raw.filter(_all(p for _n, p in station_filter_steps(box)))
    df = dedupe_first(df, ["id"], None if order_by is None else list(order_by))
    df = C.keep_in(df, "fuel_type_code", fuel_codes)
    return C.select_existing(df, K.STATION_KEEP_COLUMNS)


# ------------------------------------------------------------------ C16
def stage_audit(df: DataFrame, pre: Sequence[tuple[str, Column]], dedupe_name: str,
                keys: Sequence[str], order_by: Sequence | None,
                post: Sequence[tuple[str, Column]] = (),
                expand: tuple[str, Column] | None = None) -> DataFrame:
    """Rows in, removed, kept and % of input retained after each step.

    The filters before the keep-first step are counted in one hash aggregate
    over the raw rows; the keep-first step and those after it are counted on the
    clean job's own path (``dedupe_first`` with the same order, whose partial
    ``WindowGroupLimit`` forwards one row per key and task), so audit and job
    cannot disagree. ``order_by=None`` orders by every other column, as the job
    does; an order that adds nothing to the key is an error.
    """
    if order_by is not None and set(c for c in order_by if isinstance(c, str)) <= set(keys) and all(
            isinstance(c, str) for c in order_by):
        raise ValueError("order_by adds nothing to the key: the first row would be arbitrary")
    alive, flags = F.lit(True), []
    for _name, pred in pre:
        alive = alive & F.coalesce(pred, F.lit(False))
        flags.append(alive)
    first = dedupe_first(df.filter(alive), list(keys), None if order_by is None else list(order_by))
    later, cond = [F.count(F.lit(1)).alias("m0")], F.lit(True)
    for j, (_name, pred) in enumerate(post, start=1):
        cond = cond & F.coalesce(pred, F.lit(False))
        later.append(F.count_if(cond).alias(f"m{j}"))
    if expand is not None:
        more = F.count_if(cond & F.coalesce(expand[1], F.lit(False)))
        later.append((F.count_if(cond) + more).alias(f"m{len(post) + 1}"))
    kept = first.agg(*later)
    one = kept.select(F.struct(*kept.columns).alias("m")).scalar()
    counted = df.agg(F.count(F.lit(1)).alias("n0"), *[
        F.count_if(f).alias(f"n{i}") for i, f in enumerate(flags, start=1)]).withColumn("m", one)
    names = [n for n, _ in pre] + [dedupe_name] + [n for n, _ in post]
    if expand is not None:
        names.append(expand[0])
    cols = [F.col(f"n{i}") for i in range(len(pre) + 1)] + [F.col(f"m.m{j}") for j in range(len(later))]
    rows = [F.struct(F.lit(i).alias("step_no"), F.lit(name).alias("step"),
                     cols[i - 1].cast("bigint").alias("rows_in"), cols[i].cast("bigint").alias("rows_out"))
            for i, name in enumerate(names, start=1)]
    out = counted.select(F.col("n0").alias("_input"), F.inline(F.array(*rows)))
    return out.select(
        "step_no", "step", "rows_in", "rows_out",
        (F.col("rows_in") - F.col("rows_out")).alias("removed"),
        (F.try_divide(F.col("rows_out"), F.col("_input")) * 100).alias("pct_retained"))


def vehicle_audit(raw: DataFrame, as_of=K.DEFAULT_AS_OF, order_by: Sequence = ("id",)) -> DataFrame:
    """C16 for P1 (with E3: the explosion adds one row per dual-fuel vehicle)."""
    return stage_audit(raw, vehicle_filter_steps(as_of), "dedupe", K.VEHICLE_DEDUPE_KEYS,
                       list(order_by),
                       expand=("explode_dual_fuel", F.col("fuelType2").isNotNull()))


def complaint_audit(raw: DataFrame, as_of=K.DEFAULT_AS_OF,
                    order_by: Sequence | None = ("CMPLID",)) -> DataFrame:
    """C16 for P2, in the job's default order; the typed columns are computed once before the audit."""
    typed = raw.withColumns({"_DATEA": parse_ymd("DATEA"), "_YEAR": parse_num("YEARTXT")})
    pre = [
        ("required_fields", C.all_present_pred(K.COMPLAINT_REQUIRED)),
        ("not_future_date", C.not_after_pred("_DATEA", as_of, keep_null=True)),
        ("mileage_cap", C.cap_pred("MILEAGE", K.COMPLAINT_MAX_MILEAGE, keep_null=True)),
        ("not_future_year", C.not_after_year_pred("_YEAR", as_of, keep_null=True)),
    ]
    post = [("integer_year", F.col("_YEAR").isNotNull())]
    return stage_audit(typed, pre, "dedupe", ["ODINO"], order_by, post=post)


def station_audit(raw: DataFrame, order_by: Sequence | None = None, box=K.STATION_BBOX,
                  fuel_codes: Sequence[str] = K.ALT_FUEL_CODES) -> DataFrame:
    """C16 for P3 (the fuel filter is evaluated on each id's first row)."""
    post = [("alt_fuel_only", F.col("fuel_type_code").isin(list(fuel_codes)))]
    return stage_audit(raw, station_filter_steps(box), "dedupe", ["id"], order_by, post=post)
