"""Registry of every implemented operator/product as a runnable query.

Each entry pairs the Spark implementation ``(spark, sf_dir) -> DataFrame``
with an independent SQL statement over the same tables (or ``None`` where no
SQL check is given). Keys are the operator ids of the blueprint. Computed
columns carry the same alias on both sides.

Parameters at the test scale (thresholds that would make a report empty or
trivial on the small tables) are stated per entry; the library defaults stay
the reference's.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import scalar as S
from ..operators import aggregates as A
from ..operators import filters as C
from ..operators import joins as J
from ..operators import ranking as R
from ..operators.dedupe import dedupe_first, distinct, flag_duplicates, attach_group_count
from ..operators.expand import explode_by_union, explode_ranked, explosion_metrics
from ..sources import bindings as B
from . import analysis as Q
from . import cleaning as P
from . import extras as X
from . import gate as G
from . import integration as I
from . import quality as D
from .oracle import _lst, _map_case, norm, with_ctes
from ..session import materialize
from .pipeline import Tables

AS_OF = K.DEFAULT_AS_OF
Y = AS_OF.year
DATE = f"DATE '{AS_OF.isoformat()}'"

Fn = Callable[[SparkSession, str], DataFrame]
_REG: dict[str, tuple[Fn, str | None]] = {}


def q(key: str, sql: str | None):
    def deco(fn: Callable[[Tables], DataFrame]):
        _REG[key] = (lambda spark, sf_dir: fn(Tables(spark, sf_dir, AS_OF)),
                     None if sql is None else with_ctes(sql, AS_OF))
        return fn
    return deco


def queries() -> dict[str, Fn]:
    return {k: v[0] for k, v in _REG.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in _REG.items() if v[1] is not None}


ORDER_TAIL = ", ".join(f"{c} ASC NULLS LAST" for c in Q.ANALYSIS_ROW_ORDER)


def _p4_written(t, key):
    """The tables with P4 written first, so that P4 and P6 read one build of it."""
    return Tables(t.spark, t.sf_dir, t.as_of, {"vca": materialize(t.vca, f"{_io_root(t, key)}/vca")})


def _nf(cols):
    """SQL ORDER BY tail, ascending with nulls first (top-k tie-breaks)."""
    return ", ".join(f"{c} ASC NULLS FIRST" for c in cols)


# =====================================================================  S5
@q("S5", f"""SELECT id, {', '.join(f"CASE WHEN {c} IN ({_lst(K.NA_TOKENS)}) THEN NULL ELSE {c} END AS {c}"
    for c in ['make', 'model', 'VClass', 'drive', 'trany', 'fuelType2'])} FROM raw_vehicles""")
def _s5(t):
    return t.raw_vehicles.select("id", *[S.nullify(c).alias(c) for c in
                                         ["make", "model", "VClass", "drive", "trany", "fuelType2"]])


# =====================================================================  C1..C15
@q("C1", "SELECT * FROM raw_vehicles WHERE year >= 2010")
def _c1(t):
    return C.min_year(t.raw_vehicles)


@q("C2", "SELECT * FROM raw_vehicles WHERE year IS NOT NULL AND make IS NOT NULL AND model IS NOT NULL")
def _c2(t):
    return C.require_all(t.raw_vehicles, K.VEHICLE_REQUIRED)


@q("C3", "SELECT * FROM raw_vehicles WHERE comb08 IS NOT NULL OR city08 IS NOT NULL OR highway08 IS NOT NULL")
def _c3(t):
    return C.require_any(t.raw_vehicles, K.VEHICLE_MEASURES)


@q("C4", "SELECT * FROM raw_vehicles WHERE comb08 IS DISTINCT FROM 0")
def _c4(t):
    return C.drop_zero(t.raw_vehicles, "comb08")


@q("C5", """SELECT * FROM raw_vehicles WHERE coalesce(comb08 <= 200, false)
  OR coalesce(contains(lower(fuelType), 'electric'), false)""")
def _c5(t):
    return C.cap_unless(t.raw_vehicles)


@q("C6", f"SELECT * FROM raw_vehicles WHERE year <= {Y}")
def _c6(t):
    return C.not_after_year(t.raw_vehicles, "year", AS_OF, keep_null=False)


@q("C7", f"""SELECT CMPLID, TRY_CAST(YEARTXT AS DOUBLE) AS YEARTXT FROM raw_complaints
  WHERE TRY_CAST(YEARTXT AS DOUBLE) IS NULL OR TRY_CAST(YEARTXT AS DOUBLE) <= {Y}""")
def _c7(t):
    d = t.raw_complaints.select("CMPLID", S.parse_num("YEARTXT").alias("YEARTXT"))
    return C.not_after_year(d, "YEARTXT", AS_OF, keep_null=True)


@q("C8", f"""SELECT CMPLID, CAST(try_strptime(DATEA, '%Y%m%d') AS DATE) AS DATEA FROM raw_complaints
  WHERE try_strptime(DATEA, '%Y%m%d') IS NULL OR CAST(try_strptime(DATEA, '%Y%m%d') AS DATE) <= {DATE}""")
def _c8(t):
    d = t.raw_complaints.select("CMPLID", S.parse_ymd("DATEA").alias("DATEA"))
    return C.not_after(d, "DATEA", AS_OF, keep_null=True)


@q("C9", "SELECT CMPLID, MILEAGE FROM raw_complaints WHERE MILEAGE IS NULL OR MILEAGE <= 1000000")
def _c9(t):
    return C.cap(t.raw_complaints.select("CMPLID", "MILEAGE"), "MILEAGE", K.COMPLAINT_MAX_MILEAGE)


@q("C10", "SELECT * FROM raw_stations WHERE latitude BETWEEN 18 AND 72 AND longitude BETWEEN -180 AND -65")
def _c10(t):
    return C.in_bbox(t.raw_stations)


@q("C11", "SELECT * FROM raw_stations WHERE latitude <> 0 OR longitude <> 0")
def _c11(t):
    return C.drop_null_island(t.raw_stations)


@q("C12", f"SELECT * FROM raw_stations WHERE fuel_type_code IN ({_lst(K.ALT_FUEL_CODES)})")
def _c12(t):
    return C.keep_in(t.raw_stations, "fuel_type_code", K.ALT_FUEL_CODES)


@q("C13", "SELECT fuel_type_code, station_name, state, latitude, longitude, status_code, access_code, id FROM raw_stations")
def _c13(t):
    return C.select_existing(t.raw_stations, K.STATION_KEEP_COLUMNS)


@q("C14", "SELECT * EXCLUDE (fuelType1, fuelType2), fuelType1 AS primary_fuel, fuelType2 AS secondary_fuel FROM raw_vehicles")
def _c14(t):
    return C.rename(t.raw_vehicles, K.VEHICLE_RENAMES)


@q("C15", "SELECT * FROM vca_joined")
def _c15(t):
    return I.vehicle_complaints_joined(t.vehicles, t.complaints)


# One-pass stage audits -------------------------------------------------
_V_FILTERS = [
    ("min_year", "year >= 2010"),
    ("required_fields", "year IS NOT NULL AND make IS NOT NULL AND model IS NOT NULL"),
    ("any_measure", "comb08 IS NOT NULL OR city08 IS NOT NULL OR highway08 IS NOT NULL"),
    ("nonzero_mpg", "comb08 IS DISTINCT FROM 0"),
    ("mpg_cap_unless_electric", "coalesce(comb08 <= 200, false) OR coalesce(contains(lower(fuelType), 'electric'), false)"),
    ("not_future_year", f"year <= {Y}"),
]


def _cum(filters):
    out, acc = [], []
    for name, p in filters:
        acc.append(f"coalesce(({p}), false)")
        out.append((name, " AND ".join(acc)))
    return out


def _audit(source: str, filters, dedupe_keys, order, post=(), expand=None) -> str:
    cum = _cum(filters)
    alive = cum[-1][1]
    counts = [("input", f"(SELECT count(*) FROM {source})")]
    counts += [(n, f"(SELECT count(*) FROM {source} WHERE {p})") for n, p in cum]
    win = (f"(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {', '.join(dedupe_keys)} "
           f"ORDER BY {order}) AS _rn FROM {source} WHERE {alive}) WHERE _rn = 1)")
    counts.append(("dedupe", f"(SELECT count(*) FROM {win})"))
    acc = []
    for n, p in post:
        acc.append(f"coalesce(({p}), false)")
        counts.append((n, f"(SELECT count(*) FROM {win} WHERE {' AND '.join(acc)})"))
    if expand is not None:
        cond = " AND ".join(acc) if acc else "true"
        counts.append((expand[0], f"(SELECT count(*) + count_if({expand[1]}) FROM {win} WHERE {cond})"))
    parts = []
    for i in range(1, len(counts)):
        parts.append(f"SELECT {i} AS step_no, '{counts[i][0]}' AS step, "
                     f"CAST({counts[i - 1][1]} AS BIGINT) AS rows_in, "
                     f"CAST({counts[i][1]} AS BIGINT) AS rows_out")
    inp = counts[0][1]
    return (f"SELECT step_no, step, rows_in, rows_out, rows_in - rows_out AS removed, "
            f"CAST(rows_out AS DOUBLE) / {inp} * 100 AS pct_retained FROM (\n"
            + "\nUNION ALL ".join(parts) + ")")


_C16_VEHICLES = _audit("raw_vehicles", _V_FILTERS,
                       ["year", "make", "model", "displ", "cylinders", "trany", "drive", "fuelType",
                        "comb08", "city08", "highway08"], "id ASC NULLS LAST",
                       expand=("explode_dual_fuel", "fuelType2 IS NOT NULL"))


@q("C16", _C16_VEHICLES)
def _c16(t):
    return P.vehicle_audit(t.raw_vehicles, AS_OF, B.VEHICLE_ORDER)


_CT = ("(SELECT *, CAST(try_strptime(DATEA, '%Y%m%d') AS DATE) AS _DATEA, "
       "TRY_CAST(YEARTXT AS DOUBLE) AS _YEAR FROM raw_complaints)")


_C16_COMPLAINTS = _audit(_CT, [
    ("required_fields", "ODINO IS NOT NULL AND DATEA IS NOT NULL AND YEARTXT IS NOT NULL AND MAKETXT IS NOT NULL AND MODELTXT IS NOT NULL"),
    ("not_future_date", f"_DATEA IS NULL OR _DATEA <= {DATE}"),
    ("mileage_cap", "MILEAGE IS NULL OR MILEAGE <= 1000000"),
    ("not_future_year", f"_YEAR IS NULL OR _YEAR <= {Y}")],
    ["ODINO"], "l_linenumber, l_partkey, l_suppkey, l_extendedprice",
    post=[("integer_year", "_YEAR IS NOT NULL")])


@q("C16_complaints", _C16_COMPLAINTS)
def _c16c(t):
    return P.complaint_audit(t.raw_complaints, AS_OF, B.COMPLAINT_ORDER)


_C16_STATIONS = _audit("raw_stations", [
    ("required_fields", "latitude IS NOT NULL AND longitude IS NOT NULL AND fuel_type_code IS NOT NULL AND status_code IS NOT NULL"),
    ("in_bbox", "latitude BETWEEN 18 AND 72 AND longitude BETWEEN -180 AND -65"),
    ("not_null_island", "latitude <> 0 OR longitude <> 0")],
    ["id"], "access_code",
    post=[("alt_fuel_only", f"fuel_type_code IN ({_lst(K.ALT_FUEL_CODES)})")])


@q("C16_stations", _C16_STATIONS)
def _c16s(t):
    return P.station_audit(t.raw_stations, B.STATION_ORDER)


#: Scored rules that the bound tables do not hold: reported, no load is refused.
KNOWN_VIOLATIONS = ["vehicles.no_missing_critical", "complaints.no_missing_critical"]


def _staged(t, key):
    """P1-P3 written and audited by a load that is not published."""
    run = G.Load(t.spark, _io_root(t, key), KNOWN_VIOLATIONS)
    run.stage(G.vehicles_job(t.raw_vehicles, AS_OF, B.VEHICLE_ORDER), G.complaints_job(t.raw_complaints, AS_OF, B.COMPLAINT_ORDER),
              G.stations_job(t.raw_stations, B.STATION_ORDER))
    return {"stages": run.stages, "rules": run.rules}


@q("C16_load", " UNION ALL ".join(
    f"SELECT '{name}' AS dataset, step_no, step, rows_in, rows_out FROM ({sql})" for name, sql in (
        ("vehicles", _C16_VEHICLES), ("complaints", _C16_COMPLAINTS), ("stations", _C16_STATIONS))))
def _c16_load(t):
    """C16 as counted by the writes of a load (step 0, the input, is left out)."""
    return G.load_stages(t.spark, _staged(t, "C16_load")).where("step_no > 0")


# =====================================================================  V1..V6
@q("V1", "SELECT CMPLID, DATEA, CAST(try_strptime(DATEA, '%Y%m%d') AS DATE) AS DATEA_date FROM raw_complaints")
def _v1(t):
    return t.raw_complaints.select("CMPLID", "DATEA", S.parse_ymd("DATEA").alias("DATEA_date"))


@q("V2", "SELECT CMPLID, YEARTXT, TRY_CAST(YEARTXT AS DOUBLE) AS YEARTXT_num FROM raw_complaints")
def _v2(t):
    return t.raw_complaints.select("CMPLID", "YEARTXT", S.parse_num("YEARTXT").alias("YEARTXT_num"))


@q("V3", "SELECT ODINO, strftime(DATEA, '%Y-%m-%d') AS DATEA_text FROM clean_complaints")
def _v3(t):
    return t.complaints.select("ODINO", S.fmt_date("DATEA").alias("DATEA_text"))


@q("V4", "SELECT ODINO, CMPLID, MAKETXT, MODELTXT, 'YEARTXT is not numeric' AS reason FROM cc_dedup WHERE YEARTXT IS NULL")
def _v4(t):
    return P.complaint_rejects(t.raw_complaints, AS_OF, B.COMPLAINT_ORDER)


@q("V5", "SELECT ODINO, YEARTXT, MILEAGE FROM clean_complaints")
def _v5(t):
    return t.complaints.select("ODINO", "YEARTXT", "MILEAGE")


@q("V6", "SELECT ODINO, TRY_CAST(strftime(DATEA, '%Y-%m-%d') AS DATE) AS DATEA_roundtrip FROM clean_complaints")
def _v6(t):
    return t.complaints.select("ODINO", S.parse_iso(S.fmt_date("DATEA")).alias("DATEA_roundtrip"))


# =====================================================================  K1..K6
@q("K1", """SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY year, make, model,
  displ, cylinders, trany, drive, fuelType, comb08, city08, highway08 ORDER BY id ASC NULLS LAST) AS _rn
  FROM raw_vehicles) WHERE _rn = 1""")
def _k1(t):
    return dedupe_first(t.raw_vehicles, K.VEHICLE_DEDUPE_KEYS, B.VEHICLE_ORDER)


@q("K2", """SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY ODINO ORDER BY
  l_linenumber ASC NULLS LAST, l_partkey ASC NULLS LAST, l_suppkey ASC NULLS LAST,
  l_extendedprice ASC NULLS LAST) AS _rn FROM raw_complaints) WHERE _rn = 1""")
def _k2(t):
    return dedupe_first(t.raw_complaints, ["ODINO"], B.COMPLAINT_ORDER)


@q("K3", """SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY
  access_code ASC NULLS LAST) AS _rn FROM raw_stations) WHERE _rn = 1""")
def _k3(t):
    return dedupe_first(t.raw_stations, ["id"], B.STATION_ORDER)


@q("K4", "SELECT DISTINCT * FROM vca_joined")
def _k4(t):
    return distinct(I.vehicle_complaints_joined(t.vehicles, t.complaints))


@q("K5", f"""SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY year, make, model
  ORDER BY {ORDER_TAIL}) AS _rn FROM comp) WHERE _rn = 1""")
def _k5(t):
    return dedupe_first(t.comp, ["year", "make", "model"], Q.ANALYSIS_ROW_ORDER)


@q("K6", """SELECT * FROM (SELECT *, count(*) OVER (PARTITION BY id) AS dup_count FROM raw_stations)
  WHERE dup_count > 1""")
def _k6(t):
    return flag_duplicates(t.raw_stations, ["id"])


# =====================================================================  E1..E3
@q("E1", "SELECT * FROM clean_vehicles")
def _e1(t):
    return explode_ranked(P.clean_vehicles_unexploded(t.raw_vehicles, AS_OF, B.VEHICLE_ORDER))


@q("E2", "SELECT * FROM clean_vehicles")
def _e2(t):
    return explode_by_union(P.clean_vehicles_unexploded(t.raw_vehicles, AS_OF, B.VEHICLE_ORDER))


@q("E3", """SELECT count(*) AS rows_before, CAST(count_if(secondary_fuel IS NOT NULL) AS BIGINT) AS dual_fuel,
  count(*) + CAST(count_if(secondary_fuel IS NOT NULL) AS BIGINT) AS rows_after FROM cv_unexploded""")
def _e3(t):
    return explosion_metrics(P.clean_vehicles_unexploded(t.raw_vehicles, AS_OF, B.VEHICLE_ORDER))


# =====================================================================  F1..F10
@q("F1", f"SELECT CMPLID, {norm('MAKETXT')} AS make_norm, {norm('MODELTXT')} AS model_norm FROM raw_complaints")
def _f1(t):
    return t.raw_complaints.select("CMPLID", S.norm_key("MAKETXT").alias("make_norm"),
                                   S.norm_key("MODELTXT").alias("model_norm"))


@q("F2", f"SELECT id, fuel_rank, fuel_used, {_map_case('fuel_used')} AS fuel_type_code FROM clean_vehicles")
def _f2(t):
    return t.vehicles.select("id", "fuel_rank", "fuel_used",
                             S.map_code("fuel_used").alias("fuel_type_code"))


@q("F3", "SELECT id, fuel_rank, coalesce(contains(lower(fuel_used), 'electric'), false) AS is_electric FROM clean_vehicles")
def _f3(t):
    return t.vehicles.select("id", "fuel_rank", S.icontains("fuel_used", "Electric").alias("is_electric"))


@q("F4", """SELECT id, fuel_rank, total_complaints, crash_incidents, fire_incidents, total_injured,
  total_deaths, avg_complaint_mileage FROM vj_full""")
def _f4(t):
    from .integration import normalized_complaints
    rollup = A.complaint_rollup(normalized_complaints(t.complaints))
    j = J.join_complaints(t.vehicles, rollup)
    return j.select("id", "fuel_rank", *K.COMPLAINT_MEASURES)


@q("F5", """SELECT year, fuel_type_code, vehicle_count / (CASE WHEN total_stations = 0 THEN 1
  ELSE total_stations END) AS ratio FROM infra""")
def _f5(t):
    return t.infra.select("year", "fuel_type_code",
                          S.ratio_zero_as_one("vehicle_count", "total_stations").alias("ratio"))


@q("F6", """SELECT year, fuel_type_code, round_even(avg_combined_mpg * 10, 0) / 10 AS mpg_1,
  round_even(avg_city_mpg * 10, 0) / 10 AS city_1 FROM fuel_year""")
def _f6(t):
    v = t.vehicles.withColumn("fuel_type_code", S.map_code("fuel_used"))
    return A.fuel_year_rollup(v).select("year", "fuel_type_code",
                                        S.round_even("avg_combined_mpg", 1).alias("mpg_1"),
                                        S.round_even("avg_city_mpg", 1).alias("city_1"))


_BRAND_SQL = """SELECT make, CAST(coalesce(sum(total_complaints), 0) AS BIGINT) AS total_complaints,
  CAST(coalesce(sum(crash_incidents), 0) AS BIGINT) AS crash_incidents,
  CAST(coalesce(sum(fire_incidents), 0) AS BIGINT) AS fire_incidents,
  count(year) AS vehicle_count FROM vca WHERE make IS NOT NULL GROUP BY make"""


@q("F7", f"SELECT *, total_complaints / vehicle_count AS complaints_per_vehicle FROM ({_BRAND_SQL})")
def _f7(t):
    return A.brand_rollup(t.vca).withColumn("complaints_per_vehicle",
                                            S.rate("total_complaints", "vehicle_count"))


_Q1_CORE = """SELECT avg(CASE WHEN comb08 > {m} THEN total_complaints END) AS high_mpg_avg,
  CAST(count_if(comb08 > {m}) AS BIGINT) AS high_mpg_count,
  avg(CASE WHEN comb08 <= {m} THEN total_complaints END) AS low_mpg_avg,
  CAST(count_if(comb08 <= {m}) AS BIGINT) AS low_mpg_count FROM vca"""


@q("F8", f"SELECT (low_mpg_avg - high_mpg_avg) / low_mpg_avg * 100 AS pct FROM ({_Q1_CORE.format(m=30)})")
def _f8(t):
    m = A.mean_where(t.vca, "total_complaints", {"high_mpg": F.col("comb08") > 30,
                                                  "low_mpg": F.col("comb08") <= 30})
    return m.select(S.pct_diff("low_mpg_avg", "high_mpg_avg").alias("pct"))


@q("F9", """SELECT year, fuel_type_code, CASE WHEN total_stations / vehicle_count * 1000 < 10000
  THEN 'constrained' ELSE 'adequate' END AS status FROM infra""")
def _f9(t):
    return t.infra.select("year", "fuel_type_code", S.label(
        S.per("total_stations", "vehicle_count", 1000), 10000, "constrained", "adequate")
        .alias("status"))


@q("F10", "SELECT id, fuel_rank, least(city08, highway08) AS mpg_min, greatest(city08, highway08) AS mpg_max FROM clean_vehicles")
def _f10(t):
    return t.vehicles.select("id", "fuel_rank", S.row_min("city08", "highway08").alias("mpg_min"),
                             S.row_max("city08", "highway08").alias("mpg_max"))


# =====================================================================  A1..A20
@q("A1", "SELECT * FROM complaint_rollup")
def _a1(t):
    from .integration import normalized_complaints
    return A.complaint_rollup(normalized_complaints(t.complaints))


@q("A2", "SELECT * FROM vca_variants")
def _a2(t):
    # the join keeps the vehicle rows, so their groups are counted before it
    return attach_group_count(I.vehicle_complaints_joined(t.vehicles, t.complaints),
                              ["year", "make", "model"], "vehicle_variants", null_keys_match=False,
                              counts_from=t.vehicles)


@q("A3", "SELECT * FROM fuel_year")
def _a3(t):
    return A.fuel_year_rollup(t.vehicles.withColumn("fuel_type_code", S.map_code("fuel_used")))


@q("A4", "SELECT * FROM stations_by_state")
def _a4(t):
    return A.stations_by_state(t.stations)


@q("A5", "SELECT * FROM stations_by_fuel")
def _a5(t):
    return A.stations_by_fuel(t.stations)


@q("A5_two_level", """SELECT fuel_type_code, CAST(sum(total_stations) AS BIGINT) AS total_stations,
  CAST(sum(available_stations) AS BIGINT) AS available_stations FROM stations_by_state GROUP BY 1""")
def _a5b(t):
    return A.stations_by_fuel_two_level(t.stations)


@q("A6", "SELECT * FROM nationwide")
def _a6(t):
    return A.stations_nationwide(t.stations)


@q("A7", _Q1_CORE.format(m=30))
def _a7(t):
    return A.mean_where(t.vca, "total_complaints", {"high_mpg": F.col("comb08") > 30,
                                                     "low_mpg": F.col("comb08") <= 30})


@q("A8", _BRAND_SQL)
def _a8(t):
    return A.brand_rollup(t.vca)


_CLASS_SQL = """SELECT VClass, avg(comb08) AS comb08, avg(total_complaints) AS total_complaints,
  count(year) AS count FROM comp WHERE VClass IS NOT NULL GROUP BY VClass"""


@q("A9", _CLASS_SQL)
def _a9(t):
    return A.class_rollup(t.comp)


@q("A10", f"SELECT * FROM ({_CLASS_SQL}) WHERE count > 100")
def _a10(t):
    return A.having(A.class_rollup(t.comp), "count", 100)


_A11_SQL = """SELECT fuel_type_code, vehicle_count, total_stations, available_stations,
  round_even(_t / _n, 0) / 10 AS avg_combined_mpg,
  round_even(vehicle_count / (CASE WHEN total_stations = 0 THEN 1 ELSE total_stations END) * 10, 0) / 10
    AS vehicles_per_station
FROM (SELECT fuel_type_code, CAST(coalesce(sum(vehicle_count), 0) AS BIGINT) AS vehicle_count,
        min(total_stations) AS total_stations, min(available_stations) AS available_stations,
        CAST(sum(CAST(round_even(avg_combined_mpg * 10, 0) AS BIGINT)) AS BIGINT) AS _t,
        count(avg_combined_mpg) AS _n
      FROM infra WHERE fuel_type_code IS NOT NULL GROUP BY 1)"""


@q("A11", _A11_SQL)
def _a11(t):
    return A.fuel_summary(t.infra)


@q("A12", "SELECT count(DISTINCT id) AS distinct_id FROM clean_vehicles")
def _a12(t):
    return A.count_distinct(t.vehicles, "id")


@q("A13", """SELECT n_values, count(*) AS n_keys FROM (SELECT id, count(DISTINCT fuel_rank) AS n_values
  FROM clean_vehicles WHERE id IS NOT NULL GROUP BY id) GROUP BY n_values""")
def _a13(t):
    return A.distinct_per_group(t.vehicles, "id", "fuel_rank")


@q("A14", "SELECT make, count(*) AS count FROM clean_vehicles WHERE make IS NOT NULL GROUP BY make")
def _a14(t):
    return A.value_counts(t.vehicles, "make")


@q("A14_top5", """SELECT make, count(*) AS count FROM clean_vehicles WHERE make IS NOT NULL GROUP BY make
  ORDER BY count DESC, make ASC LIMIT 5""")
def _a14b(t):
    return A.value_counts(t.vehicles, "make", k=5)


@q("A15", "SELECT year, count(*) AS count FROM clean_vehicles WHERE year IS NOT NULL GROUP BY year")
def _a15(t):
    return A.value_counts(t.vehicles, "year", by="value")


@q("A16", """SELECT avg(comb08) AS mean, quantile_cont(comb08, 0.5) AS median, min(comb08) AS min,
  max(comb08) AS max, round_even(stddev_samp(comb08) * 1000000000, 0) / 1000000000 AS std
  FROM clean_vehicles""")
def _a16(t):
    return A.profile_numeric(t.vehicles, "comb08")


@q("A17", """SELECT CAST(coalesce(sum(total_complaints), 0) AS BIGINT) AS sum_total_complaints,
  CAST(coalesce(sum(crash_incidents), 0) AS BIGINT) AS sum_crash_incidents,
  CAST(coalesce(sum(fire_incidents), 0) AS BIGINT) AS sum_fire_incidents,
  CAST(coalesce(sum(total_injured), 0) AS BIGINT) AS sum_total_injured,
  CAST(coalesce(sum(total_deaths), 0) AS BIGINT) AS sum_total_deaths FROM vca""")
def _a17(t):
    return A.totals(t.vca, ["total_complaints", "crash_incidents", "fire_incidents",
                            "total_injured", "total_deaths"])


@q("A17_share", """SELECT count(*) AS rows, CAST(count_if(total_complaints > 0) AS BIGINT) AS with_rows,
  CAST(count_if(NOT coalesce(total_complaints > 0, false)) AS BIGINT) AS without_rows,
  CAST(count_if(total_complaints > 0) AS DOUBLE) / count(*) * 100 AS with_pct,
  CAST(count_if(NOT coalesce(total_complaints > 0, false)) AS DOUBLE) / count(*) * 100 AS without_pct
  FROM vca""")
def _a17b(t):
    return A.share(t.vca, F.col("total_complaints") > 0)


@q("A18", "SELECT min(year) AS min, max(year) AS max, CAST(count_if(year < 2010 OR year > 2025) AS BIGINT) AS out_of_range FROM clean_vehicles")
def _a18(t):
    return A.col_range(t.vehicles, "year", 2010, 2025)


@q("A19", """SELECT 'year' AS "column", CAST(count_if(year IS NULL) AS BIGINT) AS nulls FROM clean_vehicles
  UNION ALL SELECT 'make', CAST(count_if(make IS NULL) AS BIGINT) FROM clean_vehicles
  UNION ALL SELECT 'model', CAST(count_if(model IS NULL) AS BIGINT) FROM clean_vehicles
  UNION ALL SELECT 'comb08', CAST(count_if(comb08 IS NULL) AS BIGINT) FROM clean_vehicles""")
def _a19(t):
    return A.null_counts(t.vehicles, ["year", "make", "model", "comb08"])


_ROWCOUNT_TABLES = ["raw_vehicles", "raw_complaints", "raw_stations", "clean_vehicles",
                    "clean_complaints", "clean_stations", "vca", "infra", "comp"]
_ROWCOUNT_ATTR = ["raw_vehicles", "raw_complaints", "raw_stations", "vehicles", "complaints",
                  "stations", "vca", "infra", "comp"]


@q("A20", "\nUNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS rows FROM {n}"
                              for n in _ROWCOUNT_TABLES))
def _a20(t):
    once = _p4_written(t, "A20")
    return A.row_counts({n: getattr(once, a) for n, a in zip(_ROWCOUNT_TABLES, _ROWCOUNT_ATTR)})


# =====================================================================  J1..J4
@q("J1", "SELECT * FROM vj_full")
def _j1(t):
    from .integration import normalized_complaints
    return J.join_complaints(t.vehicles, A.complaint_rollup(normalized_complaints(t.complaints)))


@q("J3", "SELECT * FROM infra_joined")
def _j3(t):
    vc = A.fuel_year_rollup(t.vehicles.withColumn("fuel_type_code", S.map_code("fuel_used")))
    return J.join_stations(vc, A.stations_by_fuel(t.stations), broadcast_right=True)


@q("J4", "SELECT * FROM comp")
def _j4(t):
    b = t.vca.withColumn("fuel_type_code", S.map_code("fuel_used"))
    return J.join_nationwide(b, A.stations_nationwide(t.stations), broadcast_right=True)


# =====================================================================  R1..R4
_R_COLS = "id, fuel_rank, year, make, model, comb08"


@q("R1", f"SELECT {_R_COLS} FROM clean_vehicles WHERE comb08 IS NOT NULL ORDER BY comb08 DESC, id ASC NULLS FIRST, fuel_rank ASC NULLS FIRST LIMIT 10")
def _r1(t):
    return R.top_k(t.vehicles.select("id", "fuel_rank", "year", "make", "model", "comb08"),
                   "comb08", 10, tie_break=["id", "fuel_rank"])


@q("R2", f"SELECT {_R_COLS} FROM clean_vehicles WHERE comb08 IS NOT NULL ORDER BY comb08 ASC, id ASC NULLS FIRST, fuel_rank ASC NULLS FIRST LIMIT 10")
def _r2(t):
    return R.bottom_k(t.vehicles.select("id", "fuel_rank", "year", "make", "model", "comb08"),
                      "comb08", 10, tie_break=["id", "fuel_rank"])


@q("R3", "SELECT * FROM infra ORDER BY vehicles_per_station ASC NULLS LAST, year, fuel_type_code")
def _r3(t):
    return R.order(t.infra, "vehicles_per_station", tie_break=["year", "fuel_type_code"])


@q("R4", """SELECT id, fuel_rank, year, make, model, city08, highway08, comb08 FROM clean_vehicles
  WHERE coalesce(comb08 < least(city08, highway08) OR comb08 > greatest(city08, highway08), false)
  ORDER BY id ASC NULLS FIRST, fuel_rank ASC NULLS FIRST LIMIT 5""")
def _r4(t):
    return D.sample_inconsistent(t.vehicles, 5)


# =====================================================================  P1..P6
@q("P1", "SELECT * FROM clean_vehicles")
def _p1(t):
    return t.vehicles


@q("P2", "SELECT * FROM clean_complaints")
def _p2(t):
    return t.complaints


@q("P3", "SELECT * FROM clean_stations")
def _p3(t):
    return t.stations


@q("P4", "SELECT * FROM vca")
def _p4(t):
    return t.vca


@q("P5", "SELECT * FROM infra")
def _p5(t):
    return t.infra


@q("P6", "SELECT * FROM comp")
def _p6(t):
    return t.comp


# =====================================================================  Q1..Q12
@q("Q1", f"""SELECT *, low_mpg_avg - high_mpg_avg AS difference,
  CASE WHEN high_mpg_avg < low_mpg_avg THEN 'efficient vehicles have fewer complaints'
       ELSE 'no clear correlation' END AS verdict FROM ({_Q1_CORE.format(m=30)})""")
def _q1(t):
    return Q.efficiency_vs_complaints(t.vca, 30)


@q("Q2", f"""SELECT * FROM (SELECT *, total_complaints / vehicle_count AS complaints_per_vehicle
  FROM ({_BRAND_SQL})) WHERE vehicle_count > 50 AND complaints_per_vehicle IS NOT NULL
  ORDER BY complaints_per_vehicle DESC, make ASC NULLS FIRST LIMIT 5""")
def _q2(t):
    return Q.brands_by_complaint_rate(t.vca, 50, 5)


@q("Q3", """SELECT *, CASE WHEN ev_avg < gas_avg THEN (gas_avg - ev_avg) / gas_avg * 100 END AS ev_pct_fewer,
  CASE WHEN ev_avg < gas_avg THEN 'EVs have fewer complaints' ELSE 'EVs do not have fewer complaints' END AS verdict
  FROM (SELECT avg(CASE WHEN contains(lower(fuel_used), 'electricity') THEN total_complaints END) AS ev_avg,
    CAST(count_if(coalesce(contains(lower(fuel_used), 'electricity'), false)) AS BIGINT) AS ev_count,
    avg(CASE WHEN contains(lower(fuel_used), 'gasoline') THEN total_complaints END) AS gas_avg,
    CAST(count_if(coalesce(contains(lower(fuel_used), 'gasoline'), false)) AS BIGINT) AS gas_count FROM vca)""")
def _q3(t):
    return Q.electric_vs_gasoline(t.vca)


_Q4_SQL = """SELECT year, fuel_type_code, total_stations, vehicle_count,
  total_stations / vehicle_count * 1000 AS stations_per_1000_vehicles,
  CASE WHEN total_stations / vehicle_count * 1000 < {thr} THEN 'constrained' ELSE 'adequate' END AS status
  FROM infra WHERE year = {year}"""


@q("Q4", _Q4_SQL.format(thr=10000, year=2024) + " ORDER BY stations_per_1000_vehicles, fuel_type_code")
def _q4(t):
    return Q.infrastructure_status(t.infra, 2024, 10000)


@q("Q4_gaps", f"""SELECT CAST(count_if(status = 'constrained') AS BIGINT) AS n_constrained,
  coalesce(string_agg(CASE WHEN status = 'constrained' THEN fuel_type_code END, ', '
    ORDER BY CASE WHEN status = 'constrained' THEN fuel_type_code END), '') AS constrained_fuels
  FROM ({_Q4_SQL.format(thr=10000, year=2024)})""")
def _q4b(t):
    return Q.infrastructure_gaps(t.infra, 2024, 10000)


@q("Q5", """SELECT *, CASE WHEN poor_infra_avg > good_infra_avg THEN (poor_infra_avg - good_infra_avg) / good_infra_avg * 100 END AS poor_pct_more,
  CASE WHEN poor_infra_avg > good_infra_avg THEN 'poor infrastructure has more complaints' ELSE 'no clear correlation' END AS verdict
  FROM (SELECT avg(CASE WHEN stations_nationwide > 100 THEN total_complaints END) AS good_infra_avg,
    CAST(count_if(stations_nationwide > 100) AS BIGINT) AS good_infra_count,
    avg(CASE WHEN stations_nationwide <= 100 THEN total_complaints END) AS poor_infra_avg,
    CAST(count_if(stations_nationwide <= 100) AS BIGINT) AS poor_infra_count FROM comp)""")
def _q5(t):
    return Q.infrastructure_vs_complaints(t.comp, 100)


@q("Q6", f"""(SELECT *, 'efficient' AS list FROM ({_CLASS_SQL}) WHERE count > 100 AND comb08 IS NOT NULL
   ORDER BY comb08 DESC, VClass ASC NULLS FIRST LIMIT 5)
  UNION ALL
  (SELECT *, 'reliable' AS list FROM ({_CLASS_SQL}) WHERE count > 100 AND total_complaints IS NOT NULL
   ORDER BY total_complaints ASC, VClass ASC NULLS FIRST LIMIT 5)""")
def _q6(t):
    return Q.class_performance(t.comp, 100, 5)


def _topk_sql(cols, key, where, k, desc=True, src="vca"):
    others = [c for c in cols if c != key]
    return (f"SELECT {', '.join(cols)} FROM {src} WHERE ({where}) AND {key} IS NOT NULL "
            f"ORDER BY {key} {'DESC' if desc else 'ASC'}, {_nf(others)} LIMIT {k}")


@q("Q7", _topk_sql(Q.Q7_COLS, "total_complaints", "total_complaints > 0", 10))
def _q7(t):
    return Q.top_complaints(t.vca, 10)


@q("Q8", _topk_sql(Q.Q8_COLS, "comb08", "total_complaints = 0", 10))
def _q8(t):
    return Q.efficient_without_complaints(t.vca, 10)


@q("Q9", _A11_SQL)
def _q9(t):
    return Q.fuel_summary(t.infra)


_Q10_COLS = ", ".join(Q.Q10_COLS)


@q("Q10", f"""(SELECT {_Q10_COLS}, 'worst' AS list FROM infra WHERE vehicles_per_station IS NOT NULL
   ORDER BY vehicles_per_station DESC, year ASC NULLS FIRST, fuel_type_code ASC NULLS FIRST LIMIT 10)
  UNION ALL
  (SELECT {_Q10_COLS}, 'best' AS list FROM infra WHERE vehicle_count > 0 AND vehicles_per_station IS NOT NULL
   ORDER BY vehicles_per_station ASC, year ASC NULLS FIRST, fuel_type_code ASC NULLS FIRST LIMIT 10)""")
def _q10(t):
    return Q.coverage_extremes(t.infra, 10)


def _q11_sql(strict, relaxed):
    s = f"comb08 > {strict[0]} AND total_complaints < {strict[1]} AND stations_nationwide > {strict[2]}"
    r = f"comb08 > {relaxed[0]} AND total_complaints < {relaxed[1]} AND stations_nationwide > {relaxed[2]}"
    n = f"(SELECT count_if({s}) FROM comp)"
    inner = _topk_sql(Q.Q11_COLS, "comb08",
                      f"CASE WHEN {n} > 0 THEN coalesce({s}, false) ELSE coalesce({r}, false) END",
                      10, src="comp")
    return (f"SELECT *, CASE WHEN {n} > 0 THEN 'strict' ELSE 'relaxed' END AS rule "
            f"FROM ({inner})")


@q("Q11", _q11_sql((35, 10, 100), (30, 50, 500)))
def _q11(t):
    return Q.best_overall(t.comp, (35, 10, 100), (30, 50, 500), 10)


@q("Q11_fallback", _q11_sql((35, 10, 1000), (30, 50, 50)))
def _q11b(t):
    return Q.best_overall(t.comp, (35, 10, 1000), (30, 50, 50), 10)


@q("Q12", f"""SELECT {', '.join(Q.Q12_COLS)} FROM (
  SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY year, make, model
    ORDER BY {ORDER_TAIL}) AS _rn FROM comp WHERE total_complaints > 8 AND stations_nationwide < 100)
  WHERE _rn = 1) WHERE total_complaints IS NOT NULL
  ORDER BY total_complaints DESC, year ASC NULLS FIRST, make ASC NULLS FIRST, model ASC NULLS FIRST LIMIT 10""")
def _q12(t):
    return Q.problem_vehicles(t.comp, 8, 100, 10)


@q("J2", "SELECT * FROM vca_variants")
def _j2(t):
    """The reference's self-join for the group size, written as A2."""
    # the join keeps the vehicle rows, so their groups are counted before it
    return attach_group_count(I.vehicle_complaints_joined(t.vehicles, t.complaints),
                              ["year", "make", "model"], "vehicle_variants", null_keys_match=False,
                              counts_from=t.vehicles)


# =====================================================================  D1..D9
def _contract_sql():
    parts = []
    for key, name in [("vca", "vehicle_complaints_analysis"), ("infra", "fuel_infrastructure_analysis"),
                      ("comp", "comprehensive_vehicle_analysis")]:
        _req, mn = K.CONTRACT[name]
        parts.append(f"SELECT '{name}' AS \"table\", count(*) AS rows, '' AS missing_columns, "
                     f"CAST({mn} AS BIGINT) AS min_rows, count(*) >= {mn} AS passed FROM {key}")
    return "\nUNION ALL ".join(parts)


@q("D1", _contract_sql())
def _d1(t):
    once = _p4_written(t, "D1")
    return D.contract({"vehicle_complaints_analysis": once.vca,
                       "fuel_infrastructure_analysis": once.infra,
                       "comprehensive_vehicle_analysis": once.comp})


def _rules_sql(dataset, wide_sql, rules, scored=None):
    scored = rules if scored is None else scored
    parts = [f"SELECT '{dataset}' AS dataset, '{r}' AS rule, CAST({r} AS BIGINT) AS violations, "
             f"CAST({r} AS BIGINT) = 0 AS passed, {'true' if r in scored else 'false'} AS scored FROM w"
             for r in rules]
    return f"SELECT * FROM (WITH w AS ({wide_sql})\n" + "\nUNION ALL ".join(parts) + ")"


_D2_RULES = ["year_in_range", "positive_mpg", "year_not_null", "make_not_null", "model_not_null"]
_D2_WIDE = """SELECT count_if(year < 2010 OR year > 2025) AS year_in_range,
  count_if(comb08 <= 0) AS positive_mpg, count_if(year IS NULL) AS year_not_null,
  count_if(make IS NULL) AS make_not_null, count_if(model IS NULL) AS model_not_null FROM vca"""


@q("D2", _rules_sql("vehicle_complaints_analysis", _D2_WIDE, _D2_RULES))
def _d2(t):
    return D.vehicle_rules(t.vca)


def _nullcells(cols):
    return " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in cols)


def _dups(src, keys):
    return (f"(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {src} "
            f"GROUP BY {', '.join(keys)}) WHERE n > 1)")


_D3_ORDER = ["no_pre_min_year", "no_missing_critical", "no_zero_mpg", "no_high_mpg_non_electric",
             "no_future_year", "no_duplicate_id_rank", "mpg_consistency"]
_D3_WIDE = f"""SELECT count_if(year < 2010) AS no_pre_min_year,
  coalesce(sum({_nullcells(['year', 'make', 'model', 'comb08'])}), 0) AS no_missing_critical,
  count_if(comb08 = 0) AS no_zero_mpg,
  count_if(comb08 > 200 AND NOT coalesce(contains(lower(fuel_used), 'electric'), false)) AS no_high_mpg_non_electric,
  count_if(year > {Y}) AS no_future_year,
  {_dups('clean_vehicles', ['id', 'fuel_rank'])} AS no_duplicate_id_rank,
  count_if(comb08 < least(city08, highway08) OR comb08 > greatest(city08, highway08)) AS mpg_consistency
  FROM clean_vehicles"""


@q("D3", _rules_sql("vehicles", _D3_WIDE, _D3_ORDER, _D3_ORDER[:-1]))
def _d3(t):
    return D.vehicle_checks(t.vehicles, AS_OF)


@q("D4", """SELECT id, fuel_rank, year, make, model, city08, highway08, comb08 FROM clean_vehicles
  WHERE coalesce(comb08 < least(city08, highway08) OR comb08 > greatest(city08, highway08), false)
  ORDER BY id ASC NULLS FIRST, fuel_rank ASC NULLS FIRST LIMIT 5""")
def _d4(t):
    return D.sample_inconsistent(t.vehicles, 5)


_D5_RULES = ["no_missing_critical", "no_duplicate_odino", "no_future_date", "no_future_year"]
_D5_WIDE = f"""SELECT coalesce(sum({_nullcells(K.COMPLAINT_REQUIRED)}), 0) AS no_missing_critical,
  {_dups('clean_complaints', ['ODINO'])} AS no_duplicate_odino,
  count_if(DATEA > {DATE}) AS no_future_date, count_if(YEARTXT > {Y}) AS no_future_year
  FROM clean_complaints"""


@q("D5", _rules_sql("complaints", _D5_WIDE, _D5_RULES))
def _d5(t):
    return D.complaint_checks(t.complaints, AS_OF)


_D6_RULES = ["no_missing_critical", "coordinates_in_bounds", "allowed_fuel_codes", "no_duplicate_id"]
_D6_WIDE = f"""SELECT coalesce(sum({_nullcells(K.STATION_REQUIRED)}), 0) AS no_missing_critical,
  count_if(latitude < 18 OR latitude > 72) + count_if(longitude < -180 OR longitude > -65)
    + count_if(latitude = 0 AND longitude = 0) AS coordinates_in_bounds,
  count_if(NOT coalesce(fuel_type_code IN ({_lst(K.ALT_FUEL_CODES)}), false)) AS allowed_fuel_codes,
  {_dups('clean_stations', ['id'])} AS no_duplicate_id FROM clean_stations"""


@q("D6", _rules_sql("stations", _D6_WIDE, _D6_RULES))
def _d6(t):
    return D.station_checks(t.stations)


@q("D_load", f"""{_rules_sql("vehicles", _D3_WIDE, _D3_ORDER, _D3_ORDER[:-1])}
  UNION ALL {_rules_sql("complaints", _D5_WIDE, _D5_RULES)}
  UNION ALL {_rules_sql("stations", _D6_WIDE, _D6_RULES)}""")
def _d_load(t):
    """D3, D5 and D6 as observed by the writes of a load."""
    return G.load_rules(t.spark, _staged(t, "D_load"))


@q("D7", f"""SELECT dataset, count_if(passed) AS tests_passed, count(*) AS tests_total FROM (
  {_rules_sql("vehicles", _D3_WIDE, _D3_ORDER, _D3_ORDER[:-1])}
  UNION ALL {_rules_sql("complaints", _D5_WIDE, _D5_RULES)}
  UNION ALL {_rules_sql("stations", _D6_WIDE, _D6_RULES)}) WHERE scored GROUP BY dataset""")
def _d7(t):
    return D.scorecard(D.vehicle_checks(t.vehicles, AS_OF), D.complaint_checks(t.complaints, AS_OF),
                       D.station_checks(t.stations))


def _typed(cols):
    return ", ".join(f"{c} {t}" for c, t in cols)


_D9_TYPES = {
    "raw_vehicles": _typed([("id", "bigint"), ("year", "int"), ("make", "string"), ("model", "string"), ("VClass", "string"),
                            ("drive", "string"), ("trany", "string"), ("cylinders", "double"), ("displ", "double"),
                            ("fuelType", "string"), ("fuelType1", "string"), ("fuelType2", "string"), ("city08", "int"),
                            ("highway08", "int"), ("comb08", "int"), ("co2TailpipeGpm", "double")]),
    "raw_complaints": _typed([("ODINO", "bigint"), ("CMPLID", "bigint"), ("MFGTXT", "string"), ("MAKETXT", "string"),
                              ("MODELTXT", "string"), ("YEARTXT", "string"), ("CRASH", "string"), ("DATEA", "string"),
                              ("FIRE", "string"), ("INJURED", "int"), ("DEATHS", "int"), ("COMPDESC", "string"),
                              ("VIN", "string"), ("MILEAGE", "bigint"), ("l_linenumber", "int"), ("l_partkey", "bigint"),
                              ("l_suppkey", "bigint"), ("l_extendedprice", "double")]),
    "raw_stations": _typed([("id", "bigint"), ("fuel_type_code", "string"), ("station_name", "string"), ("state", "string"),
                            ("latitude", "double"), ("longitude", "double"), ("status_code", "string"),
                            ("access_code", "string")])}


@q("D8", """SELECT unnest(['year', 'comb08', 'city08', 'highway08', 'cylinders', 'displ']) AS "column",
  unnest(['int', 'int', 'int', 'int', 'double', 'double']) AS type, true AS is_numeric,
  unnest([count(year), count(comb08), count(city08), count(highway08), count(cylinders), count(displ)]) AS non_null
  FROM clean_vehicles""")
def _d8(t):
    """Type and filled rows of the numeric columns."""
    return D.numeric_check(t.vehicles, ["year", "comb08", "city08", "highway08", "cylinders", "displ"])


_D9 = f"""SELECT 'vehicles' AS source, count(*) AS rows, 16 AS columns, '{_D9_TYPES["raw_vehicles"]}' AS dtypes FROM raw_vehicles
  UNION ALL SELECT 'complaints', count(*), 18, '{_D9_TYPES["raw_complaints"]}' FROM raw_complaints
  UNION ALL SELECT 'stations', count(*), 8, '{_D9_TYPES["raw_stations"]}' FROM raw_stations"""


@q("D9", f"{_D9} UNION ALL SELECT 'total', CAST(sum(rows) AS BIGINT), CAST(sum(columns) AS INTEGER), '' FROM ({_D9})")
def _d9(t):
    return D.source_profile({"vehicles": t.raw_vehicles, "complaints": t.raw_complaints,
                             "stations": t.raw_stations})


# =====================================================================  X1..X12
@q("X1", """SELECT c.ODINO, c.MILEAGE, coalesce(c.MILEAGE < q.q1 - 1.5 * (q.q3 - q.q1)
    OR c.MILEAGE > q.q3 + 1.5 * (q.q3 - q.q1), false) AS is_outlier
  FROM clean_complaints c CROSS JOIN (SELECT quantile_cont(MILEAGE, 0.25) AS q1,
    quantile_cont(MILEAGE, 0.75) AS q3 FROM clean_complaints) q""")
def _x1(t):
    return X.iqr_outliers(t.complaints.select("ODINO", "MILEAGE"), "MILEAGE")


@q("X2", f"""SELECT v.year, v.make_norm, v.model_norm, v.avg_mpg,
    CAST(coalesce(c.complaint_count, 0) AS BIGINT) AS complaint_count, c.top_issue
  FROM (SELECT year, {norm('make')} AS make_norm, {norm('model')} AS model_norm, avg(comb08) AS avg_mpg
        FROM clean_vehicles GROUP BY 1, 2, 3) v
  LEFT JOIN (SELECT year, make_norm, model_norm, sum(n) OVER (PARTITION BY year, make_norm, model_norm)
               AS complaint_count, COMPDESC AS top_issue,
               row_number() OVER (PARTITION BY year, make_norm, model_norm ORDER BY n DESC, COMPDESC) AS rn
             FROM (SELECT YEARTXT AS year, make_norm, model_norm, COMPDESC, count(*) AS n FROM cc_norm
                   WHERE YEARTXT IS NOT NULL AND make_norm IS NOT NULL AND model_norm IS NOT NULL
                   GROUP BY 1, 2, 3, 4)) c
    ON v.year = c.year AND v.make_norm = c.make_norm AND v.model_norm = c.model_norm AND c.rn = 1""")
def _x2(t):
    return X.vehicle_summary(t.vehicles, t.complaints)


@q("X3", f"""SELECT CMPLID, regexp_replace({norm('MAKETXT')}, '[\\s-]+', '', 'g') AS make_key,
  regexp_replace({norm('MODELTXT')}, '[\\s-]+', '', 'g') AS model_key FROM raw_complaints""")
def _x3(t):
    return t.raw_complaints.select("CMPLID", X.aggressive_key("MAKETXT").alias("make_key"),
                                   X.aggressive_key("MODELTXT").alias("model_key"))


# X3 abbreviations for the bound makes (a parameter, like a rule table)
X3_ABBREVIATIONS = {"BRAND#11": "BRAND#12", "Brand#21": "Brand#22"}


# and abbreviations inside names; the longest run of words counts
X3_WORDS = {"Unlisted": "", "hot": "Red", "small": "Large", "Small  Widget": "Blue-Rod"}


def _standard(col):
    """X3_WORDS one after the other, longer runs first (no replacement here holds
    another one's words)."""
    text = f"(' ' || regexp_replace({norm(col)}, '[\\s-]+', ' ', 'g') || ' ')"
    for old, new in (("SMALL WIDGET", " BLUE ROD "), ("UNLISTED", " "), ("HOT", " RED "), ("SMALL", " LARGE ")):
        text = f"replace({text}, ' {old} ', '{new}')"
    return f"trim({text})"


@q("X3_words", f"SELECT CMPLID, MODELTXT, {_standard('MODELTXT')} AS model_words FROM raw_complaints")
def _x3w(t):
    return t.raw_complaints.select("CMPLID", "MODELTXT", X.standard_words("MODELTXT", X3_WORDS).alias("model_words"))


def _aggressive(col):
    key = f"regexp_replace({_standard(col)}, '[\\s-]+', '', 'g')"
    cases = " ".join(f"WHEN '{a.upper()}' THEN '{b.upper()}'" for a, b in X3_ABBREVIATIONS.items())
    return f"(CASE {key} {cases} ELSE {key} END)"


@q("X3_join", f"""SELECT v.make, CAST(sum(coalesce(r.n, 0)) AS BIGINT) AS complaints, count(*) AS rows
  FROM (SELECT DISTINCT {', '.join(c for c in K.ANALYSIS_COLUMNS if c not in K.COMPLAINT_MEASURES)} FROM clean_vehicles) v
  LEFT JOIN (SELECT year, mk, mo, count(CMPLID) AS n FROM (
    SELECT YEARTXT AS year, CMPLID, {_aggressive('MAKETXT')} AS mk, {_aggressive('MODELTXT')} AS mo FROM clean_complaints)
    WHERE year IS NOT NULL AND mk IS NOT NULL AND mo IS NOT NULL GROUP BY ALL) r
  ON v.year = r.year AND {_aggressive('v.make')} = r.mk AND {_aggressive('v.model')} = r.mo GROUP BY v.make""")
def _x3b(t):
    """X3 as the key of P4, with abbreviations."""
    vca = I.vehicle_complaints_analysis(t.vehicles, t.complaints, lambda c: X.aggressive_key(c, X3_ABBREVIATIONS, X3_WORDS))
    return vca.groupBy("make").agg(A.sum0("total_complaints").cast("bigint").alias("complaints"), F.count(F.lit(1)).alias("rows"))


@q("X4", """SELECT *, CASE WHEN avg_mpg = 0 THEN NULL ELSE complaints / avg_mpg END AS complaints_per_mpg
  FROM (SELECT make, model, avg(comb08) AS avg_mpg,
        CAST(coalesce(sum(total_complaints), 0) AS BIGINT) AS complaints
        FROM vca WHERE make IS NOT NULL AND model IS NOT NULL GROUP BY 1, 2)""")
def _x4(t):
    return X.mpg_complaint_ratio(t.vca)


@q("X5", """SELECT VClass, CAST(coalesce(sum(crash_incidents), 0) AS BIGINT) AS crash_incidents,
  CAST(coalesce(sum(fire_incidents), 0) AS BIGINT) AS fire_incidents, count(*) AS rows
  FROM vca WHERE VClass IS NOT NULL GROUP BY 1""")
def _x5(t):
    return X.class_incidents(t.vca)


@q("X6", """SELECT make_norm, model_norm, count(MILEAGE) AS with_mileage, avg(MILEAGE) AS avg_mileage,
  quantile_cont(MILEAGE, 0.5) AS median_mileage FROM cc_norm
  WHERE make_norm IS NOT NULL AND model_norm IS NOT NULL GROUP BY 1, 2""")
def _x6(t):
    return X.complaint_mileage(t.complaints)


@q("X7", """SELECT *, CAST(rank() OVER (PARTITION BY fuel_type_code ORDER BY total_stations DESC) AS INTEGER)
  AS state_rank
  FROM stations_by_state""")
def _x7(t):
    return X.state_ranking(t.stations)


@q("X8", """SELECT fuel_type_code, year, vehicle_count,
  lag(vehicle_count) OVER (PARTITION BY fuel_type_code ORDER BY year) AS prev_vehicle_count,
  vehicle_count - lag(vehicle_count) OVER (PARTITION BY fuel_type_code ORDER BY year) AS change
  FROM infra""")
def _x8(t):
    return X.fuel_trend(t.infra)


@q("X8_stations", """SELECT fuel_type_code, CAST(open_year AS INTEGER) AS open_year, opened,
  CAST(sum(opened) OVER (PARTITION BY fuel_type_code ORDER BY open_year) AS BIGINT) AS stations_to_date FROM (
  SELECT fuel_type_code, year(DATE '1995-01-01' + CAST(id % 10950 AS INTEGER)) AS open_year, count(*) AS opened
  FROM clean_stations WHERE fuel_type_code IS NOT NULL AND id % 31 <> 0 GROUP BY ALL)""")
def _x8c(t):
    """Station counts by year of opening; the bound source has no opening
    date, so one is derived from the station's id (null for every 31st)."""
    day = F.expr("CASE WHEN id % 31 <> 0 THEN date_add(DATE '1995-01-01', CAST(id % 10950 AS INT)) END")
    return X.stations_by_open_year(t.stations.withColumn("open_date", day))


@q("X8_rank", """SELECT fuel_type_code, avg_combined_mpg,
  CAST(dense_rank() OVER (ORDER BY avg_combined_mpg DESC) AS INTEGER) AS mpg_rank FROM (
  SELECT fuel_type_code, round_even(sum(CAST(round_even(avg_combined_mpg * 10, 0) AS BIGINT))
    / count(avg_combined_mpg), 0) / 10 AS avg_combined_mpg
  FROM infra WHERE fuel_type_code IS NOT NULL GROUP BY 1)""")
def _x8b(t):
    return X.fuel_economy_ranking(t.infra)


@q("X9", """SELECT round_even(corr(stations_nationwide, total_complaints) * 1000000000, 0) / 1000000000
  AS corr_stations_complaints, count(*) AS rows FROM comp""")
def _x9(t):
    return X.infra_complaint_correlation(t.comp)


_CS_DESC = f"""(SELECT fuel_type_code, station_name, state, latitude, longitude, status_code, access_code, id
  FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY access_code DESC NULLS LAST) AS _rn
        FROM raw_stations
        WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND fuel_type_code IS NOT NULL
          AND status_code IS NOT NULL AND latitude BETWEEN 18 AND 72
          AND longitude BETWEEN -180 AND -65 AND (latitude <> 0 OR longitude <> 0))
  WHERE _rn = 1 AND fuel_type_code IN ({_lst(K.ALT_FUEL_CODES)}))"""


def _stations_rerun(t):
    """The station snapshot re-run with the opposite keep-first order."""
    return P.clean_stations(t.raw_stations, [F.col("access_code").desc_nulls_last()])


@q("X11_changes", f"""SELECT coalesce(b.id, a.id) AS id,
  CASE WHEN b.id IS NULL THEN 'insert' WHEN a.id IS NULL THEN 'delete' ELSE 'update' END AS change
  FROM clean_stations b FULL OUTER JOIN {_CS_DESC} a ON b.id = a.id
  WHERE b.id IS NULL OR a.id IS NULL OR b.fuel_type_code IS DISTINCT FROM a.fuel_type_code
    OR b.station_name IS DISTINCT FROM a.station_name OR b.state IS DISTINCT FROM a.state
    OR b.latitude IS DISTINCT FROM a.latitude OR b.longitude IS DISTINCT FROM a.longitude
    OR b.status_code IS DISTINCT FROM a.status_code OR b.access_code IS DISTINCT FROM a.access_code""")
def _x11(t):
    return X.changed_rows(t.stations, _stations_rerun(t), ["id"])


@q("X11_append", f"SELECT * FROM clean_stations UNION ALL SELECT * FROM {_CS_DESC}")
def _x11c(t):
    """X11: append load (both snapshots stay)."""
    return X.append(t.stations, _stations_rerun(t))


# =====================================================================  S1..S9, L4
# Sources and sinks round-trip data derived from the given tables through the
# real file formats, in a folder below the session's shared checkpoint folder.
def _io_root(t, key):
    """A new folder for each call, below the shared checkpoint folder."""
    from ..session import shared_path
    return shared_path(t.spark, "catalog", key)


def _table(name):
    """A table name that no other session uses."""
    return f"{name}_{uuid.uuid4().hex}"


@q("S1", "SELECT * FROM raw_vehicles")
def _s1(t):
    from ..sources import readers as RD, sinks as SK
    p = SK.write_layer(t.raw_vehicles, f"{_io_root(t, 'S1')}/vehicles_csv", "csv")
    return RD.read_vehicles(t.spark, p)


def _complaints_tsv(t, path):
    """The bound complaints as a 49-column headerless TSV (positions of the
    source contract; the other positions carry filler text)."""
    at = dict(zip(K.COMPLAINT_POSITIONS, K.COMPLAINT_NAMES))
    cols = [F.col(at[i]).cast("string").alias(f"c{i}") if i in at else F.lit(f"f{i}").alias(f"c{i}")
            for i in range(K.COMPLAINT_RAW_WIDTH)]
    (t.raw_complaints.select(*cols).write.mode("overwrite")
     .option("sep", "\t").option("header", False).option("quote", '"').option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
    return path


@q("S2", """SELECT ODINO, CMPLID, MFGTXT, MAKETXT, MODELTXT, YEARTXT, CRASH, DATEA, FIRE, INJURED,
  DEATHS, COMPDESC, VIN, CAST(MILEAGE AS DOUBLE) AS MILEAGE FROM raw_complaints""")
def _s2(t):
    from ..sources import readers as RD
    return RD.read_complaints(t.spark, _complaints_tsv(t, f"{_io_root(t, 'S2')}/complaints_tsv"))


@q("S3", "SELECT * FROM raw_stations")
def _s3(t):
    from ..sources import readers as RD, sinks as SK
    p = SK.write_layer(t.raw_stations, f"{_io_root(t, 'S3')}/stations_csv", "csv")
    return RD.read_stations(t.spark, p)


@q("S4", """SELECT id, fuel_type_code, station_name, state, latitude, longitude, status_code,
  access_code FROM raw_stations""")
def _s4(t):
    from ..sources import readers as RD
    path = f"{_io_root(t, 'S4')}/stations_json"
    doc = F.struct(F.array(F.struct(*[F.col(c) for c in t.raw_stations.columns]))
                   .alias("fuel_stations"))
    t.raw_stations.select(F.to_json(doc).alias("value")).write.mode("overwrite").text(path)
    rows = RD.read_station_json(t.spark, path, multi_line=False)
    return rows.select("id", "fuel_type_code", "station_name", "state", "latitude", "longitude",
                       "status_code", "access_code")


@q("S6", """SELECT 'vehicles' AS name, count(*) AS rows FROM clean_vehicles
  UNION ALL SELECT 'complaints', count(*) FROM clean_complaints
  UNION ALL SELECT 'stations', count(*) FROM clean_stations""")
def _s6(t):
    from ..sources import sinks as SK
    paths = SK.write_layers({"vehicles": t.vehicles, "complaints": t.complaints,
                             "stations": t.stations}, f"{_io_root(t, 'S6')}/processed")
    return SK.layer_counts(t.spark, paths)


@q("S7", """SELECT 'vehicle_complaints_analysis' AS name, count(*) AS rows FROM vca
  UNION ALL SELECT 'fuel_infrastructure_analysis', count(*) FROM infra
  UNION ALL SELECT 'comprehensive_vehicle_analysis', count(*) FROM comp""")
def _s7(t):
    from ..sources import sinks as SK
    root = f"{_io_root(t, 'S7')}/integrated"
    paths = SK.write_layers({"vehicle_complaints_analysis": t.vca,
                             "fuel_infrastructure_analysis": t.infra}, root)
    stored = t.spark.read.parquet(paths["vehicle_complaints_analysis"])  # P4 is built once
    comp = I.comprehensive_vehicle_analysis(stored, t.stations)
    paths |= SK.write_layers({"comprehensive_vehicle_analysis": comp}, root)
    return SK.layer_counts(t.spark, paths)


@q("S8", "SELECT * FROM infra")
def _s8(t):
    from ..sources import readers as RD, sinks as SK
    return RD.read_layer(t.spark, SK.write_layer(t.infra, f"{_io_root(t, 'S8')}/infra"))


@q("S9", """SELECT 'csv' AS format, count(*) AS rows, false AS smaller_than_csv FROM vca
  UNION ALL SELECT 'parquet', count(*), true FROM vca""")
def _s9(t):
    """Rows read back and which format is smaller (sizes depend on the writer)."""
    from ..sources import sinks as SK
    return SK.compare_formats(t.vca, f"{_io_root(t, 'S9')}/formats").select("format", "rows", "smaller_than_csv")


@q("L4", """SELECT 'vehiscope_vehicle_complaints_analysis' AS dataset, true AS ok, count(*) AS rows,
  'PARTIAL FAILURE' AS status FROM vca
  UNION ALL SELECT 'vehiscope_fuel_infrastructure_analysis', true, count(*), 'PARTIAL FAILURE' FROM infra
  UNION ALL SELECT 'vehiscope_missing_dataset', false, NULL, 'PARTIAL FAILURE'""")
def _l4(t):
    """L1-L4: publish the integrated tables (full refresh + statistics); the
    third input does not exist, so the load is a partial failure."""
    from ..sources import sinks as SK
    root = _io_root(t, "L4")
    database = _table("vehiscope_l4")
    t.spark.sql(f"CREATE DATABASE {database}")
    paths = SK.write_layers({"vca": t.vca, "infra": t.infra}, f"{root}/integrated")
    return SK.load_all(t.spark, {"vehiscope_vehicle_complaints_analysis": paths["vca"],
                                 "vehiscope_fuel_infrastructure_analysis": paths["infra"],
                                 "vehiscope_missing_dataset": f"{root}/integrated/absent"},
                       database, location=f"{root}/tables")


@q("L1", "SELECT * FROM infra")
def _l1(t):
    """L1: full-refresh publish of an integrated table, read back as a table."""
    from ..sources import sinks as SK
    root = _io_root(t, "L1")
    return t.spark.table(SK.publish_table(t.infra, _table("vehiscope_l1"), path=f"{root}/table"))


@q("L3", "SELECT count(*) AS rows, true AS as_planned, true AS fewer_files FROM vca")
def _l3(t):
    """L2 + L3: publish with many files, refresh statistics, compact to files of
    64 KB; report rows, whether the table has the files planned from its bytes,
    and whether they are fewer than before."""
    from ..sources import sinks as SK
    root = _io_root(t, "L3")
    name = SK.publish_table(t.vca.repartition(64), _table("vehiscope_l3"), path=f"{root}/table")
    SK.analyze_table(t.spark, name)
    before = len(t.spark.table(name).inputFiles())
    planned = SK.compact_table(t.spark, name, f"{root}/table", 64 << 10)
    t.spark.catalog.refreshTable(name)
    after = len(t.spark.table(name).inputFiles())
    return t.spark.table(name).agg(F.count(F.lit(1)).alias("rows"), F.lit(after == planned).alias("as_planned"),
                                   F.lit(after < before).alias("fewer_files"))


@q("X11_stream", f"""SELECT * EXCLUDE (_src, _rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY _src) AS _rn FROM (
    SELECT *, 1 AS _src FROM clean_stations UNION ALL SELECT *, 0 AS _src FROM {_CS_DESC}))
  WHERE _rn = 1""")
def _x11s(t):
    """X11 as Structured Streaming: the first station snapshot lands and is
    loaded in several batches; then the re-run with the opposite keep-first order
    lands and is loaded by a new stream with a new checkpoint, and the dataset is
    compacted. The merge keeps the latest version of every station."""
    from ..streaming import incremental as INC
    root = _io_root(t, "X11_stream")
    base = t.stations.withColumn("snapshot", F.lit(1))
    rerun = _stations_rerun(t).withColumn("snapshot", F.lit(2))
    order = [F.col("snapshot").desc()]
    base.repartition(3).write.parquet(f"{root}/landing1")
    rerun.write.parquet(f"{root}/landing2")
    for k in (1, 2):
        INC.start_incremental_load(t.spark, f"{root}/landing{k}", base.schema, f"{root}/merged",
                                   f"{root}/checkpoint{k}", max_files_per_trigger=1).awaitTermination()
        if k == 1:
            INC.compact(t.spark, f"{root}/merged", ["id"], order)
    return INC.latest_version(t.spark, f"{root}/merged", ["id"], order).drop("snapshot")


@q("X11", f"""SELECT * EXCLUDE (_src, _rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY _src) AS _rn FROM (
    SELECT *, 1 AS _src FROM clean_stations UNION ALL SELECT *, 0 AS _src FROM {_CS_DESC}))
  WHERE _rn = 1""")
def _x11a(t):
    """X11: incremental load of a changed station snapshot (upsert by id)."""
    return X.upsert(t.stations, _stations_rerun(t), ["id"])


@q("X11_upsert", f"""SELECT * EXCLUDE (_src, _rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY _src) AS _rn FROM (
    SELECT *, 1 AS _src FROM clean_stations UNION ALL SELECT *, 0 AS _src FROM {_CS_DESC} WHERE id % 3 = 0
    UNION ALL SELECT *, 2 AS _src FROM {_CS_DESC} WHERE id % 2 = 0))
  WHERE _rn = 1""")
def _x11u(t):
    """X11 at scale: a bucketed dataset, two upserts (the second one late, with
    older rows) and a compaction between them; a third of the stations change."""
    from ..streaming import upserts as U
    root = _io_root(t, "X11_upsert")
    U.create(t.stations.withColumn("snapshot", F.lit(2)), root, ["id"], ["snapshot"], buckets=16)
    U.upsert(_stations_rerun(t).where("id % 3 = 0").withColumn("snapshot", F.lit(3)), root)
    U.compact(t.spark, root)
    U.upsert(_stations_rerun(t).where("id % 2 = 0").withColumn("snapshot", F.lit(1)), root)
    return U.current(t.spark, root).drop("snapshot")


def _changed(df, key, kept, gone, column, value):
    """The rows of an earlier state: those of ``kept`` with another ``column``,
    and rows of ``gone`` again under a key of their own; one pass."""
    def row(own):
        return F.struct(*[own.get(c, F.col(c)).alias(c) for c in df.columns])

    rows = F.array(F.when(F.expr(kept), row({column: value})), F.when(F.expr(gone), row({key: -F.col(key)})))
    return df.select(F.inline(F.filter(rows, lambda r: r.isNotNull())))


def _earlier(t):
    """Vehicles and complaints as they were before a change set: some rows are
    not there yet, some are there that go, some have other values."""
    comb08 = F.when(F.col("id") % 7 == 1, F.col("comb08") + 1).otherwise(F.col("comb08"))
    mileage = F.when(F.col("ODINO") % 9 == 4, F.lit(None)).otherwise(F.col("MILEAGE"))
    return (_changed(t.vehicles, "id", "id % 10 <> 3", "id % 11 = 5", "comb08", comb08),
            _changed(t.complaints, "ODINO", "ODINO % 6 <> 2", "ODINO % 13 = 7", "MILEAGE", mileage))


def _clean(t, root, *names):
    """The tables of ``t`` with the named clean ones written: they are made from
    the raw rows once, and every state and both sides of a change set read them."""
    from .pipeline import Tables
    return Tables(t.spark, t.sf_dir, t.as_of, t._over | {n: materialize(getattr(t, n), f"{root}/clean/{n}") for n in names})


def _complaint_states(t):
    from . import maintenance as M
    _, before = _earlier(t)
    change = M.complaint_state(M.signed_changes(before, t.complaints, ["ODINO"]))
    return M.complaint_state(before), change


@q("X11_maintained_A1", "SELECT * FROM complaint_rollup")
def _x11m1(t):
    """A1 kept up to date from changed complaints equals A1 from scratch."""
    from . import maintenance as M
    return M.rollup_of(M.merged(*_complaint_states(_clean(t, _io_root(t, "X11_maintained_A1"), "complaints"))))


@q("X11_maintained_A3", "SELECT * FROM fuel_year")
def _x11m3(t):
    """A3 kept up to date from changed vehicle rows."""
    from . import maintenance as M
    t = _clean(t, _io_root(t, "X11_maintained_A3"), "vehicles")
    before, _ = _earlier(t)
    coded = [v.withColumn("fuel_type_code", S.map_code("fuel_used")) for v in (before, t.vehicles)]
    change = M.fuel_state(M.signed_changes(*coded, ["id", "fuel_rank"]))
    return M.fuel_rollup_of(M.merged(M.fuel_state(coded[0]), change))


@q("X11_maintained_P4", "SELECT * FROM vca")
def _x11m4(t):
    """P4 kept up to date from changed vehicles and complaints; the states, the
    change states and the old P4 are written, the update reads these alone. The
    clean tables are written before them, each once."""
    from . import maintenance as M
    root = _io_root(t, "X11_maintained_P4")
    t = _clean(t, root, "vehicles", "complaints")
    vehicles, complaints = _earlier(t)
    kept = {"vehicles": M.vehicle_state(vehicles), "complaints": M.complaint_state(complaints),
            "analysis": I.vehicle_complaints_analysis(vehicles, complaints),
            "new_vehicles": M.vehicle_state(M.signed_changes(vehicles, t.vehicles, ["id", "fuel_rank"])),
            "new_complaints": M.complaint_state(M.signed_changes(complaints, t.complaints, ["ODINO"]))}
    k = {n: materialize(df, f"{root}/{n}") for n, df in kept.items()}
    return M.updated_analysis(k["analysis"], M.merged(k["vehicles"], k["new_vehicles"]),
                              M.merged(k["complaints"], k["new_complaints"]),
                              M.touched_keys(k["new_vehicles"], k["new_complaints"]))


@q("X12_log", """SELECT * FROM (VALUES (1, NULL, '2025-01-01T00:00:00.000000', 'write', NULL),
    (2, 1, '2025-01-08T00:00:00.000000', 'write', NULL), (3, 2, '2025-01-15T00:00:00.000000', 'restore', 1))
    AS v(version, parent, time, kind, restored), (SELECT count(*) AS rows FROM clean_stations)""")
def _x12l(t):
    """The log of a dataset that was written twice and restored."""
    from ..sources import versions as V
    root = _io_root(t, "X12_log")
    V.write(t.stations, root, time="2025-01-01")
    V.write(_stations_rerun(t), root, time="2025-01-08")
    V.restore(t.spark, root, 1, time="2025-01-15")
    return V.history(t.spark, root).select(F.col("version").cast("int"), F.col("parent").cast("int"), "time", "kind",
                                           F.col("restored").cast("int"), "rows")


@q("X12_as_of", f"SELECT * FROM {_CS_DESC}")
def _x12t(t):
    """The dataset as of a time between the second write and the restore."""
    from ..sources import versions as V
    root = _io_root(t, "X12_as_of")
    V.write(t.stations, root, time="2025-01-01")
    V.write(_stations_rerun(t), root, time="2025-01-08")
    V.restore(t.spark, root, 1, time="2025-01-15")
    return V.read(t.spark, root, as_of="2025-01-10")


@q("L4_release", """SELECT 'comprehensive_vehicle_analysis' AS name, count(*) AS rows, 2 AS version FROM comp
  UNION ALL SELECT 'fuel_infrastructure_analysis', count(*), 2 FROM infra
  UNION ALL SELECT 'vehicle_complaints_analysis', count(*), 2 FROM vca""")
def _l4r(t):
    """L4: the integrated tables published as one version, after an older one of
    which nothing may show; rows read back through the log. The layers are written
    first: both versions read them."""
    from ..sources import versions as V
    from .pipeline import layers
    root = _io_root(t, "L4_release")
    t = layers(t, f"{root}/layers")
    tables = {"vehicle_complaints_analysis": t.vca, "fuel_infrastructure_analysis": t.infra,
              "comprehensive_vehicle_analysis": t.comp}
    V.write_release({n: df.limit(1) for n, df in tables.items()}, root)
    version = V.write_release(tables, root)["version"]
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name"), "rows", F.lit(version).alias("version"))
             for n, df in sorted(V.read_release(t.spark, root).items())]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@q("L2", "SELECT count(*) AS rows FROM infra")
def _l2(t):
    """L2: after ANALYZE TABLE the catalog statistics hold the row count."""
    from ..sources import sinks as SK
    name = SK.publish_table(t.infra, _table("vehiscope_l2"), path=f"{_io_root(t, 'L2')}/table")
    SK.analyze_table(t.spark, name)
    d = t.spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    return (d.filter(F.col("col_name") == "Statistics")
            .select(F.regexp_extract("data_type", r"(\d+) rows", 1).cast("bigint").alias("rows")))


# X10 rule table for the bound complaints (a parameter, like a threshold)
X10_RULES = [("COMPONENT [0-2]$", "GROUP A"), ("COMPONENT [3-4]$", "GROUP B"),
             ("COMPONENT 5$", "GROUP C")]


@q("X10", "SELECT category, count(*) AS complaints FROM (SELECT CASE "
    + " ".join(f"WHEN coalesce(regexp_matches(COMPDESC, '(?i){p}'), false) THEN '{c}'"
               for p, c in X10_RULES)
    + " ELSE 'OTHER' END AS category FROM clean_complaints) GROUP BY category")
def _x10(t):
    """Component text categorised by the first matching rule."""
    return (t.complaints.select(X.categorize("COMPDESC", X10_RULES).alias("category"))
            .groupBy("category").agg(F.count(F.lit(1)).alias("complaints")))


@q("X12", "SELECT * FROM clean_stations")
def _x12(t):
    """Two snapshot versions written; version 1 restored as the live copy."""
    root = _io_root(t, "X12")
    X.write_snapshot(t.stations, f"{root}/snapshots", 1)
    X.write_snapshot(_stations_rerun(t), f"{root}/snapshots", 2)
    return X.restore_snapshot(t.spark, f"{root}/snapshots", 1, f"{root}/live")


@q("Q5_mapped_only", """SELECT *, CASE WHEN poor_infra_avg > good_infra_avg THEN (poor_infra_avg - good_infra_avg) / good_infra_avg * 100 END AS poor_pct_more,
  CASE WHEN poor_infra_avg > good_infra_avg THEN 'poor infrastructure has more complaints' ELSE 'no clear correlation' END AS verdict
  FROM (SELECT avg(CASE WHEN stations_nationwide > 100 THEN total_complaints END) AS good_infra_avg,
    CAST(count_if(stations_nationwide > 100) AS BIGINT) AS good_infra_count,
    avg(CASE WHEN stations_nationwide <= 100 THEN total_complaints END) AS poor_infra_avg,
    CAST(count_if(stations_nationwide <= 100) AS BIGINT) AS poor_infra_count
    FROM comp WHERE fuel_type_code IS NOT NULL)""")
def _q5m(t):
    """Q5 with unmapped (gasoline) rows left out (option for trap T15)."""
    return Q.infrastructure_vs_complaints(t.comp, 100, mapped_only=True)
