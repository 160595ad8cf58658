"""Raw sources bound to the driver's TPC-H-like test tables.

The test tables carry no vehicle data, so each raw source is a deterministic
derivation of them that injects nulls, duplicates and out-of-range values:
``part`` gives vehicles, ``lineitem`` joined to ``part`` gives complaints,
``customer`` joined to ``nation`` gives stations. The derivations grow with
the tables (whole tables, no sampling), and each is one scan: extra copies of
a row are produced by a generator (``inline``), not by self-unions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _copies(key: str, extra: list[tuple[int, str | None]]) -> str:
    """SQL generator of (index, override) rows: the row itself plus each extra
    copy ``(modulus, override)`` whose key is divisible by modulus, as
    ``inline(filter(array(...), ...))`` (one scan, no union)."""
    items = ["named_struct('_i', 0, '_ovr', CAST(NULL AS STRING))"]
    conds = ["x._i = 0"]
    for i, (mod, ovr) in enumerate(extra, start=1):
        o = "CAST(NULL AS STRING)" if ovr is None else f"'{ovr}'"
        items.append(f"named_struct('_i', {i}, '_ovr', {o})")
        conds.append(f"(x._i = {i} AND {key} % {mod} = 0)")
    return f"inline(filter(array({', '.join(items)}), x -> {' OR '.join(conds)}))"


# Column expressions of the bound sources (Spark SQL; one JVM call per column).
VEHICLE_EXPRS = [
    "CAST(p_partkey AS BIGINT) * 4 + _i AS id",
    "CAST(CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE 2005 + p_size % 23 END AS INT) AS year",
    "CASE WHEN p_partkey % 89 = 0 THEN NULL ELSE p_brand END AS make",
    "p_name AS model",
    "p_type AS VClass",
    "CASE p_partkey % 4 WHEN 0 THEN 'FWD' WHEN 1 THEN 'RWD' WHEN 2 THEN 'AWD' END AS drive",
    "coalesce(_ovr, CASE p_partkey % 2 WHEN 0 THEN 'Auto' ELSE 'Manual' END) AS trany",
    "CASE WHEN p_partkey % 5 = 3 THEN NULL ELSE CAST(4 + 2 * (p_partkey % 3) AS DOUBLE) END AS cylinders",
    "CASE WHEN p_partkey % 5 = 3 THEN NULL ELSE CAST(1 + p_partkey % 4 AS DOUBLE) END AS displ",
    "CASE p_partkey % 5 WHEN 0 THEN 'Regular' WHEN 1 THEN 'Premium' WHEN 2 THEN 'Diesel' "
    "WHEN 3 THEN 'Electricity' ELSE 'Hydrogen' END AS fuelType",
    "CASE p_partkey % 5 WHEN 0 THEN 'Regular Gasoline' WHEN 1 THEN 'Premium Gasoline' "
    "WHEN 2 THEN 'Diesel' WHEN 3 THEN 'Electricity' ELSE 'Hydrogen' END AS fuelType1",
    "CASE WHEN p_partkey % 5 > 1 THEN NULL WHEN p_partkey % 11 = 0 THEN 'Electricity' "
    "WHEN p_partkey % 13 = 0 THEN 'E85' END AS fuelType2",
    "CAST(CASE WHEN p_partkey % 82 = 0 THEN NULL ELSE 10 + p_size END AS INT) AS city08",
    "CAST(CASE WHEN p_partkey % 82 = 0 THEN NULL ELSE 15 + p_size END AS INT) AS highway08",
    "CAST(CASE WHEN p_partkey % 41 = 0 THEN NULL WHEN p_partkey % 37 = 0 THEN 0 "
    "WHEN p_partkey % 31 = 0 THEN 250 ELSE 12 + p_size END AS INT) AS comb08",
    "CAST(100 + p_partkey % 300 AS DOUBLE) AS co2TailpipeGpm",
]

COMPLAINT_EXPRS = [
    "CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE CAST(l_orderkey AS BIGINT) END AS ODINO",
    "CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS CMPLID",
    "p_brand AS MFGTXT",
    "CASE l_linenumber % 3 WHEN 0 THEN upper(p_brand) WHEN 1 THEN concat(' ', lower(p_brand), ' ') "
    "ELSE p_brand END AS MAKETXT",
    "CASE WHEN p_partkey % 7 = 3 THEN concat('UNLISTED ', upper(p_name)) ELSE upper(p_name) END AS MODELTXT",
    "CASE WHEN p_partkey % 503 = 7 THEN 'unknown' ELSE CAST(2005 + p_size % 23 AS STRING) END AS YEARTXT",
    "CASE WHEN l_returnflag = 'R' THEN 'Y' WHEN l_returnflag = 'A' THEN 'N' END AS CRASH",
    "CASE WHEN l_orderkey % 211 = 0 THEN '2019x' ELSE CAST((year(l_shipdate) + 24) * 10000 "
    "+ month(l_shipdate) * 100 + day(l_shipdate) AS STRING) END AS DATEA",
    "CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS FIRE",
    "CAST(CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE l_linenumber % 3 END AS INT) AS INJURED",
    "CAST(CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE l_linenumber % 2 END AS INT) AS DEATHS",
    "concat('COMPONENT ', CAST(l_suppkey % 7 AS STRING)) AS COMPDESC",
    "CAST(NULL AS STRING) AS VIN",
    "CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE CAST(floor(l_extendedprice * 12) AS BIGINT) END AS MILEAGE",
    "CAST(l_linenumber AS INT) AS l_linenumber",
    "CAST(l_partkey AS BIGINT) AS l_partkey",
    "CAST(l_suppkey AS BIGINT) AS l_suppkey",
    "CAST(l_extendedprice AS DOUBLE) AS l_extendedprice",
]

STATION_EXPRS = [
    "CAST(c_custkey AS BIGINT) AS id",
    "CASE c_custkey % 8 WHEN 0 THEN 'LPG' WHEN 1 THEN 'BD' WHEN 2 THEN 'CNG' WHEN 3 THEN 'E85' "
    "WHEN 4 THEN 'HY' WHEN 5 THEN NULL ELSE 'ELEC' END AS fuel_type_code",
    "c_name AS station_name",
    "CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE n_name END AS state",
    "CASE WHEN c_custkey % 43 = 0 THEN 0.0D ELSE CAST(15 + (c_custkey * 37) % 60 AS DOUBLE) END AS latitude",
    "CASE WHEN c_custkey % 43 = 0 THEN 0.0D ELSE CAST(-60 - (c_custkey * 13) % 125 AS DOUBLE) END AS longitude",
    "CASE c_custkey % 10 WHEN 8 THEN 'P' WHEN 9 THEN 'T' WHEN 7 THEN NULL ELSE 'E' END AS status_code",
    "coalesce(_ovr, CASE WHEN c_custkey % 3 = 0 THEN 'private' ELSE 'public' END) AS access_code",
]

# keep-first order of the bound complaint source (total within ODINO)
COMPLAINT_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
# keep-first order of the bound vehicle and station sources
VEHICLE_ORDER = ["id"]
STATION_ORDER = ["access_code"]


def raw_vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicles from ``part``: brand -> make, name -> model, type -> class.

    The id is four times the part key plus the number of the copy, so ids of
    copies never meet those of other parts. Extra rows: parts divisible by 23
    again as copy 1 (exact duplicates for K1); parts divisible by 19 again as
    copy 2 with transmission 'CVT' (survive K1, collapse in K4).
    """
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    x = p.selectExpr("*", _copies("p_partkey", [(23, None), (19, "CVT")]))
    return x.selectExpr(*VEHICLE_EXPRS)


def raw_complaints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Complaints from ``lineitem`` joined to ``part`` (those of parts
    with key % 7 = 3 name a model that no vehicle has): orderkey -> ODINO (natural repeats), shipdate + 24 years ->
    DATEA text, perturbed case and edge spaces in the make."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_returnflag", "l_linestatus", "l_shipdate")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_name", "p_size")
    j = li.join(p, li["l_partkey"] == p["p_partkey"], "inner")
    return j.selectExpr(*COMPLAINT_EXPRS)


def raw_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations from ``customer`` joined to ``nation``; customers divisible by
    29 appear twice (second copy public) to give duplicate station ids."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(n, c["c_nationkey"] == n["n_nationkey"], "inner")
    x = j.selectExpr("*", _copies("c_custkey", [(29, "public")]))
    return x.selectExpr(*STATION_EXPRS)
