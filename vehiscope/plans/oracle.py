"""Independent SQL statements of every registered query (the DuckDB oracle).

Written from the semantics, not generated from the Spark plans: the Spark
side uses the DataFrame API, this side plain SQL over the same tables, so the
driver's side-by-side comparison checks one against the other. Integer sums
and ``count_if`` are cast to BIGINT (DuckDB returns HUGEINT); keep-first is
``row_number() = 1`` with an explicit null order.
"""

from __future__ import annotations

import datetime as _dt

from .. import constants as K

AS_OF = K.DEFAULT_AS_OF


def _lst(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _map_case(col: str, mapping=K.FUEL_CODE_MAP) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"CASE {col} {whens} END"


def norm(col: str) -> str:
    return f"upper(regexp_replace({col}, '^\\s+|\\s+$', '', 'g'))"


def _date(d: _dt.date) -> str:
    return f"DATE '{d.isoformat()}'"


def base_ctes(as_of: _dt.date = AS_OF) -> dict[str, str]:
    """Named CTE bodies, in dependency order."""
    y = as_of.year
    c: dict[str, str] = {}
    c["raw_vehicles_base"] = """
  SELECT CAST(p_partkey AS BIGINT) * 4 AS id,
    CAST(CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE 2005 + p_size % 23 END AS INTEGER) AS year,
    CASE WHEN p_partkey % 89 = 0 THEN NULL ELSE p_brand END AS make,
    p_name AS model, p_type AS VClass,
    CASE p_partkey % 4 WHEN 0 THEN 'FWD' WHEN 1 THEN 'RWD' WHEN 2 THEN 'AWD' END AS drive,
    CASE p_partkey % 2 WHEN 0 THEN 'Auto' ELSE 'Manual' END AS trany,
    CASE WHEN p_partkey % 5 = 3 THEN NULL ELSE CAST(4 + 2 * (p_partkey % 3) AS DOUBLE) END AS cylinders,
    CASE WHEN p_partkey % 5 = 3 THEN NULL ELSE CAST(1 + p_partkey % 4 AS DOUBLE) END AS displ,
    CASE p_partkey % 5 WHEN 0 THEN 'Regular' WHEN 1 THEN 'Premium' WHEN 2 THEN 'Diesel'
      WHEN 3 THEN 'Electricity' ELSE 'Hydrogen' END AS fuelType,
    CASE p_partkey % 5 WHEN 0 THEN 'Regular Gasoline' WHEN 1 THEN 'Premium Gasoline'
      WHEN 2 THEN 'Diesel' WHEN 3 THEN 'Electricity' ELSE 'Hydrogen' END AS fuelType1,
    CASE WHEN p_partkey % 5 > 1 THEN NULL WHEN p_partkey % 11 = 0 THEN 'Electricity'
      WHEN p_partkey % 13 = 0 THEN 'E85' END AS fuelType2,
    CAST(CASE WHEN p_partkey % 82 = 0 THEN NULL ELSE 10 + p_size END AS INTEGER) AS city08,
    CAST(CASE WHEN p_partkey % 82 = 0 THEN NULL ELSE 15 + p_size END AS INTEGER) AS highway08,
    CAST(CASE WHEN p_partkey % 41 = 0 THEN NULL WHEN p_partkey % 37 = 0 THEN 0
      WHEN p_partkey % 31 = 0 THEN 250 ELSE 12 + p_size END AS INTEGER) AS comb08,
    CAST(100 + p_partkey % 300 AS DOUBLE) AS co2TailpipeGpm
  FROM part"""
    c["raw_vehicles"] = """
  SELECT * FROM raw_vehicles_base
  UNION ALL SELECT * REPLACE (id + 1 AS id) FROM raw_vehicles_base WHERE id % 92 = 0
  UNION ALL SELECT * REPLACE (id + 2 AS id, 'CVT' AS trany) FROM raw_vehicles_base
    WHERE id % 76 = 0"""
    c["raw_complaints"] = """
  SELECT CASE WHEN l_orderkey % 101 = 0 THEN NULL ELSE CAST(l_orderkey AS BIGINT) END AS ODINO,
    CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS CMPLID,
    p_brand AS MFGTXT,
    CASE l_linenumber % 3 WHEN 0 THEN upper(p_brand) WHEN 1 THEN concat(' ', lower(p_brand), ' ')
      ELSE p_brand END AS MAKETXT,
    CASE WHEN p_partkey % 7 = 3 THEN concat('UNLISTED ', upper(p_name)) ELSE upper(p_name) END AS MODELTXT,
    CASE WHEN p_partkey % 503 = 7 THEN 'unknown' ELSE CAST(2005 + p_size % 23 AS VARCHAR) END AS YEARTXT,
    CASE WHEN l_returnflag = 'R' THEN 'Y' WHEN l_returnflag = 'A' THEN 'N' END AS CRASH,
    CASE WHEN l_orderkey % 211 = 0 THEN '2019x' ELSE CAST((year(l_shipdate) + 24) * 10000
      + month(l_shipdate) * 100 + day(l_shipdate) AS VARCHAR) END AS DATEA,
    CASE WHEN l_linestatus = 'F' THEN 'Y' ELSE 'N' END AS FIRE,
    CAST(CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE l_linenumber % 3 END AS INTEGER) AS INJURED,
    CAST(CASE WHEN l_partkey % 6 = 0 THEN NULL ELSE l_linenumber % 2 END AS INTEGER) AS DEATHS,
    concat('COMPONENT ', CAST(l_suppkey % 7 AS VARCHAR)) AS COMPDESC,
    CAST(NULL AS VARCHAR) AS VIN,
    CASE WHEN l_partkey % 9 = 0 THEN NULL ELSE CAST(floor(l_extendedprice * 12) AS BIGINT) END AS MILEAGE,
    CAST(l_linenumber AS INTEGER) AS l_linenumber, CAST(l_partkey AS BIGINT) AS l_partkey,
    CAST(l_suppkey AS BIGINT) AS l_suppkey, CAST(l_extendedprice AS DOUBLE) AS l_extendedprice
  FROM lineitem JOIN part ON l_partkey = p_partkey"""
    c["raw_stations_base"] = """
  SELECT CAST(c_custkey AS BIGINT) AS id,
    CASE c_custkey % 8 WHEN 0 THEN 'LPG' WHEN 1 THEN 'BD' WHEN 2 THEN 'CNG' WHEN 3 THEN 'E85'
      WHEN 4 THEN 'HY' WHEN 5 THEN NULL ELSE 'ELEC' END AS fuel_type_code,
    c_name AS station_name,
    CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE n_name END AS state,
    CASE WHEN c_custkey % 43 = 0 THEN 0.0E0 ELSE CAST(15 + (c_custkey * 37) % 60 AS DOUBLE) END AS latitude,
    CASE WHEN c_custkey % 43 = 0 THEN 0.0E0 ELSE CAST(-60 - (c_custkey * 13) % 125 AS DOUBLE) END AS longitude,
    CASE c_custkey % 10 WHEN 8 THEN 'P' WHEN 9 THEN 'T' WHEN 7 THEN NULL ELSE 'E' END AS status_code,
    CASE WHEN c_custkey % 3 = 0 THEN 'private' ELSE 'public' END AS access_code
  FROM customer JOIN nation ON c_nationkey = n_nationkey"""
    c["raw_stations"] = """
  SELECT * FROM raw_stations_base
  UNION ALL SELECT * REPLACE ('public' AS access_code) FROM raw_stations_base WHERE id % 29 = 0"""
    # ---------------------------------------------------------------- P1
    c["cv_filtered"] = f"""
  SELECT * FROM raw_vehicles
  WHERE year >= {K.VEHICLE_MIN_YEAR}
    AND year IS NOT NULL AND make IS NOT NULL AND model IS NOT NULL
    AND (comb08 IS NOT NULL OR city08 IS NOT NULL OR highway08 IS NOT NULL)
    AND comb08 IS DISTINCT FROM 0
    AND (coalesce(comb08 <= {K.VEHICLE_MPG_CAP}, false)
         OR coalesce(contains(lower(fuelType), 'electric'), false))
    AND year <= {y}"""
    c["cv_unexploded"] = """
  SELECT year, make, model, VClass, drive, trany, cylinders, displ,
    fuelType1 AS primary_fuel, fuelType2 AS secondary_fuel, city08, highway08, comb08,
    co2TailpipeGpm, id
  FROM (SELECT *, row_number() OVER (PARTITION BY year, make, model, displ, cylinders, trany,
          drive, fuelType, comb08, city08, highway08 ORDER BY id ASC NULLS LAST) AS _rn
        FROM cv_filtered) WHERE _rn = 1"""
    c["clean_vehicles"] = """
  SELECT *, primary_fuel AS fuel_used, 1 AS fuel_rank FROM cv_unexploded
  UNION ALL
  SELECT *, secondary_fuel AS fuel_used, 2 AS fuel_rank FROM cv_unexploded
  WHERE secondary_fuel IS NOT NULL"""
    # ---------------------------------------------------------------- P2
    c["cc_typed"] = """
  SELECT ODINO, CMPLID, MFGTXT, MAKETXT, MODELTXT, TRY_CAST(YEARTXT AS DOUBLE) AS YEARTXT,
    CRASH, CAST(try_strptime(DATEA, '%Y%m%d') AS DATE) AS DATEA, FIRE, INJURED, DEATHS,
    COMPDESC, VIN, MILEAGE, l_linenumber, l_partkey, l_suppkey, l_extendedprice
  FROM raw_complaints
  WHERE ODINO IS NOT NULL AND DATEA IS NOT NULL AND YEARTXT IS NOT NULL
    AND MAKETXT IS NOT NULL AND MODELTXT IS NOT NULL"""
    c["cc_dedup"] = f"""
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY ODINO ORDER BY l_linenumber ASC NULLS LAST,
      l_partkey ASC NULLS LAST, l_suppkey ASC NULLS LAST, l_extendedprice ASC NULLS LAST) AS _rn
    FROM cc_typed
    WHERE (DATEA IS NULL OR DATEA <= {_date(as_of)})
      AND (MILEAGE IS NULL OR MILEAGE <= {K.COMPLAINT_MAX_MILEAGE})
      AND (YEARTXT IS NULL OR YEARTXT <= {y})) WHERE _rn = 1"""
    c["clean_complaints"] = """
  SELECT ODINO, CMPLID, MFGTXT, MAKETXT, MODELTXT, CAST(trunc(YEARTXT) AS INTEGER) AS YEARTXT,
    CRASH, DATEA, FIRE, INJURED, DEATHS, COMPDESC, VIN, MILEAGE
  FROM cc_dedup WHERE YEARTXT IS NOT NULL"""
    # ---------------------------------------------------------------- P3
    lat_lo, lat_hi, lon_lo, lon_hi = K.STATION_BBOX
    c["cs_dedup"] = f"""
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY access_code ASC NULLS LAST) AS _rn
    FROM raw_stations
    WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND fuel_type_code IS NOT NULL
      AND status_code IS NOT NULL
      AND latitude BETWEEN {lat_lo} AND {lat_hi} AND longitude BETWEEN {lon_lo} AND {lon_hi}
      AND (latitude <> 0 OR longitude <> 0)) WHERE _rn = 1"""
    c["clean_stations"] = f"""
  SELECT fuel_type_code, station_name, state, latitude, longitude, status_code, access_code, id
  FROM cs_dedup WHERE fuel_type_code IN ({_lst(K.ALT_FUEL_CODES)})"""
    # ---------------------------------------------------------------- P4
    c["cc_norm"] = f"""
  SELECT *, {norm('MAKETXT')} AS make_norm, {norm('MODELTXT')} AS model_norm
  FROM clean_complaints"""
    c["complaint_rollup"] = """
  SELECT YEARTXT AS year, make_norm, model_norm,
    count(CMPLID) AS total_complaints,
    CAST(count_if(CRASH = 'Y') AS BIGINT) AS crash_incidents,
    CAST(count_if(FIRE = 'Y') AS BIGINT) AS fire_incidents,
    CAST(coalesce(sum(INJURED), 0) AS BIGINT) AS total_injured,
    CAST(coalesce(sum(DEATHS), 0) AS BIGINT) AS total_deaths,
    avg(MILEAGE) AS avg_complaint_mileage
  FROM cc_norm
  WHERE YEARTXT IS NOT NULL AND make_norm IS NOT NULL AND model_norm IS NOT NULL
  GROUP BY 1, 2, 3"""
    c["vj_full"] = f"""
  SELECT v.*,
    coalesce(r.total_complaints, 0) AS total_complaints,
    coalesce(r.crash_incidents, 0) AS crash_incidents,
    coalesce(r.fire_incidents, 0) AS fire_incidents,
    coalesce(r.total_injured, 0) AS total_injured,
    coalesce(r.total_deaths, 0) AS total_deaths,
    coalesce(r.avg_complaint_mileage, 0.0) AS avg_complaint_mileage
  FROM clean_vehicles v LEFT JOIN complaint_rollup r
    ON v.year = r.year AND {norm('v.make')} = r.make_norm AND {norm('v.model')} = r.model_norm"""
    cols = ", ".join(K.ANALYSIS_COLUMNS)
    c["vca_joined"] = f"SELECT {cols} FROM vj_full"
    c["vca_variants"] = """
  SELECT *, CASE WHEN year IS NULL OR make IS NULL OR model IS NULL THEN NULL
    ELSE count(*) OVER (PARTITION BY year, make, model) END AS vehicle_variants
  FROM vca_joined"""
    c["vca"] = "SELECT DISTINCT * FROM vca_variants"
    # ---------------------------------------------------------------- P5
    c["vfuel"] = f"SELECT *, {_map_case('fuel_used')} AS fuel_type_code FROM clean_vehicles"
    c["fuel_year"] = """
  SELECT year, fuel_type_code, count(id) AS vehicle_count, avg(comb08) AS avg_combined_mpg,
    avg(city08) AS avg_city_mpg, avg(highway08) AS avg_highway_mpg
  FROM vfuel WHERE year IS NOT NULL AND fuel_type_code IS NOT NULL GROUP BY 1, 2"""
    c["stations_by_state"] = """
  SELECT fuel_type_code, state, count(id) AS total_stations,
    CAST(count_if(status_code = 'E') AS BIGINT) AS available_stations
  FROM clean_stations WHERE fuel_type_code IS NOT NULL AND state IS NOT NULL GROUP BY 1, 2"""
    c["stations_by_fuel"] = """
  SELECT fuel_type_code, count(id) AS total_stations,
    CAST(count_if(status_code = 'E') AS BIGINT) AS available_stations
  FROM clean_stations WHERE fuel_type_code IS NOT NULL AND state IS NOT NULL GROUP BY 1"""
    c["infra_joined"] = """
  SELECT f.*, coalesce(s.total_stations, 0) AS total_stations,
    coalesce(s.available_stations, 0) AS available_stations
  FROM fuel_year f LEFT JOIN stations_by_fuel s ON f.fuel_type_code = s.fuel_type_code"""
    c["infra"] = """
  SELECT year, fuel_type_code, vehicle_count,
    round_even(avg_combined_mpg * 10, 0) / 10 AS avg_combined_mpg,
    round_even(avg_city_mpg * 10, 0) / 10 AS avg_city_mpg,
    round_even(avg_highway_mpg * 10, 0) / 10 AS avg_highway_mpg,
    CAST(total_stations AS BIGINT) AS total_stations,
    CAST(available_stations AS BIGINT) AS available_stations,
    round_even(vehicle_count / (CASE WHEN total_stations = 0 THEN 1 ELSE total_stations END)
      * 10, 0) / 10 AS vehicles_per_station
  FROM infra_joined"""
    # ---------------------------------------------------------------- P6
    c["nationwide"] = """
  SELECT fuel_type_code, count(id) AS stations_nationwide
  FROM clean_stations WHERE fuel_type_code IS NOT NULL GROUP BY 1"""
    c["vca_code"] = f"SELECT *, {_map_case('fuel_used')} AS fuel_type_code FROM vca"
    c["comp"] = """
  SELECT c.*, CAST(coalesce(n.stations_nationwide, 0) AS BIGINT) AS stations_nationwide
  FROM vca_code c LEFT JOIN nationwide n ON c.fuel_type_code = n.fuel_type_code"""
    return c


def _count_filter(sql: str) -> str:
    """Spell ``count_if(p)`` as ``count(*) FILTER (WHERE p)``: DuckDB's
    ``count_if`` yields NULL (not 0) when every ``p`` is NULL."""
    out, i, tok = [], 0, "count_if("
    while True:
        j = sql.find(tok, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(tok)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        out.append(sql[i:j])
        out.append(f"count(*) FILTER (WHERE {_count_filter(sql[j + len(tok):k - 1])})")
        i = k


def with_ctes(select: str, as_of: _dt.date = AS_OF) -> str:
    """Prefix ``select`` with every base CTE (unused ones are never run)."""
    body = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in base_ctes(as_of).items())
    return _count_filter(f"WITH {body}\n{select}")
