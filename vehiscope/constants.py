"""Fixed values that must equal the reference's for identical results.

Everything in this module is a FIXED VALUE taken from the reference's
behaviour (column lists, the fuel lookup, code lists, bounds, null tokens).
They are stated plainly, in natural order, and used as defaults only: every
operator takes them as parameters.
"""

from __future__ import annotations

import datetime as _dt

# --- fixed values: vehicle cleaning -------------------------------------
VEHICLE_MIN_YEAR = 2010
VEHICLE_MPG_CAP = 200
ELECTRIC_NEEDLE = "electric"
VEHICLE_REQUIRED = ["year", "make", "model"]
VEHICLE_MEASURES = ["comb08", "city08", "highway08"]
VEHICLE_DEDUPE_KEYS = [
    "year", "make", "model", "displ", "cylinders", "trany",
    "drive", "fuelType", "comb08", "city08", "highway08",
]
VEHICLE_KEEP_COLUMNS = [
    "year", "make", "model", "VClass", "drive", "trany", "cylinders", "displ",
    "fuelType1", "fuelType2", "city08", "highway08", "comb08",
    "co2TailpipeGpm", "id",
]
VEHICLE_RENAMES = {"fuelType1": "primary_fuel", "fuelType2": "secondary_fuel"}

# --- fixed values: complaint cleaning -----------------------------------
# headerless TSV: positions kept and the names given to them
COMPLAINT_POSITIONS = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 14, 17]
COMPLAINT_NAMES = [
    "ODINO", "CMPLID", "MFGTXT", "MAKETXT", "MODELTXT", "YEARTXT",
    "CRASH", "DATEA", "FIRE", "INJURED", "DEATHS", "COMPDESC",
    "VIN", "MILEAGE",
]
COMPLAINT_RAW_WIDTH = 49
COMPLAINT_REQUIRED = ["ODINO", "DATEA", "YEARTXT", "MAKETXT", "MODELTXT"]
COMPLAINT_MAX_MILEAGE = 1000000

# --- fixed values: station cleaning -------------------------------------
STATION_REQUIRED = ["latitude", "longitude", "fuel_type_code", "status_code"]
# inclusive bounding box (lat_min, lat_max, lon_min, lon_max)
STATION_BBOX = (18.0, 72.0, -180.0, -65.0)
ALT_FUEL_CODES = ["ELEC", "LNG", "CNG", "BD", "E85", "HY"]
STATION_KEEP_COLUMNS = [
    "fuel_type_code", "station_name", "street_address", "city", "state", "zip",
    "latitude", "longitude", "status_code", "access_code", "open_date",
    "ev_network", "ev_connector_types", "ev_pricing", "id",
]

# --- fixed values: integration -------------------------------------------
# fuel name (as in fuel_used) -> station fuel code
FUEL_CODE_MAP = {
    "Electricity": "ELEC",
    "Gasoline or E85": "E85",
    "CNG": "CNG",
    "Diesel": "BD",
    "Hydrogen": "HY",
    "Gasoline or natural gas": "CNG",
    "LPG": "LPG",
    "LNG": "LNG",
}
# documented departure (trap T13): the plain secondary value 'E85' mapped too
FUEL_CODE_MAP_CORRECTED = {**FUEL_CODE_MAP, "E85": "E85"}

COMPLAINT_MEASURES = [
    "total_complaints", "crash_incidents", "fire_incidents",
    "total_injured", "total_deaths", "avg_complaint_mileage",
]
ANALYSIS_COLUMNS = [
    "year", "make", "model", "VClass", "drive", "cylinders", "displ",
    "primary_fuel", "secondary_fuel", "fuel_used", "fuel_rank",
    "city08", "highway08", "comb08", "co2TailpipeGpm",
    "total_complaints", "crash_incidents", "fire_incidents",
    "total_injured", "total_deaths", "avg_complaint_mileage",
]

# --- fixed values: missing-value tokens on CSV read (19) -----------------
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# --- fixed values: validation contract -----------------------------------
VALIDATION_YEAR_RANGE = (2010, 2025)
CONTRACT = {
    "vehicle_complaints_analysis": (
        ["year", "make", "model", "comb08", "total_complaints"], 20000),
    "fuel_infrastructure_analysis": (
        ["year", "fuel_type_code", "vehicle_count", "total_stations"], 30),
    "comprehensive_vehicle_analysis": (
        ["year", "make", "model", "comb08", "total_complaints",
         "stations_nationwide"], 20000),
}
NUMERIC_CHECK_COLUMNS = [
    "year", "cylinders", "displ", "city08", "highway08", "comb08",
    "co2TailpipeGpm",
]

# The clock is a parameter everywhere (trap T6); this is the default used by
# the registered queries so results never depend on today's date.
DEFAULT_AS_OF = _dt.date(2025, 3, 31)
