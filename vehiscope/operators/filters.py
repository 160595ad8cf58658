"""Row filters and projections used by the cleaning jobs.

Every predicate is written two-valued on purpose: the reference's pandas
predicates never yield "unknown", so each one states what a null does
(trap T1). They are plain comparisons and null tests, which Catalyst pushes into
the Parquet scan when the column is stored (C1, C6-C10, C12).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.scalar import icontains


def _as_date(as_of) -> _dt.date:
    if isinstance(as_of, _dt.datetime):
        return as_of.date()
    if isinstance(as_of, _dt.date):
        return as_of
    return _dt.date.fromisoformat(str(as_of))


# predicates (Column builders) --------------------------------------------
def min_year_pred(col: str = "year", y: int = K.VEHICLE_MIN_YEAR) -> Column:
    return F.col(col) >= F.lit(y)


def not_zero_pred(col: str) -> Column:
    return ~F.col(col).eqNullSafe(0)


def cap_unless_pred(col: str, cap_value, text_col: str, needle: str) -> Column:
    return F.coalesce(F.col(col) <= F.lit(cap_value), F.lit(False)) | icontains(text_col, needle)


def _keep_null(col: str, p: Column, keep_null: bool) -> Column:
    """``col IS NULL OR p``: a form that Catalyst pushes into the Parquet scan."""
    return F.col(col).isNull() | p if keep_null else p


def not_after_year_pred(col: str, as_of, keep_null: bool) -> Column:
    return _keep_null(col, F.col(col) <= F.lit(_as_date(as_of).year), keep_null)


def not_after_pred(col: str, as_of, keep_null: bool = True) -> Column:
    return _keep_null(col, F.col(col) <= F.lit(_as_date(as_of)), keep_null)


def cap_pred(col: str, hi, keep_null: bool = True) -> Column:
    return _keep_null(col, F.col(col) <= F.lit(hi), keep_null)


def bbox_pred(lat: str, lon: str, box=K.STATION_BBOX) -> Column:
    lat_lo, lat_hi, lon_lo, lon_hi = box
    return F.col(lat).between(lat_lo, lat_hi) & F.col(lon).between(lon_lo, lon_hi)


def not_null_island_pred(lat: str, lon: str) -> Column:
    return (F.col(lat) != 0) | (F.col(lon) != 0)


def all_present_pred(cols: Iterable[str]) -> Column:
    p = F.lit(True)
    for c in cols:
        p = p & F.col(c).isNotNull()
    return p


def any_present_pred(cols: Iterable[str]) -> Column:
    p = F.lit(False)
    for c in cols:
        p = p | F.col(c).isNotNull()
    return p


# operators ---------------------------------------------------------------
def min_year(df: DataFrame, col: str = "year", y: int = K.VEHICLE_MIN_YEAR) -> DataFrame:
    """Keep ``col >= y``; a null year is dropped."""
    return df.filter(min_year_pred(col, y))


def require_all(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows where ANY listed column is null."""
    return df.na.drop("any", subset=list(cols))


def require_any(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows where ALL listed columns are null."""
    return df.na.drop("all", subset=list(cols))


def drop_zero(df: DataFrame, col: str) -> DataFrame:
    """C4: drop an exact zero; a null value is KEPT (trap T1)."""
    return df.filter(not_zero_pred(col))


def cap_unless(df: DataFrame, col: str = "comb08", cap_value=K.VEHICLE_MPG_CAP,
               text_col: str = "fuelType", needle: str = K.ELECTRIC_NEEDLE) -> DataFrame:
    """Keep ``col <= cap`` or rows whose text contains ``needle`` (any case)."""
    return df.filter(cap_unless_pred(col, cap_value, text_col, needle))


def not_after_year(df: DataFrame, col: str, as_of, keep_null: bool = False) -> DataFrame:
    """C6 (``keep_null=False``) / C7 (``keep_null=True``): drop future years."""
    return df.filter(not_after_year_pred(col, as_of, keep_null))


def not_after(df: DataFrame, col: str, as_of, keep_null: bool = True) -> DataFrame:
    """Drop dates after ``as_of``; a null date is kept."""
    return df.filter(not_after_pred(col, as_of, keep_null))


def cap(df: DataFrame, col: str, hi, keep_null: bool = True) -> DataFrame:
    """Upper bound, null kept."""
    return df.filter(cap_pred(col, hi, keep_null))


def in_bbox(df: DataFrame, lat: str = "latitude", lon: str = "longitude",
            box=K.STATION_BBOX) -> DataFrame:
    """Inclusive bounding box."""
    return df.filter(bbox_pred(lat, lon, box))


def drop_null_island(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """C11: drop the exact (0, 0) point."""
    return df.filter(not_null_island_pred(lat, lon))


def keep_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """Membership filter; null is dropped."""
    return df.filter(F.col(col).isin(list(values)))


def select_existing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Project to an allow-list, keeping only columns that exist (schema
    metadata only, nothing is read)."""
    present = set(df.columns)
    return df.select([c for c in cols if c in present])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """C14: rename columns."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def project_analysis(df: DataFrame, cols: Sequence[str] = K.ANALYSIS_COLUMNS) -> DataFrame:
    """The fixed 21-column analysis projection."""
    return df.select(*cols)
