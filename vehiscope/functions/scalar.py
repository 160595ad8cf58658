"""Scalar column functions (F1-F10) and type conversions (V1-V6).

All are built-in Spark expressions, so they stay inside whole-stage codegen.
ANSI mode is on in Spark 4 (trap T19): every conversion that may fail uses a
``try_`` form and yields null instead of raising.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------- F1 .. F10
def norm_key(col) -> Column:
    """upper-case, then strip edge whitespace (any Unicode space); inner
    punctuation and spaces are kept. ``trim`` would only remove blanks."""
    return F.upper(F.regexp_replace(_c(col), r"(?U)^\s+|\s+$", ""))


def map_code(col, mapping: Mapping[str, str] = K.FUEL_CODE_MAP) -> Column:
    """dictionary lookup; an unmapped or null key gives null.

    A literal map is an expression, not a join: no shuffle, no broadcast.
    """
    m = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    return F.try_element_at(m, _c(col))


def icontains(col, needle: str) -> Column:
    """case-insensitive substring test; null text gives false."""
    return F.coalesce(F.lower(_c(col)).contains(needle.lower()), F.lit(False))


def fill0(df, cols: Iterable[str]):
    """fill missing measures with 0 on the listed columns."""
    return df.na.fill(0, subset=list(cols))


def ratio_zero_as_one(n, d) -> Column:
    """``n / d`` where a zero denominator is replaced by 1."""
    d = _c(d)
    return _c(n) / F.when(d == 0, F.lit(1)).otherwise(d)


def round_even(col, places: int = 1) -> Column:
    """half-to-even rounding on the scaled value (``rint(x*10^p)/10^p``).

    Spark's ``round`` is HALF_UP and ``bround`` works on the decimal value;
    both differ from the reference on values such as 0.45 or 2.65.
    """
    scale = 10 ** places
    return F.rint(_c(col) * scale) / scale


def rate(n, d, scale: float = 1.0) -> Column:
    """unguarded ratio ``n*scale/d``; null when ``d`` is 0 (no ANSI error)."""
    num = _c(n) if scale == 1 else _c(n) * F.lit(scale)
    return F.try_divide(num, _c(d))


def per(n, d, scale: float) -> Column:
    """F7 variant in the reference's order: ``n / d * scale``."""
    return F.try_divide(_c(n), _c(d)) * F.lit(scale)


def pct_diff(a, b) -> Column:
    """F8: percentage difference ``(a-b)/a*100``."""
    return F.try_divide(_c(a) - _c(b), _c(a)) * F.lit(100)


def label(col, threshold, below: str, otherwise: str) -> Column:
    """``below`` when ``col < threshold`` else ``otherwise``."""
    return F.when(_c(col) < threshold, F.lit(below)).otherwise(F.lit(otherwise))


def row_min(*cols) -> Column:
    """row-wise minimum, nulls skipped."""
    return F.least(*[_c(c) for c in cols])


def row_max(*cols) -> Column:
    """row-wise maximum, nulls skipped."""
    return F.greatest(*[_c(c) for c in cols])


# ---------------------------------------------------------------- V1 .. V6
def parse_ymd(col) -> Column:
    """V1: ``yyyyMMdd`` text to DATE; anything else gives null."""
    return F.try_to_date(_c(col).cast("string"), "yyyyMMdd")


def parse_num(col, to: str = "double") -> Column:
    """V2: text to number; unparseable gives null."""
    return _c(col).try_cast(to)


def fmt_date(col) -> Column:
    """V3: DATE to ``yyyy-MM-dd`` text (only needed at a CSV edge)."""
    return F.date_format(_c(col), "yyyy-MM-dd")


def require_int(col, strict: bool = False, what: str = "value") -> Column:
    """V4: number to INT, truncating the fraction.

    A null cannot become an int: in ``strict`` mode the row raises (the
    reference's behaviour); otherwise null is kept so that the caller routes
    the row to a reject set (see ``reject_reason``).
    """
    v = _c(col).cast("double").cast("int")
    if strict:
        return F.when(_c(col).isNull(),
                      F.raise_error(F.lit(f"{what} is null and cannot be an integer"))
                      ).otherwise(v)
    return v


def to_nullable_int(col) -> Column:
    """V5: fractional number to nullable BIGINT; a non-integral value raises.
    (An integral column needs only a cast; see ``clean_complaints``.)"""
    d = _c(col).cast("double")
    return F.when(d.isNull() | (d == F.floor(d)), d.cast("bigint")).otherwise(
        F.raise_error(F.concat(F.lit("non-integral value: "), d.cast("string"))))


def parse_iso(col) -> Column:
    """V6: ISO ``yyyy-MM-dd`` text to DATE; bad text gives null."""
    return F.try_to_date(_c(col).cast("string"))


# ---------------------------------------------------------------- S5
def nullify(col, tokens: Iterable[str] = K.NA_TOKENS) -> Column:
    """A text equal to one of the missing-value tokens becomes null."""
    c = _c(col)
    return F.when(~c.isin(list(tokens)), c)
