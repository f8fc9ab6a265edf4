"""Numeric coercion and rounding as built-in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobtrend.functions.common import as_col


def nan_to_null(c) -> Column:
    """NUL1: a double NaN becomes SQL NULL (NaN would sort above every number)."""
    return F.nanvl(as_col(c), F.lit(None).cast("double"))


# A plain decimal, with an exponent at most; the cast alone also takes type suffixes
# ('1d'), hexadecimal floats and names of infinity.
DECIMAL_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def to_double(c) -> Column:
    """CST2: text or number -> double; text that is no plain decimal -> NULL, and so is
    a number that is not finite."""
    number = as_col(c).try_cast("double")
    plain = as_col(c).cast("string").rlike(DECIMAL_TEXT)
    return F.when(plain & (F.abs(number) < F.lit(float("inf"))), number)


def round2(c) -> Column:
    """MTH2: round half to even at two decimals, as ``rint(x * 100) / 100``."""
    return F.rint(as_col(c) * F.lit(100.0)) / F.lit(100.0)


def percent(c) -> Column:
    """MTH1: a ratio as a percent rounded to two decimals (x100, then MTH2)."""
    return round2(as_col(c) * F.lit(100.0))


def ratio_change(current, base) -> Column:
    """``current / base - 1``; NULL for a NULL current value or a zero / NULL base."""
    cur = as_col(current)
    return F.when(cur.isNotNull(), F.try_divide(cur, as_col(base)) - F.lit(1.0))
