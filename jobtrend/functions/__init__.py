"""Scalar column functions (STR*, CST*, MTH*, NUL1)."""

from jobtrend.functions.numeric import nan_to_null, percent, ratio_change, round2, to_double
from jobtrend.functions.text import (
    area_parts,
    contains_any,
    month_digits,
    remove,
    remove_all,
    strip_ws,
    zfill,
)

__all__ = [
    "area_parts",
    "contains_any",
    "month_digits",
    "nan_to_null",
    "percent",
    "ratio_change",
    "remove",
    "remove_all",
    "round2",
    "strip_ws",
    "to_double",
    "zfill",
]
