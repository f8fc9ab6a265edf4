"""String cleaning as built-in column expressions (JVM side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobtrend.functions.common import as_col

# Characters removed by a whitespace strip: space, tab, LF, CR, VT, FF.
WHITESPACE = " \t\n\r\x0b\x0c"


def strip_ws(c) -> Column:
    """STR1: trim all leading and trailing whitespace (``trim`` alone keeps tabs)."""
    return F.btrim(as_col(c), F.lit(WHITESPACE))


def zfill(c, width: int) -> Column:
    """STR2 / CST1: text form of ``c`` left-padded with zeros to ``width``.

    Longer values are kept whole (bare ``lpad`` would cut them).
    """
    s = as_col(c).cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


def remove(c, substring: str) -> Column:
    """STR3: remove every occurrence of a literal substring."""
    return F.replace(as_col(c), F.lit(substring), F.lit(""))


def remove_all(c, substrings) -> Column:
    out = as_col(c)
    for s in substrings:
        out = remove(out, s)
    return out


def month_digits(period) -> Column:
    """STR5: ``M07`` -> ``07`` (every ``M`` removed)."""
    return remove(period, "M")


def contains_any(c, needles) -> Column:
    """STR6: true when ``c`` holds any of the literal needles; null text -> false."""
    col = as_col(c)
    hit = F.lit(False)
    for n in needles:
        hit = hit | F.coalesce(col.contains(n), F.lit(False))
    return hit


def area_parts(area_name, statewide: str) -> tuple[Column, Column]:
    """STR7: split an area name on ``", "`` into (area part, state part).

    Statewide rows give the statewide label for both parts; names without a
    second part give a null state part.
    """
    name = as_col(area_name)
    parts = F.split(name, ", ")
    is_statewide = name == F.lit(statewide)
    first = F.when(is_statewide, F.lit(statewide)).otherwise(F.try_element_at(parts, F.lit(1)))
    second = F.when(is_statewide, F.lit(statewide)).otherwise(F.try_element_at(parts, F.lit(2)))
    return first, second
