"""Cleaning, projections and row filters of the regional and national facts.

Covers PRJ1, PRJ2, PRJ4, FLT1-FLT6, STR3, STR5, STR6, CST1, CST2. Every step is
a narrow transformation (no shuffle); Catalyst pushes the predicates through the
projections towards the scans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtrend.functions import contains_any, month_digits, remove, remove_all, strip_ws, to_double, zfill
from jobtrend.params import (
    ANNUAL_AVERAGE_PERIOD,
    AREA_NAME_REMOVALS,
    EMPLOYMENT_DATA_TYPE,
    STATEWIDE,
    SUBAREA_MARKERS,
    ReportParams,
)

REGIONAL_FACT_COLUMNS = (
    "area_name",
    "state_name",
    "supersector_name",
    "industry_name",
    "period",
    "year",
    "value",
    "data_type_code",
    "seasonal",
)
NATIONAL_FACT_COLUMNS = (
    "supersector_name",
    "industry_name",
    "period",
    "year",
    "value",
    "data_type_code",
    "seasonal",
)
REGIONAL_SLICE_COLUMNS = (
    "area_name",
    "state_name",
    "supersector_name",
    "industry_name",
    "Month",
    "year",
    "value",
    "data_type_code",
    "seasonal",
)
NATIONAL_SLICE_COLUMNS = (
    "supersector_name",
    "industry_name",
    "Month",
    "year",
    "value",
    "data_type_code",
    "seasonal",
)


def not_equal_keep_null(c, value) -> Column:
    """``c != value`` where a NULL ``c`` counts as different (pandas ``!=``)."""
    return ~F.col(c).eqNullSafe(F.lit(value)) if isinstance(c, str) else ~c.eqNullSafe(F.lit(value))


def clean_regional(fact: DataFrame, params: ReportParams = ReportParams()) -> DataFrame:
    """RPT1 cleaning: drop sub-area divisions (FLT1), clean names (STR3), coerce
    ``value`` (CST2), text ``period`` (CST1), pad ``data_type_code`` (STR2)."""
    area = remove_all("area_name", AREA_NAME_REMOVALS)
    if params.tidy_names:
        area = strip_ws(area)
    return fact.where(~contains_any("area_name", SUBAREA_MARKERS)).select(
        area.alias("area_name"),
        remove("state_name", "\r").alias("state_name"),
        remove("supersector_name", "\r").alias("supersector_name"),
        F.col("industry_name").cast("string").alias("industry_name"),
        F.col("period").cast("string").alias("period"),
        F.col("year").cast("string").alias("year"),
        to_double("value").alias("value"),
        zfill("data_type_code", 2).alias("data_type_code"),
        F.col("seasonal").cast("string").alias("seasonal"),
    )


def clean_national(fact: DataFrame) -> DataFrame:
    """RPT2 projection (PRJ2) with typed columns; ``value`` is always coerced (D8)."""
    return fact.select(
        F.col("supersector_name").cast("string").alias("supersector_name"),
        F.col("industry_name").cast("string").alias("industry_name"),
        F.col("period").cast("string").alias("period"),
        F.col("year").cast("string").alias("year"),
        to_double("value").alias("value"),
        F.col("data_type_code").cast("string").alias("data_type_code"),
        F.col("seasonal").cast("string").alias("seasonal"),
    )


def _with_month(df: DataFrame, columns) -> DataFrame:
    """PRJ4 + STR5: ``period`` becomes ``Month`` without the ``M``."""
    return df.withColumn("Month", month_digits("period")).select(*columns)


def regional_slice(clean: DataFrame, params: ReportParams = ReportParams()) -> DataFrame:
    """FLT2 + FLT3 in one pass: employment rows (data type 01) of kept states,
    monthly periods only, unadjusted (U) and adjusted (S) rows together.

    The two slices differ only in ``seasonal``; downstream aggregates pick each
    side with a condition on that column instead of a second scan.
    """
    excluded = list(params.excluded_states)
    in_excluded = F.coalesce(F.col("state_name").isin(excluded), F.lit(False)) if excluded else F.lit(False)
    cond = (
        (F.col("data_type_code") == F.lit(EMPLOYMENT_DATA_TYPE))
        & ~in_excluded
        & not_equal_keep_null("period", ANNUAL_AVERAGE_PERIOD)
        & F.col("seasonal").isin("U", "S")
    )
    return _with_month(clean.where(cond), REGIONAL_SLICE_COLUMNS)


def national_slice(clean: DataFrame, params: ReportParams = ReportParams()) -> DataFrame:
    """FLT4: monthly national rows, both seasonal kinds; no data type filter
    unless ``params.data_type_code`` is given (D8)."""
    cond = not_equal_keep_null("period", ANNUAL_AVERAGE_PERIOD) & F.col("seasonal").isin("U", "S")
    if params.data_type_code is not None:
        cond = cond & (F.col("data_type_code") == F.lit(params.data_type_code))
    return _with_month(clean.where(cond), NATIONAL_SLICE_COLUMNS)


def statewide(df: DataFrame) -> DataFrame:
    """FLT5."""
    return df.where(F.col("area_name") == F.lit(STATEWIDE))


def substate(df: DataFrame) -> DataFrame:
    """FLT6: every area except the statewide rows."""
    return df.where(not_equal_keep_null("area_name", STATEWIDE))


def unadjusted() -> Column:
    return F.col("seasonal") == F.lit("U")


def adjusted() -> Column:
    return F.col("seasonal") == F.lit("S")
