"""The job's data behind its reports: one pass over the regional fact, and the
intermediate frames that can be written too (SNK2)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtrend.operators.aggregate import large_area_sums, members_of, small_area_condition
from jobtrend.operators.clean import adjusted, national_slice, regional_slice, statewide, substate, unadjusted
from jobtrend.params import ReportParams

SERIES_TAIL = ("supersector_name", "industry_name")
TIME_KEYS = ("year", "Month")
CUBE_KEYS = ("area_name", "state_name", *SERIES_TAIL, *TIME_KEYS, "seasonal")
AREA_KEYS = ("area_name", *SERIES_TAIL, *TIME_KEYS)
STATE_KEYS = ("state_name", *SERIES_TAIL, *TIME_KEYS)


def regional_cube(regional_clean: DataFrame, params: ReportParams = ReportParams()) -> DataFrame:
    """All that the regional reports need of the fact, from one aggregate: for each area,
    state, industry, month and seasonal kind the sum and number of rows, the same for
    rows below the threshold, and the largest anchor value."""
    small = small_area_condition(params)
    anchor = F.when(F.col("industry_name") == F.lit(params.anchor_industry), F.col("value"))
    return (
        regional_slice(regional_clean, params)
        .groupBy(*CUBE_KEYS)
        .agg(
            F.sum("value").alias("value"),
            F.count(F.lit(1)).alias("n"),
            F.sum(F.when(small, F.col("value"))).alias("small_value"),
            F.count(F.when(small, F.lit(1))).alias("small_n"),
            F.max(anchor).alias("anchor"),
        )
    )


def _combined(cube: DataFrame, keys, value: str, n: str) -> DataFrame:
    """Both seasonal sides of cube rows: groups with unadjusted rows, and no NULL key (JON4)."""
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    sums = cube.where(whole).groupBy(*keys).agg(
        F.sum(F.when(unadjusted(), F.col(value))).alias("value"),
        F.sum(F.when(unadjusted(), F.col(n))).alias("_rows"),
        F.sum(F.when(adjusted(), F.col(value))).alias("value_mom"),
    )
    return sums.where(F.col("_rows") > 0).select(*keys, "value", "value_mom")


def state_sums_of(cube: DataFrame) -> DataFrame:
    """``reports.state_sums`` from the cube."""
    return _combined(statewide(cube), STATE_KEYS, "value", "n")


def area_sums_of(cube: DataFrame, params: ReportParams = ReportParams(), cohort: str = "all") -> DataFrame:
    """``reports.area_sums`` from the cube."""
    rows = substate(cube)
    if cohort == "all":
        return _combined(rows, AREA_KEYS, "value", "n")
    if cohort == "over":
        groups = rows.where(adjusted()).groupBy(*AREA_KEYS).agg(F.sum("value").alias("value"), F.max("anchor").alias("_anchor"))
        return members_of(groups, AREA_KEYS, params)
    if cohort == "under":
        return _combined(rows, AREA_KEYS, "small_value", "small_n")
    raise ValueError(f"cohort must be 'all', 'over' or 'under', got {cohort!r}")


def _adjusted_sums(rows: DataFrame, keys) -> DataFrame:
    whole = F.lit(True)
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    return rows.where(whole & adjusted()).groupBy(*keys).agg(F.sum("value").alias("value_mom"))


def national_frames(national_clean: DataFrame, params: ReportParams = ReportParams()) -> dict[str, DataFrame]:
    """The adjusted national sums, under their target's name."""
    return {"national_rankings_mom": _adjusted_sums(national_slice(national_clean, params), (*SERIES_TAIL, *TIME_KEYS))}


def regional_frames(regional_clean: DataFrame, params: ReportParams = ReportParams()) -> dict[str, DataFrame]:
    """The two regional slices and the adjusted sums of the cohorts, under their targets' names."""
    rows = regional_slice(regional_clean, params)
    return {
        "sm_table_final_v2": rows.where(unadjusted()),
        "sm_table_final_v3": rows.where(adjusted()),
        "msa_rankings_over_mom": large_area_sums(rows, AREA_KEYS, params).drop("value"),
        "msa_rankings_under_mom": _adjusted_sums(rows.where(small_area_condition(params)), AREA_KEYS),
    }
