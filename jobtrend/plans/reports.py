"""The growth reports (RPT3-RPT7): national, state and area, with size cohorts.

Each report is one lazy plan: slice -> fused seasonal sums (one shuffle on the group
keys, partial aggregation first) -> growth windows (one shuffle on the series
key) -> ranks -> rounding. States rank by window; areas rank by their places in one range
exchange (``operators.rank``). Building a report starts no Spark job; the caller writes
or displays the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtrend.operators.aggregate import combined_sums, large_area_sums, small_area_condition
from jobtrend.operators.clean import (
    adjusted,
    national_slice,
    regional_slice,
    statewide,
    substate,
    unadjusted,
)
from jobtrend.operators.growth import add_growth, add_ranks, measure_columns, round_measures
from jobtrend.operators.rank import add_ranks_split
from jobtrend.params import UNITED_STATES, ReportParams

SERIES_TAIL = ("supersector_name", "industry_name")
TIME_KEYS = ("year", "Month")
RANK_KEYS = ("supersector_name", "industry_name", "year", "Month")

FIRST_RANKS = {"": "first", "_mom": "first", "_ytd": "first", "_ann": "first"}
# The size cohorts rank month-over-month change with tied values averaged.
COHORT_RANKS = {"": "first", "_mom": "average", "_ytd": "first", "_ann": "first"}
NO_RANKS = {"": None, "_mom": None, "_ytd": None, "_ann": None}


def growth_report(
    sums: DataFrame,
    region_keys: Sequence[str],
    params: ReportParams,
    rank_methods: dict,
    series_tail: Sequence[str] = SERIES_TAIL,
    bounded_regions: bool = True,
) -> DataFrame:
    """Windows, ranks and rounding over combined sums keyed by
    ``region_keys + series_tail + (year, Month)``; ranks compare regions within
    ``series_tail + (year, Month)``.

    ``bounded_regions``: the regions come from a fixed list (states), so a rank
    group is small and ranked by a window; areas, whose number grows with the data,
    are ranked by their places in one range exchange.
    """
    series = [*region_keys, *series_tail]
    if params.scope == "table":
        from jobtrend.operators.table_scope import add_growth_table

        grown = add_growth_table(sums, [*series, *TIME_KEYS], params, params.bucket_rows)
    else:
        grown = add_growth(sums, series, params)
    keys, rank_keys = [*series, *TIME_KEYS], [*series_tail, *TIME_KEYS]
    if bounded_regions:
        ranked = add_ranks(grown, rank_keys, region_keys, rank_methods)
    else:
        ranked = add_ranks_split(grown, keys, rank_keys, region_keys, rank_methods)
    return round_measures(ranked).select(*series, *TIME_KEYS, *measure_columns())


def national_sums(national_clean: DataFrame, params: ReportParams = ReportParams()) -> DataFrame:
    """AGG1 + JON3: unadjusted and adjusted national sums; inner combine."""
    sl = national_slice(national_clean, params)
    return combined_sums(sl, [*SERIES_TAIL, *TIME_KEYS], unadjusted(), adjusted(), how="inner")


def state_sums(regional_clean: DataFrame, params: ReportParams = ReportParams()) -> DataFrame:
    """FLT5 + AGG2 + JON4: statewide sums; left combine."""
    sl = statewide(regional_slice(regional_clean, params))
    return combined_sums(sl, ["state_name", *SERIES_TAIL, *TIME_KEYS], unadjusted(), adjusted(), how="left")


def area_sums(
    regional_clean: DataFrame, params: ReportParams = ReportParams(), cohort: str = "all"
) -> DataFrame:
    """Area sums for all sub-state areas (AGG3 + JON5), the large-area cohort
    (FLT7 + FLT9 + JON8 + AGG4 + JON6) or the small-area rows (FLT8 + AGG5 + JON7)."""
    sl = regional_slice(regional_clean, params)
    keys = ["area_name", *SERIES_TAIL, *TIME_KEYS]
    if cohort == "all":
        return combined_sums(substate(sl), keys, unadjusted(), adjusted(), how="left")
    if cohort == "over":
        return large_area_sums(sl, keys, params)
    if cohort == "under":
        small = small_area_condition(params)
        return combined_sums(sl, keys, unadjusted() & small, adjusted() & small, how="left")
    raise ValueError(f"cohort must be 'all', 'over' or 'under', got {cohort!r}")


def national_report(national_clean: DataFrame, params: ReportParams = ReportParams()) -> DataFrame:
    """RPT3: national growth; ranks are NULL, area and state are 'United States'."""
    rep = growth_report(national_sums(national_clean, params), [], params, NO_RANKS)
    return rep.select(
        *rep.columns,
        F.lit(UNITED_STATES).alias("area_name"),
        F.lit(UNITED_STATES).alias("state_name"),
    )


def state_report_of(sums: DataFrame, params: ReportParams = ReportParams()) -> DataFrame:
    """RPT4 from the state sums."""
    return growth_report(sums, ["state_name"], params, FIRST_RANKS)


def state_report(regional_clean: DataFrame, params: ReportParams = ReportParams()) -> DataFrame:
    """RPT4: statewide growth with ranks of the states per industry and month."""
    return state_report_of(state_sums(regional_clean, params), params)


def area_report_of(sums: DataFrame, params: ReportParams = ReportParams(), cohort: str = "all") -> DataFrame:
    """RPT5-RPT7 from the area sums."""
    methods = FIRST_RANKS if cohort == "all" else COHORT_RANKS
    return growth_report(sums, ["area_name"], params, methods, bounded_regions=False)


def area_report(
    regional_clean: DataFrame, params: ReportParams = ReportParams(), cohort: str = "all"
) -> DataFrame:
    """RPT5-RPT7: area growth with ranks of the areas per industry and month."""
    return area_report_of(area_sums(regional_clean, params, cohort), params, cohort)
