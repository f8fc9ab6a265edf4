"""Star joins of observations to code tables (JON1, JON2) with code padding.

Plan shape: the small code tables are joined to the series table first, giving
one enriched series row per series; the observation rows then pass through a
single equi-join on ``series_id``. Code tables are broadcast by the planner only
below its threshold. Observations never are: the series side is the build side
where its series table is estimated below the threshold, and else both sides are
sorted and merged, with hot series ids split by adaptive skew handling. Filters
on series attributes (seasonal, data type, state) are pushed by Catalyst into the
series side before the big join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtrend.functions import remove, strip_ws, zfill
from jobtrend.operators.clean import NATIONAL_FACT_COLUMNS, REGIONAL_FACT_COLUMNS

# Code widths of the published code tables (fixed values).
INDUSTRY_CODE_WIDTH = 8
SUPERSECTOR_CODE_WIDTH = 8
AREA_CODE_WIDTH = 5


def _pad(df: DataFrame, widths: dict[str, int]) -> DataFrame:
    return df.withColumns({c: zfill(F.col(c), w) for c, w in widths.items() if c in df.columns})


def _estimated_bytes(df: DataFrame) -> int:
    """The planner's size estimate (file sizes and filters; no job runs)."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _join_series(observations: DataFrame, enriched: DataFrame, series: DataFrame) -> DataFrame:
    """``observations`` (the large side) joined to their series, on ``series_id``."""
    limit = observations.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    # an enriched row is a series row with its names, about twice as wide
    small = 2 * _estimated_bytes(series) <= limit
    return observations.join(enriched.hint("broadcast" if small else "merge"), "series_id")


def regional_series_dims(dims: dict[str, DataFrame]) -> DataFrame:
    """sm_series joined to industry, supersector, state and area names."""
    series = _pad(
        dims["sm_series"].select(
            F.col("series_id").cast("string").alias("series_id"),
            F.col("state_code").cast("string").alias("state_code"),
            F.col("area_code").cast("string").alias("area_code"),
            F.col("industry_code").cast("string").alias("industry_code"),
            F.col("supersector_code").cast("string").alias("supersector_code"),
            F.col("data_type_code").cast("string").alias("data_type_code"),
            F.col("seasonal").cast("string").alias("seasonal"),
        ),
        {
            "area_code": AREA_CODE_WIDTH,
            "industry_code": INDUSTRY_CODE_WIDTH,
            "supersector_code": SUPERSECTOR_CODE_WIDTH,
        },
    )
    industry = _pad(
        dims["sm_industry"].select(
            F.col("industry_code").cast("string").alias("industry_code"), "industry_name"
        ),
        {"industry_code": INDUSTRY_CODE_WIDTH},
    )
    supersector = _pad(
        dims["sm_supersector"].select(
            F.col("supersector_code").cast("string").alias("supersector_code"), "supersector_name"
        ),
        {"supersector_code": SUPERSECTOR_CODE_WIDTH},
    )
    state = dims["sm_state"].select(F.col("state_code").cast("string").alias("state_code"), "state_name")
    # Area codes lose stray line feeds and are padded like the series side (D11).
    area = dims["sm_area"].select(
        zfill(remove(F.col("area_code").cast("string"), "\n"), AREA_CODE_WIDTH).alias("area_code"),
        "area_name",
    )
    return (
        series.join(industry, "industry_code")
        .join(supersector, "supersector_code")
        .join(state, "state_code")
        .join(area, "area_code")
    )


def regional_star_join(observations: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """JON1 + PRJ1: observations with their names; all joins inner."""
    obs = observations.select("series_id", "year", "period", "value")
    return _join_series(obs, regional_series_dims(dims), dims["sm_series"]).select(*REGIONAL_FACT_COLUMNS)


def national_series_dims(dims: dict[str, DataFrame]) -> DataFrame:
    """ce_series (ids stripped) joined to industry and supersector names."""
    series = _pad(
        dims["ce_series"].select(
            strip_ws(F.col("series_id").cast("string")).alias("series_id"),
            F.col("industry_code").cast("string").alias("industry_code"),
            F.col("supersector_code").cast("string").alias("supersector_code"),
            F.col("data_type_code").cast("string").alias("data_type_code"),
            F.col("seasonal").cast("string").alias("seasonal"),
        ),
        {"industry_code": INDUSTRY_CODE_WIDTH, "supersector_code": SUPERSECTOR_CODE_WIDTH},
    )
    industry = _pad(
        dims["ce_industry"].select(
            F.col("industry_code").cast("string").alias("industry_code"), "industry_name"
        ),
        {"industry_code": INDUSTRY_CODE_WIDTH},
    )
    supersector = _pad(
        dims["ce_supersector"].select(
            F.col("supersector_code").cast("string").alias("supersector_code"), "supersector_name"
        ),
        {"supersector_code": SUPERSECTOR_CODE_WIDTH},
    )
    return series.join(industry, "industry_code").join(supersector, "supersector_code")


def national_star_join(observations: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """JON2 + PRJ2."""
    obs = observations.select("series_id", "year", "period", "value")
    return _join_series(obs, national_series_dims(dims), dims["ce_series"]).select(*NATIONAL_FACT_COLUMNS)
