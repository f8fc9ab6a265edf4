"""The clean facts (RPT1, RPT2) from observation files and code tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from jobtrend.operators.clean import clean_national, clean_regional
from jobtrend.operators.joins import national_star_join, regional_star_join
from jobtrend.params import ReportParams
from jobtrend.sources.codes import read_code_tables
from jobtrend.sources.tsv import NATIONAL_STRIPPED, REGIONAL_STRIPPED, read_observations, strip_columns


def regional_fact(
    observations: DataFrame, dims: dict[str, DataFrame], params: ReportParams = ReportParams()
) -> DataFrame:
    """RPT1: strip, join to the code tables, project, filter and clean."""
    obs = strip_columns(observations, REGIONAL_STRIPPED)
    return clean_regional(regional_star_join(obs, dims), params)


def national_fact(observations: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """RPT2: strip, join to the code tables, project and type."""
    obs = strip_columns(observations, NATIONAL_STRIPPED)
    return clean_national(national_star_join(obs, dims))


def regional_fact_from_files(
    spark: SparkSession,
    observation_path: str,
    code_format: str = "parquet",
    code_paths: dict[str, str] | None = None,
    code_options: dict[str, str] | None = None,
    params: ReportParams = ReportParams(),
) -> DataFrame:
    """RPT1 end to end: one observation file plus the regional code tables."""
    obs = read_observations(spark, observation_path, REGIONAL_STRIPPED)
    dims = read_code_tables(
        spark, ("sm_series", "sm_industry", "sm_supersector", "sm_state", "sm_area"),
        code_format, code_paths, code_options,
    )
    return regional_fact(obs, dims, params)


def national_fact_from_files(
    spark: SparkSession,
    observation_paths: Sequence[str],
    code_format: str = "parquet",
    code_paths: dict[str, str] | None = None,
    code_options: dict[str, str] | None = None,
) -> DataFrame:
    """RPT2 end to end: many observation files (one scan) plus national code tables."""
    obs = read_observations(spark, list(observation_paths), NATIONAL_STRIPPED)
    dims = read_code_tables(spark, ("ce_series", "ce_industry", "ce_supersector"), code_format, code_paths, code_options)
    return national_fact(obs, dims)
