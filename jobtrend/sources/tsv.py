"""Observation files (SRC1, SRC2): tab-separated text with a header row.

The schema is given, never inferred: every column arrives as text and is typed
later by the cleaning step, so a stray ``-`` or blank never fails the scan. An
empty field reads as NULL (missing).
Several files are one scan (one DataFrame over all paths), which Spark splits
across tasks; duplicate rows across files are kept (bag union, SET1).
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from jobtrend.functions import strip_ws

OBSERVATION_COLUMNS = ("series_id", "year", "period", "value", "footnote_codes")
OBSERVATION_SCHEMA = StructType([StructField(c, StringType(), True) for c in OBSERVATION_COLUMNS])

# Columns whose text is stripped on read: regional files strip the value too,
# national files do not (the number cast ignores the padding anyway).
REGIONAL_STRIPPED = ("series_id", "year", "value", "footnote_codes")
NATIONAL_STRIPPED = ("series_id", "year", "footnote_codes")


def read_observations(
    spark: SparkSession,
    paths: str | Sequence[str],
    stripped: Iterable[str] = REGIONAL_STRIPPED,
    schema: StructType = OBSERVATION_SCHEMA,
) -> DataFrame:
    """SRC1 / SRC2: read one or many observation files as one DataFrame."""
    if isinstance(paths, str):
        paths = [paths]
    df = (
        spark.read.schema(schema)
        .option("sep", "\t")
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .csv(list(paths))
    )
    return strip_columns(df, stripped)


def strip_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """STR1 on the named columns, in place."""
    cols = [c for c in columns if c in df.columns]
    return df.withColumns({c: strip_ws(F.col(c)) for c in cols}) if cols else df


def append_frames(frames: Sequence[DataFrame]) -> DataFrame:
    """SET1: bag union by column name of frames with the same columns."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def write_observations(df: DataFrame, path: str) -> None:
    """Write observations in the same tab-separated layout (used by tests and
    round trips)."""
    (
        df.select(*OBSERVATION_COLUMNS)
        .write.mode("overwrite")
        .option("sep", "\t")
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
