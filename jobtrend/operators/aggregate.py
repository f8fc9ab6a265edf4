"""Group sums of the two seasonal sides, fused into one aggregate (AGG1-AGG6,
JON3-JON8).

The reference sums each side with its own group-by and then merges the two
results on the group keys. Here both sides are one ``groupBy`` with conditional
sums, so there is a single shuffle and map-side partial aggregation: a hot key
sends one partial row per map task, never its raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtrend.operators.clean import adjusted, not_equal_keep_null, substate
from jobtrend.params import STATEWIDE, ReportParams


def combined_sums(
    df: DataFrame,
    keys: Sequence[str],
    left: Column,
    right: Column | None,
    how: str = "left",
    left_name: str = "value",
    right_name: str = "value_mom",
) -> DataFrame:
    """Sum ``value`` per group for the ``left`` and the ``right`` rows.

    how="left":  a group is kept when it has a left row (pandas left merge).
    how="inner": a group is kept when it has rows on both sides.
    right=None:  both sides are the same rows; the one sum is named twice (JON6).

    Groups with a NULL key are dropped (pandas group-by). A side whose values are
    all NULL sums to NULL.
    """
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    keys = list(keys)
    key_ok = F.lit(True)
    for k in keys:
        key_ok = key_ok & F.col(k).isNotNull()

    value = F.col("value")
    if right is None:
        agg = (
            df.where(key_ok & left)
            .groupBy(*keys)
            .agg(F.sum(value).alias(left_name))
        )
        return agg.select(*keys, F.col(left_name), F.col(left_name).alias(right_name))

    rows = df.where(key_ok & (left | right))
    agg = rows.groupBy(*keys).agg(
        F.sum(F.when(left, value)).alias(left_name),
        F.count(F.when(left, F.lit(1))).alias("_left_rows"),
        F.sum(F.when(right, value)).alias(right_name),
        F.count(F.when(right, F.lit(1))).alias("_right_rows"),
    )
    keep = F.col("_left_rows") > 0
    if how == "inner":
        keep = keep & (F.col("_right_rows") > 0)
    return agg.where(keep).select(*keys, left_name, right_name)


def distinct_areas(df: DataFrame) -> DataFrame:
    """AGG6: the distinct area names of a frame."""
    return df.select("area_name").distinct()


def large_areas(slice_df: DataFrame, params: ReportParams) -> DataFrame:
    """FLT7 + AGG6: areas with an adjusted anchor-industry row above the threshold."""
    cond = (
        adjusted()
        & (F.col("industry_name") == F.lit(params.anchor_industry))
        & (F.col("value") > F.lit(float(params.threshold)))
    )
    return distinct_areas(substate(slice_df).where(cond))


#: Bits of the member filter: 32 bitmaps of Spark's 32,768 bits, 128 KB whatever the number of members.
FILTER_BITS = 1 << 20


def member_filter(members: DataFrame, key: str) -> DataFrame:
    """``_bucket`` and ``_bits``: a bitmap of the hashes of ``key`` (at most FILTER_BITS bits in all)."""
    at = _filter_place(key)
    return members.where(F.col(key).isNotNull()).groupBy(F.bitmap_bucket_number(at).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("_bits"))


def _filter_place(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(FILTER_BITS)) + 1


def may_be_members(df: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """The rows of ``df`` whose key is in the filter: all members, and others whose hash has the same place."""
    bit = F.bitmap_bit_position(_filter_place(key)).cast("int")
    byte = F.conv(F.hex(F.substring("_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    held = df.withColumn("_bucket", F.bitmap_bucket_number(_filter_place(key))).join(F.broadcast(found), "_bucket")
    return held.where(F.getbit(byte, bit % 8) == 1).select(*df.columns)


def large_area_rows(slice_df: DataFrame, params: ReportParams) -> DataFrame:
    """FLT9 / JON8: every adjusted row of the large areas.

    A filter of bounded size drops almost all rows of other areas where they are read; only what
    passes meets the distinct area list, in a semi join (no list is collected to the
    driver). Statewide rows, which are never members, leave before.
    """
    members = large_areas(slice_df, params)
    rows = may_be_members(substate(slice_df).where(adjusted()), member_filter(members, "area_name"), "area_name")
    return rows.join(members, on="area_name", how="left_semi")


def large_area_sums(slice_df: DataFrame, keys: Sequence[str], params: ReportParams) -> DataFrame:
    """AGG4 + FLT9 + JON6 + JON8: sums of the large areas, from one aggregate of the rows.

    Each group carries its largest anchor value, and an area is a member if any of its
    groups (those with a NULL key too) has one above the threshold. Only aggregated rows,
    one a series and month, meet by area.
    """
    anchor = F.when(F.col("industry_name") == F.lit(params.anchor_industry), F.col("value"))
    groups = (
        substate(slice_df)
        .where(adjusted())
        .groupBy(*keys)
        .agg(F.sum("value").alias("value"), F.max(anchor).alias("_anchor"))
    )
    return members_of(groups, keys, params)


def members_of(groups: DataFrame, keys: Sequence[str], params: ReportParams) -> DataFrame:
    """The groups of areas with an anchor value above the threshold, and without NULL keys."""
    largest = F.max("_anchor").over(Window.partitionBy("area_name"))
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return (
        groups.withColumn("_largest", largest)
        .where((F.col("_largest") > F.lit(float(params.threshold))) & whole)
        .select(*keys, "value", F.col("value").alias("value_mom"))
    )


def small_area_condition(params: ReportParams) -> Column:
    """FLT8: anchor-industry rows below the threshold (exactly equal is in neither cohort)."""
    return (
        not_equal_keep_null("area_name", STATEWIDE)
        & (F.col("industry_name") == F.lit(params.anchor_industry))
        & (F.col("value") < F.lit(float(params.threshold)))
    )
