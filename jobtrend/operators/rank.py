"""Ranks of regions within (supersector, industry, year, Month), split across tasks.

A window rank puts every row of one rank group in one task. For states that is
a fixed, small list; for areas the group grows with the data. Here places are numbered
by one range exchange, so the plan stays lazy and no task holds a group or a tie:

1. The changes of all ranked families are stacked into rows (family, group keys, change,
   region), and a range exchange puts them in the order family, group, change (falling), region.
   This order has no equal rows, so its ranges are even whatever group, change or
   name is frequent. The report row travels with its first family.
2. Inside a range, sorted rows are numbered as they come; the rows of each range are counted,
   and the running sum of these counts (one number a range) gives every row its place in the whole
   order. Both read the one exchange.
3. The families of a report row are put together again by its key.
4. "first": the place less the first place of the group (a map-side minimum). "average": tied
   rows share the mean of the first and the last place of their change.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from jobtrend.operators.growth import FAMILIES

#: Rows of a partition are numbered in the low bits of the id that Spark gives them.
_ROW_BITS = 33


def placed(df: DataFrame, rank_keys: Sequence[str], tie_keys: Sequence[str], families: Sequence[str]) -> DataFrame:
    """A row for each family and report row, with ``_range`` and ``_row``, its number in that range.

    Rows without a change come with their first family only, to carry the report row.
    """
    rank_keys, tie_keys = list(rank_keys), list(tie_keys)
    others = [c for c in df.columns if c not in (*rank_keys, *tie_keys)]
    entries = F.array(*[F.struct(F.lit(i).alias("_family"), F.col(f"pct_change{s}").alias("_change")) for i, s in enumerate(families)])
    stacked = df.select("*", F.explode(entries).alias("_e")).select(
        F.col("_e._family").alias("_family"),
        F.col("_e._change").alias("_change"),
        *rank_keys,
        *tie_keys,
        *[F.when(F.col("_e._family") == 0, F.col(c)).alias(c) for c in others],
    )
    order = [F.col("_family"), *(F.col(k) for k in rank_keys), F.col("_change").desc_nulls_last(), *(F.col(k) for k in tie_keys)]
    dealt = stacked.where((F.col("_family") == 0) | F.col("_change").isNotNull()).repartitionByRange(_ranges(df), *order)
    # the last columns never decide, but every reader of the rows needs them, so all read one exchange
    ordered = dealt.sortWithinPartitions(*order, *others).withColumn("_id", F.monotonically_increasing_id())
    return ordered.withColumn("_range", F.shiftright("_id", _ROW_BITS)).withColumn("_row", F.col("_id").bitwiseAND((1 << _ROW_BITS) - 1))


def _ranges(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def add_ranks_split(
    df: DataFrame,
    key_cols: Sequence[str],
    rank_keys: Sequence[str],
    tie_keys: Sequence[str],
    methods: dict[str, str] | None = None,
) -> DataFrame:
    """Same result as ``growth.add_ranks``; ``key_cols`` is the report's unique key (``rank_keys`` and ``tie_keys``)."""
    methods = methods or {}
    method = {s: methods.get(s, "first") for s, _, _ in FAMILIES}
    families = [s for s in method if method[s] is not None]
    if not families:
        return df.select("*", *[F.lit(None).cast("double").alias(f"rank{s}") for s in method])
    key_cols, rank_keys = list(key_cols), list(rank_keys)

    rows = placed(df, rank_keys, tie_keys, families)
    only = lambda i, x: F.when((F.col("_family") == i) & F.col("_change").isNotNull(), F.col(x))
    numbers = range(len(families))
    spans = rows.groupBy("_range", *rank_keys).agg(F.count(F.lit(1)).alias("_n"), *[F.min(only(i, "_row")).alias(f"_row{i}") for i in numbers])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = spans.groupBy("_range").agg(F.sum("_n").alias("_rows")).select("_range", "_rows", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    offsets = F.broadcast(offsets)
    starts = spans.join(offsets, "_range").groupBy(*rank_keys).agg(*[F.min(F.col("_before") + F.col(f"_row{i}")).alias(f"_start{i}") for i in numbers])
    # were the exchange run twice with other bounds, some range would hold more rows than were counted in it
    place = F.when(F.col("_row") < F.col("_rows"), F.col("_before") + F.col("_row"))
    rows = rows.join(offsets, "_range").withColumn("_place", place.otherwise(F.raise_error(F.lit("ranges differ between readers of one exchange")).cast("long")))
    others = [c for c in df.columns if c not in key_cols]
    whole = rows.groupBy(*key_cols).agg(
        *[F.first(c, ignorenulls=True).alias(c) for c in others], *[F.max(only(i, "_place")).alias(f"_place{i}") for i in numbers]
    )
    ranked = _null_safe_join(whole, starts, rank_keys)
    ranks = {s: (F.col(f"_place{i}") - F.col(f"_start{i}") + 1).cast("double") for i, s in enumerate(families)}
    for i, s in enumerate(families):
        if method[s] != "average":
            continue
        ties = rows.where((F.col("_family") == i) & F.col("_change").isNotNull()).groupBy(*rank_keys, F.col("_change").alias(f"_tied{i}"))
        ties = ties.agg(F.min("_place").alias(f"_first{i}"), F.count(F.lit(1)).alias(f"_n{i}")).where(F.col(f"_n{i}") > 1)
        ranked = _null_safe_join(ranked.withColumn(f"_tied{i}", F.col(f"pct_change{s}")), ties, [*rank_keys, f"_tied{i}"])
        middle = (F.col(f"_first{i}") - F.col(f"_start{i}") + 1).cast("double") + (F.col(f"_n{i}") - 1) / 2.0
        ranks[s] = F.coalesce(middle, ranks[s])
    return ranked.select(*df.columns, *[ranks.get(s, F.lit(None).cast("double")).alias(f"rank{s}") for s in method])


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join; a group with a NULL key is a group, as in a window."""
    right = right.select(*[F.col(k).alias(f"_r_{k}") if k in keys else F.col(k) for k in right.columns])
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(right, cond, "left").drop(*[f"_r_{k}" for k in keys])
