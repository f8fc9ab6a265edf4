"""Growth measures over a series (WIN1-WIN6) in series scope.

One window partitioning (the series key) feeds every measure: the two rolling
means first, then percent changes and absolute growth of ``value``, the two
means and ``value_mom``. Spark plans this as one exchange on the series key and
one sort; each window group is one series, at most a few hundred months, so no
task holds a hot group.

Semantics (reference job, pandas of its time):
- rolling mean of n rows is NULL unless all n values are present (WIN1, WIN2);
- the change over k rows divides by the last non-NULL value at or before k rows
  back (forward fill), and is NULL when the current value is NULL (WIN3, WIN4);
- absolute growth multiplies the change by the plain value k rows back (WIN5, WIN6);
- a zero base gives NULL (not infinity).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtrend.functions import percent, ratio_change, round2
from jobtrend.params import ANNUAL_MONTHS, ReportParams

# (suffix, source column, lag in rows) of the four measure families.
FAMILIES = (
    ("_mom", "value_mom", 1),
    ("_ytd", "value_ytd_avg", ANNUAL_MONTHS),
    ("_ann", "value_ann_avg", ANNUAL_MONTHS),
    ("", "value", ANNUAL_MONTHS),
)


def month_index(year: str = "year", month: str = "Month") -> Column:
    """Months since year 0: ``year * 12 + month - 1`` (calendar arithmetic)."""
    return F.col(year).try_cast("int") * F.lit(12) + F.col(month).try_cast("int") - F.lit(1)


class SeriesFrames:
    """Window frames over one series, counted in rows or in calendar months."""

    def __init__(self, series_keys: Sequence[str], calendar: bool = False):
        self.series_keys = list(series_keys)
        self.calendar = calendar
        base = Window.partitionBy(*self.series_keys)
        if calendar:
            self.ordered = base.orderBy(month_index())
        else:
            self.ordered = base.orderBy("year", "Month")

    def trailing(self, n: int):
        if self.calendar:
            return self.ordered.rangeBetween(-(n - 1), 0)
        return self.ordered.rowsBetween(-(n - 1), 0)

    def up_to(self, k: int):
        return self.ordered.rowsBetween(Window.unboundedPreceding, -k)

    def lag(self, x: Column, k: int) -> Column:
        if self.calendar:
            return F.last(x).over(self.ordered.rangeBetween(-k, -k))
        return F.lag(x, k).over(self.ordered)

    def filled_base(self, x: Column, k: int) -> Column:
        if self.calendar:  # exactly k months back, or no base
            return self.lag(x, k)
        return F.last(x, ignorenulls=True).over(self.up_to(k))

    def rolling_mean(self, x: Column, n: int) -> Column:
        frame = self.trailing(n)
        return F.when(F.count(x).over(frame) == F.lit(n), F.avg(x).over(frame))

    def calendar_ytd_mean(self, x: Column) -> Column:
        """Running mean over the months of the same year, NULL unless every month
        from January to the current one is present and non-NULL."""
        frame = (
            Window.partitionBy(*self.series_keys, "year")
            .orderBy("Month")
            .rowsBetween(Window.unboundedPreceding, 0)
        )
        return F.when(
            F.count(x).over(frame) == F.col("Month").try_cast("int"), F.avg(x).over(frame)
        )


def ytd_mean(frames: SeriesFrames, params: ReportParams, x: str = "value") -> Column:
    """WIN1: the year-to-date mean, trailing (reference) or calendar."""
    if params.ytd_mode == "calendar":
        return frames.calendar_ytd_mean(F.col(x))
    return frames.rolling_mean(F.col(x), params.ytd_months)


def add_means(df: DataFrame, frames: SeriesFrames, params: ReportParams) -> DataFrame:
    """WIN1 + WIN2 as one projection."""
    return df.select(
        "*",
        ytd_mean(frames, params).alias("value_ytd_avg"),
        frames.rolling_mean(F.col("value"), ANNUAL_MONTHS).alias("value_ann_avg"),
    )


def base_columns(frames: SeriesFrames, families=FAMILIES) -> list[Column]:
    """For each family the forward-filled base and the plain shifted value, each
    computed once (they feed both the change and the growth)."""
    out = []
    for suffix, source, k in families:
        x = F.col(source)
        out.append(frames.filled_base(x, k).alias(f"_base{suffix}"))
        out.append(frames.lag(x, k).alias(f"_shift{suffix}"))
    return out


def change_columns(families=FAMILIES) -> list[Column]:
    """WIN3-WIN6 from the bases: unrounded ``pct_change*`` (a ratio) and ``abs_growth*``."""
    out = []
    for suffix, source, _ in families:
        pct = ratio_change(F.col(source), F.col(f"_base{suffix}"))
        out.append(pct.alias(f"pct_change{suffix}"))
        out.append((F.col(f"_shift{suffix}") * pct).alias(f"abs_growth{suffix}"))
    return out


def add_growth(df: DataFrame, series_keys: Sequence[str], params: ReportParams = ReportParams()) -> DataFrame:
    """Rolling means, then changes and growth of every family (unrounded).

    Two window projections over the same partitioning and order (one exchange,
    one sort), then plain arithmetic."""
    frames = SeriesFrames(series_keys, calendar=params.calendar)
    with_means = add_means(df, frames, params)
    with_bases = with_means.select("*", *base_columns(frames))
    return with_bases.select(*df.columns, "value_ytd_avg", "value_ann_avg", *change_columns())


def rank_first(pct: Column, rank_keys: Sequence[str], tie_keys: Sequence[str]) -> Column:
    """WIN8: descending rank, ties broken by table order (the region name);
    NULL change -> NULL rank. Returned as double, like the reference."""
    w = Window.partitionBy(*rank_keys).orderBy(pct.desc_nulls_last(), *[F.col(t).asc() for t in tie_keys])
    return F.when(pct.isNotNull(), F.row_number().over(w).cast("double"))


def rank_average(pct: Column, rank_keys: Sequence[str]) -> Column:
    """WIN9: descending rank, tied values share the mean of their positions."""
    w = Window.partitionBy(*rank_keys).orderBy(pct.desc_nulls_last())
    ties = Window.partitionBy(*rank_keys, pct)
    avg_rank = F.rank().over(w).cast("double") + (F.count(F.lit(1)).over(ties).cast("double") - F.lit(1.0)) / F.lit(2.0)
    return F.when(pct.isNotNull(), avg_rank)


def add_ranks(
    df: DataFrame,
    rank_keys: Sequence[str],
    tie_keys: Sequence[str],
    methods: dict[str, str] | None = None,
) -> DataFrame:
    """Rank every family on its unrounded change (rounding first would make ties).

    ``methods`` maps a family suffix to "first" (default) or "average"; a family
    mapped to None gets a NULL rank column (the national report).
    """
    methods = methods or {}
    cols = []
    for suffix, _, _ in FAMILIES:
        method = methods.get(suffix, "first")
        pct = F.col(f"pct_change{suffix}")
        if method is None:
            r = F.lit(None).cast("double")
        elif method == "first":
            r = rank_first(pct, rank_keys, tie_keys)
        elif method == "average":
            r = rank_average(pct, rank_keys)
        else:
            raise ValueError(f"unknown rank method {method!r}")
        cols.append(r.alias(f"rank{suffix}"))
    return df.select("*", *cols)


def round_measures(df: DataFrame) -> DataFrame:
    """MTH1 + MTH2: changes to percent with two decimals, growth to two decimals."""
    replaced = {}
    for suffix, _, _ in FAMILIES:
        replaced[f"pct_change{suffix}"] = percent(F.col(f"pct_change{suffix}"))
        replaced[f"abs_growth{suffix}"] = round2(F.col(f"abs_growth{suffix}"))
    return df.withColumns(replaced)


def measure_columns() -> list[str]:
    """Measure columns of a report, in report order."""
    cols = ["value", "value_mom"]
    for suffix, source, _ in FAMILIES:
        if source not in cols:
            cols.append(source)
        cols += [f"pct_change{suffix}", f"rank{suffix}", f"abs_growth{suffix}"]
    return cols
