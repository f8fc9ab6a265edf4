"""Filters, fused sums, growth windows, ranks and table scope on hand-made frames."""

from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from jobtrend.operators.aggregate import combined_sums, large_area_rows, small_area_condition
from jobtrend.operators import table_scope
from jobtrend.operators.clean import adjusted, clean_regional, regional_slice, unadjusted
from jobtrend.operators.growth import add_growth, add_ranks, round_measures
from jobtrend.operators.table_scope import add_growth_table, with_position
from jobtrend.params import ReportParams

from tests import pandas_model as M

FACT_SCHEMA = (
    "area_name string, state_name string, supersector_name string, industry_name string, "
    "period string, year string, value string, data_type_code string, seasonal string"
)


def rows_equal(a, b, tol=0.0):
    if a is None or (isinstance(a, float) and math.isnan(a)):
        return b is None or (isinstance(b, float) and math.isnan(b))
    if b is None or (isinstance(b, float) and math.isnan(b)):
        return False
    if isinstance(a, float) or isinstance(b, float):
        return abs(float(a) - float(b)) <= tol
    return a == b


def test_clean_regional_filters_divisions_and_cleans(spark):
    rows = [
        ("Statewide", "Ohio\r", "Mining\r", "Total Nonfarm", "M01", "2015", " 12 ", "1", "U"),
        ("Akron, OH Metropolitan Division", "Ohio", "Mining", "Total Nonfarm", "M01", "2015", "5", "01", "U"),
        ("Boston NECTA Division", "Mass", "Mining", "Total Nonfarm", "M01", "2015", "5", "01", "U"),
        ("Boston, MA NECTA", "Mass", "Mining", "Total Nonfarm", "M01", "2015", "-", "01", "S"),
        ("Akron, OH Metropolitan Statistical Area", "Ohio", "Mining", "Total Nonfarm", "M02", "2015", "7", "001", "S"),
    ]
    df = spark.createDataFrame(rows, FACT_SCHEMA)
    got = [tuple(r) for r in clean_regional(df).collect()]
    assert got == [
        ("Statewide", "Ohio", "Mining", "Total Nonfarm", "M01", "2015", 12.0, "01", "U"),
        ("Boston, MA", "Mass", "Mining", "Total Nonfarm", "M01", "2015", None, "01", "S"),
        ("Akron, OH ", "Ohio", "Mining", "Total Nonfarm", "M02", "2015", 7.0, "001", "S"),
    ]
    tidy = clean_regional(df, ReportParams(tidy_names=True)).collect()
    assert tidy[2].area_name == "Akron, OH"


def test_regional_slice_rules(spark):
    rows = [
        ("Statewide", "Ohio", "S1", "I1", "M01", "2015", "1", "01", "U"),
        ("Statewide", "Puerto Rico", "S1", "I1", "M01", "2015", "1", "01", "U"),  # excluded state
        ("Statewide", None, "S1", "I1", "M01", "2015", "1", "01", "U"),  # null state stays
        ("Statewide", "Ohio", "S1", "I1", "M13", "2015", "1", "01", "U"),  # annual row
        ("Statewide", "Ohio", "S1", "I1", "M02", "2015", "1", "02", "U"),  # other data type
        ("Statewide", "Ohio", "S1", "I1", "M03", "2015", "1", "01", "X"),  # other seasonal code
        ("Statewide", "Ohio", "S1", "I1", "M04", "2015", "1", "01", "S"),
    ]
    df = clean_regional(spark.createDataFrame(rows, FACT_SCHEMA))
    got = sorted((r.state_name or "", r.Month, r.seasonal) for r in regional_slice(df).collect())
    assert got == [("", "01", "U"), ("Ohio", "01", "U"), ("Ohio", "04", "S")]


def test_combined_sums_left_inner_nulls(spark):
    rows = [
        ("a", "01", 1.0, "U"), ("a", "01", 2.0, "U"), ("a", "01", 10.0, "S"),
        ("b", "01", 5.0, "U"),  # no adjusted side
        ("c", "01", 7.0, "S"),  # no unadjusted side
        ("d", "01", None, "U"), ("d", "01", None, "S"),  # all-null values
        (None, "01", 3.0, "U"),  # null key dropped
    ]
    df = spark.createDataFrame(rows, "k string, Month string, value double, seasonal string")
    left = {r.k: (r.value, r.value_mom) for r in combined_sums(df, ["k", "Month"], unadjusted(), adjusted(), "left").collect()}
    assert left == {"a": (3.0, 10.0), "b": (5.0, None), "d": (None, None)}
    inner = {r.k for r in combined_sums(df, ["k", "Month"], unadjusted(), adjusted(), "inner").collect()}
    assert inner == {"a", "d"}
    same = {r.k: (r.value, r.value_mom) for r in combined_sums(df, ["k", "Month"], adjusted(), None).collect()}
    assert same == {"a": (10.0, 10.0), "c": (7.0, 7.0), "d": (None, None)}


def test_cohort_boundaries(spark):
    p = ReportParams(anchor_industry="Total Nonfarm", threshold=1000.0)
    rows = [
        ("A1", "Total Nonfarm", 1500.0, "S"), ("A1", "Mining", 3.0, "S"),  # large area: all rows
        ("A2", "Total Nonfarm", 1000.0, "S"),  # exactly the threshold: in neither cohort
        ("A3", "Total Nonfarm", 999.0, "S"), ("A3", "Total Nonfarm", 999.0, "U"),
        ("Statewide", "Total Nonfarm", 5000.0, "S"),
    ]
    df = spark.createDataFrame(rows, "area_name string, industry_name string, value double, seasonal string")
    large = sorted((r.area_name, r.industry_name) for r in large_area_rows(df, p).collect())
    assert large == [("A1", "Mining"), ("A1", "Total Nonfarm")]
    small = sorted(r.area_name for r in df.where(small_area_condition(p)).collect())
    assert small == ["A3", "A3"]


def make_series(seed: int, n_series: int = 3, null_rate: float = 0.15, zero_rate: float = 0.05, drop_rate: float = 0.1):
    rnd = random.Random(seed)
    rows = []
    for s in range(n_series):
        for y in range(2010, 2014):
            for m in range(1, 13):
                if rnd.random() < drop_rate:
                    continue  # missing month
                v = None if rnd.random() < null_rate else float(rnd.choice([0] * int(zero_rate * 100) + list(range(1, 200))))
                vm = None if rnd.random() < null_rate else float(rnd.randint(0, 200))
                rows.append((f"R{s % 2}", f"S{s}", str(y), f"{m:02d}", v, vm))
    return rows


SUMS_SCHEMA = "region string, series string, year string, Month string, value double, value_mom double"
MEASURES = [f"{p}{s}" for s in ("_mom", "_ytd", "_ann", "") for p in ("pct_change", "abs_growth")] + [
    "value_ytd_avg", "value_ann_avg"]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_series_growth_matches_pandas_model(spark, seed):
    rows = make_series(seed)
    df = spark.createDataFrame(rows, SUMS_SCHEMA)
    got = add_growth(df, ["region", "series"], ReportParams()).toPandas()
    want = M.series_growth(pd.DataFrame(rows, columns=df.columns), ["region", "series"])
    key = ["region", "series", "year", "Month"]
    got = got.sort_values(key).reset_index(drop=True)
    want = want.sort_values(key).reset_index(drop=True)
    for c in MEASURES:
        for a, b in zip(got[c], want[c]):
            assert rows_equal(a, b, 1e-9), (c, a, b)


@pytest.mark.parametrize("seed,bucket,run", [(4, 13, 2), (4, 13, 1024), (5, 40, 1), (6, 1000, 1024)])
def test_table_scope_matches_pandas_model(spark, monkeypatch, seed, bucket, run):
    monkeypatch.setattr(table_scope, "RUN_BUCKETS", run)
    rows = make_series(seed, n_series=4, null_rate=0.3)
    df = spark.createDataFrame(rows, SUMS_SCHEMA)
    order = ["region", "series", "year", "Month"]
    got = add_growth_table(df, order, ReportParams(scope="table"), bucket_rows=bucket).toPandas()
    want = M.table_growth(pd.DataFrame(rows, columns=df.columns), order)
    got = got.sort_values(order).reset_index(drop=True)
    for c in MEASURES:
        for a, b in zip(got[c], want[c]):
            assert rows_equal(a, b, 1e-9), (c, a, b)


def test_position_is_dense_and_ordered(spark):
    df = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).alias("k"))
    pos = with_position(df, ["k"], "pos", partitions=7).collect()
    assert sorted((r.k, r.pos) for r in pos) == [(i, i) for i in range(5000)]


def test_calendar_lag_uses_months_not_rows(spark):
    rows = [("R", "S", "2010", f"{m:02d}", float(m), float(m)) for m in range(1, 13)]
    rows += [("R", "S", "2011", "02", 100.0, 100.0)]  # January 2011 missing
    df = spark.createDataFrame(rows, SUMS_SCHEMA)
    rowwise = {(r.year, r.Month): r for r in add_growth(df, ["region", "series"], ReportParams()).collect()}
    cal = {(r.year, r.Month): r for r in add_growth(df, ["region", "series"], ReportParams(calendar=True)).collect()}
    # by rows, Feb 2011 compares with the row 12 back (Feb 2010 is row 2 -> base 1.0 of January)
    assert rowwise[("2011", "02")].pct_change == 100.0 / 1.0 - 1
    # by months, the base is February 2010
    assert cal[("2011", "02")].pct_change == 100.0 / 2.0 - 1
    assert cal[("2011", "02")].pct_change_mom is None
    assert cal[("2011", "02")].abs_growth_mom is None


def test_calendar_base_is_never_an_older_month(spark):
    """Without 2011-02, 2012-02 has no change, no growth and no rank."""
    rows = [("R", "S", str(y), f"{m:02d}", float(100 + m + y), 1.0) for y in (2011, 2012) for m in range(1, 13) if (y, m) != (2011, 2)]
    df = add_growth(spark.createDataFrame(rows, SUMS_SCHEMA), ["region", "series"], ReportParams(calendar=True))
    got = {(r.year, r.Month): r for r in add_ranks(df, ["series", "year", "Month"], ["region"], {}).collect()}
    gap = got[("2012", "02")]
    assert gap.pct_change is None and gap.abs_growth is None and gap["rank"] is None
    assert got[("2011", "03")].pct_change_mom is None
    assert got[("2012", "03")].pct_change == (100 + 3 + 2012) / (100 + 3 + 2011) - 1
    assert got[("2012", "03")]["rank"] == 1.0


def test_calendar_ytd_mean(spark):
    rows = [("R", "S", "2010", f"{m:02d}", float(m), None) for m in range(1, 7)]
    rows += [("R", "S", "2011", "02", 5.0, None)]
    df = spark.createDataFrame(rows, SUMS_SCHEMA)
    got = {(r.year, r.Month): r.value_ytd_avg for r in add_growth(df, ["region", "series"], ReportParams(ytd_mode="calendar")).collect()}
    assert got[("2010", "03")] == 2.0
    assert got[("2010", "06")] == 3.5
    assert got[("2011", "02")] is None  # January missing


def rank_frame(spark):
    rows = [
        ("S1", "01", "ca", 0.5), ("S1", "01", "az", 0.5), ("S1", "01", "ny", 0.9),
        ("S1", "01", "tx", None), ("S1", "01", "wa", 0.1), ("S1", "02", "ca", 0.3),
    ]
    base = spark.createDataFrame(rows, "ss string, Month string, region string, pct_change double")
    return base.select(
        "*",
        *[F.col("pct_change").alias(f"pct_change{s}") for s in ("_mom", "_ytd", "_ann")],
    )


def test_rank_first_breaks_ties_by_region(spark):
    got = add_ranks(rank_frame(spark), ["ss", "Month"], ["region"], {}).collect()
    ranks = {(r.Month, r.region): r["rank"] for r in got}
    assert ranks == {("01", "ny"): 1.0, ("01", "az"): 2.0, ("01", "ca"): 3.0, ("01", "wa"): 4.0,
                     ("01", "tx"): None, ("02", "ca"): 1.0}


def test_rank_average_shares_ties(spark):
    got = add_ranks(rank_frame(spark), ["ss", "Month"], ["region"], {"_mom": "average"}).collect()
    ranks = {(r.Month, r.region): r.rank_mom for r in got}
    assert ranks == {("01", "ny"): 1.0, ("01", "az"): 2.5, ("01", "ca"): 2.5, ("01", "wa"): 4.0,
                     ("01", "tx"): None, ("02", "ca"): 1.0}
    pdf = rank_frame(spark).toPandas()
    want = pdf.groupby(["ss", "Month"])["pct_change_mom"].rank(ascending=False, method="average")
    assert sorted(x for x in want if not np.isnan(x)) == sorted(v for v in ranks.values() if v is not None)


def test_rank_is_a_permutation(spark):
    rnd = random.Random(11)
    rows = [("S", str(g), f"r{i:03d}", float(rnd.randint(0, 5))) for g in range(5) for i in range(40)]
    df = spark.createDataFrame(rows, "ss string, Month string, region string, pct_change double")
    df = df.select("*", *[F.col("pct_change").alias(f"pct_change{s}") for s in ("_mom", "_ytd", "_ann")])
    got = add_ranks(df, ["ss", "Month"], ["region"], {}).toPandas()
    for _, g in got.groupby("Month"):
        assert sorted(g["rank"]) == list(range(1, 41))
        ordered = g.sort_values(["pct_change", "region"], ascending=[False, True])
        assert list(ordered["rank"]) == list(range(1, 41))


def test_round_measures_rounds_after_ranking(spark):
    rows = [("S", "01", "a", 0.123456), ("S", "01", "b", 0.123459)]
    df = spark.createDataFrame(rows, "ss string, Month string, region string, pct_change double")
    df = df.select("*", *[F.col("pct_change").alias(f"pct_change{s}") for s in ("_mom", "_ytd", "_ann")],
                   *[F.lit(None).cast("double").alias(f"abs_growth{s}") for s in ("_mom", "_ytd", "_ann", "")])
    got = {r.region: (r["rank"], r.pct_change) for r in round_measures(add_ranks(df, ["ss", "Month"], ["region"], {})).collect()}
    # equal after rounding, still ordered by the unrounded change
    assert got == {"a": (2.0, 12.35), "b": (1.0, 12.35)}


def test_params_validate():
    with pytest.raises(ValueError):
        ReportParams(scope="everything")
    with pytest.raises(ValueError):
        ReportParams(ytd_mode="fiscal")
    with pytest.raises(ValueError):
        ReportParams(bucket_rows=0)
    with pytest.raises(ValueError):
        add_growth_table(None, [], ReportParams(scope="table", calendar=True))


@pytest.mark.parametrize("seed", [21, 22])
def test_split_ranks_equal_window_ranks(spark, seed):
    from jobtrend.operators.growth import add_ranks
    from jobtrend.operators.rank import add_ranks_split

    rnd = random.Random(seed)
    rows = []
    for g in range(3):
        n = 300 if g == 0 else rnd.randint(1, 20)  # one hot group
        for i in range(n):
            vals = [None if rnd.random() < 0.2 else float(rnd.randint(-3, 3)) / 4 for _ in range(4)]
            rows.append(("S", f"{g:02d}", f"r{i:04d}", *vals))
    df = spark.createDataFrame(
        rows, "ss string, Month string, region string, pct_change_mom double, pct_change_ytd double, "
              "pct_change_ann double, pct_change double")
    methods = {"_mom": "average"}
    want = {(r.Month, r.region): tuple(r[f"rank{s}"] for s in ("_mom", "_ytd", "_ann", ""))
            for r in add_ranks(df, ["ss", "Month"], ["region"], methods).collect()}
    got = {(r.Month, r.region): tuple(r[f"rank{s}"] for s in ("_mom", "_ytd", "_ann", ""))
           for r in add_ranks_split(df, ["ss", "Month", "region"], ["ss", "Month"], ["region"], methods).collect()}
    assert got == want


@pytest.mark.parametrize("name, n", [("{i:05d}-{c}", 4000), ("Supplier number {i:06d}", 50_000)])
def test_a_hot_rank_group_spreads_over_tasks(spark, name, n):
    """One group, with ties whose names begin alike: ranks equal the window's, and ranges are even."""
    from jobtrend.operators.rank import add_ranks_split, placed

    rnd = random.Random(9)
    tied = 1 if n > 10_000 else 3
    rows = [("S", "01", name.format(i=i, c=rnd.choice("abc")), 0.0 if i % tied == 0 else rnd.gauss(0.02, 0.05)) for i in range(n)]
    rnd.shuffle(rows)
    base = spark.createDataFrame(rows, "ss string, Month string, region string, pct_change double")
    df = base.select("*", *[F.col("pct_change").alias(f"pct_change{s}") for s in ("_mom", "_ytd", "_ann")])
    methods = {"_mom": "average"}
    want = {r.region: (r["rank"], r.rank_mom) for r in add_ranks(df, ["ss", "Month"], ["region"], methods).collect()}
    split = add_ranks_split(df, ["ss", "Month", "region"], ["ss", "Month"], ["region"], methods)
    assert {r.region: (r["rank"], r.rank_mom) for r in split.collect()} == want
    places = placed(df, ["ss", "Month"], ["region"], ["_mom", "_ytd", "_ann", ""])
    sizes = [r["count"] for r in places.groupBy("_range").count().collect()]
    assert sum(sizes) == 4 * n and len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(sizes) < 2 * sum(sizes) / len(sizes)


def test_ranks_compute_their_rows_once(spark):
    """Counts and rows read one range exchange; growth is computed once."""
    import re

    from jobtrend.plans.catalog import regional_clean_df
    from jobtrend.plans.reports import area_report
    from jobtrend.sources.fixture import FIXTURE_PARAMS

    from tests.conftest import SF_SMALL

    for cohort in ("all", "over", "under"):
        df = area_report(regional_clean_df(spark, SF_SMALL), FIXTURE_PARAMS, cohort=cohort)
        df.collect()
        final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert len(re.findall(r"[+:]- Exchange rangepartitioning", final)) == 1
        assert len(re.findall(r"ReusedExchange \[_family", final)) >= 1
        assert len(re.findall(r"Window \[[^\n]*last\(value_mom", final)) == 1


def test_split_ranks_of_odd_rows(spark):
    """NULL keys are a group, NULL changes have no rank, an empty frame has no rows."""
    from jobtrend.operators.rank import add_ranks_split

    rows = [(None, "01", "a", 1.0), (None, "01", "b", 2.0), ("S", "01", "a", None), ("S", "01", "b", None), ("S", None, "a", 0.0), ("S", None, "b", -0.0)]
    base = spark.createDataFrame(rows, "ss string, Month string, region string, pct_change double")
    df = base.select("*", *[F.col("pct_change").alias(f"pct_change{s}") for s in ("_mom", "_ytd", "_ann")])
    for methods in ({}, {"_mom": "average", "": None}, dict.fromkeys(("_mom", "_ytd", "_ann", ""))):
        want = add_ranks(df, ["ss", "Month"], ["region"], methods)
        got = add_ranks_split(df, ["ss", "Month", "region"], ["ss", "Month"], ["region"], methods)
        assert got.columns == want.columns
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
        assert add_ranks_split(df.where("region > 'z'"), ["ss", "Month", "region"], ["ss", "Month"], ["region"], methods).collect() == []


def test_membership_counts_rows_with_a_null_key(spark):
    """An area that is large only through a row without a month is a member; that row is not summed."""
    from jobtrend.operators.aggregate import large_area_sums

    p = ReportParams(anchor_industry="Total Nonfarm", threshold=1000.0)
    rows = [
        ("A1", "S", "Total Nonfarm", "2015", None, 1500.0, "S"),
        ("A1", "S", "Mining", "2015", "01", 3.0, "S"),
        ("A2", "S", "Total Nonfarm", "2015", "01", 1000.0, "S"),
        ("Statewide", "S", "Total Nonfarm", "2015", "01", 5000.0, "S"),
        ("A3", "S", "Total Nonfarm", "2015", "01", 5000.0, "U"),
    ]
    df = spark.createDataFrame(
        rows, "area_name string, supersector_name string, industry_name string, year string, Month string, value double, seasonal string")
    keys = ["area_name", "supersector_name", "industry_name", "year", "Month"]
    got = [(r.area_name, r.industry_name, r.value, r.value_mom) for r in large_area_sums(df, keys, p).collect()]
    assert got == [("A1", "Mining", 3.0, 3.0)]


def test_national_data_type_filter(spark):
    """D8: without a code the national slice mixes data types; with one it keeps that type."""
    from jobtrend.operators.clean import clean_national, national_slice

    rows = [("S", "I", "M01", "2015", "1", "01", "U"), ("S", "I", "M01", "2015", "7", "06", "U")]
    df = clean_national(spark.createDataFrame(
        rows, "supersector_name string, industry_name string, period string, year string, value string, data_type_code string, seasonal string"))
    assert national_slice(df).count() == 2
    assert [r.value for r in national_slice(df, ReportParams(data_type_code="06")).collect()] == [7.0]


def test_sums_from_the_cube_equal_sums_of_rows(spark):
    from jobtrend.plans.catalog import regional_clean_df
    from jobtrend.plans.frames import area_sums_of, regional_cube, state_sums_of
    from jobtrend.plans.reports import area_sums, state_sums
    from jobtrend.sources.fixture import FIXTURE_PARAMS

    from tests.conftest import SF_SMALL

    clean = regional_clean_df(spark, SF_SMALL)
    cube = regional_cube(clean, FIXTURE_PARAMS)
    pairs = [(state_sums(clean, FIXTURE_PARAMS), state_sums_of(cube))]
    pairs += [(area_sums(clean, FIXTURE_PARAMS, c), area_sums_of(cube, FIXTURE_PARAMS, c)) for c in ("all", "over", "under")]
    for direct, derived in pairs:
        assert sorted(map(tuple, direct.collect()), key=str) == sorted(map(tuple, derived.select(*direct.columns).collect()), key=str)


def test_seasonal_slices_go_to_their_own_targets(spark):
    """sm_table_final_v2 is the unadjusted slice ("U"), sm_table_final_v3 the adjusted one ("S")."""
    from jobtrend.plans.catalog import regional_clean_df
    from jobtrend.plans.frames import regional_frames
    from jobtrend.sources.fixture import FIXTURE_PARAMS

    from tests.conftest import SF_SMALL

    frames = regional_frames(regional_clean_df(spark, SF_SMALL), FIXTURE_PARAMS)
    assert {r.seasonal for r in frames["sm_table_final_v2"].select("seasonal").distinct().collect()} == {"U"}
    assert {r.seasonal for r in frames["sm_table_final_v3"].select("seasonal").distinct().collect()} == {"S"}


def test_only_rows_that_pass_the_member_filter_are_exchanged(spark, monkeypatch):
    from jobtrend.operators import aggregate

    p = ReportParams(anchor_industry="Total Nonfarm", threshold=1000.0)
    rows = [(f"A{i}", "Total Nonfarm", 2000.0 if i % 50 == 0 else 5.0, "S") for i in range(2000)] + [(f"A{i}", "Mining", 1.0, s) for i in range(2000) for s in "SU"]
    rows += [(None, "Total Nonfarm", 9000.0, "S"), ("Statewide", "Total Nonfarm", 9000.0, "S")]
    df = spark.createDataFrame(rows, "area_name string, industry_name string, value double, seasonal string")
    want = sorted(r for r in rows if r[3] == "S" and r[0] and r[0] != "Statewide" and int(r[0][1:]) % 50 == 0)
    for bits in (1 << 20, 64):  # with few bits others pass the filter, and the join drops them
        monkeypatch.setattr(aggregate, "FILTER_BITS", bits)
        assert sorted(map(tuple, large_area_rows(df, p).collect())) == want
        members = aggregate.large_areas(df, p)
        passed = aggregate.may_be_members(df, aggregate.member_filter(members, "area_name"), "area_name").count()
        assert passed == 120 if bits > 64 else passed >= 120
    assert large_area_rows(df.where("value < 0"), p).collect() == []
    monkeypatch.setattr(aggregate, "FILTER_BITS", 1 << 20)
    lines = large_area_rows(df, p)._jdf.queryExecution().executedPlan().toString().splitlines()
    tested = next(i for i, x in enumerate(lines) if "getbit" in x)
    depth = lambda x: len(x) - len(x.lstrip(" :|+-"))
    below = [x for x in lines[tested + 1 :] if depth(x) <= depth(lines[tested]) + 6]
    # what passes is exchanged at most; the rows themselves come from their scan by the broadcast filter
    assert not any("Exchange hashpartitioning(area_name" in x for x in below[:3]), lines
