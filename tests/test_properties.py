"""Property tests: generated series (NULLs, zeros, gaps) against the pandas model."""

from __future__ import annotations

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from jobtrend.operators.growth import add_growth
from jobtrend.operators.table_scope import add_growth_table
from jobtrend.params import ReportParams

from tests import pandas_model as M
from tests.test_operators import MEASURES, SUMS_SCHEMA, rows_equal

value = st.one_of(st.none(), st.just(0.0), st.integers(min_value=1, max_value=500).map(float))
series = st.lists(st.tuples(value, value), min_size=1, max_size=40)


def to_rows(all_series):
    rows = []
    for s, points in enumerate(all_series):
        for i, (v, vm) in enumerate(points):
            rows.append((f"R{s % 2}", f"S{s}", str(2000 + i // 12), f"{i % 12 + 1:02d}", v, vm))
    return rows


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(series, min_size=1, max_size=4))
def test_series_scope_property(spark, all_series):
    rows = to_rows(all_series)
    df = spark.createDataFrame(rows, SUMS_SCHEMA)
    got = add_growth(df, ["region", "series"], ReportParams()).toPandas()
    want = M.series_growth(pd.DataFrame(rows, columns=df.columns), ["region", "series"])
    key = ["region", "series", "year", "Month"]
    got, want = got.sort_values(key).reset_index(drop=True), want.sort_values(key).reset_index(drop=True)
    for c in MEASURES:
        assert all(rows_equal(a, b, 1e-9) for a, b in zip(got[c], want[c])), c


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(series, min_size=1, max_size=4), st.integers(min_value=1, max_value=60))
def test_table_scope_property(spark, all_series, bucket):
    rows = to_rows(all_series)
    df = spark.createDataFrame(rows, SUMS_SCHEMA)
    order = ["region", "series", "year", "Month"]
    got = add_growth_table(df, order, ReportParams(scope="table"), bucket_rows=bucket).toPandas()
    want = M.table_growth(pd.DataFrame(rows, columns=df.columns), order)
    got = got.sort_values(order).reset_index(drop=True)
    for c in MEASURES:
        assert all(rows_equal(a, b, 1e-9) for a, b in zip(got[c], want[c])), c


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(min_value=1, max_value=900).map(float), min_size=25, max_size=45),
                min_size=2, max_size=4),
       st.integers(min_value=24, max_value=80))
def test_table_scope_equals_series_scope_deep_in_full_series(spark, lengths_values, bucket):
    """Without NULLs or gaps, a row 24 or more rows into its series only reads its
    own series, so both scopes agree there."""
    all_series = [[(v, v + 1.0) for v in vals] for vals in lengths_values]
    rows = to_rows(all_series)
    df = spark.createDataFrame(rows, SUMS_SCHEMA)
    key = ["region", "series", "year", "Month"]
    series_pd = add_growth(df, ["region", "series"], ReportParams()).toPandas().sort_values(key)
    table_pd = add_growth_table(df, key, ReportParams(scope="table"), bucket_rows=bucket).toPandas().sort_values(key)
    series_pd["depth"] = series_pd.groupby(["region", "series"]).cumcount()
    deep = series_pd["depth"].to_numpy() >= 24
    for c in MEASURES:
        a = series_pd[c].to_numpy()[deep]
        b = table_pd[c].to_numpy()[deep]
        assert all(rows_equal(x, y, 1e-9) for x, y in zip(a, b)), c


keys = st.sampled_from(["a", "b", "c", None])
fact_rows = st.lists(
    st.tuples(keys, st.sampled_from(["01", "02"]), st.one_of(st.none(), st.integers(0, 50).map(float)),
              st.sampled_from(["U", "S"])),
    min_size=0, max_size=40,
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(fact_rows, st.sampled_from(["left", "inner"]))
def test_fused_sums_equal_two_groupbys_and_a_merge(spark, rows, how):
    """The one-aggregate form equals the reference's form: sum each side by group
    (NULL keys dropped, all-NULL sums NULL), then merge the two on the keys."""
    from jobtrend.operators.aggregate import combined_sums
    from jobtrend.operators.clean import adjusted, unadjusted

    df = spark.createDataFrame(rows, "k string, Month string, value double, seasonal string")
    got = sorted(tuple(r) for r in combined_sums(df, ["k", "Month"], unadjusted(), adjusted(), how).collect())

    pdf = pd.DataFrame(rows, columns=["k", "Month", "value", "seasonal"]).dropna(subset=["k", "Month"])

    def side(code, name):
        part = pdf[pdf["seasonal"] == code]
        if part.empty:
            return pd.DataFrame(columns=["k", "Month", name])
        g = part.groupby(["k", "Month"])["value"].sum(min_count=1).rename(name).reset_index()
        return g

    merged = side("U", "value").merge(side("S", "value_mom"), on=["k", "Month"], how=how)
    want = sorted(
        (r.k, r.Month, None if pd.isna(r.value) else float(r.value),
         None if pd.isna(r.value_mom) else float(r.value_mom))
        for r in merged.itertuples()
    )
    assert got == want
