"""Registered queries against their DuckDB oracle, the entry smoke check, and
plan shapes."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from jobtrend.plans.catalog import ORACLE, QUERIES, regional_clean_df
from jobtrend.plans.reports import area_report, state_report
from jobtrend.sources.fixture import FIXTURE_PARAMS

from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    rel = duck.sql(ORACLE[name])
    assert sorted(cols) == sorted(rel.columns)
    assert _canon(cols, rows) == _canon(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "rank" in df.columns and "pct_change" in df.columns


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_state_report_plan_shape(spark):
    df = state_report(regional_clean_df(spark, SF_SMALL), FIXTURE_PARAMS)
    plan = _plan(df)
    # group keys, series key, rank key: three shuffles; no single-partition exchange
    assert plan.count("Exchange hashpartitioning") == 3, plan
    assert "SinglePartition" not in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
    # the statewide and excluded-state predicates reach the dimension scans
    lines = _unfolded(plan)
    for column, value in (("n_name", "NATION_22"), ("s_name", "Statewide")):
        at = next(i for i, x in enumerate(lines) if "FileScan" in x and column in x)
        above = next(x for x in reversed(lines[:at]) if "Filter" in x)
        assert value in above, lines[at - 4 : at + 1]


def _unfolded(plan: str) -> list[str]:
    return plan.replace("\r", " ").splitlines()


def _below(lines: list[str], at: int) -> list[str]:
    """The lines of the plan node at ``at`` and of all nodes below it."""
    def depth(x):
        return len(x) - len(x.lstrip(" :|+-"))
    end = at + 1
    while end < len(lines) and depth(lines[end]) > depth(lines[at]):
        end += 1
    return lines[at:end]


@pytest.mark.parametrize("cohort", ["all", "over", "under"])
def test_area_reports_start_no_job_while_built(spark, cohort):
    group = f"build-{cohort}"
    spark.sparkContext.setJobGroup(group, group)
    df = area_report(regional_clean_df(spark, SF_SMALL), FIXTURE_PARAMS, cohort)
    tracker = spark.sparkContext.statusTracker()
    assert not tracker.getJobIdsForGroup(group)
    assert df.count() > 0
    assert tracker.getJobIdsForGroup(group)


def test_over_cohort_moves_no_raw_rows_by_area(spark):
    from jobtrend.plans.reports import area_sums

    lines = _unfolded(_plan(area_sums(regional_clean_df(spark, SF_SMALL), FIXTURE_PARAMS, "over")))
    assert sum("lineitem.parquet" in x for x in lines) == 1
    for i, line in enumerate(lines):
        if "Exchange hashpartitioning(area_name" in line and "supersector_name" not in line:
            assert any("Aggregate" in x for x in lines[i + 1 : i + 4]), lines[i : i + 4]
    # Statewide rows leave on the supplier side, before any exchange
    assert any("supplier.parquet" in x for x in lines)
    assert any("Filter" in x and "Statewide" in x for x in lines), lines


@pytest.mark.parametrize("name", ["regional_fact", "national_fact"])
def test_observations_are_never_broadcast(spark, name):
    for sf in (SF_SMALL, "/root/testdata/sf0.1"):
        lines = _unfolded(_plan(QUERIES[name](spark, sf)))
        # the observation scan is the one that reads the value
        for i, line in enumerate(lines):
            if "BroadcastExchange" in line:
                assert not any("l_quantity" in x for x in _below(lines, i)), lines[i]


def test_table_scope_plan_has_no_single_task_window_over_rows(spark):
    params = FIXTURE_PARAMS.with_(scope="table", bucket_rows=200)
    df = state_report(regional_clean_df(spark, SF_SMALL), params)
    lines = _plan(df).splitlines()
    # single-partition windows exist only over per-partition counts and summaries of
    # runs of buckets: every such exchange reads an aggregate, never raw rows
    singles = [i for i, line in enumerate(lines) if "Exchange SinglePartition" in line]
    assert singles
    for i in singles:
        assert "HashAggregate" in lines[i + 1], lines[i : i + 2]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_hygiene(spark, name):
    """No Python UDF anywhere; a single-partition exchange only ever reads an
    aggregate (per-partition counts, per-bucket summaries, global maxima)."""
    df = QUERIES[name](spark, SF_SMALL)
    lines = _plan(df).splitlines()
    assert not any("PythonUDF" in line or "BatchEvalPython" in line or "ArrowEvalPython" in line for line in lines)
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "Aggregate" in lines[i + 1], (name, lines[i : i + 2])
