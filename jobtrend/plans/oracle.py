"""Oracle SQL (DuckDB dialect) for the registered queries.

The oracle restates each query the way the reference job computes it: the two
seasonal sides summed separately and then merged, windows and ranks written
out plainly. It runs on the test tables registered as views.
"""

from __future__ import annotations

from collections.abc import Sequence

from jobtrend.sources.fixture import (
    FIXTURE_ANCHOR_INDUSTRY,
    FIXTURE_EXCLUDED_STATES,
    FIXTURE_THRESHOLD,
)

PERIOD_SQL = (
    "case when l_linenumber = 7 then 'M13' "
    "else 'M' || lpad(cast(month(l_shipdate) as varchar), 2, '0') end"
)
YEAR_SQL = "cast(year(l_shipdate) as varchar)"
SEASONAL_SQL = "case when l_linestatus = 'O' then 'U' else 'S' end"
AREA_SQL = (
    "case s_suppkey % 10 when 0 then 'Statewide' when 1 then 'Statewide' "
    "when 2 then 'Statewide' when 3 then 'Statewide' "
    "when 4 then s_name || ' Metropolitan Division' "
    "when 5 then s_name || ' NECTA Division' "
    "when 6 then s_name || ' Metropolitan NECTA' "
    "else s_name || ' Metropolitan Statistical Area' end"
)

REGIONAL_RAW = f"""
select {AREA_SQL} as area_name, n_name as state_name, l_returnflag as supersector_name,
       p_brand as industry_name, {PERIOD_SQL} as period, {YEAR_SQL} as year,
       l_quantity as value, '01' as data_type_code, {SEASONAL_SQL} as seasonal
from lineitem join supplier on l_suppkey = s_suppkey
     join nation on s_nationkey = n_nationkey join part on l_partkey = p_partkey
"""

NATIONAL_RAW = f"""
select l_returnflag as supersector_name, p_brand as industry_name, {PERIOD_SQL} as period,
       {YEAR_SQL} as year, l_quantity as value, '01' as data_type_code, {SEASONAL_SQL} as seasonal
from lineitem join part on l_partkey = p_partkey
"""

REGIONAL_CLEAN = """
select replace(replace(area_name, ' NECTA', ''), 'Metropolitan Statistical Area', '') as area_name,
       replace(state_name, chr(13), '') as state_name,
       replace(supersector_name, chr(13), '') as supersector_name,
       industry_name, cast(period as varchar) as period, cast(year as varchar) as year,
       case when isnan(try_cast(value as double)) then null else try_cast(value as double) end as value,
       case when length(data_type_code) < 2 then lpad(data_type_code, 2, '0') else data_type_code end
         as data_type_code,
       seasonal
from regional_raw
where not coalesce(contains(area_name, 'Metropolitan Division'), false)
  and not coalesce(contains(area_name, 'NECTA Division'), false)
"""

NATIONAL_CLEAN = """
select supersector_name, industry_name, period, year,
       case when isnan(try_cast(value as double)) then null else try_cast(value as double) end as value,
       data_type_code, seasonal
from national_raw
"""

_EXCLUDED = ", ".join(f"'{s}'" for s in FIXTURE_EXCLUDED_STATES)

REGIONAL_SLICE = f"""
select area_name, state_name, supersector_name, industry_name, replace(period, 'M', '') as Month,
       year, value, data_type_code, seasonal
from regional_clean
where data_type_code = '01' and not coalesce(state_name in ({_EXCLUDED}), false)
  and period is distinct from 'M13' and seasonal in ('U', 'S')
"""

NATIONAL_SLICE = """
select supersector_name, industry_name, replace(period, 'M', '') as Month, year, value,
       data_type_code, seasonal
from national_clean
where period is distinct from 'M13' and seasonal in ('U', 'S')
"""

BASE_CTES = {
    "regional_raw": REGIONAL_RAW,
    "regional_clean": REGIONAL_CLEAN,
    "regional_slice": REGIONAL_SLICE,
    "national_raw": NATIONAL_RAW,
    "national_clean": NATIONAL_CLEAN,
    "national_slice": NATIONAL_SLICE,
}
_CTE_DEPS = {
    "regional_raw": [],
    "regional_clean": ["regional_raw"],
    "regional_slice": ["regional_clean"],
    "national_raw": [],
    "national_clean": ["national_raw"],
    "national_slice": ["national_clean"],
}


def with_ctes(ctes: Sequence[tuple[str, str]], final: str) -> str:
    """``with a as (...), b as (...) <final>``, adding the base CTEs named."""
    needed: list[str] = []

    def need(name):
        for dep in _CTE_DEPS.get(name, []):
            need(dep)
        if name in BASE_CTES and name not in needed:
            needed.append(name)

    text = final + " ".join(body for _, body in ctes)
    for name in BASE_CTES:
        if name in text:
            need(name)
    parts = [f"{n} as ({BASE_CTES[n]})" for n in needed] + [f"{n} as ({body})" for n, body in ctes]
    return "with " + ",\n".join(parts) + "\n" + final


def _nn(keys: Sequence[str]) -> str:
    return " and ".join(f"{k} is not null" for k in keys)


def sums_sql(source: str, keys: Sequence[str], left_where: str, right_where: str | None, how: str) -> list:
    """Two group-by sums and their merge, as the reference does it."""
    k = ", ".join(keys)
    left = f"select {k}, sum(value) as value from {source} where {_nn(keys)} and ({left_where}) group by {k}"
    if right_where is None:
        return [("sums", f"select {k}, value, value as value_mom from ({left}) l")]
    right = (
        f"select {k}, sum(value) as value_mom from {source} where {_nn(keys)} and ({right_where}) "
        f"group by {k}"
    )
    join = "left join" if how == "left" else "join"
    return [
        ("side_u", left),
        ("side_s", right),
        ("sums", f"select side_u.*, side_s.value_mom from side_u {join} side_s using ({k})"),
    ]


CHANGE_FAMILIES = [("_mom", "value_mom", 1), ("_ytd", "value_ytd_avg", 12), ("_ann", "value_ann_avg", 12), ("", "value", 12)]


def _calendar_changes_sql(series: Sequence[str], families) -> str:
    """Changes against the row exactly k months back, found by a join on the month number."""
    number = "cast({0}.year as integer) * 12 + cast({0}.Month as integer)"
    cols, joins = [], []
    for lag in sorted({k for _, _, k in families}):
        on = " and ".join(f"b{lag}.{c} = m.{c}" for c in series)
        joins.append(f"left join means b{lag} on {on} and {number.format(f'b{lag}')} = {number.format('m')} - {lag}")
    for suf, x, lag in families:
        pct = f"(m.{x} / nullif(b{lag}.{x}, 0) - 1)"
        cols.append(f"{pct} as pct_change{suf}, b{lag}.{x} * {pct} as abs_growth{suf}")
    return f"select m.*, {', '.join(cols)} from means m {' '.join(joins)}"


def growth_sql(
    source: str,
    series: Sequence[str],
    ytd_months: int = 5,
    ytd_mode: str = "trailing",
    calendar: bool = False,
    table_order: Sequence[str] | None = None,
) -> list:
    """Rolling means, then changes and growth of the four families.

    ``table_order`` given: windows run down the whole table in that order
    (table scope) instead of inside each series.
    """
    if table_order is not None:
        part, order = "", "order by " + ", ".join(table_order)
        ytd_part = ""
    else:
        part = "partition by " + ", ".join(series)
        order = "order by year, Month"
        ytd_part = part + ", year"
    if calendar:
        mi = "(cast(year as integer) * 12 + cast(Month as integer) - 1)"
        order = f"order by {mi}"

        def trailing(n):
            return f"({part} {order} range between {n - 1} preceding and current row)"

    else:

        def trailing(n):
            return f"({part} {order} rows between {n - 1} preceding and current row)"

        def upto(kk):
            return f"({part} {order} rows between unbounded preceding and {kk} preceding)"

        def lag(x, kk):
            return f"lag({x}, {kk}) over ({part} {order})"

    if ytd_mode == "calendar":
        yw = f"({ytd_part} order by Month rows between unbounded preceding and current row)"
        ytd = f"case when count(value) over {yw} = cast(Month as integer) then avg(value) over {yw} end"
    else:
        ytd = (
            f"case when count(value) over {trailing(ytd_months)} = {ytd_months} "
            f"then avg(value) over {trailing(ytd_months)} end"
        )
    ann = f"case when count(value) over {trailing(12)} = 12 then avg(value) over {trailing(12)} end"
    means = f"select *, {ytd} as value_ytd_avg, {ann} as value_ann_avg from {source}"

    fams = CHANGE_FAMILIES
    if calendar:
        return [("means", means), ("grown", _calendar_changes_sql(series, fams))]
    cols = []
    for suf, x, kk in fams:
        base = f"last_value({x} ignore nulls) over {upto(kk)}"
        pct = f"(case when {x} is not null then {x} / nullif({base}, 0) - 1 end)"
        cols.append(f"{pct} as pct_change{suf}")
        cols.append(f"{lag(x, kk)} * {pct} as abs_growth{suf}")
    changes = "select *, " + ", ".join(cols) + " from means"
    return [("means", means), ("grown", changes)]


RANK_KEYS = "supersector_name, industry_name, year, Month"


def rank_sql(source: str, tie: str | None, methods: dict, rank_keys: str = RANK_KEYS) -> list:
    cols = []
    for suf in ("_mom", "_ytd", "_ann", ""):
        m = methods.get(suf, "first")
        p = f"pct_change{suf}"
        if m is None:
            cols.append(f"cast(null as double) as rank{suf}")
        elif m == "first":
            cols.append(
                f"case when {p} is not null then cast(row_number() over "
                f"(partition by {rank_keys} order by {p} desc nulls last, {tie}) as double) end as rank{suf}"
            )
        else:
            cols.append(
                f"case when {p} is not null then cast(rank() over (partition by {rank_keys} "
                f"order by {p} desc nulls last) as double) + "
                f"(cast(count(*) over (partition by {rank_keys}, {p}) as double) - 1) / 2 end as rank{suf}"
            )
    return [("ranked", f"select *, {', '.join(cols)} from {source}")]


MEASURES = (
    "value, value_mom, value_ytd_avg, value_ann_avg, "
    + ", ".join(
        f"round_even((pct_change{s} * 100) * 100, 0) / 100 as pct_change{s}, rank{s}, "
        f"round_even(abs_growth{s} * 100, 0) / 100 as abs_growth{s}"
        for s in ("_mom", "_ytd", "_ann", "")
    )
)

FIRST = {"": "first", "_mom": "first", "_ytd": "first", "_ann": "first"}
COHORT = {"": "first", "_mom": "average", "_ytd": "first", "_ann": "first"}
NONE = {"": None, "_mom": None, "_ytd": None, "_ann": None}


def report_sql(
    source: str,
    region: Sequence[str],
    left_where: str,
    right_where: str | None,
    how: str,
    methods: dict,
    extra: str = "",
    tail: Sequence[str] = ("supersector_name", "industry_name"),
    columns: str = MEASURES,
    **growth_kw,
) -> str:
    series = [*region, *tail]
    keys = [*series, "year", "Month"]
    ctes = sums_sql(source, keys, left_where, right_where, how)
    if growth_kw.pop("table_scope", False):
        growth_kw["table_order"] = keys
    ctes += growth_sql("sums", series, **growth_kw)
    ctes += rank_sql("grown", region[0] if region else None, methods, ", ".join([*tail, "year", "Month"]))
    final = f"select {', '.join(keys)}, {columns}{extra} from ranked"
    return with_ctes(ctes, final)


def state_report_sql(**kw) -> str:
    return report_sql(
        "regional_slice",
        ["state_name"],
        "area_name = 'Statewide' and seasonal = 'U'",
        "area_name = 'Statewide' and seasonal = 'S'",
        "left",
        FIRST,
        **kw,
    )


def national_report_sql(**kw) -> str:
    return report_sql(
        "national_slice",
        [],
        "seasonal = 'U'",
        "seasonal = 'S'",
        "inner",
        NONE,
        extra=", 'United States' as area_name, 'United States' as state_name",
        **kw,
    )


SUBSTATE = "area_name is distinct from 'Statewide'"
LARGE_AREAS = (
    f"select distinct area_name from regional_slice where seasonal = 'S' and {SUBSTATE} "
    f"and industry_name = '{FIXTURE_ANCHOR_INDUSTRY}' and value > {FIXTURE_THRESHOLD}"
)
SMALL_ROWS = (
    f"{SUBSTATE} and industry_name = '{FIXTURE_ANCHOR_INDUSTRY}' and value < {FIXTURE_THRESHOLD}"
)


def area_report_sql(cohort: str = "all", **kw) -> str:
    if cohort == "all":
        return report_sql(
            "regional_slice", ["area_name"], f"{SUBSTATE} and seasonal = 'U'",
            f"{SUBSTATE} and seasonal = 'S'", "left", FIRST, **kw,
        )
    if cohort == "over":
        return report_sql(
            "regional_slice", ["area_name"],
            f"seasonal = 'S' and area_name in ({LARGE_AREAS})", None, "left", COHORT, **kw,
        )
    return report_sql(
        "regional_slice", ["area_name"], f"seasonal = 'U' and {SMALL_ROWS}",
        f"seasonal = 'S' and {SMALL_ROWS}", "left", COHORT, **kw,
    )


STRIP_CHARS = "' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12)"


def strip_sql(x: str) -> str:
    return f"trim({x}, {STRIP_CHARS})"


def zfill_sql(x: str, width: int) -> str:
    s = f"cast({x} as varchar)"
    return f"case when length({s}) < {width} then lpad({s}, {width}, '0') else {s} end"


def measure_sql(name: str) -> str:
    """One report measure as the final select writes it (rounded where rounded)."""
    if name.startswith("pct_change"):
        return f"round_even(({name} * 100) * 100, 0) / 100 as {name}"
    if name.startswith("abs_growth"):
        return f"round_even({name} * 100, 0) / 100 as {name}"
    return name


STATE_U = "area_name = 'Statewide' and seasonal = 'U'"
STATE_S = "area_name = 'Statewide' and seasonal = 'S'"
DENSE_TAIL = ("supersector_name",)


def dense_state_sql(measures: Sequence[str], methods: dict = FIRST, **kw) -> str:
    """Growth at the dense grain (state, supersector, year, Month)."""
    cols = ", ".join(measure_sql(m) for m in measures)
    return report_sql(
        "regional_slice", ["state_name"], STATE_U, STATE_S, "left", methods,
        tail=DENSE_TAIL, columns=cols, **kw,
    )
