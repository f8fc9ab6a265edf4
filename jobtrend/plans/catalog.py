"""Registered queries: name -> (spark, sf_dir) -> DataFrame, and their oracle SQL.

Every query reads the generated test tables (through the fixture mapping) and
runs over all of their rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobtrend.functions import area_parts, month_digits, percent, round2, strip_ws, to_double, zfill
from jobtrend.operators.aggregate import combined_sums, large_area_rows, large_areas
from jobtrend.operators.clean import (
    adjusted,
    clean_national,
    clean_regional,
    national_slice,
    regional_slice,
    statewide,
    unadjusted,
)
from jobtrend.operators.growth import measure_columns
from jobtrend.params import STATEWIDE
from jobtrend.plans import oracle as O
from jobtrend.session import shared_folder
from jobtrend.plans.facts import (
    national_fact,
    national_fact_from_files,
    regional_fact,
    regional_fact_from_files,
)
from jobtrend.plans.frames import national_frames, regional_frames
from jobtrend.plans.reports import (
    COHORT_RANKS,
    FIRST_RANKS,
    area_report,
    area_sums,
    growth_report,
    national_report,
    national_sums,
    state_report,
    state_sums,
)
from jobtrend.sources.codes import latest_month
from jobtrend.sources.fixture import (
    FIXTURE_PARAMS,
    national_code_tables,
    national_observations,
    national_raw,
    regional_code_tables,
    regional_observations,
    regional_raw,
    table,
)
from jobtrend.sources.sinks import write_csv, write_report
from jobtrend.sources.tsv import (
    NATIONAL_STRIPPED,
    append_frames,
    read_observations,
    strip_columns,
    write_observations,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def regional_clean_df(spark: SparkSession, sf_dir: str, params=FIXTURE_PARAMS) -> DataFrame:
    return clean_regional(regional_raw(spark, sf_dir), params)


def national_clean_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_national(national_raw(spark, sf_dir))


# --- reports -------------------------------------------------------------------


@register("state_report", O.state_report_sql())
def q_state_report(spark, sf_dir):
    return state_report(regional_clean_df(spark, sf_dir), FIXTURE_PARAMS)


@register("national_report", O.national_report_sql())
def q_national_report(spark, sf_dir):
    return national_report(national_clean_df(spark, sf_dir), FIXTURE_PARAMS)


@register("area_report", O.area_report_sql("all"))
def q_area_report(spark, sf_dir):
    return area_report(regional_clean_df(spark, sf_dir), FIXTURE_PARAMS, cohort="all")


@register("area_over_report", O.area_report_sql("over"))
def q_area_over_report(spark, sf_dir):
    return area_report(regional_clean_df(spark, sf_dir), FIXTURE_PARAMS, cohort="over")


@register("area_under_report", O.area_report_sql("under"))
def q_area_under_report(spark, sf_dir):
    return area_report(regional_clean_df(spark, sf_dir), FIXTURE_PARAMS, cohort="under")


# --- facts, cleaning and slices ----------------------------------------------------


@register("regional_clean", O.with_ctes([], "select *, replace(period, 'M', '') as Month from regional_clean"))
def q_regional_clean(spark, sf_dir):
    """FLT1, STR3, STR6, CST1, CST2, PRJ1, plus PRJ4 / STR5 on the period."""
    clean = regional_clean_df(spark, sf_dir)
    return clean.withColumn("Month", month_digits("period"))


@register("regional_slices", O.with_ctes([], "select * from regional_slice"))
def q_regional_slices(spark, sf_dir):
    """FLT2 + FLT3 (both seasonal sides in one pass), PRJ4, STR5."""
    return regional_slice(regional_clean_df(spark, sf_dir), FIXTURE_PARAMS)


@register("national_slices", O.with_ctes([], "select * from national_slice"))
def q_national_slices(spark, sf_dir):
    """FLT4, PRJ2."""
    return national_slice(national_clean_df(spark, sf_dir), FIXTURE_PARAMS)


@register("regional_fact", O.with_ctes([], "select * from regional_clean"))
def q_regional_fact(spark, sf_dir):
    """RPT1: observation rows joined to five code tables (JON1), cleaned."""
    return regional_fact(
        regional_observations(spark, sf_dir), regional_code_tables(spark, sf_dir), FIXTURE_PARAMS
    )


@register("national_fact", O.with_ctes([], "select * from national_clean"))
def q_national_fact(spark, sf_dir):
    """RPT2: observation rows joined to three code tables (JON2)."""
    return national_fact(national_observations(spark, sf_dir), national_code_tables(spark, sf_dir))


def _national_file_sql(where: str) -> str:
    sid = (
        "rpad(concat_ws('_', 'CE', " + O.SEASONAL_SQL + ", cast(l_partkey as varchar), l_returnflag), 30, ' ')"
    )
    return (
        f"select {O.strip_sql(sid)} as series_id, {O.strip_sql(chr(39) + ' ' + chr(39) + ' || ' + O.YEAR_SQL)} as year, "
        f"{O.PERIOD_SQL} as period, lpad(cast(l_quantity as varchar), 12, ' ') as value, "
        f"{O.strip_sql(chr(39) * 2)} as footnote_codes from lineitem where {where}"
    )


@register(
    "append_files",
    " union all ".join(
        _national_file_sql(w)
        for w in ("l_returnflag = 'A'", "l_returnflag = 'N'", "l_returnflag not in ('A', 'N') or l_returnflag is null")
    ),
)
def q_append_files(spark, sf_dir):
    """SRC2 + SET1: national observation files (one per supersector group) appended
    as a bag, with the national strip rule (the value keeps its padding)."""
    li = table(spark, sf_dir, "lineitem")
    flag = F.col("l_returnflag")
    files = []
    for cond in (flag == "A", flag == "N", ~flag.isin("A", "N") | flag.isNull()):
        files.append(national_observations(spark, sf_dir, lineitem=li.where(cond)))
    return strip_columns(append_frames(files), NATIONAL_STRIPPED)


# --- scalar functions ------------------------------------------------------------


@register(
    "code_padding",
    f"select p_partkey, {O.zfill_sql('p_partkey', 8)} as industry_code, "
    f"{O.zfill_sql('p_partkey', 5)} as area_code, {O.zfill_sql('p_partkey', 3)} as short_code, "
    f"{O.zfill_sql('p_size', 2)} as size_code from part",
)
def q_code_padding(spark, sf_dir):
    """STR2 + CST1: numbers to zero-padded text; longer codes are never cut."""
    part = table(spark, sf_dir, "part")
    return part.select(
        "p_partkey",
        zfill("p_partkey", 8).alias("industry_code"),
        zfill("p_partkey", 5).alias("area_code"),
        zfill("p_partkey", 3).alias("short_code"),
        zfill("p_size", 2).alias("size_code"),
    )


# Text that is no plain decimal, though a cast may take some of it for a number.
ODD_TEXTS = ("1d", "12f", "0x1p3", "Infinity", "-inf", "1e999", "1_000")
_VALUE_TEXT_SQL = (
    "case l_linenumber when 3 then '-' when 4 then '' when 5 then ' ' || cast(l_quantity as varchar) || ' ' "
    "when 6 then 'NaN' when 7 then case cast(l_orderkey % "
    + str(len(ODD_TEXTS)) + " as integer) "
    + " ".join(f"when {i} then '{t}'" for i, t in enumerate(ODD_TEXTS))
    + " end else cast(l_quantity as varchar) end"
)
_DECIMAL_SQL = "regexp_full_match(trim(value_text), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?')"


@register(
    "numeric_coercion",
    f"select l_orderkey, l_linenumber, value_text, "
    f"case when {_DECIMAL_SQL} and not isinf(try_cast(value_text as double)) then try_cast(value_text as double) end as value "
    f"from (select l_orderkey, l_linenumber, {_VALUE_TEXT_SQL} as value_text from lineitem) t",
)
def q_numeric_coercion(spark, sf_dir):
    """CST2 + NUL1: text values to double; '-', blanks, NaN and text that is no plain
    decimal become NULL."""
    li = table(spark, sf_dir, "lineitem")
    q = F.col("l_quantity").cast("string")
    odd = F.element_at(F.array(*map(F.lit, ODD_TEXTS)), (F.col("l_orderkey") % len(ODD_TEXTS) + 1).cast("int"))
    text = (
        F.when(F.col("l_linenumber") == 3, F.lit("-"))
        .when(F.col("l_linenumber") == 4, F.lit(""))
        .when(F.col("l_linenumber") == 5, F.concat(F.lit(" "), q, F.lit(" ")))
        .when(F.col("l_linenumber") == 6, F.lit("NaN"))
        .when(F.col("l_linenumber") == 7, odd)
        .otherwise(q)
    )
    return li.select("l_orderkey", "l_linenumber", text.alias("value_text")).select(
        "l_orderkey", "l_linenumber", "value_text", to_double("value_text").alias("value")
    )


_RAW_NAME_SQL = "chr(9) || ' ' || p_name || ' ' || chr(13) || chr(10)"


@register(
    "strip_text",
    f"select p_partkey, {_RAW_NAME_SQL} as raw_text, {O.strip_sql(_RAW_NAME_SQL)} as stripped from part",
)
def q_strip_text(spark, sf_dir):
    """STR1: leading and trailing blanks, tabs, CR and LF removed; inner ones kept."""
    part = table(spark, sf_dir, "part")
    raw = F.concat(F.lit("\t "), F.col("p_name"), F.lit(" \r\n"))
    return part.select("p_partkey", raw.alias("raw_text")).select(
        "p_partkey", "raw_text", strip_ws("raw_text").alias("stripped")
    )


@register(
    "round_two",
    "select l_orderkey, l_linenumber, "
    "round_even(((l_extendedprice / (l_quantity * 1000.0::double) - 1) * 100) * 100, 0) / 100 as pct_change, "
    "round_even((l_extendedprice * l_discount - l_tax * 1000.0::double) * 100, 0) / 100 as abs_growth "
    "from lineitem",
)
def q_round_two(spark, sf_dir):
    """MTH1 + MTH2: ratio to percent with two decimals; growth to two decimals
    (half to even, as the reference's rounding)."""
    li = table(spark, sf_dir, "lineitem")
    ratio = F.col("l_extendedprice") / (F.col("l_quantity") * F.lit(1000.0)) - F.lit(1.0)
    growth = F.col("l_extendedprice") * F.col("l_discount") - F.col("l_tax") * F.lit(1000.0)
    return li.select(
        "l_orderkey", "l_linenumber", percent(ratio).alias("pct_change"), round2(growth).alias("abs_growth")
    )


@register(
    "latest_month",
    O.with_ctes(
        [],
        "select year, cast(max(Month) as integer) as month from regional_slice "
        "where year = (select max(year) from regional_slice) group by year",
    ),
)
def q_latest_month(spark, sf_dir):
    """SRC5: the reporting month, derived from the data as a one-row aggregate."""
    return latest_month(regional_slice(regional_clean_df(spark, sf_dir), FIXTURE_PARAMS))


_LABEL_SQL = "case when area_name = 'Statewide' then area_name else area_name || ', ' || state_name end"


@register(
    "split_area_name",
    O.with_ctes(
        [("labels", f"select distinct {_LABEL_SQL} as area_label from regional_clean")],
        "select area_label, "
        "case when area_label = 'Statewide' then 'Statewide' else string_split(area_label, ', ')[1] end as area_part, "
        "case when area_label = 'Statewide' then 'Statewide' else string_split(area_label, ', ')[2] end as state_part "
        "from labels",
    ),
)
def q_split_area_name(spark, sf_dir):
    """STR7: published-style area labels ("area, state") split into their parts."""
    clean = regional_clean_df(spark, sf_dir)
    label = F.when(F.col("area_name") == STATEWIDE, F.col("area_name")).otherwise(
        F.concat(F.col("area_name"), F.lit(", "), F.col("state_name"))
    )
    labels = clean.select(label.alias("area_label")).distinct()
    area_part, state_part = area_parts("area_label", STATEWIDE)
    return labels.select("area_label", area_part.alias("area_part"), state_part.alias("state_part"))


# --- sums ------------------------------------------------------------------------------


@register(
    "sum_national",
    O.with_ctes(
        O.sums_sql("national_slice", ["supersector_name", "industry_name", "year", "Month"],
                   "seasonal = 'U'", "seasonal = 'S'", "inner"),
        "select * from sums",
    ),
)
def q_sum_national(spark, sf_dir):
    """AGG1 + JON3."""
    return national_sums(national_clean_df(spark, sf_dir), FIXTURE_PARAMS)


@register(
    "sum_state",
    O.with_ctes(
        O.sums_sql("regional_slice", ["state_name", "supersector_name", "industry_name", "year", "Month"],
                   O.STATE_U, O.STATE_S, "left"),
        "select * from sums",
    ),
)
def q_sum_state(spark, sf_dir):
    """FLT5 + AGG2 + JON4."""
    return state_sums(regional_clean_df(spark, sf_dir), FIXTURE_PARAMS)


@register(
    "sum_area",
    O.with_ctes(
        O.sums_sql("regional_slice", ["area_name", "supersector_name", "industry_name", "year", "Month"],
                   f"{O.SUBSTATE} and seasonal = 'U'", f"{O.SUBSTATE} and seasonal = 'S'", "left"),
        "select * from sums",
    ),
)
def q_sum_area(spark, sf_dir):
    """FLT6 + AGG3 + JON5."""
    return area_sums(regional_clean_df(spark, sf_dir), FIXTURE_PARAMS, "all")


@register("distinct_areas", O.with_ctes([], O.LARGE_AREAS))
def q_distinct_areas(spark, sf_dir):
    """FLT7 + AGG6: areas above the threshold in the anchor industry."""
    return large_areas(regional_slice(regional_clean_df(spark, sf_dir), FIXTURE_PARAMS), FIXTURE_PARAMS)


@register(
    "large_area_members",
    O.with_ctes([], f"select * from regional_slice where seasonal = 'S' and area_name in ({O.LARGE_AREAS})"),
)
def q_large_area_members(spark, sf_dir):
    """FLT9 + JON8: all adjusted rows of those areas (semi join, nothing collected)."""
    return large_area_rows(regional_slice(regional_clean_df(spark, sf_dir), FIXTURE_PARAMS), FIXTURE_PARAMS)


# --- window operators at the dense grain (state, supersector, year, Month) -------------

DENSE_KEYS = ["state_name", "supersector_name", "year", "Month"]


def dense_state_growth(spark, sf_dir, params=FIXTURE_PARAMS, methods=FIRST_RANKS) -> DataFrame:
    """State growth at the dense grain: the same operators as the state report
    with the industry left out of the keys, so most series are long."""
    sl = statewide(regional_slice(regional_clean_df(spark, sf_dir), params))
    sums = combined_sums(sl, DENSE_KEYS, unadjusted(), adjusted(), how="left")
    return growth_report(sums, ["state_name"], params, methods, series_tail=("supersector_name",))


def _dense_query(name: str, measures, methods=FIRST_RANKS, doc: str = "", **params_kw):
    oracle_methods = O.COHORT if methods is COHORT_RANKS else O.FIRST
    register(name, O.dense_state_sql(measures, oracle_methods, **params_kw))(
        _make_dense(measures, methods, doc, **params_kw)
    )


def _make_dense(measures, methods, doc, **params_kw):
    def q(spark, sf_dir):
        params = FIXTURE_PARAMS.with_(**params_kw) if params_kw else FIXTURE_PARAMS
        return dense_state_growth(spark, sf_dir, params, methods).select(*DENSE_KEYS, *measures)

    q.__doc__ = doc
    return q


_dense_query("rolling_ytd", ["value", "value_ytd_avg"], doc="WIN1: trailing 5-row mean.")
_dense_query("rolling_annual", ["value", "value_ann_avg"], doc="WIN2: trailing 12-row mean.")
_dense_query("pct_change_12", ["value", "pct_change"], doc="WIN3: 12-row change, forward-filled base.")
_dense_query("pct_change_1", ["value_mom", "pct_change_mom"], doc="WIN4: 1-row change of value_mom.")
_dense_query("abs_growth_12", ["value", "abs_growth"], doc="WIN5: 12-row shift times change.")
_dense_query("abs_growth_1", ["value_mom", "abs_growth_mom"], doc="WIN6: 1-row shift times change.")
_dense_query("rank_first", ["pct_change", "rank", "pct_change_ann", "rank_ann"], doc="WIN8.")
_dense_query("rank_average", ["pct_change_mom", "rank_mom"], COHORT_RANKS, doc="WIN9.")
_dense_query("calendar_lag", measure_columns(), doc="D2: lags and means counted in calendar months.",
             calendar=True)
_dense_query("calendar_ytd", ["value", "value_ytd_avg", "pct_change_ytd", "rank_ytd", "abs_growth_ytd"],
             doc="D7: year-to-date mean over the months of the same year.", ytd_mode="calendar")


# --- table scope (the reference's windows down the whole sorted table) ----------------

TABLE_SCOPE_PARAMS = FIXTURE_PARAMS.with_(scope="table")


@register("table_scope_state", O.state_report_sql(table_scope=True))
def q_table_scope_state(spark, sf_dir):
    """WIN7 + D1 literal: the state report with windows crossing series."""
    return state_report(regional_clean_df(spark, sf_dir), TABLE_SCOPE_PARAMS)


@register("table_scope_national", O.national_report_sql(table_scope=True))
def q_table_scope_national(spark, sf_dir):
    """WIN7 + D1 literal: the national report with windows crossing series."""
    return national_report(national_clean_df(spark, sf_dir), TABLE_SCOPE_PARAMS)


# --- round trips through files in the shared folder ------------------------------------


_SM_ID_SQL = (
    "rpad(concat_ws('_', 'SM', " + O.SEASONAL_SQL + ", cast(l_suppkey as varchar), "
    "cast(l_partkey as varchar), l_returnflag), 30, ' ')"
)


@register(
    "tsv_scan",
    f"select {O.strip_sql(_SM_ID_SQL)} as series_id, {O.YEAR_SQL} as year, {O.PERIOD_SQL} as period, "
    f"cast(l_quantity as varchar) as value, cast(null as varchar) as footnote_codes from lineitem",
)
def q_tsv_scan(spark, sf_dir):
    """SRC1: observations written as a tab-separated file with padded fields,
    read back with the given schema and the regional strip rule. An empty field
    reads as NULL (missing), as a table reader reads it."""
    path = shared_folder(spark, "sm-observations")
    write_observations(regional_observations(spark, sf_dir), path)
    return read_observations(spark, path)


_STATE_KEYS = "state_name, supersector_name, industry_name, year, Month"


@register(
    "write_report",
    f"select *, row_number() over (order by {_STATE_KEYS}) - 1 as index from ({O.state_report_sql()}) r",
)
def q_write_report(spark, sf_dir):
    """SNK1: the state report replaces a table (parquet here), written with its
    table-order index like the reference's table writes, then read back."""
    path = shared_folder(spark, "state_rankings_t")
    report = state_report(regional_clean_df(spark, sf_dir), FIXTURE_PARAMS)
    write_report(report, path, fmt="parquet", with_index=_STATE_KEYS.split(", "))
    return spark.read.parquet(path)


@register(
    "sorted_report",
    f"select *, row_number() over (order by {_STATE_KEYS}) - 1 as position from ({O.state_report_sql()}) r",
)
def q_sorted_report(spark, sf_dir):
    """ORD1: the state report written in key order; ``position`` is where a row stands in
    the files taken in order (part number, then row of the part)."""
    path = shared_folder(spark, "sorted_report")
    write_report(state_report(regional_clean_df(spark, sf_dir), FIXTURE_PARAMS), path, sort_by=_STATE_KEYS.split(", "))
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    rows = spark.read.parquet(path).select("*", name.alias("_file"), F.col("_metadata.row_index").alias("_row"))
    # one row a file
    earlier = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = rows.groupBy("_file").count()
    before = sizes.select("_file", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("_before"))
    joined = rows.join(before, "_file").withColumn("position", F.col("_before") + F.col("_row"))
    return joined.drop("_file", "_row", "_before")


@register("write_csv", f"select * from ({O.national_report_sql()}) r")
def q_write_csv(spark, sf_dir):
    """SNK3: the national report as CSV, read back with the report's types; its ranks are
    empty fields (NULL)."""
    path = shared_folder(spark, "national_csv")
    report = national_report(national_clean_df(spark, sf_dir), FIXTURE_PARAMS)
    write_csv(report, path)
    return spark.read.schema(report.schema).option("header", True).csv(path)


def _supersector_files(spark, sf_dir, observations, name):
    """Observation files, one for each supersector group, as the published data comes."""
    li = table(spark, sf_dir, "lineitem")
    flag = F.col("l_returnflag")
    paths = []
    for k, cond in enumerate((flag == "A", flag == "N", ~flag.isin("A", "N") | flag.isNull())):
        path = shared_folder(spark, f"{name}-{k}")
        write_observations(observations(spark, sf_dir, lineitem=li.where(cond)), path)
        paths.append(path)
    return paths


_NATIONAL_ROWS = _national_file_sql("true")


@register(
    "national_tsv_scan",
    f"select * replace (cast(null as varchar) as footnote_codes) from ({_NATIONAL_ROWS} union all "
    f"{_national_file_sql("l_returnflag = 'A'")}) t",
)
def q_national_tsv_scan(spark, sf_dir):
    """SRC2: several written files as one scan; a file given twice gives its rows twice."""
    paths = _supersector_files(spark, sf_dir, national_observations, "ce")
    return read_observations(spark, [*paths, paths[0]], NATIONAL_STRIPPED)


def _code_files(spark, tables, fmt):
    paths = {}
    for name, df in tables.items():
        paths[name] = shared_folder(spark, name)
        writer = df.write.format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True).option("sep", "\t").option("quoteAll", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        writer.save(paths[name])
    return paths


@register("regional_fact_from_files", O.with_ctes([], "select * from regional_clean"))
def q_regional_fact_from_files(spark, sf_dir):
    """RPT1 + SRC1 + SRC3 (parquet): the regional fact from an observation file and code tables."""
    path = shared_folder(spark, "sm-data")
    write_observations(regional_observations(spark, sf_dir), path)
    codes = _code_files(spark, regional_code_tables(spark, sf_dir), "parquet")
    return regional_fact_from_files(spark, path, "parquet", codes, params=FIXTURE_PARAMS)


@register("national_fact_from_files", O.with_ctes([], "select * from national_clean"))
def q_national_fact_from_files(spark, sf_dir):
    """RPT2 + SRC2 + SRC3 (csv): the national fact from several observation files and code tables."""
    paths = _supersector_files(spark, sf_dir, national_observations, "ce-data")
    codes = _code_files(spark, national_code_tables(spark, sf_dir), "csv")
    options = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    return national_fact_from_files(spark, paths, "csv", codes, options)


# --- frames that the job can write besides the reports (SNK2) ----------------------------


@register(
    "adjusted_national_sums",
    O.with_ctes(
        [],
        "select supersector_name, industry_name, year, Month, sum(value) as value_mom from national_slice "
        "where seasonal = 'S' and supersector_name is not null and industry_name is not null "
        "and year is not null and Month is not null group by all",
    ),
)
def q_adjusted_national_sums(spark, sf_dir):
    return national_frames(national_clean_df(spark, sf_dir), FIXTURE_PARAMS)["national_rankings_mom"]


def _regional_frame(name, sql):
    def query(spark, sf_dir):
        return regional_frames(regional_clean_df(spark, sf_dir), FIXTURE_PARAMS)[name]

    query.__doc__ = f"SNK2: the frame written as {name}."
    register(name, sql)(query)


_AREA_KEYS = "area_name, supersector_name, industry_name, year, Month"
_regional_frame("sm_table_final_v2", O.with_ctes([], "select * from regional_slice where seasonal = 'U'"))
_regional_frame("sm_table_final_v3", O.with_ctes([], "select * from regional_slice where seasonal = 'S'"))
for _name, _where in (
    ("msa_rankings_over_mom", f"seasonal = 'S' and area_name in ({O.LARGE_AREAS})"),
    ("msa_rankings_under_mom", f"seasonal = 'S' and {O.SMALL_ROWS}"),
):
    _whole = " and ".join(f"{c} is not null" for c in _AREA_KEYS.split(", "))
    _regional_frame(
        _name,
        O.with_ctes([], f"select {_AREA_KEYS}, sum(value) as value_mom from regional_slice where {_where} and {_whole} group by all"),
    )
