"""The generated test tables seen as employment data.

The test tables are an order/line-item star schema. This module maps them onto
the regional and national fact shapes (and onto observation files and code
tables for the star joins), as fixed in FIXTURES.md:

- state      = nation name; excluded states = the last three nations
- area       = supplier, by supplier key mod 10 (statewide, divisions, MSAs)
- supersector, industry = line return flag, part brand
- period, year = ship month and year; line number 7 stands for the annual row M13
- unadjusted / adjusted = line status O / F; value = quantity

Every frame is derived from the tables by Spark, so its size grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtrend.params import ReportParams
from jobtrend.sources.scan import read_fact

# Fixed stand-ins of the fixture (FIXTURES.md section 2).
FIXTURE_EXCLUDED_STATES = ("NATION_22", "NATION_23", "NATION_24")
FIXTURE_ANCHOR_INDUSTRY = "Brand#1"
FIXTURE_THRESHOLD = 45.0
FIXTURE_PARAMS = ReportParams(
    excluded_states=FIXTURE_EXCLUDED_STATES,
    anchor_industry=FIXTURE_ANCHOR_INDUSTRY,
    threshold=FIXTURE_THRESHOLD,
)


# Schemas of the generated tables used here (fixed values). Reading with a given
# schema skips the footer-inference job that every untyped read would start.
TABLE_SCHEMAS = {
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
}


# The fact table of the fixture; the others are dimensions.
FACT_TABLES = ("lineitem",)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if name in FACT_TABLES:
        return read_fact(spark, path, TABLE_SCHEMAS.get(name))
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(path)


def area_name_expr(suppkey: Column, supplier_name: Column) -> Column:
    kind = suppkey % F.lit(10)
    return (
        F.when(kind <= 3, F.lit("Statewide"))
        .when(kind == 4, F.concat(supplier_name, F.lit(" Metropolitan Division")))
        .when(kind == 5, F.concat(supplier_name, F.lit(" NECTA Division")))
        .when(kind == 6, F.concat(supplier_name, F.lit(" Metropolitan NECTA")))
        .otherwise(F.concat(supplier_name, F.lit(" Metropolitan Statistical Area")))
    )


def period_expr() -> Column:
    month = F.lpad(F.month("l_shipdate").cast("string"), 2, "0")
    return F.when(F.col("l_linenumber") == 7, F.lit("M13")).otherwise(F.concat(F.lit("M"), month))


def year_expr() -> Column:
    return F.year("l_shipdate").cast("string")


def seasonal_expr() -> Column:
    return F.when(F.col("l_linestatus") == "O", F.lit("U")).otherwise(F.lit("S"))


def regional_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The regional fact before cleaning (the FIXTURES.md view)."""
    li = table(spark, sf_dir, "lineitem")
    # dimension attributes are derived on the dimension side (one row per supplier),
    # not once per line after the join
    sup = table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_nationkey", area_name_expr(F.col("s_suppkey"), F.col("s_name")).alias("area_name")
    )
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    joined = (
        li.join(sup, li.l_suppkey == sup.s_suppkey)
        .join(nat, sup.s_nationkey == nat.n_nationkey)
        .join(part, li.l_partkey == part.p_partkey)
    )
    return joined.select(
        F.col("area_name"),
        F.col("n_name").alias("state_name"),
        F.col("l_returnflag").alias("supersector_name"),
        F.col("p_brand").alias("industry_name"),
        period_expr().alias("period"),
        year_expr().alias("year"),
        F.col("l_quantity").alias("value"),
        F.lit("01").alias("data_type_code"),
        seasonal_expr().alias("seasonal"),
    )


def national_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The national fact: every line, no area or state."""
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    return li.join(part, li.l_partkey == part.p_partkey).select(
        F.col("l_returnflag").alias("supersector_name"),
        F.col("p_brand").alias("industry_name"),
        period_expr().alias("period"),
        year_expr().alias("year"),
        F.col("l_quantity").alias("value"),
        F.lit("01").alias("data_type_code"),
        seasonal_expr().alias("seasonal"),
    )


# --- observation files and code tables for the star joins (RPT1, RPT2) -------
#
# A regional series is one (line status, supplier, part, return flag); its id is
# written padded with blanks, values are text, codes are unpadded numbers, state
# names end in CR and area codes in LF, as in the published flat files.

SERIES_ID_WIDTH = 30


def regional_series_id() -> Column:
    return F.concat_ws(
        "_",
        F.lit("SM"),
        seasonal_expr(),
        F.col("l_suppkey").cast("string"),
        F.col("l_partkey").cast("string"),
        F.col("l_returnflag"),
    )


def national_series_id() -> Column:
    return F.concat_ws(
        "_", F.lit("CE"), seasonal_expr(), F.col("l_partkey").cast("string"), F.col("l_returnflag")
    )


def supersector_code() -> Column:
    return F.ascii(F.col("l_returnflag")).cast("string")


def observations(
    spark: SparkSession, sf_dir: str, series_id: Column, lineitem: DataFrame | None = None
) -> DataFrame:
    """Observation rows in the flat-file layout: all text, padded."""
    li = lineitem if lineitem is not None else table(spark, sf_dir, "lineitem")
    return li.select(
        F.rpad(series_id, SERIES_ID_WIDTH, " ").alias("series_id"),
        F.concat(F.lit(" "), year_expr()).alias("year"),
        period_expr().alias("period"),
        F.lpad(F.col("l_quantity").cast("string"), 12, " ").alias("value"),
        F.lit("").alias("footnote_codes"),
    )


def regional_observations(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    return observations(spark, sf_dir, regional_series_id(), lineitem)


def national_observations(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    return observations(spark, sf_dir, national_series_id(), lineitem)


def _series_keys(li: DataFrame, *cols: str) -> DataFrame:
    """Distinct series keys, taken on the raw (short) columns; text codes are built
    afterwards, once per series instead of once per line."""
    return li.select(seasonal_expr().alias("seasonal"), *cols).distinct()


def regional_code_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """sm_series, sm_industry, sm_supersector, sm_state, sm_area."""
    li = table(spark, sf_dir, "lineitem")
    sup = table(spark, sf_dir, "supplier")
    keys = _series_keys(li, "l_suppkey", "l_partkey", "l_returnflag")
    series = keys.join(sup.select("s_suppkey", "s_nationkey"), keys.l_suppkey == sup.s_suppkey).select(
        F.concat_ws(
            "_", F.lit("SM"), F.col("seasonal"), F.col("l_suppkey").cast("string"),
            F.col("l_partkey").cast("string"), F.col("l_returnflag"),
        ).alias("series_id"),
        F.col("s_nationkey").cast("string").alias("state_code"),
        F.col("l_suppkey").cast("string").alias("area_code"),
        F.col("l_partkey").cast("string").alias("industry_code"),
        supersector_code().alias("supersector_code"),
        F.lit("1").alias("data_type_code"),
        F.col("seasonal"),
    )
    flags = li.select("l_returnflag").distinct()
    return {
        "sm_series": series,
        "sm_industry": table(spark, sf_dir, "part").select(
            F.col("p_partkey").cast("string").alias("industry_code"),
            F.col("p_brand").alias("industry_name"),
        ),
        "sm_supersector": flags.select(
            supersector_code().alias("supersector_code"),
            F.concat(F.col("l_returnflag"), F.lit("\r")).alias("supersector_name"),
        ),
        "sm_state": table(spark, sf_dir, "nation").select(
            F.col("n_nationkey").cast("string").alias("state_code"),
            F.concat(F.col("n_name"), F.lit("\r")).alias("state_name"),
        ),
        "sm_area": sup.select(
            F.concat(F.col("s_suppkey").cast("string"), F.lit("\n")).alias("area_code"),
            area_name_expr(F.col("s_suppkey"), F.col("s_name")).alias("area_name"),
        ),
    }


def national_code_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """ce_series, ce_industry, ce_supersector."""
    li = table(spark, sf_dir, "lineitem")
    series = _series_keys(li, "l_partkey", "l_returnflag").select(
        F.concat(
            F.lit("  "),
            F.concat_ws("_", F.lit("CE"), F.col("seasonal"), F.col("l_partkey").cast("string"), F.col("l_returnflag")),
        ).alias("series_id"),
        F.col("l_partkey").cast("string").alias("industry_code"),
        supersector_code().alias("supersector_code"),
        F.lit("01").alias("data_type_code"),
        F.col("seasonal"),
    )
    return {
        "ce_series": series,
        "ce_industry": table(spark, sf_dir, "part").select(
            F.col("p_partkey").cast("string").alias("industry_code"),
            F.col("p_brand").alias("industry_name"),
        ),
        "ce_supersector": li.select("l_returnflag").distinct().select(
            supersector_code().alias("supersector_code"),
            F.col("l_returnflag").alias("supersector_name"),
        ),
    }
