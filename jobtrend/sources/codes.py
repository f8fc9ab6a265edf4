"""Code tables (SRC3) and the reporting month (SRC5).

Code tables come from a database over JDBC (options from the caller; no
connection details live in this code) or from files. Only the columns the
joins need are kept; Catalyst prunes the rest at the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REGIONAL_CODE_TABLES = ("sm_state", "sm_supersector", "sm_series", "sm_industry", "sm_data_type", "sm_area")
NATIONAL_CODE_TABLES = ("ce_supersector", "ce_data_type", "ce_industry", "ce_period", "ce_series")


def read_code_table(
    spark: SparkSession,
    name: str,
    fmt: str = "parquet",
    path: str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """SRC3: ``SELECT * FROM name`` as a DataFrame.

    fmt="jdbc": ``options`` carries url, user, password, driver (from the caller);
    the table name becomes ``dbtable``. Other formats read ``path`` (default: the
    table name) with the given reader options.
    """
    opts = dict(options or {})
    if fmt == "jdbc":
        opts.setdefault("dbtable", name)
        return spark.read.format("jdbc").options(**opts).load()
    reader = spark.read.format(fmt).options(**opts)
    if fmt == "csv":
        reader = reader.option("header", True).option("sep", opts.get("sep", "\t"))
    return reader.load(path or name)


def parallel_reads(column: str, lower: int | str, upper: int | str, parts: int) -> dict[str, str]:
    """JDBC options that read a table in ``parts`` ranges of ``column`` (rows outside the bounds come with the
    first and the last range)."""
    if parts < 1:
        raise ValueError("parts must be at least 1")
    return {"partitionColumn": column, "lowerBound": str(lower), "upperBound": str(upper), "numPartitions": str(parts)}


def read_code_tables(
    spark: SparkSession,
    names,
    fmt: str = "parquet",
    paths: dict | None = None,
    options: dict[str, str] | None = None,
    table_options: dict[str, dict[str, str]] | None = None,
):
    """Several code tables by name -> {name: DataFrame}.

    ``options`` hold for all tables, ``table_options[name]`` for one (they win): a large series
    table can be read in ranges (``parallel_reads``) beside small ones that are read whole.
    """
    paths, own = paths or {}, table_options or {}
    unknown = set(own) - set(names)
    if unknown:
        raise ValueError(f"table_options for tables that are not read: {sorted(unknown)}")
    return {n: read_code_table(spark, n, fmt, paths.get(n), {**(options or {}), **own.get(n, {})}) for n in names}


def latest_month(monthly: DataFrame) -> DataFrame:
    """SRC5: the latest year and its last month, as one row (``year``, ``month``).

    The reference reads this number from a lookup table (and then fixes it at 5);
    here it is a single global aggregate over the monthly rows.
    """
    latest = monthly.agg(F.max(F.struct(F.col("year"), F.col("Month"))).alias("_m"))
    return latest.select(
        F.col("_m.year").alias("year"), F.col("_m.Month").try_cast("int").alias("month")
    )


def reporting_month(monthly: DataFrame) -> int:
    """SRC5 as a parameter: the last month of the latest year, for
    ``ReportParams(ytd_months=...)``. One aggregate; a single number returns."""
    row = latest_month(monthly).first()
    if row is None or row["month"] is None:
        raise ValueError("no monthly rows to take the reporting month from")
    return int(row["month"])
