"""Report sinks (SNK1-SNK3): replace a target table or folder.

A file target is written beside its place and takes it only when it is complete, so a report can be
rerun alone, a failed run leaves the old target whole (D12), and a report may read what it replaces.
A JDBC target is dropped first, as the database driver does it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def with_table_index(df: DataFrame, order: Sequence[str], name: str = "index") -> DataFrame:
    """WIN7 for a sink: the 0-based position of each row in table order.

    Uses the distributed position of the table-scope module (no single task).
    """
    from jobtrend.operators.table_scope import with_position

    return with_position(df, order, name)


def write_report(
    df: DataFrame,
    target: str,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
    partition_by: Sequence[str] | None = None,
    with_index: Sequence[str] | None = None,
    sort_by: Sequence[str] | None = None,
) -> None:
    """SNK1 / SNK2: replace ``target`` with the report.

    fmt="jdbc": ``options`` holds the connection (from the caller), ``target`` is the
    table. fmt="csv": header row, values as text; NULL ranks are written as empty
    fields, as the reference wrote its national ranks (SNK3, D9).
    ``with_index`` gives the table order to add a position column, like a pandas
    table written with its index. ``sort_by`` (ORD1) writes the rows in that order:
    a global sort, which Spark runs as a range-partitioned, distributed sort.
    """
    if with_index:
        df = with_table_index(df, with_index)
    if sort_by:
        df = df.orderBy(*sort_by)
    opts = dict(options or {})
    if fmt == "jdbc":
        opts.setdefault("dbtable", target)
        df.write.format("jdbc").options(**opts).mode("overwrite").save()
        return
    writer = df.write.mode("error").format(fmt).options(**opts)
    if fmt == "csv":
        writer = writer.option("header", True).option("nullValue", "").option("emptyValue", "")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    parent, _, name = target.rstrip("/").rpartition("/")
    run = uuid.uuid4().hex
    # names with an underscore are no data for readers of the parent folder
    fresh, old = (f"{parent}/_{name}.{kind}-{run}" if parent else f"_{name}.{kind}-{run}" for kind in ("new", "old"))
    try:
        writer.save(fresh)
        _take_place(df.sparkSession, fresh, target.rstrip("/"), old)
    except BaseException:
        _Files(df.sparkSession, target).delete(fresh)
        raise


class _Files:
    """The Hadoop file system of a path (any store that Spark writes to)."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.path(path))

    def rename(self, a: str, b: str) -> None:
        if not self.fs.rename(self.path(a), self.path(b)):
            raise OSError(f"cannot rename {a} to {b}")

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)


def _take_place(spark: SparkSession, fresh: str, target: str, old: str) -> None:
    """Two renames; if the second fails, the old target goes back."""
    files = _Files(spark, target)
    had = files.exists(target)
    if had:
        files.rename(target, old)
    try:
        files.rename(fresh, target)
    except BaseException:
        if had:
            files.rename(old, target)
        raise
    if had:
        files.delete(old)


def write_csv(df: DataFrame, path: str) -> None:
    """SNK3: CSV export without an index column."""
    write_report(df, path, fmt="csv")
