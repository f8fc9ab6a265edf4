"""Table-scope windows (WIN7, decision D1 literal mode).

The reference computes its rolling means, shifts and percent changes down the
whole sorted table, so the first rows of a series read the tail of the series
before it. A plain ``Window.orderBy`` would pull every row into one task. Here:

1. Position (WIN7). The table is range-partitioned and sorted on the table order,
   each row is tagged with its partition id and its index inside the partition,
   and the result is checkpointed to the shared checkpoint folder (fixing the
   tags and cutting lineage). Per-partition row counts (one row per partition:
   bounded by the partition count) give each partition's offset.
2. Buckets with a halo. ``bucket = position div B``; the last H rows of each
   bucket are copied into the next bucket, so every row finds the H rows before
   it in its own window partition. Means need H >= n-1, shifts H >= k.
3. Forward-filled bases. A base may lie before the halo. A per-bucket summary
   (one row per bucket) holds the last non-NULL value before the halo and in
   the whole bucket. Runs of RUN_BUCKETS buckets find their carries side by side, and a
   window over one row a run carries values from run to run.
4. Means are computed first (pass A) and their bases afterwards (pass B), so a
   base is always taken from fully computed means.

All work is partitioned by bucket; no task holds more than B + H rows, whatever
the skew of the keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobtrend.functions import ratio_change
from jobtrend.operators.growth import FAMILIES
from jobtrend.params import ANNUAL_MONTHS, ReportParams
from jobtrend.session import checkpointed, ensure_checkpoint_dir

DEFAULT_BUCKET_ROWS = 65536
# Buckets whose carries one task works out together.
RUN_BUCKETS = 1024
POS = "_pos"
BUCKET = "_b"


def with_position(
    df: DataFrame, order: Sequence[str], name: str = "index", partitions: int | None = None
) -> DataFrame:
    """Add the 0-based position of each row in the order of ``order`` (unique keys).

    Distributed: a range exchange, a checkpoint, a tiny per-partition count and a
    broadcast of one offset per partition.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    tagged = checkpointed(
        ranged.select(
            "*",
            F.spark_partition_id().alias("_pid"),
            F.monotonically_increasing_id().alias("_mid"),
        )
    )
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    # one row per range partition: bounded by the partition count
    return tagged.join(F.broadcast(offsets), "_pid").select(
        *df.columns, (F.col("_off") + local).alias(name)
    )


def _own_bucket(bucket_rows: int) -> Column:
    return F.floor(F.col(POS) / F.lit(bucket_rows)).cast("long")


def _with_halo(df: DataFrame, bucket_rows: int, halo: int) -> DataFrame:
    """Each row in its bucket, plus a copy in the next bucket when it is among the
    last ``halo`` rows of its own; copies are flagged ``_halo``."""
    own = _own_bucket(bucket_rows)
    in_tail = (F.col(POS) % F.lit(bucket_rows)) >= F.lit(bucket_rows - halo)
    targets = F.when(in_tail, F.array(own, own + F.lit(1))).otherwise(F.array(own))
    return df.select("*", F.explode(targets).alias(BUCKET)).withColumn("_halo", F.col(BUCKET) != own)


def _rolling_mean(x: Column, n: int, w) -> Column:
    frame = w.rowsBetween(-(n - 1), 0)
    return F.when(F.count(x).over(frame) == F.lit(n), F.avg(x).over(frame))


def _carry(df: DataFrame, columns: Sequence[str], bucket_rows: int, halo: int) -> DataFrame:
    """Per bucket and column: the last non-NULL value before the bucket's window
    partition starts (i.e. before its halo)."""
    own = _own_bucket(bucket_rows)
    before_tail = (F.col(POS) % F.lit(bucket_rows)) < F.lit(bucket_rows - halo)
    aggs = []
    for c in columns:
        x = F.col(c)
        # max_by skips rows whose ordering is NULL: the last non-NULL value by position
        aggs.append(F.max_by(x, F.when(x.isNotNull() & before_tail, F.col(POS))).alias(f"_pre_{c}"))
        aggs.append(F.max_by(x, F.when(x.isNotNull(), F.col(POS))).alias(f"_full_{c}"))
    per_bucket = df.groupBy(own.alias(BUCKET)).agg(*aggs).withColumn("_run", F.floor(F.col(BUCKET) / F.lit(RUN_BUCKETS)))
    # the last non-NULL value up to a bucket: inside its run of buckets, else from earlier runs
    inside = Window.partitionBy("_run").orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, 0)
    runs = per_bucket.groupBy("_run").agg(
        *[F.max_by(F.col(f"_full_{c}"), F.when(F.col(f"_full_{c}").isNotNull(), F.col(BUCKET))).alias(f"_full_{c}") for c in columns]
    )
    # one row a run, i.e. one for RUN_BUCKETS * bucket_rows rows of the table
    earlier = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    older = runs.select("_run", *[F.last(F.col(f"_full_{c}"), ignorenulls=True).over(earlier).alias(f"_older_{c}") for c in columns])
    upto = per_bucket.select(
        "_run", BUCKET, *[F.last(F.col(f"_full_{c}"), ignorenulls=True).over(inside).alias(f"_inside_{c}") for c in columns]
    ).join(older, "_run")
    # a bucket's halo comes from the bucket before it: older values end two buckets back
    far = upto.select(
        (F.col(BUCKET) + F.lit(2)).alias(BUCKET), *[F.coalesce(f"_inside_{c}", f"_older_{c}").alias(f"_far_{c}") for c in columns]
    )
    near = per_bucket.select((F.col(BUCKET) + F.lit(1)).alias(BUCKET), *[f"_pre_{c}" for c in columns])
    return near.join(far, BUCKET, "left").select(BUCKET, *[F.coalesce(f"_pre_{c}", f"_far_{c}").alias(f"_carry_{c}") for c in columns])


def add_growth_table(
    df: DataFrame,
    order: Sequence[str],
    params: ReportParams = ReportParams(),
    bucket_rows: int = DEFAULT_BUCKET_ROWS,
) -> DataFrame:
    """WIN1-WIN6 down the whole table in ``order`` (the reference's literal
    behaviour), distributed by position buckets."""
    if params.calendar or params.ytd_mode != "trailing":
        raise ValueError("table scope counts rows of the sorted table: use calendar=False, ytd_mode='trailing'")
    n_ytd = params.ytd_months
    halo_means = max(n_ytd, ANNUAL_MONTHS) - 1
    halo_bases = max(k for _, _, k in FAMILIES)
    bucket_rows = max(bucket_rows, halo_means + 1, halo_bases + 1)
    base_cols = list(df.columns)

    positioned = with_position(df, order, POS)

    # pass A: means
    w = Window.partitionBy(BUCKET).orderBy(POS)
    a = _with_halo(positioned, bucket_rows, halo_means)
    means = checkpointed(  # the bases and the carries both read it
        a.select(
            "*",
            _rolling_mean(F.col("value"), n_ytd, w).alias("value_ytd_avg"),
            _rolling_mean(F.col("value"), ANNUAL_MONTHS, w).alias("value_ann_avg"),
        )
        .where(~F.col("_halo"))
        .select(*base_cols, POS, "value_ytd_avg", "value_ann_avg")
    )

    # pass B: shifted values and forward-filled bases, with carries from earlier buckets
    sources = [source for _, source, _ in FAMILIES]
    b = _with_halo(means, bucket_rows, halo_bases)
    inner = []
    for suffix, source, k in FAMILIES:
        x = F.col(source)
        inner.append(F.last(x, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -k)).alias(f"_in{suffix}"))
        inner.append(F.lag(x, k).over(w).alias(f"_shift{suffix}"))
    bases = b.select("*", *inner).where(~F.col("_halo")).drop("_halo")
    carry = _carry(means, sources, bucket_rows, halo_bases)
    joined = bases.join(carry, BUCKET, "left")

    changes = []
    for suffix, source, _ in FAMILIES:
        base = F.coalesce(F.col(f"_in{suffix}"), F.col(f"_carry_{source}"))
        pct = ratio_change(F.col(source), base)
        changes.append(pct.alias(f"pct_change{suffix}"))
        changes.append((F.col(f"_shift{suffix}") * pct).alias(f"abs_growth{suffix}"))
    return joined.select(*base_cols, "value_ytd_avg", "value_ann_avg", *changes)
