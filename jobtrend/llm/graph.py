"""Connected components, and groups that are dealt out in blocks of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtrend.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) of every node in ``edges`` (u, v long).

    Alternating large and small stars: every node points to the smallest node that it or a
    neighbour knows, until every member points to one center that knows none smaller;
    about log2 of the longest path rounds. Each round's edges are written to the
    shared folder, and so are the minima, so that both sides of the joins are exchanges
    that adaptive execution can split where a node has very many neighbours. The driver
    gets one truth value a round.
    """
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    while True:
        # large star: larger neighbours of a node go to the smallest node that it knows
        both = now.union(now.select("v", "u"))
        least = written(both.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m")).select("k", F.least("k", "m").alias("m")), "minima")
        large = both.join(least, both.u == least.k).where("v > u")
        large = written(large.select(F.col("v").alias("u"), F.col("m").alias("v"), (F.col("m") < F.col("u")).alias("moved")), "edges")
        # small star: so do smaller ones
        least = written(large.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"), ((F.min("v") < F.max("v")) | F.max("moved")).alias("open")), "minima")
        if not least.where("open").limit(1).count():
            return least.select(F.col("k").alias("node"), F.col("m").alias("component")).union(least.select("m", "m").distinct())
        small = large.join(least, large.u == least.k).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(small.union(least.select(F.col("k").alias("u"), F.col("m").alias("v"))).distinct(), "edges")


def in_blocks(members: DataFrame, group: str, node: str, size: int) -> DataFrame:
    """``members`` with columns own, i, j, blocks: a copy for each pair of blocks that it belongs to.

    A group of n members has ceil(n / size) blocks by hash of ``node``; blocks meet in pairs, so
    that any two members share a pair (i, j) and no pair holds more than about twice ``size``.
    """
    large = members.groupBy(F.col(group).alias("_g")).agg(F.count("*").alias("_n")).where(F.col("_n") > size).select("_g", F.ceil(F.col("_n") / size).cast("int").alias("_blocks"))
    large = written(large, "large-groups")
    placed = members.join(large, members[group] == large["_g"], "left").withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
    placed = placed.withColumn("own", F.pmod(F.xxhash64(node), F.col("_blocks")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1))
    return placed.withColumn("_other", others).select(
        *members.columns, "own", F.least("own", "_other").alias("i"), F.greatest("own", "_other").alias("j"), F.col("_blocks").alias("blocks")
    )


def map_whole_groups(df: DataFrame, keys: list[str], work: Callable[[pa.Table, np.ndarray], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``work`` on tables of whole groups: rows in order of ``keys``, and where each group begins.

    A table holds an Arrow batch of rows and the rest of its last group, so groups must have a bounded
    size (see in_blocks).
    """
    dealt = df.repartition(*keys).sortWithinPartitions(*keys)

    def begins(rows: pa.Table | pa.RecordBatch) -> np.ndarray:
        change = np.zeros(rows.num_rows, bool)
        change[:1] = True
        for k in keys:
            x = rows.column(k).to_numpy(zero_copy_only=False) if isinstance(rows, pa.RecordBatch) else rows.column(k).to_numpy()
            change[1:] |= x[1:] != x[:-1]
        return np.flatnonzero(change)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            last = int(begins(batch)[-1])
            if last:  # all but the batch's last group are whole now
                whole = pa.Table.from_batches([*waiting, batch.slice(0, last)])
                yield from work(whole, begins(whole))
                waiting = []
            elif waiting and any(batch.column(k)[0] != waiting[-1].column(k)[-1] for k in keys):
                whole = pa.Table.from_batches(waiting)
                yield from work(whole, begins(whole))
                waiting = []
            waiting.append(batch.slice(last))
        if waiting:
            whole = pa.Table.from_batches(waiting)
            yield from work(whole, begins(whole))

    return dealt.mapInArrow(task, schema)


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For links a-b among 0..n-1 the smallest number in each one's component."""
    at = np.arange(n)
    while True:
        low = at.copy()
        np.minimum.at(low, a, at[b])
        np.minimum.at(low, b, at[a])
        low = low[low]
        if (low == at).all():
            return at
        at = low
