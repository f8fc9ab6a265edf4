"""Benchmark decontamination by Wu-Manber search over words.

Test strings are windows of 13 consecutive words of a benchmark item (a shorter item is one
window). For windows of one length, a table gives for each block of two words how far a
search may skip: the distance from the block's last place in any window to the window's
end. Where it is zero, the hash of the last block and that of the first one select the test
strings of a bucket, and their bytes are compared. Texts are searched in many short lanes at
once, each lane with a cursor of its own.

The search is a map over documents; nothing of them is shuffled. The windows are cut, hashed and
grouped by a Spark job over the benchmark and written. They go to all tasks in blocks dealt out by
a hash, each with BLOCK_BYTES of table on average (windows, slots, item ids); a window in more than PIECE_ITEMS
items comes in pieces, each with a part of its item ids. The driver holds one block at a time. Each block is a pass and passes
join their marks, so no size is left out; what a pass returns is written before the next one,
so a task holds one block too.

Defined results: null and empty texts have no words, no hits and are not contaminated;
items without words have no window; repeated item rows count once; items with equal text
are each reported; windows of an item with a null item_id are hits that add no name to items; an
empty benchmark hits nothing. Every input row is returned
once, its columns inside ``row`` and the results inside ``found``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtrend.llm.common import Words, slices, spread, whole_row, written

WINDOW = 13
#: A document is contaminated if 1 of so many words, or more, is hit.
SHARE = 20
BLOCK_BYTES = 32 << 20
#: Items of a window that stay together in a row, on average at most.
PIECE_ITEMS = 4096
#: Bytes of a window in a block besides its text, slots and item ids (keys, order, offsets).
ROW_BYTES = 48
TABLE_BITS = 18
#: Words that a lane covers.
LANE = 256
FOUND = "n_words long, n_hit long, items array<string>, contaminated boolean, hits binary"


def bucket(words: Words, at: np.ndarray, width: int) -> np.ndarray:
    """64 bits of the last and the first block of the runs of ``width`` words that begin at each word number."""
    block = min(2, width)
    return words.run_hash(at + width - block, block) ^ (words.run_hash(at, block) * np.uint64(0x9FB21C651E98DF25))


class Search:
    """The shift table and buckets of all test strings with the same number of words."""

    def __init__(self, width: int, rows: pa.Table):
        self.width, self.block = width, min(2, width)
        self.strings = rows.column("window").cast(pa.large_binary()).combine_chunks()
        self.items = rows.column("items").combine_chunks()
        last = width - self.block
        self.shift = np.full(1 << TABLE_BITS, last + 1, np.int32)
        slots = rows.column("slots").combine_chunks().flatten().to_numpy().reshape(-1, last + 1)
        for j in range(last + 1):
            np.minimum.at(self.shift, slots[:, j], last - j)
        key = rows.column("key").to_numpy().view(np.uint64)
        order = np.argsort(key, kind="stable")
        self.key, self.number = key[order], order

    @staticmethod
    def slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def find(self, words: Words) -> Iterator[tuple[int, int]]:
        """(word number where it begins, number of the test string) of every occurrence."""
        windows = np.maximum(words.counts - self.width + 1, 0)
        lanes = -(-windows // LANE)
        doc = np.repeat(np.arange(len(lanes)), lanes)
        place = np.arange(len(doc)) - (np.cumsum(lanes) - lanes)[doc]
        cursor = words.first[doc] + place * LANE
        stop = np.minimum(cursor + LANE, words.first[doc] + windows[doc])
        tail = self.width - self.block
        zero = []
        while len(cursor):
            skip = self.shift[self.slot(words.run_hash(cursor + tail, self.block))]
            zero.append(cursor[skip == 0])
            cursor = cursor + np.maximum(skip, 1)
            going = cursor < stop
            cursor, stop = cursor[going], stop[going]
        at = np.concatenate(zero) if zero else np.empty(0, np.int64)
        if not len(at):
            return
        key = bucket(words, at, self.width)
        low, high = np.searchsorted(self.key, key, "left"), np.searchsorted(self.key, key, "right")
        buffer = words.norm.tobytes()
        for i in np.flatnonzero(high > low):
            text = buffer[words.start[at[i]] : words.end[at[i] + self.width - 1]]
            for k in self.number[low[i] : high[i]]:
                if self.strings[k].as_py() == text:
                    yield int(at[i]), int(k)


def windows_of(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The windows of (item, text): item, width, window, key, slots (of its blocks of words)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, lambda x: x.column("text")):
            words = Words(batch.column("text"))
            buffer = words.norm.tobytes()
            widths = np.minimum(words.counts, window)
            owner, place = spread(np.where(words.counts > 0, words.counts - widths + 1, 0))
            for width in np.unique(widths[owner]).tolist():
                own = widths[owner] == width
                starts, owners = (words.first[owner] + place)[own], owner[own]
                for i in range(0, len(starts), 2_000):
                    at, block = starts[i : i + 2_000], min(2, width)
                    slots = np.stack([Search.slot(words.run_hash(at + j, block)) for j in range(width - block + 1)], axis=1).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("item").take(pa.array(owners[i : i + 2_000])),
                            pa.array(np.full(len(at), width, np.int32)),
                            pa.array([buffer[a:b] for a, b in zip(words.start[at], words.end[at + width - 1])], pa.binary()),
                            pa.array(bucket(words, at, width).view(np.int64)),
                            pa.array(list(slots), pa.list_(pa.int32())),
                        ],
                        names=["item", "width", "window", "key", "slots"],
                    )

    return benchmark.mapInArrow(task, "item string, width int, window binary, key long, slots array<int>")


def grouped(windows: DataFrame, piece_items: int = PIECE_ITEMS) -> DataFrame:
    """Each different window with its items, in pieces of about ``piece_items`` items, each a row.

    Spark groups by window and item first, with partial aggregates, so a window of very many items is spread over tasks and
    no row, group or task holds all of them.
    """
    keys = ["width", "window"]
    same = [F.first(x).alias(x) for x in ("key", "slots")]  # they follow from the window
    each = written(windows.groupBy(*keys, "item").agg(*same), "window-items")
    many = each.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > piece_items)
    placed = each.join(written(many, "frequent-windows"), keys, "left")
    piece = F.pmod(F.xxhash64("item"), F.ceil(F.coalesce("n", F.lit(1)) / piece_items)).alias("piece")
    return placed.select(*keys, "key", "slots", "item", piece).groupBy(*keys, "piece").agg(*same, F.sort_array(F.collect_set("item")).alias("items"))


def searches(windows: pa.Table) -> list[Search]:
    """One Search for each length of these test strings."""
    widths = sorted(set(windows.column("width").to_pylist()))
    return [Search(width, windows.filter(pc.equal(windows.column("width"), width))) for width in widths]


def _marks(words: Words, found: list[Search], hits: np.ndarray, items: list[set[str]]) -> None:
    edge = np.zeros(len(words.hash) + 1, np.int64)
    for search in found:
        for at, k in search.find(words):
            edge[at] += 1
            edge[at + search.width] -= 1
            items[words.doc[at]].update(search.items[k].as_py())
    hits |= np.cumsum(edge[:-1]) > 0


def mark(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``row`` and ``found`` (n_words, n_hit, items, contaminated, hits: a bit for each word)."""
    spark = docs.sparkSession
    known = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).cast("string").alias("text")).where("text is not null")
    cut = written(windows_of(known.distinct(), window), "cut")
    size = F.octet_length("window") + 4 * F.size("slots") + F.coalesce(F.octet_length("item"), F.lit(0)) + ROW_BYTES
    total = cut.agg(F.sum(size.cast("long"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_bytes))
    windows = written(grouped(cut), "windows")
    out = docs.select(whole_row(docs).alias("row"), F.lit(None).cast(f"struct<{FOUND.replace(' ', ':').replace(',:', ',')}>").alias("found"))
    schema = out.schema
    for b in range(blocks):
        if b:
            out = written(out, "marked")
            held.unpersist()
        part = windows.where(F.pmod(F.xxhash64("window", "piece"), F.lit(blocks)) == b)
        held = spark.sparkContext.broadcast(searches(part.toArrow()))

        def task(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:
            own_text = lambda batch: pc.struct_field(batch.column("row"), text).cast(pa.string())
            for batch in slices(batches, own_text):
                row, before = batch.column("row"), batch.column("found")
                words = Words(own_text(batch))
                hits = np.zeros(len(words.hash), bool)
                items: list[set[str]] = [set() for _ in range(batch.num_rows)]
                for k, x in enumerate(before.to_pylist()):
                    if x is not None:
                        n, a = int(words.counts[k]), int(words.first[k])
                        hits[a : a + n] = np.unpackbits(np.frombuffer(x["hits"], np.uint8), count=n).astype(bool)
                        items[k].update(x["items"])
                _marks(words, held.value, hits, items)
                n_hit = np.bincount(words.doc, hits, words.n_docs).astype(np.int64) if len(hits) else np.zeros(words.n_docs, np.int64)
                values = [
                    {
                        "n_words": int(n),
                        "n_hit": int(h),
                        "items": sorted(names),
                        "contaminated": bool(h and SHARE * h >= n),
                        "hits": np.packbits(hits[a : a + n]).tobytes(),
                    }
                    for n, h, a, names in zip(words.counts, n_hit, words.first, items)
                ]
                yield pa.RecordBatch.from_arrays([row, pa.array(values, before.type)], names=["row", "found"])

        out = out.mapInArrow(task, schema)
    return out
