"""Helpers that several operators share: tables, shared folders, Arrow maps, words."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtrend.session import shared_folder

#: Fixed value: the word pattern that the contracts state, after A-Z is lower-cased.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def whole_row(df: DataFrame, columns: list[str] | None = None) -> Column:
    """The columns of ``df`` (or some of them) as one struct, whatever they are called."""
    return F.struct(*(F.col(f"`{c.replace('`', '``')}`") for c in columns or df.columns))


def process_cache() -> dict:
    """A dictionary that lives as long as the Python worker process."""
    module = sys.modules.setdefault("_jobtrend_worker_cache", types.ModuleType("_jobtrend_worker_cache"))
    return module.__dict__.setdefault("kept", {})


def utf8_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column back to back, and where each value starts (one more at the end)."""
    column = column.cast(pa.large_string()).fill_null("")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: Callable[[pa.RecordBatch], pa.Array], rows: int = 256, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of the batches with at most ``rows`` rows and about ``size`` bytes of text (one row at least)."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(text(batch)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths)
        at = 0
        while at < batch.num_rows:
            before = ends[at] - lengths[at]
            to = int(np.searchsorted(ends, before + size, side="right"))
            to = min(max(to, at + 1), at + rows, batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of the given sizes: each member's group, and its place in the group."""
    owner = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    return owner, np.arange(len(owner)) - first[owner]


def row_identity(*columns: str):
    """128 bits that tell rows with different values in ``columns`` apart (null is a value of its own)."""
    parts = [F.when(F.col(c).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col(c).cast("string"))) for c in columns]
    return F.unhex(F.md5(F.concat_ws("\x1f", *parts)))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 2**64)


#: Powers that a worker keeps for each base (8 bytes each).
KEPT_POWERS = 1 << 21


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, grown by doubling; up to KEPT_POWERS are kept for the process."""
    kept = process_cache()
    have = kept.get(("powers", base))
    if have is None or len(have) < n:
        size = max(1024, 1 << (n - 1).bit_length())
        have = np.ones(size, np.uint64)
        filled = 1
        while filled < size:
            step = np.uint64(pow(base, filled, 2**64))
            have[filled : 2 * filled] = have[:filled] * step
            filled *= 2
        if size <= KEPT_POWERS:
            kept[("powers", base)] = have
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose high bits depend on all input bits."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Words:
    """The words of a batch of texts, by WORD_PATTERN after A-Z is lower-cased.

    UTF-8 bytes from 0x80 up are word characters, so the pattern works on bytes.
    ``norm`` holds the words with one space between them; a word is
    ``norm[start:end]``; ``doc`` is the text it comes from, ``hash`` 64 bits of it.
    """

    def __init__(self, column: pa.Array):
        data, offsets = utf8_buffer(column)
        self.n_docs = len(offsets) - 1
        lower = _LOWER[data]
        inside = _IS_WORD[lower]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        cut = offsets[:-1][offsets[:-1] < len(data)]  # a text's first byte begins a word of its own
        begin[cut] = inside[cut]
        starts = np.flatnonzero(begin)
        final = inside.copy()
        final[:-1] &= ~inside[1:] | begin[1:]
        ends = np.flatnonzero(final) + 1
        self.doc = np.searchsorted(offsets, starts, side="right") - 1
        self.counts = np.bincount(self.doc, minlength=self.n_docs) if len(starts) else np.zeros(self.n_docs, np.int64)
        self.first = np.cumsum(self.counts) - self.counts
        lengths = ends - starts
        self.start = np.cumsum(lengths + 1) - lengths - 1
        self.end = self.start + lengths
        owner, place = spread(lengths)
        self.norm = np.full(int(lengths.sum() + len(lengths)), 32, np.uint8)
        self.norm[self.start[owner] + place] = lower[inside]
        n = len(self.norm)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((self.norm.astype(np.uint64) + np.uint64(1)) * _powers(_MULTIPLIER, n), out=sums[1:])
        self.hash = mix64((sums[self.end] - sums[self.start]) * _powers(_INVERSE, n + 1)[self.start])

    def runs(self, width: int) -> np.ndarray:
        """Where ``width`` consecutive words of one text begin (word numbers)."""
        n = len(self.hash) - width + 1
        if n <= 0:
            return np.empty(0, np.int64)
        return np.flatnonzero(self.doc[:n] == self.doc[width - 1 :])

    def run_hash(self, at: np.ndarray, width: int) -> np.ndarray:
        """64 bits of the ``width`` words that begin at each word number."""
        out = np.zeros(len(at), np.uint64)
        for i in range(width):
            out = (out + self.hash[at + i]) * np.uint64(0xFF51AFD7ED558CCD)
            out ^= out >> np.uint64(29)
        return out
