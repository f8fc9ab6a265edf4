"""Best-two-fit packing of documents into sequences of a fixed number of tokens.

A sequence is filled greedily, each time with the longest piece that still fits. Then its
smallest piece is swapped for two unpacked pieces, where two are found that fill the larger
gap more tightly. Only documents longer than a sequence are cut; the first piece takes the
remainder, the others fill whole sequences.

Texts are encoded first and written as pieces without text. These are dealt out by a hash into
partitions of DEAL_PIECES on average, so each holds a sample of all lengths, whatever order or
files the documents came in, and a task packs its partition. Its pieces are put in order before,
so the result does not depend on the layout of the input. Packing in parts can cost sequences
against packing all pieces at once; a part's sequences stay open as far as its own lengths
do not fit together (README has measured figures), and no bound is claimed.

Rows that agree in doc_id, place and ids meet in one partition. A task packs PACK_PIECES at a
time, so its memory is bounded even then; only beyond that does the order of arrival count.

Defined results: null text is empty (its one id is the end id, so every row has a piece);
repeated rows are packed one by one; an empty table gives no row; extra input columns
are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtrend.llm.common import slices, written
from jobtrend.llm.tokens import CALL, default_tokenizer, encoder, with_end

SEQUENCE_TOKENS = 1024
#: Pieces that a task packs together at most (about 60 bytes of memory each).
PACK_PIECES = 1_000_000
#: Pieces of a partition on average.
DEAL_PIECES = 50_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
SCHEMA = f"{PIECES}, sequence_id long, offset long"


def cut_points(n: int, capacity: int) -> list[int]:
    """Where the pieces of a document of n ids start, and its end."""
    first = (n - 1) % capacity + 1
    return [0, *range(first, n + 1, capacity)] if n else [0]


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """For each piece its sequence and place there; the number of sequences.

    Lengths are whole numbers from 1 to ``capacity``. Which lengths are left is one large
    integer with a bit for each, and its mirror image finds pairs with a given sum.
    """
    order = np.argsort(lengths, kind="stable")
    left = np.bincount(lengths, minlength=capacity + 1).tolist()
    at = (np.cumsum([0, *left])[:-1]).tolist()
    have = sum(1 << n for n, c in enumerate(left) if c)
    mirror = sum(1 << (capacity - n) for n, c in enumerate(left) if c)
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    made = 0

    def take(n: int, k: int = 1) -> None:
        nonlocal have, mirror
        left[n] -= k
        if not left[n]:
            have &= ~(1 << n)
            mirror &= ~(1 << (capacity - n))

    def give(n: int) -> None:
        nonlocal have, mirror
        left[n] += 1
        have |= 1 << n
        mirror |= 1 << (capacity - n)

    def pair(total: int, least: int) -> tuple[int, int] | None:
        """Two unpacked pieces with the largest sum up to ``total`` and above ``least``."""
        for t in range(total, least, -1):
            both = have & (mirror >> (capacity - t)) if t <= capacity else 0
            if both and not t % 2 and both == 1 << (t // 2) and left[t // 2] < 2:
                both = 0
            if both:
                a = both.bit_length() - 1
                if 2 * a == t and left[a] < 2:
                    continue
                return a, t - a
        return None

    while have:
        bin_, gap = [], capacity
        while gap and (n := (have & ((1 << (gap + 1)) - 1)).bit_length() - 1) > 0:
            bin_.append(n)
            take(n)
            gap -= n
        if gap and len(bin_) > 1 and (two := pair(gap + bin_[-1], bin_[-1])):
            give(bin_.pop())
            for n in two:
                take(n)
                bin_.append(n)
        need = {n: bin_.count(n) for n in bin_}
        more = min(left[n] // c for n, c in need.items())  # the same choice again, as often as it can be made
        for n, c in need.items():
            if more:
                take(n, more * c)
        place = 0
        for n in bin_:
            chosen = order[at[n] : at[n] + more + 1]
            at[n] += more + 1
            sequence[chosen] = made + np.arange(more + 1)
            offset[chosen] = place
            place += n
        made += more + 1
    return sequence, offset, made


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = SEQUENCE_TOKENS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a piece: its document, place and digest, its sequence and offset there."""
    tokenizer = tokenizer or default_tokenizer()
    own = [x.split()[0] for x in PIECES.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode_column
        for batch in slices(batches, lambda x: x.column("text"), *CALL):
            columns: list[list] = [[], [], [], [], []]
            ids, begins = with_end(*encode(batch.column("text")))
            ids = ids.astype("<u4")
            for key, at, end in zip(batch.column("doc_id").to_pylist(), begins.tolist(), begins[1:].tolist()):
                points = cut_points(end - at, capacity)
                for piece, (a, b) in enumerate(zip(points, points[1:])):
                    for column, x in zip(columns, (key, piece, a, b - a, zlib.crc32(ids[at + a : at + b]))):
                        column.append(x)
            arrays = [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), *(pa.array(x, pa.int64()) for x in columns[2:])]
            yield pa.RecordBatch.from_arrays(arrays, names=own)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        made, held, rows = 0, [], 0

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal made, held, rows
            whole = pa.Table.from_batches(held).sort_by([(x, "ascending") for x in own])
            sequence, offset, n = best_two_fit(whole.column("length").to_numpy(), capacity)
            whole = whole.append_column("sequence_id", pa.array(base + made + sequence)).append_column("offset", pa.array(offset))
            made += n
            held, rows = [], 0
            yield from whole.to_batches(10_000)

        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, PACK_PIECES - rows)
                held.append(part)
                at += part.num_rows
                rows += part.num_rows
                if rows >= PACK_PIECES:
                    yield from packed()
        if held:
            yield from packed()

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    pieces = written(given.mapInArrow(cut, PIECES), "pieces")
    parts = max(1, math.ceil(pieces.count() / DEAL_PIECES))
    return pieces.repartition(parts, "doc_id", "piece", "ids_crc32").mapInArrow(fill, SCHEMA)
