"""Removal of byte strings that occur twice, by suffix arrays.

Every window of LENGTH bytes that starts at two places, in one text or two, is removed. Windows
are brought together by content: the anchor of a window is its substring of ANCHOR bytes with
the smallest hash, and consecutive windows with the same anchor form a piece of at most
2 * LENGTH bytes. Equal windows have equal anchors, so only pieces whose anchor occurs twice
in the corpus can hold a repeat; they are found by counting anchor hashes.

* Pieces with equal bytes are merged with a count. A piece that occurs twice is repeated as a whole.
* For the others, the different pieces of an anchor become one text, whose suffix array
  (linear grouping, ``suffix_array``) puts equal windows next to each other; neighbours are
  compared byte by byte.
* An anchor with more than BLOCK different pieces (a frequent passage in changing
  surroundings) would make one large group, so its windows are dealt out again by more of their
  content: windows that begin far before the anchor by the bytes on its left, the others by
  the bytes on its right. That halves the range of places each time, so after eight
  rounds a group would hold one window; surroundings that differ part long before.

Texts travel compressed, and only spans come back to their documents.

Defined results: null and empty texts have no bytes and no spans; a text shorter than LENGTH
keeps all; rows that repeat in full are copies like any others, so both lose what they share;
spans of a document are merged where they touch or overlap. Hashes that merge pieces or count
windows have 128 bits (64 of the anchor, 64 of the content).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from jobtrend.llm.common import _powers, mix64, process_cache, slices, utf8_buffer, whole_row, written
from jobtrend.llm.graph import map_whole_groups
from jobtrend.llm.suffix_array import suffix_arrays

#: A string of so many bytes that starts anywhere else is removed.
LENGTH = 200
ANCHOR = 40
SPAN = LENGTH - ANCHOR + 1
#: Bytes of a text that are looked at together; longer texts go in slices that overlap.
SLICE = 1 << 19
#: Different pieces of an anchor that one suffix array takes at most.
BLOCK = 256
#: Bytes whose suffix arrays a task builds together.
TOGETHER = 1 << 20
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def _byte_values() -> np.ndarray:
    kept = process_cache()
    if "bytes" not in kept:
        kept["bytes"] = np.random.default_rng(5).integers(1, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return kept["bytes"]


class Hashes:
    """Hashes of any substring of some bytes, from polynomial prefix sums modulo 2**64."""

    def __init__(self, data: np.ndarray, kinds: int):
        self.sums = []
        for values, base in list(zip(_byte_values(), BASES))[:kinds]:
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(values[data] * _powers(base, len(data)), out=sums[1:])
            self.sums.append(sums)
        self.inverse = [_powers(pow(b, -1, 2**64), len(data) + 1) for b in BASES[:kinds]]

    def of(self, start: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
        return mix64((self.sums[which][end] - self.sums[which][start]) * self.inverse[which][start])


def pieces(data: np.ndarray, keys_only: bool = False) -> tuple[np.ndarray, ...]:
    """Runs of windows (of LENGTH bytes) with the same anchor: start, number, hash of the anchor, hash of all bytes.

    The anchor of a window is its substring of ANCHOR bytes with the smallest hash, the leftmost
    of equals, so windows with equal bytes have equal anchors. A run covers number + LENGTH - 1 bytes.
    """
    n = len(data) - LENGTH + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    if n > SLICE:  # windows are dealt out to slices; a piece may end at the edge of one
        parts = [pieces(data[a : a + SLICE + LENGTH - 1], keys_only) for a in range(0, n, SLICE)]
        starts = [p[0] + k * SLICE for k, p in enumerate(parts)]
        return (np.concatenate(starts), *(np.concatenate([p[k] for p in parts]) for k in (1, 2, 3)))
    hashes = Hashes(data, 1 if keys_only else 2)
    m = len(data) - ANCHOR + 1
    inner = mix64((hashes.sums[0][ANCHOR:] - hashes.sums[0][:m]) * hashes.inverse[0][:m])
    low = np.uint64((1 << 20) - 1)
    least = (inner & ~low) | np.arange(m, dtype=np.uint64)
    width = 1
    while width < SPAN:  # minima of windows of doubling width
        step = min(width, SPAN - width)
        least = np.minimum(least[: len(least) - step], least[step:])
        width += step
    at = (least & low).astype(np.int64)
    start = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    number = np.diff(np.append(start, n))
    content = np.empty(0, np.uint64) if keys_only else hashes.of(start, start + number + LENGTH - 1, 1)
    return start, number, inner[at[start]], content


def row_key(doc_id: str, text: str) -> tuple[Column, Column]:
    """Two numbers that name a row: its doc_id, and 24 bits of its text for ids that repeat."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return F.coalesce(F.col(doc_id).cast("long"), F.xxhash64(body)).alias("own"), F.xxhash64(body).bitwiseAND(0xFFFFFF).cast("int").alias("mark")


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, lambda x: x.column("text")):
        data, offsets = utf8_buffer(batch.column("text"))
        found = [pieces(data[a:b], keys_only=True)[2] for a, b in zip(offsets, offsets[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["key"])


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """own, at (start, mark and number in one integer), key, content."""
    for batch in slices(batches, lambda x: x.column("text")):
        data, offsets = utf8_buffer(batch.column("text"))
        mark = batch.column("mark").to_numpy().astype(np.int64)
        found = [pieces(data[a:b]) for a, b in zip(offsets, offsets[1:])]
        at = np.concatenate([(p[0] << 32) | (m << 8) | p[1] for p, m in zip(found, mark)])
        own = np.repeat(batch.column("own").to_numpy(), [len(p[0]) for p in found])
        key, content = (np.concatenate([p[k] for p in found]).view(np.int64) for k in (2, 3))
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(at), pa.array(key), pa.array(content)], names=["own", "at", "key", "content"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import zstandard

    press = zstandard.ZstdCompressor(level=1)
    for batch in slices(batches, lambda x: x.column("text")):
        body = [press.compress((x or "").encode()) for x in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in batch.schema.names if c != "text"), pa.array(body, pa.binary())], names=[*(c for c in batch.schema.names if c != "text"), "body"])


def _unpacked(body: bytes) -> np.ndarray:
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8)


PART = "key long, n long, own long, at long, piece binary, anchor int, lo int, hi int"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of wanted pieces, with the place of the anchor in them."""
    for batch in slices(batches, lambda x: x.column("body"), 64):
        out: dict[str, list] = {k: [] for k in ("key", "n", "own", "at", "piece", "anchor", "m")}
        for own, body, wanted in zip(*(batch.column(c).to_pylist() for c in ("own", "body", "wanted"))):
            data = _unpacked(body)
            for x in wanted:
                start, number = x["at"] >> 32, x["at"] & 0xFF
                piece = data[start : start + number + LENGTH - 1]
                first = np.arange(SPAN)
                out["anchor"].append(int((Hashes(piece, 1).of(first, first + ANCHOR, 0) >> np.uint64(20)).argmin()))
                for k in ("key", "n", "at", "m"):
                    out[k].append(x[k])
                out["own"].append(own)
                out["piece"].append(piece.tobytes())
        out["lo"], out["hi"] = [0] * len(out["key"]), [SPAN - 1] * len(out["key"])
        types = {"piece": pa.binary(), "anchor": pa.int32(), "lo": pa.int32(), "hi": pa.int32()}
        names = ["key", "n", "own", "at", "piece", "anchor", "lo", "hi", "m"]
        yield pa.RecordBatch.from_arrays([pa.array(out[k], types.get(k, pa.int64())) for k in names], names=names)


def _halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in two: windows with the anchor in the upper and in the lower half of its places.

    Windows of a half have more bytes around the anchor in common, and these go into the key.
    """
    names = [x.split()[0] for x in PART.split(", ")]
    for batch in slices(batches, lambda x: x.column("piece"), 1024):
        out: dict[str, list] = {k: [] for k in [*names, "content"]}
        for key, n, own, at, piece, anchor, lo, hi in zip(*(batch.column(c).to_pylist() for c in names)):
            number, rest, middle = at & 0xFF, at & 0xFFFFFF00, (lo + hi) // 2
            cut = min(max(anchor - middle, 0), number)  # windows before it have more than ``middle`` bytes on the left
            for a, b, low, high in ((0, cut, middle + 1, hi), (cut, number, lo, middle)):
                if a == b:
                    continue
                around = piece[anchor - low : anchor + ANCHOR + SPAN - 1 - high]
                part = piece[a : b - 1 + LENGTH]
                row = {
                    "key": _digest(around, key ^ (low << 8 | high)), "n": n, "own": own, "at": ((at >> 32) + a) << 32 | rest | (b - a),
                    "piece": part, "anchor": anchor - a, "lo": low, "hi": high, "content": _digest(part, 0),
                }
                for k, v in row.items():
                    out[k].append(v)
        types = {"piece": pa.binary(), "anchor": pa.int32(), "lo": pa.int32(), "hi": pa.int32()}
        yield pa.RecordBatch.from_arrays([pa.array(v, types.get(k, pa.int64())) for k, v in out.items()], names=list(out))


def _digest(data: bytes, salt: int) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8, salt=(salt & 0xFFFFFFFFFFFFFFFF).to_bytes(8, "little")).digest(), "little", signed=True)


def repeated_windows(groups: list[list[bytes]]) -> list[list[np.ndarray]]:
    """For each group of texts and each text in it, which of its windows occur elsewhere in the group.

    Bytes become symbols from 2 on; 1 ends a text and 0 a group.
    """
    joined = [np.concatenate([*(np.append(np.frombuffer(t, np.uint8).astype(np.int64) + 2, 1) for t in texts), [0]]) for texts in groups]
    order, _ = suffix_arrays(joined)
    symbols = np.concatenate(joined)
    lengths = np.array([len(t) + 1 for texts in groups for t in texts])
    group_ends = np.cumsum([len(j) for j in joined])
    first = np.concatenate([np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1] + e - len(j) for texts, j, e in zip(groups, joined, group_ends)])
    window = np.zeros(len(symbols), bool)  # where a whole window starts
    owner = np.repeat(np.arange(len(first)), lengths)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    window[(first[owner] + within)[within + LENGTH < lengths[owner]]] = True
    group_of = np.repeat(np.arange(len(groups)), [len(j) for j in joined])
    a, b = order[:-1], order[1:]
    near = window[a] & window[b] & (group_of[a] == group_of[b]) & (symbols[a] == symbols[b])
    a, b = a[near], b[near]
    for step in range(1, LENGTH):  # neighbours drop out at the first byte that differs
        same = symbols[a + step] == symbols[b + step]
        if not same.all():
            a, b = a[same], b[same]
    hit = np.zeros(len(symbols), bool)
    hit[a] = hit[b] = True
    flat = [np.flatnonzero(hit[f : f + n]) for f, n in zip(first, lengths)]
    out, k = [], 0
    for texts in groups:
        out.append(flat[k : k + len(texts)])
        k += len(texts)
    return out


def _arrays(rows: pa.Table, begins: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Spans of pieces that occur once, where their windows occur in other pieces of the anchor."""
    n, own, at = (rows.column(c).to_numpy() for c in ("n", "own", "at"))
    ends = np.append(begins[1:], rows.num_rows)
    held: list[tuple[int, int]] = []
    bytes_held = 0
    lengths = (at & 0xFF) + LENGTH - 1
    for a, b in zip(begins, ends):
        held.append((a, b))
        bytes_held += int(lengths[a:b].sum())
        if bytes_held < TOGETHER and b < rows.num_rows:
            continue
        low, high = held[0][0], held[-1][1]
        texts = rows.column("piece").slice(low, high - low).to_pylist()
        found = repeated_windows([texts[x - low : y - low] for x, y in held])
        out: list[tuple[int, int, int, int]] = []
        for (x, _), windows in zip(held, found):
            for k, hit in enumerate(windows):
                if n[x + k] == 1 and len(hit):
                    runs = np.flatnonzero(np.diff(hit) > 1)
                    start, mark = int(at[x + k]) >> 32, (int(at[x + k]) >> 8) & 0xFFFFFF
                    for i, j in zip([hit[0], *hit[runs + 1]], [*hit[runs], hit[-1]]):
                        out.append((int(own[x + k]), mark, start + int(i), start + int(j) + LENGTH))
        if out:
            own_, mark_, start_, end_ = zip(*out)
            yield pa.RecordBatch.from_arrays([pa.array(own_, pa.int64()), pa.array(mark_, pa.int32()), pa.array(start_, pa.int64()), pa.array(end_, pa.int64())], names=["own", "mark", "start", "end"])
        held, bytes_held = [], 0


def spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """own, mark (see row_key), start, end: byte ranges to remove; they may overlap."""
    given = docs.where(F.octet_length(F.col(text).cast("string")) >= LENGTH).select(*row_key(doc_id, text), F.col(text).cast("string").alias("text"))
    keys = written(given.select("text").mapInArrow(_keys, "key long").groupBy("key").count().where("count > 1").select("key"), "anchors")
    found = given.mapInArrow(_placed, "own long, at long, key long, content long")
    found = written(found.join(keys, "key"), "pieces")
    kinds = written(found.groupBy("key", "content").agg(F.count("*").alias("n"), F.min(F.struct("own", "at")).alias("first")).select("key", "content", "n", "first.*"), "kinds")
    mixed = written(kinds.groupBy("key").agg(F.count("*").alias("m"), F.min("n").alias("_least")).where("m > 1 and _least = 1").select("key", "m"), "mixed")
    mark = F.shiftright("at", 8).bitwiseAND(0xFFFFFF).cast("int").alias("mark")
    start = F.shiftright("at", 32)
    wanted = kinds.join(mixed, "key").groupBy("own", mark).agg(F.collect_list(F.struct("key", "n", "at", "m")).alias("wanted"))
    texts = given.mapInArrow(_packed, "own long, mark int, body binary")
    ranges = lambda df: df.select("own", mark, start.alias("start"), (start + F.col("at").bitwiseAND(0xFF) + LENGTH - 1).alias("end"))
    cut = written(wanted.join(texts, ["own", "mark"]).mapInArrow(_cut, PART + ", m long"), "cut")
    small, large, whole = [cut.where(F.col("m") <= BLOCK).drop("m")], cut.where(F.col("m") > BLOCK).drop("m"), []
    while large.limit(1).count():  # eight rounds at most
        halves = written(large.mapInArrow(_halves, PART + ", content long"), "halves")
        merged = written(halves.groupBy("key", "content").agg(F.sum("n").alias("n"), F.min(F.struct("own", "at")).alias("first")), "merged")
        groups = written(merged.groupBy("key").agg(F.count("*").alias("m"), F.min("n").alias("_least")).where("m > 1 and _least = 1").select("key", "m"), "groups")
        several = merged.where("n > 1").select("key", "content")
        whole.append(ranges(halves.where("n = 1").join(several, ["key", "content"], "left_semi")))
        chosen = merged.join(groups, "key").select("key", "content", "first.own", "first.at", F.col("n").alias("_n"), "m")
        parted = halves.join(chosen, ["key", "content", "own", "at"]).withColumn("n", F.col("_n")).drop("content", "_n")
        parted = written(parted.select(*(x.split()[0] for x in PART.split(", ")), "m"), "parted")
        small.append(parted.where(F.col("m") <= BLOCK).drop("m"))
        large = parted.where(F.col("m") > BLOCK).drop("m")
    arrays = map_whole_groups(reduce(DataFrame.union, small), ["key"], _arrays, "own long, mark int, start long, end long")
    twice = kinds.where("n > 1").select("key", "content")
    whole.append(ranges(found.join(written(twice, "twice"), ["key", "content"], "left_semi")))
    return reduce(DataFrame.union, whole, arrays)


def merged(ranges: list) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def remove(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None, keep_bytes: bool = False) -> DataFrame:
    """``row`` (the columns to keep) and ``found``: n_bytes, n_removed, n_spans, kept_sha256, spans, kept (bytes, if asked for)."""
    ranges = written(spans(docs, doc_id, text).groupBy("own", "mark").agg(F.collect_set(F.struct("start", "end")).alias("ranges")), "spans")
    packed = docs.select(whole_row(docs, keep).alias("row"), *row_key(doc_id, text), F.col(text).cast("string").alias("text"))
    kind = StructType([*packed.schema.fields[:3], StructField("body", BinaryType())])
    packed = packed.mapInArrow(_packed, kind)
    joined = packed.join(ranges, ["own", "mark"], "left").select("row", "body", "ranges")
    found = "struct<n_bytes:bigint,n_removed:bigint,n_spans:bigint,kept_sha256:string,spans:array<struct<start:bigint,end:bigint>>,kept:binary>"
    schema = joined.select("row", F.lit(None).cast(found).alias("found")).schema

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, lambda x: x.column("body")):
            values = []
            for body, given in zip(batch.column("body").to_pylist(), batch.column("ranges").to_pylist()):
                data = _unpacked(body).tobytes()
                own = merged([(x["start"], x["end"]) for x in given or []])
                edges = [0, *(e for span in own for e in span), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2]))
                values.append(
                    {
                        "n_bytes": len(data),
                        "n_removed": len(data) - len(kept),
                        "n_spans": len(own),
                        "kept_sha256": hashlib.sha256(kept).hexdigest(),
                        "spans": [{"start": a, "end": b} for a, b in own],
                        "kept": kept if keep_bytes else None,
                    }
                )
            column = batch.column("row")
            kind = pa.struct([("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary())])
            yield pa.RecordBatch.from_arrays([column, pa.array(values, kind)], names=["row", "found"])

    return joined.mapInArrow(task, schema)
