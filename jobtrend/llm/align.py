"""Alignment of the tokens of two tokenizers over the same texts.

Every token covers bytes of its text. In a batch, pandas ``merge_asof``, keyed by document, gives each token start
of one side the other side's token that covers it; both directions together are all pairs of tokens that overlap. Pairs
that end together are links, and their ends cut the tokens of both sides into groups, the smallest parts that
both tokenizers agree on. Long texts are merged in blocks that end where a token of each side ends, so memory is bounded by
the text and its ids.

How often an id pair is linked in the whole corpus is counted in Spark. A document's links then meet their
counts: pairs with at least one of HOT_PAIRS parts of all links (so at most HOT_PAIRS pairs) by a broadcast table, all
others by an exchange, in which none of them can be hot.

Defined results: null and empty texts, and texts that the joined tokens of a side do not give back (a piece vocabulary has
no U+2581 of its own), have no tokens: zeros, and an empty string of groups; rows come back one for one, rows that
repeat or share a doc_id (null, too) stay apart; an empty table gives no rows; extra input columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtrend.llm.bpe import vocabulary
from jobtrend.llm.common import process_cache, slices, utf8_buffer, written
from jobtrend.llm.tokens import default_tokenizer, encoder

#: Rows and bytes of text of one call, and bytes of text that are merged at once.
CALL, BLOCK = (1 << 16, 1 << 21), 1 << 19
#: Pairs that go to a broadcast table at most.
HOT_PAIRS = 1 << 16
FOUND = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<int>"


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """A sentencepiece model: ids of texts, and the bytes of its pieces."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.strings = np.empty(self.model.get_piece_size(), object)
        for k in range(len(self.strings)):
            piece = self.model.id_to_piece(k)
            self.strings[k] = bytes([int(piece[3:-1], 16)]) if self.model.is_byte(k) else piece.replace("▁", " ").encode()

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = [np.array(x, np.int32) for x in self.model.encode([x or "" for x in texts.to_pylist()], num_threads=1)]
        return np.concatenate([*found, np.empty(0, np.int32)]), np.cumsum([0, *map(len, found)])


def pieces(path: str) -> Pieces:
    kept = process_cache()
    if ("pieces", path) not in kept:
        kept["pieces", path] = Pieces(path)
    return kept["pieces", path]


def overlaps(doc_a: np.ndarray, start_a: np.ndarray, doc_b: np.ndarray, start_b: np.ndarray) -> pd.DataFrame:
    """Pairs (a, b) of numbers of tokens that share bytes. Both sides cover the same bytes, starts ascend."""
    a = pd.DataFrame({"doc": doc_a, "start": start_a, "a": np.arange(len(start_a))})
    b = pd.DataFrame({"doc": doc_b, "start": start_b, "b": np.arange(len(start_b))})
    forth, back = pd.merge_asof(a, b, on="start", by="doc"), pd.merge_asof(b, a, on="start", by="doc")
    # equal starts are found both ways
    back = back[start_a[back["a"].to_numpy()] != start_b]
    return pd.concat([forth[["a", "b"]], back[["a", "b"]]], ignore_index=True)


class Side:
    """The tokens of one tokenizer for the texts of a call; bytes are counted over all of them."""

    def __init__(self, ids: np.ndarray, begins: np.ndarray, strings: np.ndarray):
        self.ids, self.strings = ids, strings
        self.size = np.fromiter(map(len, strings), np.int64, len(strings))[ids]
        self.doc = np.repeat(np.arange(len(begins) - 1), np.diff(begins))

    def gives(self, data: bytes, offsets: np.ndarray) -> np.ndarray:
        """Which texts the joined tokens give back."""
        joined = b"".join(self.strings[self.ids].tolist())
        ends = np.cumsum(np.bincount(self.doc, self.size, len(offsets) - 1).astype(np.int64))
        if joined == data and (ends == offsets[1:]).all():
            return np.ones(len(ends), bool)
        return np.array([joined[a:b] == data[c:d] for a, b, c, d in zip([0, *ends[:-1]], ends, offsets, offsets[1:])], bool)

    def only(self, good: np.ndarray) -> None:
        keep = good[self.doc]
        self.ids, self.size, self.doc = self.ids[keep], self.size[keep], self.doc[keep]
        self.end = np.cumsum(self.size)
        self.start = self.end - self.size


def linked(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the tokens that are linked, in order."""
    common = np.intersect1d(a.end, b.end, assume_unique=True)
    found_a, found_b, at = [], [], 0
    while at < (common[-1] if len(common) else 0):
        to = common[min(np.searchsorted(common, at + BLOCK), len(common) - 1)]
        (a0, a1), (b0, b1) = (np.searchsorted(x.start, [at, to]) for x in (a, b))
        pairs = overlaps(a.doc[a0:a1], a.start[a0:a1], b.doc[b0:b1], b.start[b0:b1])
        i, j = pairs["a"].to_numpy() + a0, pairs["b"].to_numpy() + b0
        same = a.end[i] == b.end[j]
        order = np.argsort(i[same])
        found_a.append(i[same][order])
        found_b.append(j[same][order])
        at = to
    none = np.empty(0, np.int64)
    return np.concatenate([*found_a, none]), np.concatenate([*found_b, none])


def _names(n: int) -> np.ndarray:
    """Texts of ids behind which a comma, a bar or a semicolon follows."""
    kept = process_cache()
    if ("names", n) not in kept:
        kept["names", n] = np.array([f"{k}{mark}" for mark in ",|;" for k in range(n)], object)
    return kept["names", n]


def group_texts(a: Side, b: Side, ends: np.ndarray, n_docs: int) -> list[str]:
    """For each text its groups: ids of a, a bar, ids of b; groups apart by semicolons."""
    group_a, group_b = np.searchsorted(ends, a.end), np.searchsorted(ends, b.end)
    in_a, in_b = np.bincount(group_a, minlength=len(ends)), np.bincount(group_b, minlength=len(ends))
    parts = np.empty(len(a.ids) + len(b.ids), object)
    for side, group, place, mark in ((a, group_a, (np.cumsum(in_b) - in_b)[group_a], 1), (b, group_b, np.cumsum(in_a)[group_b], 2)):
        last = np.append(group[1:] != group[:-1], True)[: len(group)]
        names = _names(len(side.strings))
        parts[np.arange(len(group)) + place] = names[side.ids + len(side.strings) * np.where(last, mark, 0)]
    sizes = np.bincount(a.doc, minlength=n_docs) + np.bincount(b.doc, minlength=n_docs)
    bounds = np.cumsum([0, *sizes])
    return ["".join(parts[x:y].tolist())[:-1] for x, y in zip(bounds, bounds[1:])]


def align(docs: DataFrame, tokenizer: str | None = None, piece_model: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """For each row the numbers of tokens, groups and links, its groups as text, and its linked id pairs (a * 2^32 + b) with how often."""
    path_a, path_b = tokenizer or default_tokenizer(), piece_model or default_pieces()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blank, none = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
        encode_a, strings_a, model_b = encoder(path_a, special=False), vocabulary(path_a)[0].strings, pieces(path_b)
        for batch in slices(batches, lambda x: x.column("text"), *CALL):
            n = batch.num_rows
            texts = batch.column("text").cast(pa.large_string()).fill_null("")
            some = pc.greater(pc.binary_length(texts), 0)
            spaced = pc.if_else(some, pc.binary_join_element_wise(blank, texts, none), "")
            data, offsets = utf8_buffer(spaced)
            a, b = Side(*encode_a.encode_column(spaced), strings_a), Side(*model_b.encode_column(texts), model_b.strings)
            whole = data.tobytes()
            good = some.to_numpy(zero_copy_only=False) & a.gives(whole, offsets) & b.gives(whole, offsets)
            a.only(good)
            b.only(good)
            i, j = linked(a, b)
            doc = a.doc[i]
            pair = a.ids[i].astype(np.int64) << 32 | b.ids[j]
            order = np.lexsort((pair, doc))
            doc_at, pair = doc[order], pair[order]
            first = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (doc_at[1:] != doc_at[:-1]))[: len(pair)])
            bounds = pa.array(np.searchsorted(doc_at[first], np.arange(n + 1)), pa.int32())
            times = np.diff(np.append(first, len(pair)))
            count = lambda x: pa.array(np.bincount(x, minlength=n), pa.int64())
            columns = [batch.column("doc_id"), count(a.doc), count(b.doc), count(doc), count(doc), pa.array(group_texts(a, b, a.end[i], n), pa.string())]
            columns += [pa.ListArray.from_arrays(bounds, pa.array(pair[first])), pa.ListArray.from_arrays(bounds, pa.array(times, pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in FOUND.split(", ")])

    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return given.mapInArrow(task, FOUND)


def pair_counts(pairs: DataFrame) -> DataFrame:
    """pair, n (links of the corpus that hold it) and best (whether none of its b id has more), from (pair, times)."""
    counts = written(pairs.groupBy("pair").agg(F.sum("times").alias("n")), "pair-counts")
    b = F.col("pair").bitwiseAND(0xFFFFFFFF)
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return written(counts.withColumn("b", b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "best-pairs")


def with_counts(found: DataFrame) -> DataFrame:
    """``found`` (from align) with n_best and count_sum in place of its pairs."""
    rows = written(found.withColumn("number", F.monotonically_increasing_id()), "aligned")
    links = rows.select("number", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select("number", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    counts = pair_counts(links)
    total = counts.agg(F.sum("n")).first()[0] or 0  # one number
    often = F.col("n") * HOT_PAIRS >= total
    hot = F.broadcast(counts.where(often))
    share = lambda x: x.groupBy("number").agg(F.sum(F.when(F.col("best"), F.col("times"))).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    cold = links.join(hot.select("pair"), "pair", "left_anti").join(counts.where(~often).hint("merge"), "pair")
    sums = share(links.join(hot, "pair")).union(share(cold)).groupBy("number").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    none = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return rows.drop("pairs", "times").join(sums, "number", "left").select(*(c for c in rows.columns if c not in ("number", "pairs", "times")), none("n_best"), none("count_sum"))
