"""Byte-pair encoding with a priority queue over a linked list of symbols, and decoding.

A word is a doubly linked list of symbols. A heap holds a merge rank and a place for each neighbouring pair that can be
merged; the best pair, of equal ones the leftmost, is taken out and merged, and its two new neighbours are put in. Entries
are never removed: one is stale, and skipped, if the pair at its place has another rank by now. So a word of
n symbols takes O(n log n) steps, however long it is. Texts are cut into words, and words are kept, as ``tokens``
describes. Ids are decoded by concatenating the bytes of their vocabulary strings.

Defined results: null text is empty and has no ids; an empty table gives no rows; rows come back one for one, the columns
to keep inside ``row``; texts of added tokens get their ids; ids that are null, or unknown to the
vocabulary, decode to nothing; bytes that are no UTF-8 decode to U+FFFD; null ids decode to an empty text.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from jobtrend.llm.common import process_cache, slices, whole_row
from jobtrend.llm.tokens import CALL, TextEncoder, byte_symbols, default_tokenizer, is_byte_level


class Vocabulary:
    """Symbols, merges and strings of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            described = json.load(f)
        if not is_byte_level(described):
            raise ValueError(f"{path} is not a plain byte-level BPE file")
        model = described["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.rank: dict[int, int] = {}
        self.made: list[int] = []
        for k, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.rank[self.ids[a] << 32 | self.ids[b]] = k
            self.made.append(self.ids[a + b])
        self.special = {x["content"]: x["id"] for x in described.get("added_tokens", [])}
        byte = {x: b for b, x in enumerate(byte_symbols())}
        strings = {k: x for x, k in (self.ids | self.special).items()}
        self.strings = np.full(max(strings) + 2, b"", object)  # the last one stands for unknown ids
        for k, x in strings.items():
            self.strings[k] = bytes(byte[c] for c in x) if all(c in byte for c in x) else x.encode()

    def word(self, symbols: str) -> list[int]:
        """The ids of one word, written in byte symbols."""
        n = len(symbols)
        here = [*map(self.ids.__getitem__, symbols), -1]  # -1 is no symbol and has no pairs
        if n < 2:
            return here[:n]
        rank = self.rank.get
        after, before = [*range(1, n + 1), n], [*range(-1, n)]
        queue = [r << 32 | k for k in range(n - 1) if (r := rank(here[k] << 32 | here[k + 1])) is not None]
        heapq.heapify(queue)
        while queue:
            entry = heapq.heappop(queue)
            k, merge = entry & 0xFFFFFFFF, entry >> 32
            gone = after[k]
            if here[k] < 0 or rank(here[k] << 32 | here[gone]) != merge:
                continue  # stale
            here[k] = new = self.made[merge]
            here[gone] = -1
            after[k] = right = after[gone]
            before[right] = k
            if (r := rank(new << 32 | here[right])) is not None:
                heapq.heappush(queue, r << 32 | k)
            left = before[k]
            if left >= 0 and (r := rank(here[left] << 32 | new)) is not None:
                heapq.heappush(queue, r << 32 | left)
        return [x for x in here if x >= 0]

    def encoder(self, path: str) -> TextEncoder:
        from tokenizers import Tokenizer

        # only text with characters newer than this Python's Unicode tables is cut into words by the library
        cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        return TextEncoder(lambda words: [*map(self.word, words)], self.special, lambda text: [text[a:b] for _, (a, b) in cut(text)])

    def text(self, ids: np.ndarray) -> str:
        known = (ids >= 0) & (ids < len(self.strings) - 1)
        return b"".join(self.strings[np.where(known, ids, len(self.strings) - 1)].tolist()).decode("utf-8", "replace")


def vocabulary(path: str) -> tuple[Vocabulary, TextEncoder]:
    """This worker's vocabulary and encoder of a file."""
    kept = process_cache()
    if ("bpe", path) not in kept:
        found = Vocabulary(path)
        kept["bpe", path] = found, found.encoder(path)
    return kept["bpe", path]


def encode(docs: DataFrame, tokenizer: str | None = None, text: str = "text", keep: list[str] | None = None, decoded: bool = False) -> DataFrame:
    """``row`` (the columns to keep) and ``ids`` of every text; with ``decoded`` also ``text``, decoded from the ids in the same task."""
    path = tokenizer or default_tokenizer()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, encoder = vocabulary(path)
        for batch in slices(batches, lambda x: x.column("body"), *CALL):
            ids, begins = encoder.encode_column(batch.column("body"))
            columns = [batch.column("row"), pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(ids, pa.int32()))]
            if decoded:
                columns.append(pa.array([known.text(ids[a:b]) for a, b in zip(begins, begins[1:])], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["row", "ids", "text"][: len(columns)])

    given = docs.select(whole_row(docs, keep).alias("row"), F.col(text).cast("string").alias("body"))
    fields = [given.schema["row"], StructField("ids", ArrayType(IntegerType())), StructField("text", StringType())]
    return given.mapInArrow(task, StructType(fields if decoded else fields[:2]))


def decode(encoded: DataFrame, tokenizer: str | None = None, ids: str = "ids") -> DataFrame:
    """The columns of ``encoded`` inside ``row``, and the ``text`` of its ids."""
    path = tokenizer or default_tokenizer()

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, _ = vocabulary(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                lists = batch.column("given")
                flat = lists.flatten().fill_null(-1).to_numpy()
                ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
                texts = [found.text(flat[a:b]) for a, b in zip([0, *ends[:-1]], ends)]
                yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])

    given = encoded.select(whole_row(encoded).alias("row"), F.col(ids).cast("array<int>").alias("given"))
    return given.mapInArrow(task, StructType([given.schema["row"], StructField("text", StringType())]))
