"""Token ids in a seekable file: independent zstandard frames, a seek table, checksums.

A file holds the ids of documents as little-endian unsigned 32-bit integers, cut into
zstandard frames that can each be decompressed alone. Behind them come two skippable
frames, which plain zstandard readers ignore:

* document index: a compressed array of (doc_id, valid, number of ids), then its size;
* seek table as in the published zstandard seekable format: for each frame its
  compressed size, decompressed size and the low 32 bits of XXH64 of its content, then
  a nine-byte footer.

``write`` deals documents out by ranges of doc_id, so that files in order hold documents
in order; a task writes one file under a temporary name and renames it, so a task that is
run again replaces the same file. ``read_back`` opens each file in one task and keeps one
frame in memory; ``read_documents`` decompresses only the frames that hold what is asked.

Defined results: null text is empty (its one id is the end id); a null doc_id comes first;
rows with equal doc_id stay next to each other, in order of text; an empty table gives no
file and no row; extra input columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobtrend.llm.common import shared_folder, slices
from jobtrend.llm.tokens import CALL, default_tokenizer, encoder, with_end

#: Fixed values of the published formats.
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_FOOTER = 0x8F92EAB1
SKIPPABLE_INDEX = 0x184D2A50
CHECKSUMS = 0x80

#: A frame ends at the first document that brings it to so many ids; longer documents fill several.
FRAME_IDS = 1 << 16
LEVEL = 3


class DamagedFile(ValueError):
    pass


def open_folder(uri: str):
    """The Arrow file system of a Hadoop path, and the path in it."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "file://" + uri.removeprefix("file:").removeprefix("//")
    return fs.FileSystem.from_uri(uri)


class FrameWriter:
    """Writes documents to an open binary file."""

    def __init__(self, sink, frame_ids: int = FRAME_IDS):
        import zstandard

        self.sink, self.frame_ids = sink, frame_ids
        self.zstd = zstandard.ZstdCompressor(level=LEVEL)
        self.waiting: list[np.ndarray] = []
        self.held = 0
        self.frames: list[tuple[int, int, int]] = []
        self.documents: list[tuple[int, int, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.documents.append((doc_id or 0, doc_id is not None, len(ids)))
        for i in range(0, len(ids), self.frame_ids):
            part = ids[i : i + self.frame_ids]
            self.waiting.append(part)
            self.held += len(part)
            if self.held >= self.frame_ids:
                self._frame()

    def _frame(self) -> None:
        import xxhash

        raw = np.concatenate(self.waiting).astype("<u4").tobytes()
        packed = self.zstd.compress(raw)
        self.sink.write(packed)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.waiting, self.held = [], 0

    def finish(self) -> None:
        if self.waiting:
            self._frame()
        index = self.zstd.compress(np.array(self.documents, "<i8").tobytes())
        self.sink.write(struct.pack("<II", SKIPPABLE_INDEX, len(index) + 8) + index + struct.pack("<Q", len(index)))
        table = b"".join(struct.pack("<III", *x) for x in self.frames) + struct.pack("<IBI", len(self.frames), CHECKSUMS, SEEKABLE_FOOTER)
        self.sink.write(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(table)) + table)


class FrameReader:
    """Random access to a file of FrameWriter."""

    def __init__(self, source):
        import zstandard

        self.source, self.zstd = source, zstandard.ZstdDecompressor()
        end = source.size()
        frames, flags, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != SEEKABLE_FOOTER or flags != CHECKSUMS:
            raise DamagedFile("no seek table")
        table = end - 9 - 12 * frames
        self.frames = np.frombuffer(self._at(table, 12 * frames), "<u4").reshape(-1, 3).astype(np.int64)
        table -= 8
        (size,) = struct.unpack("<Q", self._at(table - 8, 8))
        self.index = np.frombuffer(self.zstd.decompress(self._at(table - 8 - size, size)), "<i8").reshape(-1, 3)
        self.place = np.concatenate([[0], np.cumsum(self.frames[:, 0])])
        self.id_place = np.concatenate([[0], np.cumsum(self.frames[:, 1] // 4)])
        self.start = np.concatenate([[0], np.cumsum(self.index[:, 2])])
        self.last: tuple[int, np.ndarray] = (-1, np.empty(0, "<u4"))

    def _at(self, place: int, size: int) -> bytes:
        self.source.seek(int(place))
        return self.source.read(int(size))

    def frame(self, k: int) -> np.ndarray:
        import xxhash

        if self.last[0] != k:
            raw = self.zstd.decompress(self._at(self.place[k], self.frames[k, 0]))
            if len(raw) != self.frames[k, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.frames[k, 2]:
                raise DamagedFile(f"frame {k} differs from its checksum")
            self.last = k, np.frombuffer(raw, "<u4")
        return self.last[1]

    def ids(self, document: int) -> np.ndarray:
        """The ids of the document with this number in the file."""
        a, b = self.start[document], self.start[document + 1]
        first, last = np.searchsorted(self.id_place, [a, max(a, b - 1)], side="right") - 1
        return np.concatenate([self.frame(k)[max(a - self.id_place[k], 0) : b - self.id_place[k]] for k in range(first, last + 1)])


def write(docs: DataFrame, folder: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> list[tuple[str, int, int]]:
    """Writes ``docs``; returns (file, documents, ids) in order of doc_id, one entry a file."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = f"part-{TaskContext.get().partitionId():06d}.zst"
        encode = encoder(tokenizer).encode_column
        writer = None
        for batch in slices(batches, lambda x: x.column("text"), *CALL):
            if writer is None:
                store, path = open_folder(folder)
                store.create_dir(path, recursive=True)
                sink = store.open_output_stream(own := f"{path}/.{name}-{TaskContext.get().taskAttemptId()}")
                writer = FrameWriter(sink)
            ids, begins = with_end(*encode(batch.column("text")))
            for k, a, b in zip(batch.column("doc_id").to_pylist(), begins, begins[1:]):
                writer.add(k, ids[a:b])
        if writer is not None:
            writer.finish()
            sink.close()
            store.move(own, f"{path}/{name}")
            total = int(sum(x[2] for x in writer.documents))
            yield pa.RecordBatch.from_pydict({"file": [name], "documents": [len(writer.documents)], "ids": [total]})

    dealt = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    # one small row a file
    return [tuple(x) for x in sorted(dealt.mapInArrow(task, "file string, documents long, ids long").collect())]


def read_back(spark, folder: str, files: list[tuple[str, int, int]]) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not files:
        return spark.createDataFrame([], schema)
    starts = np.cumsum([0, *(x[2] for x in files)])[:-1].tolist()
    listed = spark.createDataFrame([(x[0], s) for x, s in zip(files, starts)], "file string, base long")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_folder(folder)
        for batch in batches:
            for name, base in zip(*(x.to_pylist() for x in batch.columns)):
                with store.open_input_file(f"{path}/{name}") as source:
                    reader = FrameReader(source)
                    for i in range(0, len(reader.index), 4096):
                        part = reader.index[i : i + 4096]
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(part[:, 0], mask=part[:, 1] == 0),
                                pa.array(base + reader.start[i : i + len(part)]),
                                pa.array(part[:, 2]),
                                pa.array([zlib.crc32(reader.ids(k).tobytes()) for k in range(i, i + len(part))], pa.int64()),
                            ],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"],
                        )

    return listed.repartition(len(files)).mapInArrow(task, schema)


def read_documents(folder: str, file: str, numbers: list[int]) -> dict[int, np.ndarray]:
    """The ids of some documents of one file, by their numbers in it."""
    store, path = open_folder(folder)
    with store.open_input_file(f"{path}/{file}") as source:
        reader = FrameReader(source)
        return {k: reader.ids(k) for k in numbers}


def encode_and_read(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    folder = shared_folder(docs.sparkSession, "token-files")
    return read_back(docs.sparkSession, folder, write(docs, folder, tokenizer or default_tokenizer()))
