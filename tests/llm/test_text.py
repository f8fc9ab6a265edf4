"""Words, token ids, token files, packing, decontamination."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from jobtrend.llm import decontaminate, packing, token_store
from jobtrend.llm import tokens as T
from jobtrend.llm.common import Words

from tests.llm.helpers import odd_documents, prose, words

ODD_TEXTS = [
    None, "", " ", "a", "A B", "don't  stop's", "<|endoftext|> x<|endoftext|>", "tab\tnew\nline \n x", "Ünïcödé 漢字 １２ ²", "a\x1cb\x85c", "x" * 3000, "1.2,3;4",
]


def test_words_follow_the_pattern():
    rng = random.Random(1)
    texts = ODD_TEXTS + ["".join(rng.choice("aB1 .,é漢\n-_") for _ in range(rng.randint(0, 60))) for _ in range(500)]
    got = Words(pa.array(texts, pa.string()))
    want = [words(t) for t in texts]
    assert got.counts.tolist() == [len(w) for w in want]
    assert [bytes(got.norm[a:b]).decode() for a, b in zip(got.start, got.end)] == [x for w in want for x in w]
    by_hash = {}
    for h, x in zip(got.hash.tolist(), [x for w in want for x in w]):
        assert by_hash.setdefault(h, x) == x
    assert Words(pa.array([], pa.string())).counts.tolist() == []


LIBRARY = Tokenizer.from_file(T.default_tokenizer())
#: Characters around which the word pattern turns; the last letter is newer than this Python's Unicode tables.
EDGES = ["a", "b", "s", "l", "L", "'", " ", "  ", "\n", "\t", "\r\n", "1", "²", "é", "漢", "\u3000", "\xa0", "!", "-", "\u0301", "'s", "'re", "'ll", "’s", "😀", "<|endoftext|>", "\u200b", "\x1c", "\x85", "٣", "\U00010940"]


@pytest.mark.parametrize("kept, part, special", [(10**6, 1 << 22, True), (20, 1 << 22, True), (20, 40, True), (10**6, 1 << 22, False)])
def test_ids_equal_those_of_whole_texts(monkeypatch, kept, part, special):
    monkeypatch.setattr(T, "KEPT_WORDS", kept)
    monkeypatch.setattr(T, "PART", part)
    cache: dict = {}
    monkeypatch.setattr(T, "process_cache", lambda: cache)
    encoder = T.encoder(T.default_tokenizer(), special)
    LIBRARY.encode_special_tokens = not special
    rng = random.Random(2)
    texts = [t or "" for t in ODD_TEXTS] + ["".join(rng.choice(EDGES) for _ in range(rng.randrange(60))) for _ in range(3000)]
    try:
        for i in range(0, len(texts), 100):
            for text, ids in zip(texts[i : i + 100], encoder.encode(texts[i : i + 100])):
                assert ids.tolist() == LIBRARY.encode(text, add_special_tokens=False).ids, text
    finally:
        LIBRARY.encode_special_tokens = False
    assert len(encoder.kept.young) <= kept and len(encoder.kept.old) <= kept
    assert encoder.encode([]) == [] and encoder.encode_column(pa.array([None], pa.string()))[1].tolist() == [0, 0]


def test_other_tokenizer_files_are_used_whole():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = ["Hello  World", "", "x<|endoftext|>y"]
    assert [x.tolist() for x in T.encoder(path).encode(texts)] == [x.ids for x in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


def _ids(text):
    return np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2], "<u4")


def test_token_files_round_trip(spark):
    texts = [(k, t) for k, t in enumerate(ODD_TEXTS)] + [(100, prose(1, 30_000)), (7, "again"), (None, "no id"), (50, "same"), (50, "same")]
    docs = odd_documents(spark, texts).repartition(3)
    folder = token_store.shared_folder(spark, "test-tokens")
    files = token_store.write(docs, folder, T.default_tokenizer())
    got = [tuple(r) for r in token_store.read_back(spark, folder, files).collect()]
    want = sorted(texts, key=lambda x: (x[0] is not None, x[0] or 0, x[1] is not None, x[1] or ""))
    ids = [_ids(t) for _, t in want]
    starts = np.cumsum([0, *map(len, ids)])
    assert sorted(got, key=lambda r: r[1]) == [(k, int(s), len(i), zlib.crc32(i.tobytes())) for (k, _), s, i in zip(want, starts, ids)]
    # random access decompresses the frames of a document only, and any two of a file can be had
    flat = [(f, k) for f, n, _ in files for k in range(n)]
    for (file, number), expected in zip(flat, ids):
        assert token_store.read_documents(folder, file, [number])[number].tolist() == expected.tolist()
    assert token_store.encode_and_read(docs.limit(0)).count() == 0


def test_frames_are_independent_and_checked(tmp_path):
    import io

    import zstandard

    sink = io.BytesIO()
    writer = token_store.FrameWriter(sink, frame_ids=100)
    rng = np.random.default_rng(3)
    documents = [rng.integers(0, 50_000, n).astype(np.int32) for n in (0, 5, 99, 100, 101, 950, 1, 40)]
    for k, ids in enumerate(documents):
        writer.add(k if k != 3 else None, ids)
    writer.finish()
    raw = sink.getvalue()
    # a plain zstandard reader sees the ids back to back and skips the rest
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    assert plain[: 4 * sum(map(len, documents))] == b"".join(d.astype("<u4").tobytes() for d in documents)

    class Source(io.BytesIO):
        def size(self):
            return len(self.getvalue())

    reader = token_store.FrameReader(Source(raw))
    for k in (7, 0, 5, 3, 1):
        assert reader.ids(k).tolist() == documents[k].tolist()
    assert reader.index[3].tolist() == [0, 0, 100]
    broken = bytearray(raw)
    broken[10] ^= 0xFF
    with pytest.raises(Exception):
        token_store.FrameReader(Source(bytes(broken))).ids(1)
    reader = token_store.FrameReader(Source(raw))
    reader.frames[:, 2] ^= 1
    with pytest.raises(token_store.DamagedFile):
        reader.ids(1)
    with pytest.raises(token_store.DamagedFile):
        token_store.FrameReader(Source(raw[:-1] + b"\0"))


def _check_packing(lengths, sequence, offset, n, capacity):
    assert set(sequence.tolist()) == set(range(n))
    for s in range(n):
        own = np.flatnonzero(sequence == s)
        own = own[np.argsort(offset[own])]
        assert offset[own].tolist() == (np.cumsum(lengths[own]) - lengths[own]).tolist()
        assert lengths[own].sum() <= capacity


def test_best_two_fit():
    # greedy fills 60 + 30; the smallest, 30, gives way to 25 + 15, which fill the gap of 40
    lengths = np.array([60, 30, 25, 15])
    sequence, offset, n = packing.best_two_fit(lengths, 100)
    assert sequence[0] == sequence[2] == sequence[3] != sequence[1] and n == 2
    rng = np.random.default_rng(4)
    for capacity in (1, 7, 100, 1024):
        for size in (0, 1, 5, 400):
            lengths = rng.integers(1, capacity + 1, size)
            sequence, offset, n = packing.best_two_fit(lengths, capacity)
            _check_packing(lengths, sequence, offset, n, capacity)
            assert n >= lengths.sum() / capacity
    lengths = rng.integers(1, 1025, 5000)
    _, _, n = packing.best_two_fit(lengths, 1024)
    assert n <= 1.02 * lengths.sum() / 1024
    assert packing.best_two_fit(np.array([50, 50, 50]), 100)[2] == 2


def test_pack_pieces(spark, monkeypatch):
    monkeypatch.setattr(packing, "PACK_PIECES", 8)
    texts = [(k, t) for k, t in enumerate(ODD_TEXTS)] + [(100, prose(1, 2000)), (None, "no id"), (50, "same"), (50, "same")]
    got = packing.pack(odd_documents(spark, texts).repartition(2), capacity=64).collect()
    want = {}
    for k, t in texts:
        ids = _ids(t)
        points = packing.cut_points(len(ids), 64)
        for p, (a, b) in enumerate(zip(points, points[1:])):
            want.setdefault((k, p, a, b - a, zlib.crc32(ids[a:b].tobytes())), []).append(1)
            assert b - a == 64 or p == 0
    have = {}
    for r in got:
        have.setdefault(tuple(r)[:5], []).append(1)
    assert have == want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *(n for _, n in parts)])[:-1].tolist() and sum(n for _, n in parts) <= 64
    assert packing.pack(odd_documents(spark, texts).limit(0)).count() == 0


def _contamination(texts, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = []
    for k, text in texts:
        w = words(text)
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (own := windows.get(tuple(w[i : i + n]))) is not None:
                    hit.update(range(i, i + n))
                    found |= own
        out.append((k, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_decontamination_equals_brute_force(spark, block_bytes):
    rng = random.Random(6)
    vocabulary = [f"v{i}" for i in range(12)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 12, 13, 14, 30])))) for k in range(12)]
    items += [(90, None), (91, ""), (92, "One, TWO"), (93, items[4][1]), (4, items[4][1])]
    texts = [(0, None), (1, ""), (2, items[3][1].upper()), (3, "x " + items[4][1] + " y " + prose(3, 400)), (4, items[4][1][:-1]), (5, "one... two one two")]
    texts += [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 700)))) for k in range(10, 30)]
    texts += [(2, items[3][1].upper()), (None, prose(4, 3000) + " " + items[7][1])]
    docs = odd_documents(spark, texts)
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumnRenamed("item_id", "row")
    marked = decontaminate.mark(docs, benchmark, item_id="row", block_bytes=block_bytes)
    got = [(r.row.doc_id, r.found.n_words, r.found.n_hit, sorted(r.found["items"]), r.found.contaminated) for r in marked.collect()]
    key = lambda r: (str(r[0]), *map(str, r[1:]))
    assert sorted(got, key=key) == sorted(_contamination(texts, items), key=key)
    assert marked.select("row.*").columns == docs.columns
    assert all(not r.found.contaminated for r in decontaminate.mark(docs, benchmark.limit(0), item_id="row").collect())
    assert decontaminate.mark(docs.limit(0), benchmark, item_id="row").count() == 0


def test_packing_joins_documents_of_different_splits(spark):
    """Documents sorted by length, each split with one length only: they fill each other's gaps."""
    texts = [(k, "a " * 60) for k in range(40)] + [(k, "a " * 40) for k in range(40, 80)]
    tokens = {k: len(_ids(t)) for k, t in texts}
    capacity = tokens[0] + tokens[40]
    assert 2 * tokens[0] > capacity  # of the longer ones no two share a sequence
    docs = odd_documents(spark, texts).repartitionByRange(2, "doc_id").sortWithinPartitions("doc_id")
    got = packing.pack(docs, capacity=capacity).collect()
    assert len(got) == 80 and len({r.sequence_id for r in got}) == 40
    # the same sequences whatever the layout of the input
    places = sorted((r.doc_id, r.sequence_id, r.offset) for r in got)
    again = packing.pack(odd_documents(spark, texts[::-1]).repartition(5), capacity=capacity).collect()
    assert sorted((r.doc_id, r.sequence_id, r.offset) for r in again) == places


def test_dealt_packing_stays_near_one_pack_of_all(spark, monkeypatch):
    monkeypatch.setattr(packing, "DEAL_PIECES", 200)
    rng = random.Random(8)
    texts = sorted(((k, "a " * rng.randint(1, 120)) for k in range(2000)), key=lambda x: len(x[1]))
    lengths = np.array([len(_ids(t)) for _, t in texts])
    docs = odd_documents(spark, texts).repartitionByRange(8, "n_chars").sortWithinPartitions("n_chars")
    got = packing.pack(docs, capacity=128).collect()
    assert sorted(r.length for r in got) == sorted(lengths.tolist())
    assert len({r.sequence_id >> 40 for r in got}) > 5
    assert len({r.sequence_id for r in got}) <= 1.05 * packing.best_two_fit(lengths, 128)[2]


@pytest.mark.parametrize("block_bytes", [1 << 20, 100])
def test_items_without_an_id_hit_too(spark, block_bytes):
    items = [(None, prose(1, 20)), (None, "one two"), (1, prose(2, 15)), (2, prose(3, 13)), (None, prose(3, 13))]
    texts = [(1, prose(1, 20)), (2, "x one, TWO y"), (3, prose(2, 15) + " . " + prose(1, 14)), (4, prose(3, 13)), (5, prose(4, 50)), (6, None)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    marked = decontaminate.mark(odd_documents(spark, texts), benchmark, block_bytes=block_bytes)
    got = sorted((r.row.doc_id, r.found.n_hit, r.found["items"], r.found.contaminated) for r in marked.collect())
    assert got == [(1, 20, [], True), (2, 2, [], True), (3, 29, ["1"], True), (4, 13, ["2"], True), (5, 0, [], False), (6, 0, [], False)]


def test_items_without_an_id_as_in_sql(spark, tmp_path):
    import duckdb

    from jobtrend.llm.queries import ORACLE, QUERIES

    texts = [(1, prose(1, 20)), (2, "x one, TWO y"), (3, prose(2, 15)), (4, "none")]
    odd_documents(spark, texts).select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(None, prose(1, 20)), (None, "one two"), (1, prose(2, 15))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    df = QUERIES["op5_decontamination"](spark, str(tmp_path))
    want = con.sql(f"select {', '.join(df.columns)} from ({ORACLE['op5_decontamination']})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want)


def test_blocks_of_windows_have_a_byte_bound(spark, monkeypatch):
    """What the driver collects and sends for a pass is bounded by bytes of windows, not of benchmark text."""
    sent = []
    whole = decontaminate.searches
    monkeypatch.setattr(decontaminate, "searches", lambda *x: sent.append(whole(*x)) or sent[-1])
    items = [(k, prose(k, 100)) for k in range(20)]
    texts = [(k, prose(k, 100)) for k in range(20)] + [(50, prose(50, 100))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    limit = 100_000
    assert sum(len(t) for _, t in items) < limit
    marked = decontaminate.mark(odd_documents(spark, texts), benchmark, block_bytes=limit).collect()
    assert sorted((r.row.doc_id, r.found.n_hit, r.found["items"]) for r in marked) == [(k, 100 * (k < 20), [str(k)] * (k < 20)) for k, _ in texts]
    size = lambda x: x.nbytes if isinstance(x, pa.Array) else sum(map(len, x))
    assert len(sent) > 1 and all(sum(size(s.strings) for s in found) <= limit for found in sent)


def test_a_window_of_very_many_items_is_spread(spark):
    text = prose(70, 13)
    n = 100_000
    benchmark = spark.range(n).selectExpr("concat('item', id) AS item_id", f"'{text}' AS text").union(spark.createDataFrame([(None, text), ("other", prose(71, 14))], "item_id string, text string"))
    cut = decontaminate.windows_of(benchmark.selectExpr("item_id AS item", "text"))
    rows = decontaminate.grouped(cut).collect()
    sizes = [len(r["items"]) for r in rows]
    assert sum(sizes) == n + 2 and max(sizes) < 2 * decontaminate.PIECE_ITEMS and len(sizes) > n / decontaminate.PIECE_ITEMS
    docs = odd_documents(spark, [(1, "before " + text + " after"), (2, prose(72, 50))])
    for block_bytes in (decontaminate.BLOCK_BYTES, 2 << 20):
        found = {r.row.doc_id: r.found for r in decontaminate.mark(docs, benchmark, block_bytes=block_bytes).collect()}
        assert found[1].n_hit == 13 and found[1]["items"] == sorted(f"item{k}" for k in range(n)) and not found[2]["items"]
