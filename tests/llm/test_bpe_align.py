"""Byte-pair encoding, decoding and alignment against the libraries and a plain restatement."""

from __future__ import annotations

import hashlib
import random
import time
from collections import Counter

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from jobtrend.llm import align, bpe
from jobtrend.llm.queries import QUERIES
from jobtrend.llm.tokens import byte_symbols, default_tokenizer

from tests.conftest import SF_SMALL
from tests.llm.helpers import odd_documents
from tests.llm.test_llm_queries import _documents
from tests.llm.test_text import EDGES, ODD_TEXTS

LIBRARY = Tokenizer.from_file(default_tokenizer())


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _random_texts(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choice([*EDGES, "▁", "the", "ing", "\x00"]) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_words_are_merged_as_the_library_does():
    vocabulary, _ = bpe.vocabulary(default_tokenizer())
    rng = random.Random(4)
    symbols = byte_symbols()
    words = ["".join(rng.choice("abehinorstuĠ") for _ in range(rng.randrange(1, 25))) for _ in range(3000)]
    words += ["".join(rng.choice(symbols) for _ in range(rng.randrange(1, 12))) for _ in range(2000)] + ["", "a", "Ġ" * 100, "-" * 333]
    for word in words:
        assert vocabulary.word(word) == [x.id for x in LIBRARY.model.tokenize(word)], word


def test_long_words_take_no_quadratic_time():
    vocabulary, _ = bpe.vocabulary(default_tokenizer())
    rng = random.Random(5)
    word = "".join(rng.choice("etaoinshr") for _ in range(400_000))
    began = time.time()
    ids = vocabulary.word(word)
    assert time.time() - began < 60
    assert b"".join(vocabulary.strings[ids]).decode() == word


def test_encode_and_decode_equal_the_library(spark):
    texts = [*enumerate(ODD_TEXTS), (50, "same"), (50, "same"), (None, "no id"), *enumerate(_random_texts(6, 400), 100)]
    got = bpe.decode(bpe.encode(odd_documents(spark, texts), keep=["doc_id", "row", "a.b"])).collect()
    assert sorted(((r.row.row.doc_id, r.row.ids, r.text) for r in got), key=str) == sorted(
        ((k, (e := LIBRARY.encode(t or "", add_special_tokens=False)).ids, LIBRARY.decode(e.ids, skip_special_tokens=False)) for k, t in texts), key=str
    )
    assert all(r.row.row.row == "r" for r in got)
    both = bpe.encode(odd_documents(spark, texts), decoded=True).collect()
    assert sorted(((r.row.doc_id, r.ids, r.text) for r in both), key=str) == sorted(((r.row.row.doc_id, r.row.ids, r.text) for r in got), key=str)
    assert bpe.decode(bpe.encode(odd_documents(spark, []))).collect() == []


def test_any_ids_decode_as_the_library_does(spark):
    rng = random.Random(7)
    lists = [[rng.randrange(50257) for _ in range(rng.randrange(12))] for _ in range(500)] + [[50256, 1, 50256]]
    got = bpe.decode(spark.createDataFrame([(k, x) for k, x in enumerate(lists)], "k int, ids array<int>")).collect()
    assert {r.row.k: r.text for r in got} == {k: LIBRARY.decode(x, skip_special_tokens=False) for k, x in enumerate(lists)}
    odd = bpe.decode(spark.createDataFrame([(None,), ([None, 64, -5, 10**9],)], "ids array<int>")).collect()
    assert sorted(r.text for r in odd) == ["", LIBRARY.decode([64])]


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))


def test_bpe_query(spark):
    want = []
    for k, text in _documents():
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        want.append((k, len(ids), _sha(",".join(map(str, ids))), _sha(LIBRARY.decode(ids, skip_special_tokens=False))))
    assert sorted(tuple(r) for r in QUERIES["op12_bpe"](spark, SF_SMALL).collect()) == sorted(want)


def _aligned(texts):
    """The contract, restated with loops over single tokens."""
    plain = Tokenizer.from_file(default_tokenizer())
    plain.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=align.default_pieces())
    byte = {c: b for b, c in enumerate(byte_symbols())}
    strings_a = {k: bytes(byte[c] for c in x) for x, k in plain.get_vocab(with_added_tokens=False).items()}
    rows, counts = [], Counter()
    for k, text in texts:
        whole = (" " + (text or "")).encode()
        a = plain.encode(" " + text, add_special_tokens=False).ids if text else []
        b = pieces.encode(text) if text else []
        bytes_a = [strings_a[x] for x in a]
        bytes_b = [bytes([int(p[3:-1], 16)]) if pieces.is_byte(x) else p.replace("▁", " ").encode() for x, p in ((x, pieces.id_to_piece(x)) for x in b)]
        if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            a, b, bytes_a, bytes_b = [], [], [], []
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        groups, links, i, j = [], [], 0, 0
        for end in sorted({*ends_a} & {*ends_b}):
            x, y = ends_a.index(end, i) + 1, ends_b.index(end, j) + 1
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            links.append((a[x - 1], b[y - 1]))
            i, j = x, y
        counts.update(links)
        rows.append((k, len(a), len(b), groups, links))
    most = Counter()
    for (a, b), n in counts.items():
        most[b] = max(most[b], n)
    return [
        (k, n_a, n_b, len(g), len(l), _sha(";".join(g)) if g else "", sum(counts[x] == most[x[1]] for x in l), sum(counts[x] for x in l)) for k, n_a, n_b, g, l in rows
    ]


@pytest.mark.parametrize("block, hot", [(1 << 19, 1 << 16), (64, 5)])
def test_alignment_of_odd_texts(spark, monkeypatch, block, hot):
    monkeypatch.setattr(align, "BLOCK", block)
    monkeypatch.setattr(align, "HOT_PAIRS", hot)
    texts = [*enumerate(ODD_TEXTS), (50, "same"), (50, "same"), (None, "no id"), (None, None), (60, "a▁b"), (61, "</s><unk>"), *enumerate(_random_texts(8, 300), 100)]
    got = align.with_counts(align.align(odd_documents(spark, texts))).collect()
    got = [(r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, _sha(r.groups) if r.groups else "", r.n_best, r.count_sum) for r in got]
    assert sorted(got, key=str) == sorted(_aligned(texts), key=str)
    assert align.with_counts(align.align(odd_documents(spark, []))).collect() == []


def test_overlaps_are_all_pairs_that_share_bytes():
    rng = random.Random(9)
    doc_a, start_a, end_a, doc_b, start_b, end_b = [], [], [], [], [], []
    at = 0
    for doc in range(40):
        size = rng.randrange(1, 30)
        for docs, starts, ends in ((doc_a, start_a, end_a), (doc_b, start_b, end_b)):
            cuts = sorted({0, size, *(rng.randrange(size) for _ in range(8))})
            docs += [doc] * (len(cuts) - 1)
            starts += [at + x for x in cuts[:-1]]
            ends += [at + x for x in cuts[1:]]
        at += size
    got = align.overlaps(*(np.array(x) for x in (doc_a, start_a, doc_b, start_b)))
    want = [(i, j) for i in range(len(doc_a)) for j in range(len(doc_b)) if start_a[i] < end_b[j] and start_b[j] < end_a[i]]
    assert sorted(map(tuple, got.to_numpy().tolist())) == want
    assert isinstance(got, pd.DataFrame)


def test_alignment_query(spark):
    got = QUERIES["op13_alignment"](spark, SF_SMALL)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(_aligned(_documents()))


def test_piece_bytes():
    model = align.Pieces(align.default_pieces())
    ids, begins = model.encode_column(pa.array(["a\nb", None, ""], pa.string()))
    assert b"".join(model.strings[ids]) == b" a\nb" and begins.tolist() == [0, len(ids), len(ids), len(ids)]
