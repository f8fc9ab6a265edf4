"""The registered queries and the pipeline, over whole small tables."""

from __future__ import annotations

import math
import re
import zlib

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from jobtrend.llm import pii, toxicity
from jobtrend.llm.queries import ORACLE, QUERIES

from tests.conftest import SF_CHECK, SF_SMALL
from tests.llm.test_duplicates import _jaccard, _repeated, _vector_links
from tests.llm.test_text import _contamination, _ids


def _documents():
    return [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()]


def test_every_query_is_registered():
    assert {*QUERIES, "pipeline"} <= set(entry.queries())
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    df = QUERIES[name](spark, SF_SMALL)
    rel = con.sql(ORACLE[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    at = [rel.columns.index(c) for c in cols]
    assert sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str) == sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=str)


def test_repeated_strings_query(spark):
    got = [tuple(r) for r in QUERIES["op2_suffix_array"](spark, SF_SMALL).collect()]
    assert sorted(got, key=str) == _repeated(_documents())


def test_toxicity_query(spark):
    rows = QUERIES["op3_toxicity"](spark, SF_SMALL).collect()
    assert sorted(r.doc_id for r in rows) == sorted(k for k, _ in _documents())
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5)


def test_token_query(spark):
    start = 0
    got = sorted(tuple(r) for r in QUERIES["op4_token_store"](spark, SF_SMALL).collect())
    for (k, text), row in zip(sorted(_documents()), got):
        ids = _ids(text)
        assert row == (k, start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_toxicity_of_held_out_rows(spark):
    """Scores of rows that were not learned from put toxic texts before clean ones."""
    marked = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{SF_CHECK}/labels.parquet").to_pylist()}
    rows = [r for r in QUERIES["op3_toxicity"](spark, SF_CHECK).collect() if r.held_out and marked.get(r.doc_id) is not None]
    toxic, clean = ([r.score for r in rows if marked[r.doc_id] == k] for k in (1, 0))
    assert len(toxic) > 5 and len(clean) > 20
    assert np.mean([(t > c) + 0.5 * (t == c) for t in toxic for c in clean]) > 0.85


def test_vector_query(spark):
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in pq.read_table(f"{SF_SMALL}/embeddings.parquet").to_pylist()]
    got = [tuple(r) for r in QUERIES["op6_rotation_codes"](spark, SF_SMALL).collect()]
    assert sorted(got, key=str) == sorted(_vector_links(rows), key=str)


def test_jaccard_query(spark):
    got = [tuple(r) for r in QUERIES["op7_jaccard_join"](spark, SF_SMALL).collect()]
    assert sorted(got, key=str) == _jaccard(_documents())[0]


def _packed(rows, texts):
    """Whether these rows pack these texts."""
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(pieces) == sorted(k for k, _ in texts)
    total = 0
    for k, text in texts:
        ids = _ids(text)
        total += len(ids)
        at = 0
        for number, (piece, start, length, crc) in enumerate(sorted(pieces[k])):
            assert (piece, start) == (number, at) and crc == zlib.crc32(ids[at : at + length].tobytes())
            assert length == 1024 or number == 0
            at += length
        assert at == len(ids)
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *(n for _, n in parts)])[:-1].tolist() and sum(n for _, n in parts) <= 1024
    assert len(sequences) <= math.ceil(total / 1024) * 1.1 + 8


def test_packing_query(spark):
    _packed(QUERIES["op9_best_two_fit"](spark, SF_SMALL).collect(), _documents())


def test_pipeline_stages(spark, scratch):
    """Each stage against a plain statement of what it does to its own input."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    columns = docs.schema
    benchmark = [(r["item_id"], r["text"]) for r in pq.read_table(f"{SF_SMALL}/benchmark.parquet").to_pylist()]
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "n-gram Jaccard join", "benchmark decontamination", "PII", "best-fit packing"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        texts = [(i, r.text) for i, r in sorted(before.items())]
        out = stage(spark, docs, SF_SMALL)
        if name != "best-fit packing":
            assert out.schema.simpleString() == columns.simpleString()
            path = f"{scratch}/{k}"
            out.write.parquet(path)
            after = spark.read.parquet(path)
            rows = {r.doc_id: r for r in after.collect()}
        if name == "toxicity":
            model = toxicity.train(docs, labels)
            gone = {r.row.doc_id for r in toxicity.score(docs, model).where("found.predicted = 1").collect()}
            assert set(rows) == set(before) - gone
            marked = [(r.doc_id, r.toxic) for r in labels.collect() if r.doc_id in before and r.toxic is not None]
            kept = {k: np.mean([i in rows for i, toxic in marked if toxic == k]) for k in (0, 1)}
            assert kept[0] > 0.9 and kept[1] < 0.5
        elif name == "n-gram Jaccard join":
            classes, _, _ = _jaccard(texts)
            assert set(rows) == {c for i, c, _ in classes}
        elif name == "benchmark decontamination":
            gone = {c[0] for c in _contamination(texts, benchmark) if c[-1]}
            assert gone and set(rows) == set(before) - gone
        elif name == "PII":
            spans = {r.row.doc_id: r.found.all for r in pii.find(docs).collect()}
            for i, text in texts:
                want, at = [], 0
                for s in sorted(spans[i], key=lambda s: (s.start, s.end)):
                    if s.start >= at:
                        want += [text[at : s.start], f"<{s.kind}>"]
                    at = max(at, s.end)
                assert rows[i].text == "".join(want) + text[at:]
                assert rows[i].n_chars == len(rows[i].text)
                # by the contract's own patterns nothing valid is left
                assert not re.search(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", rows[i].text)
                assert not any(9 <= len(re.sub("[^0-9]", "", m[0])) <= 15 for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", rows[i].text))
        else:
            _packed(out.collect(), texts)
        if name in ("toxicity", "n-gram Jaccard join", "benchmark decontamination"):
            assert all(rows[i] == before[i] for i in rows)
        docs = after


def test_pipeline_runs_whole(spark):
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert rows and {r.doc_id for r in rows} < {k for k, _ in _documents()}
