"""Suffix arrays, repeated strings, Jaccard join, rotation codes, components."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from jobtrend.llm import jaccard, repeats, vectors
from jobtrend.llm.graph import components, roots
from jobtrend.llm.suffix_array import suffix_arrays

from tests.llm.helpers import odd_documents, prose, words


def test_suffix_arrays_equal_sorted_suffixes():
    rng = random.Random(3)
    for _ in range(300):
        texts = []
        for _ in range(rng.randint(1, 6)):
            t = [rng.randint(2, 1 + rng.choice([1, 2, 3, 26])) for _ in range(rng.randint(0, 60))]
            if rng.random() < 0.4:
                t = t[:5] * rng.randint(1, 8)
            if t and rng.random() < 0.4:
                t[rng.randrange(len(t))] = 1
            texts.append(np.array([*t, 0]))
        order, starts = suffix_arrays(texts)
        for s, t in zip(starts, texts):
            assert [x - s for x in order[s : s + len(t)]] == sorted(range(len(t)), key=lambda k: list(t[k:]))


def _repeated(texts, length=repeats.LENGTH):
    bodies = [(t or "").encode() for _, t in texts]
    seen = Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    out = []
    for (k, _), b in zip(texts, bodies):
        covered = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                covered[i : i + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~covered])
        edges = np.flatnonzero(np.diff(np.concatenate([[0], covered.astype(int)])) == 1)
        out.append((k, len(b), int(covered.sum()), len(edges), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def _repeat_cases():
    rng = random.Random(7)
    passage = prose(50, 60)
    texts = [(0, None), (1, ""), (2, "short"), (3, "a" * 450), (4, "ab" * 300), (5, prose(5, 80)), (6, prose(5, 80)), (5, prose(5, 80)), (None, prose(9, 90)), (8, prose(9, 90) + "é")]
    # a passage in many surroundings, one-byte edits, a string of just under and just over the length
    texts += [(100 + k, prose(200 + k, rng.randint(0, 40)) + " é" + passage[: rng.randint(150, 500)] + "漢 " + prose(300 + k, rng.randint(0, 40))) for k in range(25)]
    base = prose(77, 70)
    texts += [(200 + k, base[:k] + "#" + base[k + 1 :]) for k in (0, 100, 199, 200, 300)]
    edge = prose(88, 60)
    texts += [(300, "x" + edge[:199] + "y"), (301, "z" + edge[:199] + "w"), (302, "q" + edge[250:450] + "r"), (303, "s" + edge[250:450] + "t")]
    return texts


@pytest.mark.parametrize("block", [repeats.BLOCK, 3])
def test_repeats_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(repeats, "BLOCK", block)  # with 3, most groups are dealt out by windows
    monkeypatch.setattr(repeats, "SLICE", 1 << 9)
    monkeypatch.setattr(repeats, "TOGETHER", 1 << 13)
    texts = _repeat_cases()
    found = repeats.remove(odd_documents(spark, texts).repartition(4), keep_bytes=True).collect()
    got = [(r.row.doc_id, r.found.n_bytes, r.found.n_removed, r.found.n_spans, r.found.kept_sha256) for r in found]
    assert sorted(got, key=str) == _repeated(texts)
    for r in found:
        body = (r.row.text or "").encode()
        assert len(r.found.kept) == len(body) - sum(s.end - s.start for s in r.found.spans)


def test_repeats_of_an_empty_table(spark):
    docs = odd_documents(spark, [(1, "x")])
    assert repeats.remove(docs.limit(0)).count() == 0
    assert [r.row for r in repeats.remove(docs).collect()] == docs.collect()


def test_components(spark):
    rng = random.Random(8)
    n = 400
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + k) for k in range(1, 90)] + [(rng.randrange(200, n), rng.randrange(200, n)) for _ in range(110)] + [(5, 5), (3, 2), (2, 3)]
    shuffled = [(-(a * 7919 % 1000), -(b * 7919 % 1000)) for a, b in edges]
    names = sorted({x for e in shuffled for x in e})
    at = {x: k for k, x in enumerate(names)}
    a, b = (np.array([at[e[j]] for e in shuffled]) for j in (0, 1))
    want = dict(zip(names, (names[k] for k in roots(len(names), a, b))))
    got = {r.node: r.component for r in components(spark.createDataFrame(shuffled, "u long, v long")).collect()}
    assert got == {x: want[x] for x in got} and set(got) == {x for e in shuffled if e[0] != e[1] for x in e}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def _shingles(text):
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or (frozenset([tuple(w)]) if w else frozenset())


def _jaccard(texts):
    sets = [_shingles(t) for _, t in texts]
    n = len(sets)
    links = [[j for j in range(n) if j != i and sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(n)]
    a, b = (np.array(x, int) for x in zip(*[(i, j) for i in range(n) for j in links[i]]))
    root = roots(n, a, b)
    out = []
    for i in range(n):
        ids = [texts[j][0] for j in range(n) if root[j] == root[i] and texts[j][0] is not None]
        out.append((texts[i][0], min(ids) if ids else None, len(links[i])))
    return sorted(out, key=str), sets, root


def _jaccard_cases():
    rng = random.Random(10)
    texts = [(0, None), (1, ""), (2, "..."), (3, "two words"), (4, "Two, WORDS!"), (5, "two"), (None, prose(3, 50)), (6, prose(3, 50)), (6, prose(3, 50))]
    base = prose(20, 120).split()
    for k in range(40):  # a chain of near copies, a bit further apart each time
        base[rng.randrange(len(base))] = f"n{k}"
        texts.append((100 + k, " ".join(base)))
    for k in range(30):  # a ball of near copies
        w = prose(30, 200).split()
        for _ in range(2):
            w[rng.randrange(len(w))] = f"m{k}"
        texts.append((200 + k, " ".join(w)))
    # exactly 0.8, and just below: 4 of 5 shingles shared, 7 of 9
    w = prose(40, 9).split()
    texts += [(300, " ".join(w[:8])), (301, " ".join(w))]
    texts += [(302, " ".join(w[1:9])), (400, prose(41, 20_000))]
    return texts


@pytest.mark.parametrize("block", [jaccard.BLOCK, 7])
def test_jaccard_join_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "COLUMNS", 50)
    texts = _jaccard_cases()
    docs = odd_documents(spark, texts).repartition(3)
    want, sets, root = _jaccard(texts)
    joined = jaccard.join(docs)
    got = sorted(((r.doc_id, r.class_id, r.n_links) for r in joined.collect()), key=str)
    assert got == want
    kept = jaccard.one_of_each(docs)
    assert kept.columns == docs.columns
    # one of each class: the smallest doc_id; texts without words all stay
    expected = [texts[i][0] for i in range(len(texts)) if not sets[i]]
    for r in {root[i] for i in range(len(texts)) if sets[i]}:
        expected.append(min(texts[i][0] for i in range(len(texts)) if root[i] == r and texts[i][0] is not None))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expected)


def test_jaccard_of_an_empty_table(spark):
    docs = odd_documents(spark, [(1, "x")]).limit(0)
    assert jaccard.join(docs).count() == 0 and jaccard.one_of_each(docs).count() == 0


def test_prefixes_are_shortened_to_the_recall():
    assert jaccard.longest_prefix() == 6
    for recall in (0.5, 0.9, 0.999, 0.9999, 0.9999999):
        d = jaccard.longest_prefix(recall=recall)
        assert 1 - (1 - 0.8**d) ** jaccard.TREES >= recall or d == jaccard.SHORTEST
        assert d == jaccard.DEPTH or 1 - (1 - 0.8 ** (d + 1)) ** jaccard.TREES < recall


def test_prefixes_and_sketches_meet_as_often_as_promised():
    """Sets at similarity 0.8 share prefixes and pass by their sketches; of sets at 0.2 few meet and none passes."""
    rng = np.random.default_rng(5)
    for share in (0.8, 0.2):
        a, b = [], []
        for _ in range(300):
            n = 400
            common = round(2 * n * share / (1 + share))
            pool = rng.integers(0, 1 << 63, 2 * n - common, dtype=np.uint64) * np.uint64(2)
            a.append(pool[:n])
            b.append(np.concatenate([pool[:common], pool[n:]]))
        (x, s), (y, t) = (jaccard.signatures(v) for v in (a, b))
        met = (x == y).any(axis=2).mean(axis=0)
        strong = ((s == t).sum(axis=1) >= jaccard.least_agreement(s.shape[1])).mean()
        if share == 0.8:
            assert met[0] == 1.0 and met[-1] >= 0.99 and strong == 1.0
        else:
            assert met[0] < 0.15 and met[-1] < 0.02 and strong == 0.0


@pytest.mark.parametrize("block", [jaccard.BLOCK, 4])
def test_weak_pairs_do_not_chain(spark, monkeypatch, block):
    """2,000 texts, each sharing half of its words with the next: classes meet, but only near copies are compared."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    pool = prose(60, 2000 * 20 + 60).split()
    texts = [(k, " ".join(pool[20 * k : 20 * k + 50])) for k in range(2000)]
    texts += [(5000 + k, texts[k][1] + " more words") for k in range(0, 2000, 100)]
    depth = jaccard.longest_prefix()
    signed = jaccard._signed(odd_documents(spark, texts), "doc_id", "text", depth)
    classes = jaccard._classes(signed)
    met = jaccard.meetings(classes, signed, depth).select("node").distinct().count()
    groups = [r["count"] for r in jaccard.candidate_groups(classes, signed, depth).groupBy("component").count().collect()]
    assert met > 1000 and max(groups) <= 3 and len(groups) <= 25
    linked = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.join(odd_documents(spark, texts)).where("n_links > 0").collect()}
    assert linked == {x: (k, 1) for k in range(0, 2000, 100) for x in (k, 5000 + k)}


def _vector_links(rows, threshold=vectors.THRESHOLD):
    def sound(v, label):
        return label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    units = [np.array(v, float) / np.linalg.norm(np.array(v, float) / max(map(abs, v))) / max(map(abs, v)) if sound(v, lab) else None for _, v, lab in rows]
    n = len(rows)
    links = defaultdict(list)
    for i in range(n):
        for j in range(n):
            if i != j and units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= threshold:
                links[i].append(j)
    a, b = (np.array([x[k] for x in [(i, j) for i in links for j in links[i]]], int) for k in (0, 1))
    root = roots(n, a, b)
    out = []
    for i in range(n):
        ids = [rows[j][0] for j in range(n) if root[j] == root[i] and rows[j][0] is not None]
        low = min(ids) if ids else None
        out.append((rows[i][0], len(links[i]), low, low is not None and rows[i][0] == low))
    return out


@pytest.mark.parametrize("block", [vectors.BLOCK, 5])
def test_rotation_codes_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    monkeypatch.setattr(vectors, "PAIRS", 50)
    rng = np.random.default_rng(12)
    rows = []
    for c in range(12):
        center = rng.normal(size=32)
        for k in range(12):
            v = center + rng.normal(size=32) * rng.choice([0.02, 0.2, 0.4])
            rows.append((len(rows), [float(np.float32(x)) for x in v], int(c % 3)))
    same = rows[0][1]
    rows += [(900, same, 0), (901, same, 0), (901, same, 0), (902, same, 1), (903, same, None), (904, None, 0), (905, [], 0), (906, [0.0] * 32, 0), (907, [float("nan")] * 32, 0),
             (908, [None, *same[1:]], 0), (909, [float("inf"), *same[1:]], 0), (910, same[:8], 0), (911, same[:8], 0), (None, same, 0), (912, [1e-30 * x for x in same], 0), (913, [1.0], 2), (914, [2.0], 2)]
    schema = "vec_id long, embedding array<float>, label int, node string, component string, `own` string"
    frame = spark.createDataFrame([(*r, "n", "c", "o") for r in rows], schema).repartition(3)
    got = sorted((tuple(r) for r in vectors.near_duplicates(frame).collect()), key=str)
    want = sorted(_vector_links(rows), key=str)
    assert sum(w[1] for w in want) > 300
    # the bands' recall is a probability; none may be wrong, nearly all must be found
    assert len(got) == len(want)
    assert sum(g[1] for g in got) >= 0.99 * sum(w[1] for w in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want) if g[0] == w[0] and g[0] not in (901, None))
    assert sum(g == w for g, w in zip(got, want)) >= 0.97 * len(want)
    assert vectors.near_duplicates(frame.limit(0)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(13)
    a = vectors.unit(rng.normal(size=(4000, 64)))
    b = vectors.unit(a + rng.normal(size=(4000, 64)) * 0.05)
    true = (a * b).sum(axis=1)
    signs, factors = vectors.encode(a)
    guess, deviation = vectors.estimate(signs, factors, np.einsum("nd,rde->nre", b, vectors.rotations(64)))
    error = guess - true
    assert abs(error.mean()) < 0.004
    assert (np.abs(error) <= vectors.CONFIDENCE * deviation).mean() > 0.999


def test_measured_recall(spark):
    """Against all pairs: at least 0.9 is asked for, the bands promise more than 0.998."""
    rng = np.random.default_rng(14)
    centers = rng.normal(size=(150, 64))
    data = np.concatenate([centers + rng.normal(size=centers.shape) * s for s in (0, 0.1, 0.2, 0.25)]).astype(np.float32)
    rows = [(k, [float(x) for x in v], 0) for k, v in enumerate(data)]
    got = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()
    units = vectors.unit(data.astype(float))
    want = int(((units @ units.T >= vectors.THRESHOLD).sum() - len(units)))
    found = sum(r.n_links for r in got)
    assert 0.995 * want <= found <= want


def test_chance_meetings_do_not_grow_with_the_table():
    """Band widths follow the number of classes: a vector meets about as many others by chance in 1,000 as in 16,000."""
    rng = np.random.default_rng(15)
    met = {}
    for n in (1000, 16_000):
        width = max(vectors.LEAST_BITS, math.ceil(math.log2(n)))
        bands = vectors.band_count(width, vectors.THRESHOLD)
        signs, _ = vectors.encode(vectors.unit(rng.normal(size=(n, 64))), width * bands)
        values = vectors._values(signs.reshape(n, -1), width, vectors.THRESHOLD)
        met[n] = sum(int((np.unique(v, return_counts=True)[1] ** 2).sum()) - n for v in values.T) / n
        assert 1 - (1 - (1 - math.acos(0.93) / math.pi) ** width) ** bands >= vectors.RECALL
    assert met[16_000] < 2 * met[1000]


def test_bands_miss_few_pairs_at_the_threshold(spark):
    rng = np.random.default_rng(16)
    rows = []
    for k in range(600):  # pairs whose cosine is just above 0.93
        a = rng.normal(size=64)
        a /= np.linalg.norm(a)
        b = rng.normal(size=64)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        rows += [(2 * k, a.tolist(), 1), (2 * k + 1, (0.931 * a + math.sqrt(1 - 0.931**2) * b).tolist(), 1)]
    got = vectors.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).where("n_links > 0").collect()
    assert len(got) >= 0.98 * len(rows)
    assert all(r.n_links == 1 and r.component_id == r.vec_id // 2 * 2 for r in got)
