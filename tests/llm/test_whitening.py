"""Whitening against a decomposition of the whole table."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow.parquet as pq
import pytest

from jobtrend.llm import whitening
from jobtrend.llm.queries import QUERIES

from tests.conftest import SF_SMALL


def _plain(vectors):
    """n, deviations, eigenvalues, components (columns) and trace, from all rows at once."""
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    n = len(x)
    sums = [sum(col) for col in zip(*x)]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(row, sums)] for row in x])
    _, values, components = np.linalg.svd(centred, full_matrices=False)
    return n, deviations, values**2 / n, components, centred


def _compare(got, vectors, tolerance=1e-7):
    n, deviations, values, components, centred = _plain(vectors)
    dim = min(8, len(vectors[0]))
    rows = {}
    for r in got:
        rows.setdefault(r.vec_id, {})[r.component] = r
    assert {len(x) for x in rows.values()} == {dim}
    whitened = np.array([[rows[i][k + 1].whitened for k in range(dim)] for i in range(n)], float)
    want = centred @ components[:dim].T / np.sqrt(values[:dim])
    for k in range(dim):
        assert min(np.abs(whitened[:, k] - s * want[:, k]).max() for s in (1, -1)) < tolerance * max(1, np.abs(want[:, k]).max())
        for i in range(n):
            r = rows[i][k + 1]
            assert (r.n, r.deviation) == (n, deviations[i])
            assert math.isclose(r.explained, values[k] / values.sum(), rel_tol=1e-9)
    away = whitened - whitened.mean(axis=0)
    assert np.abs(away.T @ away / n - np.eye(dim)).max() < 1e-9
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9


def test_whitening_query(spark):
    rows = pq.read_table(f"{SF_SMALL}/embeddings.parquet").to_pylist()
    assert [r["vec_id"] for r in rows] == list(range(len(rows)))
    _compare(QUERIES["op11_whitening"](spark, SF_SMALL).collect(), [r["embedding"] for r in rows])


def test_badly_scaled_columns(spark):
    # the Gram matrix itself would lose the small components: their variances are 1e-12 of the largest
    rng = np.random.default_rng(1)
    wide = np.rint(rng.normal(size=(400, 1)) * 1e6)
    vectors = np.hstack([wide + rng.integers(-2, 3, (400, 3)), wide]) / 1024
    got = whitening.whiten(spark.createDataFrame([(k, v) for k, v in enumerate(vectors.tolist())], "vec_id long, embedding array<double>").repartition(5)).collect()
    _compare(got, vectors.tolist(), 1e-6)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    sound = [[1.0, 2.0], [0.5, -1.0], [1.0, 2.0], [7.0, 7.25]]
    rows = [(None, sound[0], "x", 9), (1, sound[1], "x", 9), (1, sound[2], "x", 9), (2, sound[3], "x", 9)]
    rows += [(10, None, "", 0), (11, [nan, 1.0], "", 0), (12, [inf, 1.0], "", 0), (13, [None, 1.0], "", 0), (14, [], "", 0), (15, [1e300, 1.0], "", 0)]
    rows += [(20, [1.0, 1.0, 1.0], "", 0), (21, [1.0, 1.0, 1.0], "", 0), (30, [5.0], "", 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, dim string, n int")
    got = whitening.whiten(df).collect()
    assert sorted((r.vec_id, r.component) for r in got if r.vec_id is not None) == sorted([(1, 1), (1, 2)] * 2 + [(2, 1), (2, 2)] + [(i, k) for i in (20, 21) for k in (1, 2, 3)] + [(30, 1)])
    equal = [r for r in got if r.vec_id in (20, 21)]
    assert all((r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (2, 0, None, 0.0, 0.0) for r in equal)
    four = [r for r in got if r.vec_id not in (20, 21, 30)]
    assert {r.n for r in four} == {4} and len(four) == 8
    n, deviations, *_ = _plain(sound)
    assert sorted(r.deviation for r in four if r.component == 1) == sorted(deviations)
    assert whitening.whiten(df.where("vec_id > 99")).collect() == []


def test_fewer_vectors_than_dimensions(spark):
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(4, 6)).tolist()
    got = whitening.whiten(spark.createDataFrame([(k, v) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")).collect()
    assert {r.component for r in got if r.whitened is not None} == {1, 2, 3}
    assert all(math.isclose(sum(r.whitened**2 for r in got if r.component == k), 4, rel_tol=1e-9) for k in (1, 2, 3))


@pytest.mark.parametrize("far", [10**12, 2**55])
def test_large_numbers_stay_exact(spark, far):
    rows = [(0, [float(far)]), (1, [float(-far)]), (2, [0.0])]
    got = {r.vec_id: r for r in whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>").where("embedding is not null")).collect()}
    if far == 2**55:  # 1024 * 2^55 has no place: both rows are dropped
        assert set(got) == {2}
        return
    _, deviations, *_ = _plain([v for _, v in rows])
    assert [got[k].deviation for k in range(3)] == [d if d < 2**63 else None for d in deviations]
    assert math.isclose(got[0].whitened, -got[1].whitened)


def test_triangular_solves():
    rng = np.random.default_rng(3)
    a, b = np.triu(rng.normal(size=(5, 5))) + 5 * np.eye(5), np.triu(rng.normal(size=(5, 5))) + 5 * np.eye(5)
    rows = rng.normal(size=(7, 5))
    assert np.allclose(whitening.solved(rows, [a, b]) @ b @ a, rows)
