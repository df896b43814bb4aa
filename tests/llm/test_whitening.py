"""Whitening against numpy and exact integers, and its edge cases."""

import math
from fractions import Fraction

import numpy as np
import pytest

from ebbtide.llm import whitening
from ebbtide.llm.queries import QUERIES

ROWS = "vec_id long, embedding array<double>, n int, x string, component string"


def frame(spark, vectors):
    """Vectors with extra columns of names that the operator uses inside."""
    return spark.createDataFrame([(i, v, 1, "x", "y") for i, v in enumerate(vectors)], ROWS)


def plain(vectors, components=4):
    """{row: [(component, n, deviation, |whitened|, explained)]} in exact integers and one eigh."""
    good = {i: v for i, v in enumerate(vectors) if v is not None and all(c is not None and math.isfinite(c) for c in v)}
    width = max((len(v) for v in good.values()), default=0)
    whole = {i: [math.floor(256 * c) for c in v] + [0] * (width - len(v)) for i, v in good.items()}
    fit = sorted({tuple(x) for x in whole.values()})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    cov = np.array(
        [[float(sum(Fraction(n * x[a] - sums[a]) * (n * x[b] - sums[b]) for x in fit) / n**3) for b in range(width)] for a in range(width)]
    )
    values, vecs = np.linalg.eigh(cov)
    values, vecs = values[::-1], vecs[:, ::-1]
    out = {}
    for i, x in whole.items():
        y = [n * c - s for c, s in zip(x, sums, strict=True)]
        w = np.array(y, float) / n @ vecs
        out[i] = [
            (k + 1, n, sum(c * c for c in y), abs(w[k]) / math.sqrt(values[k]), values[k] / values.sum())
            for k in range(min(components, width))
        ]
    return out


def held(rows):
    found = {}
    for r in sorted(rows, key=lambda r: (r.vec_id, r.component)):
        w = None if r.whitened is None else abs(r.whitened)
        found.setdefault(r.vec_id, []).append((r.component, r.n, int(r.deviation), w, r.explained))
    return found


def check(got, expected):
    assert got.keys() == expected.keys()
    for i, rows in expected.items():
        assert [r[:3] for r in got[i]] == [r[:3] for r in rows]
        assert np.allclose([r[3:] for r in got[i]], [r[3:] for r in rows], rtol=1e-6, atol=1e-8)


def test_equals_plain_version(spark):
    rng = np.random.default_rng(5)
    vectors = (rng.normal(size=(300, 7)) @ rng.normal(size=(7, 7)) * 3).tolist()
    vectors += vectors[:40] + [vectors[0]] * 100  # copies do not count twice
    vectors += [None, [], [1.0], [math.nan] * 7, [math.inf] + [0.0] * 6, [None] + [1.0] * 6]
    df = frame(spark, vectors)
    model = whitening.fit(df)
    check(held(whitening.whiten(df, model).collect()), plain(vectors))
    assert model.identity_error < 1e-9


def test_large_offsets_do_not_cancel(spark):
    rng = np.random.default_rng(6)
    vectors = (rng.normal(size=(120, 3)) + [1e9, -3e12, 0]).tolist()
    df = frame(spark, vectors)
    model = whitening.fit(df)
    check(held(whitening.whiten(df, model).collect()), plain(vectors))
    assert model.identity_error < 1e-4


def test_defined_results_at_the_edges(spark):
    for vectors in ([], [None, [math.nan]]):
        df = frame(spark, vectors)
        model = whitening.fit(df)
        assert model.n == 0
        assert whitening.whiten(df, model).collect() == []
    df = frame(spark, [[1.0, 2.0]] * 3)
    rows = whitening.whiten(df, whitening.fit(df)).collect()
    assert len(rows) == 6 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in rows} == {
        (1, 0, None, None, 0.0)
    }
    df = frame(spark, [[1.0, 0.5], [2.0, 0.5], [3.0, 0.5]])
    rows = whitening.whiten(df, whitening.fit(df)).collect()
    assert all((r.whitened is None) == (r.component == 2) for r in rows)
    wide = frame(spark, [[1e300, -1e300], [0.0, 0.0], [1.0, 1.0]])
    rows = whitening.whiten(wide, whitening.fit(wide)).collect()
    assert len(rows) == 6 and all(r.explained is not None for r in rows)


@pytest.mark.parametrize("size", ["sf0.001"])
def test_query_equals_plain_version(spark, size):
    folder = f"/root/testdata/{size}"
    vectors = [r.embedding for r in spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()]
    rows = QUERIES["op11_embedding_whitening"](spark, folder).collect()
    assert {type(r.deviation) for r in rows} == {int} and max(r.identity_error for r in rows) < 1e-4
    got = [[abs(r.whitened) for r in sorted(rows, key=lambda r: (r.vec_id, r.component))]]
    x = np.floor(256 * np.array(vectors)).astype(np.int64)
    fit = np.unique(x, axis=0)
    y = fit - fit.mean(axis=0)
    values, vecs = np.linalg.eigh(y.T @ y / len(fit))
    expected = np.abs((x - fit.mean(axis=0)) @ vecs[:, ::-1][:, :4] / np.sqrt(values[::-1][:4]))
    assert np.allclose(np.array(got).reshape(-1, 4), expected, rtol=1e-6, atol=1e-6)
