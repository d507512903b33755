import math

import numpy as np
import pytest

from rollbook.llm.whitening import eigenvectors, fit, transform, usable, whitened_components


def matrix(values, seed=0):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values),) * 2))
    m = (q * values) @ q.T
    return (m + m.T) / 2


KINDS = {
    "spread": np.linspace(1, 100, 30),
    "cluster": np.concatenate([np.linspace(1, 9, 20), 50 + np.arange(10) * 1e-9]),
    "close cluster": np.concatenate([np.linspace(1, 9, 20), 50 + np.arange(10) * 1e-13]),
    "equal": np.concatenate([np.linspace(1, 9, 20), np.full(10, 7.5)]),
    "low rank": np.concatenate([np.zeros(20), np.linspace(1, 9, 10)]),
    "wide": 10.0 ** np.linspace(-9, 6, 30),
    "one": np.array([3.0]),
}


@pytest.mark.parametrize("kind", KINDS)
def test_eigenvectors(kind):
    m = matrix(KINDS[kind])
    values, vectors = eigenvectors(m)
    wide, top = m.astype(np.longdouble), np.abs(m).max()
    assert np.abs(wide @ vectors - vectors * values).max() <= 1e-16 * top
    assert np.abs(vectors.T @ vectors - np.eye(len(m))).max() <= 1e-17
    assert (np.diff(values) <= 0).all()
    assert np.allclose(values.astype(float), sorted(KINDS[kind], reverse=True), rtol=0, atol=1e-13 * top)


def test_eigenvectors_in_a_cluster_are_told_apart():
    """Neighbours a billionth apart, exactly known: a block matrix, turned by exact reflections."""
    values = np.array([1, 1 + 2.0**-30, 2, 3, 1 - 2.0**-30, 1 + 2.0**-29])
    v = np.array([1.0, 1, 1, 1, 2, 0]) / np.sqrt(np.longdouble(8))
    reflect = np.eye(6, dtype=np.longdouble) - 2 * np.outer(v, v)
    m = (reflect * values) @ reflect.T
    found, vectors = eigenvectors(m)
    order = np.argsort(-values)
    assert np.abs(found - values[order]).max() < 1e-17
    cosines = np.abs(np.einsum("ij,ij->j", vectors, reflect[:, order]))
    assert np.abs(1 - cosines).max() < 1e-15
    assert (np.abs(vectors) - np.abs(reflect[:, order])).max() < 1e-9


def rows_of(spark, vectors):
    return spark.createDataFrame(
        [(i, v, 1, "x", 2.0) for i, v in enumerate(vectors)],
        "vec_id long, embedding array<float>, n int, component string, whitened double",
    ).repartition(3)


def expected(vectors, components=32):
    """Plain numpy on all vectors at once."""
    x = np.floor(64 * np.array(vectors, dtype=np.float32).astype(float)).astype(int) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    centred = x - sums / n
    cov = centred.T @ centred / n
    values, turn = np.linalg.eigh(cov)
    values, turn = values[::-1][:components], turn[:, ::-1][:, :components]
    deviations = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    return n, deviations, centred @ turn / np.sqrt(values), values / np.trace(cov)


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(4)
    good = (rng.normal(size=(300, 40)) * np.linspace(1, 2, 40) @ rng.normal(size=(40, 40))).tolist()
    good += [good[7], good[7]]
    bad = [None, [], [None] + [1.0] * 39, [float("nan")] * 40, [1.0] * 39 + [float("inf")], [1.0] * 39, [2.0] * 41]
    got = whitened_components(rows_of(spark, good + bad)).collect()
    n, deviations, white, explained = expected(good)
    assert len(got) == len(good) * 32 and {r["n"] for r in got} == {n}
    by_component = {}
    for r in got:
        assert r["deviation"] == deviations[r["vec_id"]]
        assert math.isclose(r["explained"], explained[r["component"] - 1], rel_tol=1e-10)
        by_component.setdefault(r["component"], {})[r["vec_id"]] = r["whitened"]
    for component, found in by_component.items():
        found = np.array([found[i] for i in range(len(good))])
        wanted = white[:, component - 1]
        assert min(np.abs(found - wanted).max(), np.abs(found + wanted).max()) < 1e-9
    assert max(r["identity_error"] for r in got) < 1e-10
    assert len({r["identity_error"] for r in got}) == 1


def test_few_vectors_and_none(spark):
    assert whitened_components(rows_of(spark, [None, [float("nan")]])).collect() == []
    assert fit(usable(rows_of(spark, []))) is None
    alone = whitened_components(rows_of(spark, [[1.0, 2.0]])).collect()
    assert [(r["component"], r["n"], r["deviation"], r["whitened"], r["explained"]) for r in sorted(alone, key=lambda r: r["component"])] == [
        (1, 1, 0, None, None), (2, 1, 0, None, None),
    ]
    # the second dimension never changes: one component has variance
    flat = whitened_components(rows_of(spark, [[1.0, 5.0], [2.0, 5.0], [4.0, 5.0]])).collect()
    assert {(r["component"], r["whitened"] is None, r["explained"]) for r in flat} == {(1, False, 1.0), (2, True, 0.0)}


def test_very_large_entries_are_exact(spark):
    vectors = [[1e9, 0.0], [-1e9, 1.0], [3e9, 2.0]]
    found = usable(rows_of(spark, vectors))
    fitted = fit(found)
    n, deviations, _, explained = expected(vectors, 2)
    assert [s for s in fitted.sums] == [sum(math.floor(64 * float(np.float32(v[k]))) + 1_000_000 for v in vectors) for k in (0, 1)]
    got = {r["vec_id"]: r["deviation"] for r in transform(found, fitted).collect()}
    assert got == {i: d if d < 2**63 else None for i, d in enumerate(deviations)}
    assert np.allclose(fitted.explained, explained, atol=1e-12)
