"""Whitening against plain linear algebra in whole numbers."""

from fractions import Fraction

import numpy as np
import pytest

from turntable.llm import whitening
from turntable.llm.queries import QUERIES
from turntable.llm.whitening import WhiteningError, count_above, feast, principal_components, whiten
from turntable.sources.tables import read_table


def turned(values, seed=0):
    basis, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    made = (basis * values) @ basis.T
    return (made + made.T) / 2


SPECTRA = {
    "spread": np.linspace(1, 50, 60),
    "falling": 1.4 ** -np.arange(60.0),
    "steep": 10.0 ** -np.arange(40.0),
    "equal": np.full(48, 3.0),
    "close": np.repeat([5.0, 5.0 + 1e-9, 1.0, 1e-3], 12),
    "flat beside one": np.array([1e6, *np.full(40, 1.0)]),
    "few": np.array([9.0, 4.0, 1.0, *np.zeros(30)]),
    "single": np.array([2.0]),
}


@pytest.mark.parametrize("name", SPECTRA)
def test_components(name):
    matrix = turned(SPECTRA[name])
    values, vectors = principal_components(matrix, 32)
    want = np.sort(SPECTRA[name])[::-1][:32]
    want = want[want > 1e-13 * np.trace(matrix)]
    assert len(values) == len(want)
    np.testing.assert_allclose(values, want, atol=1e-13 * want[0] * len(matrix))
    np.testing.assert_allclose(vectors.T @ vectors, np.eye(len(want)), atol=1e-13)
    np.testing.assert_allclose(matrix @ vectors, vectors * values, atol=1e-12 * want[0] * len(matrix))


def test_inertia():
    random = np.random.default_rng(1)
    for n in (1, 2, 3, 10, 40):
        for _ in range(20):
            made = random.integers(-3, 4, (n, n)).astype(float)
            made = made + made.T
            for shift in (-2.3, 0.1, 0.7, 5.2):
                assert count_above(made, shift) == (np.linalg.eigvalsh(made) > shift).sum()


def test_a_missed_component_is_noticed():
    matrix = np.diag(np.arange(1.0, 11.0))
    assert feast(matrix, 2.5, 5.5, 3).shape == (10, 3)
    with pytest.raises(WhiteningError):
        feast(matrix, 2.5, 5.5, 4)


def brute(vectors, components=32):
    """Covariance in exact fractions; deviation; explained shares; projections up to their direction."""
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in vector] for vector in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(row[i] for row in x) for i in range(d)]
    centred = [[n * row[i] - sums[i] for i in range(d)] for row in x]
    exact = [[Fraction(sum(row[i] * row[j] for row in centred), n**3) for j in range(d)] for i in range(d)]
    matrix = np.array([[float(value) for value in row] for row in exact])
    values, basis = np.linalg.eigh(matrix)
    values, basis = values[::-1][:components], basis[:, ::-1][:, :components]
    there = values > 1e-12 * np.trace(matrix)
    values, basis = values[there], basis[:, there]
    rows = np.array(centred, dtype=float) / n
    return [sum(v * v for v in row) for row in centred], rows @ basis / np.sqrt(values), values / np.trace(matrix)


def check(out, ids, vectors):
    deviations, projected, explained = brute(vectors)
    by_id = {}
    for row in out.collect():
        by_id.setdefault(row[0], {})[row.component] = row
    assert set(by_id) == set(ids)
    found = np.array([[by_id[one][c + 1].whitened for c in range(len(explained))] for one in ids])
    signs = np.sign((found * projected).sum(axis=0))
    np.testing.assert_allclose(found * signs, projected, atol=1e-7)
    for one, deviation in zip(ids, deviations, strict=True):
        own = by_id[one]
        assert len(own) == len(explained)
        assert {(row.n, row.deviation) for row in own.values()} == {(len(vectors), deviation)}
        assert all(row.identity_error < 1e-6 for row in own.values())
        np.testing.assert_allclose([own[c + 1].explained for c in range(len(explained))], explained, rtol=1e-6)


def test_drawn_vectors_with_bad_rows(spark):
    random = np.random.default_rng(5)
    good = (random.standard_normal((300, 7)) * [50, 20, 10, 5, 2, 1, 0] + [0, 3000, 0, -70, 0, 1, 5]).tolist()
    good += [good[0], good[0], [1e5, -1e5, 0.0, 0.0, 0.0, 0.0, 5.0]]
    bad = [None, [], [1.0] * 6, [1.0] * 8, [None] + [1.0] * 6, [float("nan")] + [1.0] * 6, [1.0] * 6 + [float("inf")]]
    rows = [(i, vector, 1) for i, vector in enumerate(good)] + [(-1, vector, 1) for vector in bad]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, n int").selectExpr("*", "2 AS component", "3 AS _id", "4 AS cell")
    check(whiten(df), range(len(good)), good)


def test_no_rows(spark):
    df = spark.createDataFrame([(1, None), (2, [])], "vec_id bigint, embedding array<float>")
    for none in (df, df.limit(0), spark.createDataFrame([(i, [1.0, 2.0]) for i in range(3)], "vec_id bigint, embedding array<float>")):
        out = whiten(none)
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
        assert out.count() == 0


def test_null_id_and_too_large_entries(spark):
    df = spark.createDataFrame([(None, [1.0]), (None, [2.0]), (4, [4.0])], "vec_id bigint, embedding array<float>")
    assert sorted(row.deviation for row in whiten(df).collect()) == [1 * 64**2, 16 * 64**2, 25 * 64**2]
    with pytest.raises(Exception, match="entry of"):
        whiten(spark.createDataFrame([(1, [1e30]), (2, [2.0])], "vec_id bigint, embedding array<float>"))


def test_large_deviation_is_null(spark):
    df = spark.createDataFrame([(i, [1e11 * (i % 2)]) for i in range(1000)], "vec_id bigint, embedding array<double>")
    assert {row.deviation for row in whiten(df).collect()} == {None}


def test_moments_do_not_depend_on_blocks():
    rows = np.random.default_rng(2).integers(-(10**9), 10**9, (500, 5))
    one, several = whitening._Moments(5), whitening._Moments(5)
    one.add(rows)
    for at in range(0, 500, 70):
        several.add(rows[at : at + 70])
    exact = rows.astype(object)
    assert (one.products == exact.T @ exact).all() and (several.products == one.products).all()
    assert (several.sums == exact.sum(axis=0)).all() and several.n == 500


def test_query(spark, sf_dir):
    vectors = {row.vec_id: row.embedding for row in read_table(spark, f"{sf_dir}/embeddings.parquet").collect()}
    check(QUERIES["op12_embedding_whitening"](spark, sf_dir), list(vectors), list(vectors.values()))
