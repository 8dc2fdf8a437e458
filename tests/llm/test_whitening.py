"""Eigenpairs against numpy, whitening against plain matrices."""

import numpy as np
import pytest

from cellstride.llm import whitening

SCHEMA = "vec_id bigint, embedding array<double>, whitened string"
RNG = np.random.default_rng(3)


def spread(*values):
    q, _ = np.linalg.qr(RNG.standard_normal((len(values), len(values))))
    return q * np.array(values) @ q.T


MATRICES = {
    "random": (lambda a: a.T @ a / 90)(RNG.standard_normal((90, 40))),
    "low rank": (lambda a: a.T @ a)(RNG.standard_normal((6, 30))),
    "repeated": spread(5, 5, 5, 3, 3, 1, 1e-3, 0),
    "close": spread(1, 1 - 1e-9, 1 - 1e-12, 1 - 1e-15, 0.5, 0.5 + 1e-13, 1e-9),
    "graded": spread(*[10.0 ** -i for i in range(12)]),
    "identity": np.eye(9), "blocks": np.kron(np.eye(4), np.ones((3, 3))), "one": np.array([[2.0]]),
    "small numbers": spread(3e-9, 2e-9, 1e-9), "large numbers": spread(3e12, 2e12, 1e5),
}


@pytest.mark.parametrize("name", sorted(MATRICES))
@pytest.mark.parametrize("k", [2, 32])
def test_eigenpairs(name, k):
    m = (MATRICES[name] + MATRICES[name].T) / 2
    values, vectors = whitening.leading_eigenpairs(m, k)
    expected = np.linalg.eigvalsh(m)[::-1]
    top = expected[0]
    floor = len(m) * np.finfo(float).eps * np.abs(m).sum(1).max()
    assert len(values) == min(k, int((expected > 2 * floor).sum()))
    assert np.abs(values - expected[:len(values)]).max() <= 1e-14 * len(m) * top
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-12
    assert np.abs(m @ vectors - vectors * values).max() <= 1e-12 * top
    assert (np.diff(values) <= 1e-13 * top).all()
    assert (vectors[np.abs(vectors).argmax(0), range(len(values))] > 0).all()


def test_no_spread():
    assert len(whitening.leading_eigenpairs(np.zeros((4, 4)), 3)[0]) == 0
    assert len(whitening.leading_eigenpairs(np.zeros((0, 0)), 3)[0]) == 0


def test_inertia():
    for n in (1, 2, 7, 30):
        m = RNG.standard_normal((n, n))
        m = m + m.T
        for shift in (-5.0, -0.3, 0.0, 0.2, 4.0):
            assert whitening.count_above(m, shift) == (np.linalg.eigvalsh(m) > shift).sum()
    saddle = np.array([[0.0, 1.0, 0.0], [1.0, 0.0, 0.0], [0.0, 0.0, 0.0]])  # no pivot on the diagonal
    assert whitening.count_above(saddle, 0.0) == 1


def plain(vectors):
    x = np.floor(64 * vectors).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(0)
    c = x - s / n
    v = c.T @ c / n
    e, q = np.linalg.eigh(v)
    return x, n, s, v, e[::-1], q[:, ::-1]


def test_whitening(spark):
    vectors = RNG.standard_normal((700, 6)) @ RNG.standard_normal((6, 6)) + 3
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)]
    rows += [(None, vectors[0].tolist(), "x"), (5, vectors[5].tolist(), "x"), (901, None, "x"), (902, [1.0, None] * 3, "x"),
             (903, [float("nan")] * 6, "x"), (904, [float("inf")] * 6, "x"), (905, [], "x"), (906, [1.0, 2.0], "x")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    fitted = whitening.fit(df, components=4)
    used = np.concatenate([vectors, vectors[:1], vectors[5:6]])
    x, n, s, v, e, q = plain(used)
    assert (fitted.n, fitted.dim, fitted.sums) == (n, 6, tuple(s))
    assert np.allclose(fitted.values, e[:4], rtol=1e-12) and np.allclose(fitted.explained, e[:4] / np.trace(v), rtol=1e-12)
    got = whitening.transform(df, fitted).collect()
    assert sorted((r.vec_id for r in got), key=repr) == sorted([*range(700), None, 5], key=repr)
    expected = (x - s / n) @ q[:, :4] / np.sqrt(e[:4])
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    for r in got:
        i = 0 if r.vec_id is None else r.vec_id
        assert np.allclose(np.abs(r.whitened), np.abs(expected[i]), atol=1e-10)
        assert r.deviation == deviation[i]
    assert whitening.identity_error(df, fitted) < 1e-10
    w = np.array([r.whitened for r in got])
    assert np.abs(np.cov(w.T, bias=True) - np.eye(4)).max() < 1e-10


def test_deviation_beyond_a_long(spark):
    df = spark.createDataFrame([(1, [0.5, 0.25], ""), (2, [1e300, 0.0], ""), (3, [0.0, 1.0], "")], SCHEMA)
    fitted = whitening.fit(df)
    got = {r.vec_id: r.deviation for r in whitening.transform(df, fitted).collect()}
    assert set(got) == {1, 2, 3} and got[2] is None
    far = whitening.Whitening(2, 10, (10 ** 7, 10 ** 7), 1.0, np.ones(1), np.ones((2, 1)))
    x = np.array([[1_000_000 + 10 ** 9, 1_000_000]])
    assert far.deviation(x) == [None] and far.deviation(np.array([[1_000_003, 1_000_000]])) == [900]


def test_awkward_tables(spark):
    for rows in ([], [(1, None, "")], [(1, [2.0, 3.0], "")], [(1, [2.0, 3.0], "a")] * 4):
        df = spark.createDataFrame(rows, SCHEMA)
        fitted = whitening.fit(df)
        assert len(fitted.values) == 0 and whitening.identity_error(df, fitted) is None
        assert [list(r.whitened) for r in whitening.transform(df, fitted).collect()] == [[]] * fitted.n
    with pytest.raises(ValueError):
        whitening.fit(spark.createDataFrame([(1, [0.0] * (whitening.MAX_DIM + 1), "")], SCHEMA))


def test_query(spark, small):
    rows = whitening.query(spark, small).toPandas()
    vectors = np.stack([np.asarray(r.embedding, float) for r in spark.read.parquet(f"{small}/embeddings.parquet").orderBy("vec_id").collect()])
    x, n, s, v, e, q = plain(vectors)
    k = min(32, int((e > 1e-12 * e[0]).sum()))
    assert len(rows) == n * k and set(rows["n"]) == {n}
    w = rows.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.abs(np.abs(w) - np.abs((x - s / n) @ q[:, :k] / np.sqrt(e[:k]))).max() < 1e-8
    assert (rows["identity_error"] < 1e-8).all() and rows["identity_error"].nunique() == 1
