import numpy as np
import pytest

from ludica.llm import whitening as W
from ludica.llm.queries import op11_whitening


def matrix(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values),) * 2))[0]
    a = (q * values) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("values", [
    np.linspace(0.1, 2, 64), np.geomspace(1, 1e-10, 40), np.repeat([5.0, 3.0, 1.0], 12), 1 + np.arange(30) * 1e-9,
    np.r_[np.full(10, 2.0), 2 + 1e-7, 2 + 2e-7, np.linspace(0, 1, 20)], np.array([3.0]), np.geomspace(1e30, 1e28, 9)])
def test_refined_vectors(values):
    a = matrix(values)
    e, x = W.refined_eigh(a)
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-13
    assert np.abs(a @ x - x * e).max() < 1e-14 * np.abs(a).max() * len(a)
    assert np.allclose(e, np.sort(np.linalg.eigvalsh(a))[::-1], rtol=1e-12, atol=1e-13 * values.max())
    assert (np.diff(e) <= 0).all()


def test_float32_alone_would_not_do():
    a = matrix(np.linspace(0.1, 2, 64))
    rough = np.linalg.eigh(a.astype(np.float32))[1].astype(float)
    fine = W.refined_eigh(a)[1]
    off = lambda x: np.abs(x.T @ a @ x - np.diag(np.diag(x.T @ a @ x))).max()
    assert off(rough) > 1e-9 and off(fine) < 1e-14


def test_zero_matrix():
    e, x = W.refined_eigh(np.zeros((3, 3)))
    assert (e == 0).all() and (x == np.eye(3)).all()


def brute(vectors, k=32):
    x = np.floor(64 * np.array(vectors, dtype=float)).astype(object).astype(int) + 1_000_000
    n, sums = len(x), x.sum(axis=0)
    c = (n * x - sums) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    kept = min(k, int((e > 1e-11 * e[0]).sum()))
    return ((n * x - sums) ** 2).sum(axis=1), c @ u[:, :kept] / np.sqrt(e[:kept]), e[:kept] / e.sum()


def check(df, vectors, rows):
    deviation, white, explained = brute(vectors)
    rows = sorted(rows, key=lambda r: (r["vec_id"], r["component"]))
    k = white.shape[1]
    assert len(rows) == len(vectors) * k
    got = np.array([r["whitened"] for r in rows]).reshape(-1, k)
    white *= np.sign((got * white).sum(axis=0))
    assert np.abs(got - white).max() < 1e-8
    assert [r["deviation"] for r in rows[::k]] == deviation.tolist()
    assert [r["component"] for r in rows[:k]] == list(range(1, k + 1))
    assert np.allclose([r["explained"] for r in rows[:k]], explained, rtol=1e-9)
    assert {r["n"] for r in rows} == {len(vectors)}
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-9


def test_query_against_numpy(spark):
    rows = op11_whitening(spark, "/root/testdata/sf0.001").collect()
    given = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").orderBy("vec_id").collect()
    check(spark, [r["embedding"] for r in given], rows)


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    good = rng.normal(size=(40, 5)).astype(np.float32).tolist()
    rows = [(i, v, "x") for i, v in enumerate(good)]
    rows += [(100, None, "x"), (101, [1.0, None, 1.0, 1.0, 1.0], "x"), (102, [float("nan")] * 5, "x"),
             (103, [float("inf")] + [0.0] * 4, "x"), (104, [1.0, 2.0], "x"), (105, [], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, deviation string").repartition(4)
    check(spark, good, W.component_rows(df).collect())


def test_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (None, [0.0, 3.0]), (2, [4.0, 1.0])],
                               "vec_id long, embedding array<double>")
    rows = W.component_rows(df).collect()
    assert sorted(str(r["vec_id"]) for r in rows) == ["1"] * 4 + ["2"] * 2 + ["None"] * 2


@pytest.mark.parametrize("rows", [[], [(1, [])], [(1, None)], [(1, [2.0, 2.0]), (2, [2.0, 2.0])], [(1, [7.0])]])
def test_nothing_to_whiten(spark, rows):
    out = W.component_rows(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    assert out.collect() == []
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_huge_entries(spark):
    """Entries beyond the fixed-point range stand for its bound; a deviation beyond a long is null."""
    df = spark.createDataFrame([(i, [1e300 * (i % 2), float(i)]) for i in range(8)], "vec_id long, embedding array<double>")
    rows = W.component_rows(df).collect()
    assert {r["deviation"] for r in rows} == {None} and rows[0]["identity_error"] < 1e-9


def test_deviation_between_float_and_long(spark):
    """Sums of squares beyond 2**53 are exact."""
    df = spark.createDataFrame([(i, [float(i * 10_003), float(i % 3)]) for i in range(50)], "vec_id long, embedding array<double>")
    want = brute([[i * 10_003.0, i % 3] for i in range(50)])[0].tolist()
    assert max(want) > 2 ** 53
    got = {r["vec_id"]: r["deviation"] for r in W.component_rows(df).collect()}
    assert [got[i] for i in range(50)] == want
