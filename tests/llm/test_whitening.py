"""Whitening against numpy's symmetric eigensolver and exact integers."""

import math

import numpy as np
import pytest

from conftest import SF_SMALL
from lakecart.llm import queries as llm
from lakecart.llm import whitening as wh

SCHEMA = "vec_id bigint, embedding array<float>, label int, id string, x string, n string"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, 0, "a", "b", "c") for i, v in vectors], SCHEMA)


def by_definition(vectors, k=16):
    """id -> (deviation, whitened up to sign), and n, explained."""
    x = {i: tuple(math.floor(64 * float(c)) + 1_000_000 for c in v) for i, v in vectors}
    fit = sorted(set(x.values()))
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    exact = {i: [n * a - b for a, b in zip(v, s)] for i, v in x.items()}
    centre = np.array([[n * a - b for a, b in zip(v, s)] for v in fit], float) / n
    cov = centre.T @ centre / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    return n, e / np.trace(cov), {i: (sum(c * c for c in v), np.array(v, float) / n @ u / np.sqrt(e)) for i, v in exact.items()}


def check(rows, vectors, k=16):
    n, shares, want = by_definition(vectors, k)
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {})[r.component] = r
    assert set(got) == set(want)
    k = len(shares)
    w = np.array([[got[i][c + 1].whitened for c in range(k)] for i in want])
    sign = np.sign((w * np.array([v[1] for v in want.values()])).sum(0))
    assert np.allclose(w * sign, np.array([v[1] for v in want.values()]), rtol=1e-9, atol=1e-8)
    for i, (deviation, _) in want.items():
        assert set(got[i]) == set(range(1, k + 1))
        assert all(r.deviation == deviation and r.n == n for r in got[i].values())
        assert np.allclose([got[i][c + 1].explained for c in range(k)], shares, rtol=1e-9)
        assert all(r.identity_error < 1e-9 for r in got[i].values())


def test_query_by_definition(spark):
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    vectors = [(r.vec_id, r.embedding) for r in table.collect()]
    check(llm.queries()["op11_whitening"](spark, SF_SMALL).collect(), vectors)


@pytest.mark.parametrize("fan", [wh.FAN, 2])
def test_unusable_and_repeated_rows(spark, monkeypatch, fan):
    monkeypatch.setattr(wh, "FAN", fan)
    monkeypatch.setattr(wh, "ROWS", 7)
    rng = np.random.default_rng(1)
    good = [(i, [float(c) for c in np.float32(rng.normal(size=5) * [9, 4, 2, 1, 1] + [0, 500, 0, 0, -3])]) for i in range(60)]
    good += [(100 + i, good[3][1]) for i in range(50)]  # one vector many times: once in the fit
    bad = [(200, None), (201, []), (202, [1.0, None, 0.0, 0.0, 0.0]), (203, [1.0, float("nan"), 0.0, 0.0, 0.0]),
           (204, [float("inf"), 1.0, 0.0, 0.0, 0.0]), (205, [1.0, 2.0]), (206, [3e38, 0.0, 0.0, 0.0, 0.0])]
    check(wh.components(frame(spark, good + bad).repartition(9)).collect(), good)


@pytest.mark.parametrize("fan", [wh.FAN, 2])
def test_triangles_of_many_tasks(spark, monkeypatch, fan):
    monkeypatch.setattr(wh, "FAN", fan)
    rng = np.random.default_rng(4)
    x = rng.integers(-50, 50, size=(90, 4))
    table = spark.createDataFrame([(v.tolist(),) for v in x], "x array<bigint>").repartition(9)
    r = wh.triangle(table, 4, 90, x.sum(0).tolist())
    c = x - x.mean(0)
    assert r.shape == (4, 4) and np.allclose(r.T @ r, c.T @ c)


def test_few_components_null_ids_and_repeated_ids(spark):
    rng = np.random.default_rng(2)
    rows = [(None if i < 2 else i // 2, [float(c) for c in rng.normal(size=4)]) for i in range(30)]
    out = wh.components(frame(spark, rows), k=2)
    assert out.count() == 60 and out.filter("vec_id is null").count() == 4 and out.agg({"component": "max"}).first()[0] == 2


def test_no_variance(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        out = wh.components(frame(spark, rows))
        assert out.count() == 0
        assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    # A dimension that repeats another one, and one that never varies, give no component.
    rows = [(i, [float(i % 7), float(i % 7), 4.0, float(i % 5)]) for i in range(35)]
    assert wh.components(frame(spark, rows)).agg({"component": "max"}).first()[0] == 2


def test_large_entries_stay_exact(spark):
    rows = [(i, [1e12 - 65536.0 * i, float(i * i), 0.25 * (i % 3)]) for i in range(40)]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in rows]
    got = wh.components(frame(spark, rows)).collect()
    n, _, want = by_definition(rows)
    assert {r.vec_id: r.deviation for r in got} == {i: (d if d < 1 << 63 else None) for i, (d, _) in want.items()}


def ortho(z):
    return np.abs(z.T @ z - np.eye(z.shape[1])).max()


@pytest.mark.parametrize("name", ["plain", "graded", "upward", "clusters", "tight", "equal", "wilkinson", "integers", "short"])
def test_solver(name):
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.normal(size=(40, 40)))
    r = {"plain": lambda: rng.normal(size=(90, 40)), "graded": lambda: rng.normal(size=(90, 40)) * np.logspace(0, -8, 40),
         "upward": lambda: rng.normal(size=(90, 40)) * np.logspace(-8, 0, 40), "clusters": lambda: np.diag([5.0] * 20 + [1.0] * 20) @ q,
         "tight": lambda: np.diag(5 + 1e-9 * np.arange(40)) @ q, "equal": lambda: np.eye(40),
         "wilkinson": lambda: np.diag(np.abs(np.arange(-10.0, 11)) + 1) + np.diag(np.ones(20), 1),
         "integers": lambda: np.triu(rng.integers(-2, 3, size=(12, 12)).astype(float)), "short": lambda: rng.normal(size=(3, 40))}[name]()
    r = np.linalg.qr(r, mode="r")
    values, z = wh.singular_pairs(r, 16)
    want = np.linalg.svd(r, compute_uv=False)[:len(values)] ** 2
    full = values > 1e-10 * values[0]
    assert np.allclose(values[full], want[:full.sum()], rtol=1e-12) and (want[full.sum():] <= 1e-9 * want[0]).all()
    assert ortho(z[:, full]) < 1e-11
    assert np.abs(r.T @ (r @ z[:, full]) - z[:, full] * values[full]).max() < 1e-12 * values[0]


def test_dqds_is_accurate_for_tiny_values():
    """A bidiagonal matrix fixes all its singular values to high relative accuracy, the smallest ones too."""
    a, b = 10.0 ** -np.arange(0, 12.0), np.full(11, 1e-13)
    values = wh.dqds(a ** 2, b ** 2)
    assert np.allclose(values, a ** 2, rtol=1e-3) and np.isclose(np.prod(values / a ** 2), 1.0, rtol=1e-12)
