import math
import random

import numpy as np
import pytest

from termflow.llm.whitening import eigenvectors, op11_embedding_whitening, polar_factor, whitened

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, components=4):
    """{(row, component): (id, n, deviation, |whitened| with sign fixed later, explained)} by numpy."""
    ok = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows
          if v is not None and len(v) and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in ok})
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    f = np.array(fit, float)
    y = f - np.array(s) / n
    v = y.T @ y / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    out = []
    for i, x in ok:
        dev = sum((n * a - b) ** 2 for a, b in zip(x, s))
        for k in range(min(components, len(s))):
            out.append((i, k + 1, n, dev, (np.array(x) - np.array(s) / n) @ u[:, k] / math.sqrt(e[k]), e[k] / np.trace(v)))
    return out


def agree(got, want, tolerance=1e-9):
    got = sorted(tuple(r) for r in got)
    want = sorted(want, key=lambda r: r[:2])
    assert [r[:4] for r in got] == [r[:4] for r in want]
    for k in {r[1] for r in want}:
        a = np.array([r[4] for r in got if r[1] == k])
        b = np.array([r[4] for r in want if r[1] == k])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < tolerance
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9)
    assert all(0 <= r[6] < 1e-9 for r in got)


@pytest.mark.parametrize("n", [1, 2, 3, 8, 64, 150])
def test_eigenvectors(n):
    rng = np.random.default_rng(n)
    q = np.linalg.qr(rng.normal(size=(n, n)))[0]
    for values in (rng.random(n), np.linspace(1, 2, n), np.repeat([3.0, 1.0], [n // 2, n - n // 2]), 10.0 ** -np.arange(n).clip(0, 30),
                   np.ones(n), np.zeros(n), np.append(np.zeros(n - 1), 1e9)):
        a = q * values @ q.T
        a = (a + a.T) / 2
        e, u = eigenvectors(a)
        scale = max(np.linalg.norm(a), 1e-300)
        assert np.abs(u.T @ u - np.eye(n)).max() < 1e-12
        assert np.abs(a @ u - u * e).max() < 1e-13 * n * scale
        assert np.abs(e - np.linalg.eigvalsh(a)[::-1]).max() < 1e-13 * n * scale


def test_polar_factor():
    a = np.diag([5.0, 1e-9, -3.0]) + 0.0
    assert np.allclose(polar_factor(a), np.diag([1.0, 1.0, -1.0]), atol=1e-12)


def test_as_numpy(spark):
    rng = np.random.default_rng(0)
    base = rng.normal(size=(400, 9)) * np.arange(1, 10) + 5
    rows = [(i, list(map(float, v))) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[i % 3][1]) for i in range(300)]  # copies count once in the fit
    rows += [(None, rows[9][1]), (7, rows[8][1])]
    bad = [(2000, None), (2001, [1.0] * 8 + [None]), (2002, [1.0] * 8 + [float("nan")]), (2003, [float("inf")] * 9), (2004, [])]
    got = whitened(spark.createDataFrame(rows + bad, SCHEMA).repartition(5)).where("vec_id IS NOT NULL AND vec_id <> 7").collect()
    agree(got, [r for r in brute(rows) if r[0] not in (None, 7)])
    assert whitened(spark.createDataFrame(rows + bad, SCHEMA)).count() == 4 * len(rows)


def test_same_for_any_partitions(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) for _ in range(5)]) for i in range(200)]
    a, b = (sorted(map(tuple, whitened(spark.createDataFrame(rows, SCHEMA).repartition(p)).drop("identity_error").collect())) for p in (1, 7))
    assert a == b


def test_large_numbers_are_exact(spark):
    rng = random.Random(3)
    rows = [(i, [rng.uniform(-1e9, 1e9) for _ in range(4)]) for i in range(60)]
    want = brute(rows)
    got = whitened(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r[0], r[1]): r[3] for r in got} == {(r[0], r[1]): r[3] if r[3] < 2**63 else None for r in want}
    huge = whitened(spark.createDataFrame([(1, [1e17, 2.0]), (2, [-1e17, 3.0]), (3, [0.0, 4.0])], SCHEMA)).collect()
    assert len(huge) == 6 and all(r["deviation"] is None for r in huge if r["vec_id"] != 3)


def test_degenerate_inputs(spark):
    assert whitened(spark.createDataFrame([], SCHEMA)).count() == 0
    one = whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(1, 0, None, None, None)] * 4
    line = whitened(spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(9)], SCHEMA)).collect()
    assert all((r["whitened"] is None) == (r["component"] > 1) for r in line)
    assert all(abs(r["explained"] - (r["component"] == 1)) < 1e-12 and r["identity_error"] < 1e-9 for r in line)
    mixed = whitened(spark.createDataFrame([(i, [float(i), float(i * i % 7)][:1 + i % 2]) for i in range(20)], SCHEMA)).collect()
    assert {r["n"] for r in mixed} == {10} and len(mixed) == 10 + 20
    named = spark.createDataFrame([(i, [float(i)], "a", 3) for i in range(3)], "vec_id long, embedding array<double>, x string, n int")
    assert whitened(named).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_query_on_the_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    agree(op11_embedding_whitening(spark, "/root/testdata/sf0.001").collect(), brute(rows))
