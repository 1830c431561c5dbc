import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm.whitening import integers, leading, polar, whiten

SCHEMA = "vec_id long, embedding array<float>"


def matrices():
    rng = np.random.default_rng(1)
    q = lambda n: np.linalg.qr(rng.standard_normal((n, n)))[0]
    for values in (
        rng.random(40), np.ones(6), [5, 5, 5, 1, 1, 0], [1e12, 1.0, 1e-3, 0], [3.0], np.repeat([2.0, 1.0], 20),
        10.0 ** -np.arange(30), [1, 1 + 1e-9, 2], [0, 0, 0], np.arange(64) % 3,
    ):
        u = q(len(values))
        a = u @ np.diag(np.asarray(values, float)) @ u.T
        yield (a + a.T) / 2
    yield np.diag([4.0, 4.0, 1.0])
    yield np.array([[0, 1], [1, 0.0]])


@pytest.mark.parametrize("a", list(matrices()))
def test_leading_like_a_library(a):
    values, vectors = leading(a, 16)
    k, size = min(16, len(a)), max(1e-300, np.linalg.norm(a, 2))
    assert np.allclose(values, np.linalg.eigvalsh(a)[::-1][:k], rtol=0, atol=1e-13 * size * len(a))
    assert np.abs(vectors @ vectors.T - np.eye(k)).max() < 1e-13 * len(a)
    assert np.abs(a @ vectors.T - vectors.T * values).max() < 1e-13 * size * len(a)


def test_polar():
    rng = np.random.default_rng(2)
    a = rng.standard_normal((30, 30))
    a = a + a.T
    values, u = np.linalg.eigh(a)
    assert np.abs(polar(a) - u @ np.diag(np.sign(values)) @ u.T).max() < 1e-12


def brute_force(rows, k):
    kept = [(i, [int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v]) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = max(len(x) for _, x in kept)
    kept = [(i, tuple(x + [1_000_000] * (width - len(x)))) for i, x in kept]
    fit = sorted({x for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    y = np.array(fit, float) - 1_000_000
    mean = y.mean(0)
    values, vectors = np.linalg.eigh((y - mean).T @ (y - mean) / n)
    values, vectors = values[::-1], vectors.T[::-1]
    out = []
    for i, x in kept:
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        for j in range(k):
            out.append((i, j + 1, n, deviation, float((np.array(x, float) - 1_000_000 - mean) @ vectors[j]) / values[j] ** 0.5, values[j] / values.sum()))
    return out


def rows_of(spark, rows, k):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("a") for c in ("x", "key", "n", "component")})
    return whiten(df.repartition(3), "vec_id", integers(F.col("embedding")), k).collect()


def test_like_brute_force(spark):
    rng = np.random.default_rng(3)
    scale = 2.0 ** -np.arange(6)
    rows = [(i, [float(c) for c in np.float32(rng.standard_normal(6) * scale * 3 + 2)]) for i in range(400)]
    rows += [(1000 + i % 3, rows[7][1]) for i in range(200)]  # a hot vector counts once
    rows += [(2000, None), (2001, [1.0, None]), (2002, [float("nan")] * 6), (2003, [float("inf")] * 6), (2004, [1.0, 2.0]), (2005, []), (None, [0.5] * 6)]
    found, wanted = rows_of(spark, rows, 4), brute_force(rows, 4)
    sort = lambda rs: sorted(rs, key=lambda r: (str(r[0]), r[1], int(r[3])))
    found, wanted = sort([tuple(r) for r in found]), sort(wanted)
    assert [(r[0], r[1], r[2], int(r[3])) for r in found] == [r[:4] for r in wanted]
    assert np.allclose([r[5] for r in found], [r[5] for r in wanted], rtol=1e-10)
    for j in range(1, 5):
        a, b = (np.array([r[4] for r in rs if r[1] == j]) for rs in (found, wanted))
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-9
    assert {r[6] for r in found} == {found[0][6]} and found[0][6] < 1e-9


def test_small_tables(spark):
    assert rows_of(spark, [], 16) == []
    assert rows_of(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])], 16) == []  # nothing varies
    assert rows_of(spark, [(1, None), (2, [])], 16) == []
    found = rows_of(spark, [(1, [0.0, 5.0]), (2, [1.0, 5.0])], 16)
    assert [(r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in found] in (
        [(1, 1, 2, 64**2, 1.0, 1.0), (2, 1, 2, 64**2, 1.0, 1.0)], [(2, 1, 2, 64**2, 1.0, 1.0), (1, 1, 2, 64**2, 1.0, 1.0)])


def test_huge_entries_stay_exact(spark):
    rows = [(i, [1e9 * i, -3e8 * i * i, 1e30 if i == 4 else 0.25 * i]) for i in range(5)]
    found = {r.vec_id: r.deviation for r in rows_of(spark, rows, 3) if r.component == 1}
    x = [[min(int(np.floor(64 * float(np.float32(c)))), 1 << 52) + 1_000_000 for c in v] for _, v in rows]
    sums = [sum(c) for c in zip(*x)]
    assert found == {i: sum((5 * c - s) ** 2 for c, s in zip(v, sums)) for i, v in enumerate(x)}
