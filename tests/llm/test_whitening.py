import math

import numpy as np
import pytest

from clientele.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<float>, n string, component string, x int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "n", "c", 1) for i, v in rows], SCHEMA)


def whole(v):
    return tuple(math.floor(256 * float(np.float32(c))) for c in v)


def brute(rows, k=4):
    """Vectors in whole numbers, and covariance and eigenvectors of the distinct ones, all by numpy."""
    kept = [
        (i, whole(v)) for i, v in rows if v is not None and all(c is not None and np.isfinite(np.float32(c)) for c in v)
    ]
    fit = sorted({x for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    x = np.array(fit, float) - np.array([s / n for s in sums])
    values, vectors = np.linalg.eigh(x.T @ x / n)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    trace = np.square(x).sum() / n
    out = []
    for i, v in kept:
        deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums))
        z = (np.array(v, float) - np.array([s / n for s in sums])) @ vectors / np.sqrt(values)
        out += [(i, at + 1, n, deviation, z[at], values[at] / trace) for at in range(len(values))]
    return out


def check(got, want):
    by = lambda r: (r[0] is None, r[0] or 0, r[1], r[3])
    got, want = sorted(map(tuple, got), key=by), sorted(want, key=by)
    assert [r[:4] for r in got] == [r[:4] for r in want]
    assert all(r[6] <= 1e-10 for r in got)
    for component in {r[1] for r in got}:
        ours = np.array([r[4] for r in got if r[1] == component])
        theirs = np.array([r[4] for r in want if r[1] == component])
        sign = np.sign(ours @ theirs)
        assert np.allclose(ours, sign * theirs, rtol=1e-7, atol=1e-7)
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-10)


@pytest.mark.parametrize("seed,size", [(1, (400, 24)), (2, (60, 5)), (3, (30, 80))])
def test_against_a_full_decomposition(spark, seed, size):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=size) * rng.uniform(0.2, 2, size[1])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    check(whitening.whitened(frame(spark, rows)).collect(), brute(rows))


def test_odd_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(80)]
    rows += [(200 + i, rows[3][1]) for i in range(70)] + [(5, rows[5][1])] * 3 + [(5, rows[6][1]), (None, rows[7][1])]
    rows += [(300, [0.0] * 6)]
    out = [(301, None), (302, [None] * 6), (303, [float("nan")] * 6), (304, [float("-inf")] * 6), (305, [1e38] * 6)]
    check(whitening.whitened(frame(spark, rows + out)).collect(), brute(rows))


def test_lengths_are_whitened_apart(spark):
    rng = np.random.default_rng(5)
    a = [(i, rng.normal(size=6).tolist()) for i in range(50)]
    b = [(100 + i, rng.normal(size=2).tolist()) for i in range(50)]
    got = whitening.whitened(frame(spark, a + b + [(1, []), (2, [])])).collect()
    check([r for r in got if r.vec_id < 100], brute(a))
    check([r for r in got if r.vec_id >= 100], brute(b))


def test_nothing_to_whiten(spark):
    assert whitening.whitened(frame(spark, [])).count() == 0
    assert whitening.whitened(frame(spark, [(1, [1.0, 2.0])] * 5)).count() == 0
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(20)]
    got = whitening.whitened(frame(spark, line)).collect()
    assert {r.component for r in got} == {1} and len(got) == 20 and got[0].explained == pytest.approx(1)


def test_deviations_of_any_size():
    x = np.array([[1 << 40, 3], [5, -(1 << 31)], [(1 << 61), 0], [2, 2]])
    sums = [int(v) for v in x.sum(axis=0)]
    want = [sum((4 * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    assert whitening.deviations(x, 4, sums) == [v if v < 1 << 63 else None for v in want]
    sums = [7, -9]
    want = [sum((4 * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    assert whitening.deviations(x, 4, sums) == [v if v < 1 << 63 else None for v in want]


@pytest.mark.parametrize("kind", ["flat", "steep", "equal", "close", "negative"])
def test_leading_pairs_of_any_spectrum(kind):
    rng = np.random.default_rng(6)
    values = {
        "flat": 1 + 0.01 * rng.normal(size=90),
        "steep": 10.0 ** -np.arange(90),
        "equal": np.repeat([5.0, 1.0], [6, 84]),
        "close": np.concatenate([[1, 1 - 1e-9, 1 - 2e-9, 1 - 3e-9], rng.uniform(0, 0.9, 86)]),
        "negative": rng.normal(size=90),
    }[kind]
    q, _ = np.linalg.qr(rng.normal(size=(90, 90)))
    a = (q * values) @ q.T
    a = (a + a.T) / 2
    found = whitening.jacobi_davidson(lambda x: a @ x, 90, 4)
    assert np.allclose(found.values, np.sort(values)[::-1][:4], atol=1e-12 * np.abs(values).max())
    assert np.abs(found.vectors.T @ found.vectors - np.eye(4)).max() < 1e-12
    residuals = a @ found.vectors - found.vectors * found.values
    assert np.linalg.norm(residuals, axis=0).max() <= 1e-13 * np.abs(values).max()


def test_corrections_solve_their_equation():
    rng = np.random.default_rng(7)
    a = rng.normal(size=(30, 30))
    a = a + a.T
    q, _ = np.linalg.qr(rng.normal(size=(30, 2)))
    theta = np.array([1.3, -0.4])
    r = rng.normal(size=(30, 2))
    r -= q @ (q.T @ r)
    t = whitening.minres(lambda x: a @ x, theta, q, r, 200, 1e-13)
    left = a @ t - t * theta
    assert np.allclose(left - q @ (q.T @ left), -r, atol=1e-8) and np.abs(q.T @ t).max() < 1e-12


def test_query_returns_its_columns(spark, tmp_path):
    rows = [(i, v.tolist()) for i, v in enumerate(np.random.default_rng(8).normal(size=(100, 8)))]
    frame(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op13_whitened_embeddings(spark, str(tmp_path))
    assert ",".join(f"{n} {t}" for n, t in got.dtypes) == whitening.OUT.replace(", ", ",").replace("long", "bigint")
    check(got.collect(), brute(rows))


def test_products_take_the_tasks_that_the_vectors_fill(spark, monkeypatch):
    monkeypatch.setattr(whitening, "PARTITION", 20)
    x = [[i, i * i % 17, -i] for i in range(50)]
    spread = spark.createDataFrame([(v,) for v in x], "x array<long>").repartition(29)
    of = whitening.Fit(spread, 3)
    assert of.blocks.rdd.getNumPartitions() == 3 and of.n == 50
    centred = np.array(x, float) - of.mean
    assert np.allclose(of.product(np.eye(3)), centred.T @ centred / 50)
