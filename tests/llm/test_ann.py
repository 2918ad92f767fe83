import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clientele.llm import ann, queries

SCHEMA = "vec_id long, embedding array<float>, label int, part int, key string"


def brute(rows, k=20, every=20):
    """Ids and scores of the nearest by inner product; rows of one id with different vectors are rows of their own."""
    kept = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)})
    out = {}
    for i, q in kept:
        if i % every == 0:
            near = [(-float(np.dot(np.float64(q), np.float64(v))), j) for j, v in kept if (j, v) != (i, q) and len(v) == len(q)]
            out[i] = out.get(i, []) + [(j, -s) for s, j in sorted(near)[:k]]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "k") for i, v in rows], SCHEMA)


def test_hilbert_neighbours_differ_in_one_step():
    for dims in (2, 3):
        cells = np.stack(np.meshgrid(*[np.arange(8)] * dims), -1).reshape(-1, dims)
        key = ann.hilbert(cells, 3)
        assert sorted(key) == list(range(8**dims))
        path = cells[np.argsort(key)]
        assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_ties_odd_rows_and_repeats(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in np.float32(rng.normal(size=8))]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)] + [(5, rows[5][1])] * 2
    rows += [(2000, None), (2020, []), (2040, [0.0] * 8), (2060, [None] * 8), (2080, [float("nan")] * 8), (None, rows[3][1])]
    rows += [(2100, [1.0, 2.0]), (2120, [3.0, 4.0]), (2140, [float(x) for x in np.float32(rng.normal(size=8) * 50)])]
    frame(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    got, want = {}, brute(rows)
    for r in queries.op9_nearest_neighbours(spark, str(tmp_path)).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(got.setdefault(r.query_id, [])) + 1
        got[r.query_id].append((r.vec_id, r.score))
    assert {q: len(n) for q, n in got.items()} == {q: len(n) for q, n in want.items()}
    assert got[2100] == want[2100] and got[2120] == want[2120]
    true = brute(rows, k=10**6)
    assert all(dict(true[q])[i] == pytest.approx(s, rel=1e-12) for q, n in got.items() for i, s in n)
    assert all(n == sorted(n, key=lambda p: (-p[1], p[0])) for n in got.values())
    hits = sum(len({i for i, _ in n} & {i for i, _ in want[q]}) for q, n in got.items())
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_rows_of_one_id_are_rows_of_their_own(spark):
    rows = [(20, [1.0, 0.0]), (1, [0.9, 0.1]), (1, [0.1, 0.9]), (2, [0.5, 0.5]), (40, [0.0, 1.0]), (40, [0.0, -1.0])]
    got = {}
    for r in ann.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, pytest.approx(r.score, rel=1e-7)))
    want = {i: [(j, float(np.float32(s))) for j, s in near] for i, near in brute(rows).items()}
    assert got[20] == want[20] and (1, pytest.approx(0.9)) in got[20]
    assert len(got[40]) == len(want[40]) == 10


def test_recall_of_windows_on_random_vectors(spark):
    rng = np.random.default_rng(2)
    x = np.float32(rng.normal(size=(4000, 32)))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    found = ann.nearest(frame(spark, rows), F.col("vec_id") % 20 == 0).collect()
    true = {q: {i for i, _ in near} for q, near in brute(rows).items()}
    hits = sum(r.vec_id in true[r.query_id] for r in found)
    assert 0.9 <= hits / (20 * len(true)) < 1


@pytest.mark.parametrize("lengths", ["one", "spread"])
def test_recall_with_unequal_lengths(spark, lengths):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(22_000, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    if lengths == "one":
        x[17] *= 30
    else:
        x *= np.exp2(rng.integers(-3, 1, len(x)) + rng.uniform(size=len(x)))[:, None]
        x[17] *= 1000
    x = np.float32(x)
    vectors = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(x)), "embedding": x.tolist()}), "vec_id long, embedding array<float>")
    found = ann.nearest(vectors, F.col("vec_id") % 100 == 0).collect()
    asked = np.arange(0, len(x), 100)
    products = np.float64(x[asked]) @ np.float64(x).T
    products[np.arange(len(asked)), asked] = -np.inf
    true = {q: set(np.argsort(-row)[:20]) for q, row in zip(asked, products)}
    assert len(found) == 20 * len(asked)
    assert sum(r.vec_id in true[r.query_id] for r in found) >= 0.9 * len(found)


def test_windows_at_the_ends_are_as_long_as_others():
    counts = [10] * 20
    first, last = ann.windows(counts, 40)
    assert set(last - first) == {4} and first[0] == 0 and last[-1] == 19
    assert all(f <= i <= b for i, (f, b) in enumerate(zip(first, last)))
    first, last = ann.windows([3, 50, 7], 60)
    assert first.tolist() == [0, 0, 0] and last.tolist() == [2, 2, 2]


def test_scores_are_inner_products(spark):
    rng = np.random.default_rng(3)
    x = np.float32(rng.normal(size=(50, 5)))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    for r in ann.nearest(frame(spark, rows), F.col("vec_id") == 4, k=3).collect():
        assert r.score == pytest.approx(float(np.dot(np.float64(x[4]), np.float64(x[r.vec_id]))), rel=1e-14)


def test_empty_table(spark):
    assert ann.nearest(frame(spark, []), F.col("vec_id") % 20 == 0).count() == 0
