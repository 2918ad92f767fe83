import numpy as np

from clientele.llm import embedding_dedup as dedup
from clientele.llm import queries

SCHEMA = "vec_id long, embedding array<float>, label int, node string, n_links string"


def made():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 24))
    for i in range(0, 120, 3):
        x[i + 1] = x[i] + rng.normal(size=24) * rng.uniform(0.05, 0.6)
    x[150:230] = x[149] + rng.normal(size=(80, 24)) * 0.05
    x[240:260] = x[239]
    x[261] = x[260] * 7
    return x.astype(np.float32)


def brute(x, threshold=0.9):
    x = x.astype(np.float64)
    n = np.linalg.norm(x, axis=1)
    link = (x @ x.T) / (n[:, None] * n[None]) >= threshold
    np.fill_diagonal(link, False)
    root = np.arange(len(x))
    while True:
        new = np.minimum(root, np.where(link, root[None], len(x)).min(axis=1))
        if (new == root).all():
            return link.sum(axis=1), root
        root = new


def test_query_against_brute_force_with_odd_vectors(spark, tmp_path):
    x = made()
    odd = [None, [], [0.0] * 24, [None] + [1.0] * 23, [float("nan")] * 24, [float("inf")] * 24, [1.0, 0.0], [2.0, 0.0]]
    rows = [(i, v.tolist(), 0, "x", "y") for i, v in enumerate(x)]
    rows += [(1000 + i, v, None, "x", "y") for i, v in enumerate(odd)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {r.vec_id: r for r in queries.op3_embedding_duplicates(spark, str(tmp_path)).collect()}
    links, root = brute(x)
    assert len(got) == len(rows) and links.max() >= 80
    assert [got[i].n_links for i in range(len(x))] == links.tolist()
    assert [got[i].component_id for i in range(len(x))] == root.tolist()
    for i in range(1000, 1006):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert (got[1006].n_links, got[1007].component_id, got[1007].kept) == (1, 1006, False)


def test_blocks_give_the_same_links(spark):
    x = made()
    frame = spark.createDataFrame([(i, v.tolist(), 0, "", "") for i, v in enumerate(x)], SCHEMA)
    a = sorted(map(tuple, dedup.embedding_duplicates(frame, block=20).collect()))
    assert [r[1] for r in a] == brute(x)[0].tolist()


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 64))
    x[300:] = x[:300] + rng.normal(size=(300, 64)) * 0.3
    coding = dedup.Coding.of(600)
    codes, factors = dedup.encode(x, coding)
    got, bound = dedup.estimates(codes, factors, x, coding)
    true = dedup.unit(x) @ dedup.unit(x).T
    off = ~np.eye(600, dtype=bool)
    assert abs((got - true)[off].mean()) < 0.002
    assert ((np.abs(got - true) <= bound[:, None])[off]).mean() > 0.9995


def test_repeated_rows_and_null_ids(spark):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [1.0, 2.0]), (None, None), (4, [-1.0, 5.0])]
    frame = spark.createDataFrame([(*r, 0, "", "") for r in rows], SCHEMA)
    out = sorted(map(tuple, dedup.embedding_duplicates(frame).collect()), key=str)
    assert out == sorted(
        [(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 0, None, True), (4, 0, 4, True)], key=str
    )


def test_empty_table(spark):
    assert dedup.embedding_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
