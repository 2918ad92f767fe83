import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from clientele.llm import queries, topk

SCHEMA = "vec_id long, embedding array<float>, rank int, score string, x string, entry int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "s", "x", 2) for i, v in rows], SCHEMA)


def whole(v):
    return [math.floor(256 * float(np.float32(x))) for x in v]


def brute(rows, k=5, asks=lambda i: i % 50 == 0):
    """Scores of all pairs in whole numbers of any size."""
    kept = set()
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(np.float32(x)) for x in v):
            if sum(c * c for c in whole(v)) < 1 << 62:
                kept.add((i, tuple(whole(v))))
    out = []
    for i, q in kept:
        if asks(i):
            near = sorted(
                (-sum(a * b for a, b in zip(q, v)), j) for j, v in kept if (j, v) != (i, q) and len(v) == len(q)
            )
            out += [(i, at + 1, j, -s) for at, (s, j) in enumerate(near[:k])]
    return sorted(out)


def rows_of(df):
    assert df.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, df.collect()))


def odd(rng):
    rows = [(i, rng.normal(size=7).tolist()) for i in range(260)]
    rows += [(300 + i, rows[9][1]) for i in range(60)]  # copies of one vector
    rows += [(100, rows[100][1])] * 3  # repeated rows
    rows += [(50, rng.normal(size=7).tolist()), (51, rows[50][1])]  # an id with two vectors
    rows += [(400, None), (450, [float("nan")] * 7), (500, [float("inf")] + [0.0] * 6), (550, [None] * 7)]
    rows += [(600, [0.0] * 7), (650, []), (700, []), (None, rows[3][1])]
    rows += [(750, [1.0, 2.0]), (800, [3.0, -4.0]), (850, [5.0])]
    rows += [(900, [1e30] * 7), (950, [3e6, -2e6] + [1.0] * 5), (951, [3e6, -2e6] + [2.0] * 5)]
    return rows


@pytest.mark.parametrize("lists", [1, 2, 4])
def test_all_rows_against_brute_force(spark, lists):
    rows = odd(np.random.default_rng(1))
    got = topk.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0, lists=lists)
    assert rows_of(got) == brute(rows)


def test_chunks_and_blocks_meet_each_other(spark, monkeypatch):
    monkeypatch.setattr(topk, "CHUNK", 20)
    monkeypatch.setattr(topk, "BLOCK", 7)
    monkeypatch.setattr(topk, "SLICE", 3)
    rows = odd(np.random.default_rng(2))
    got = topk.top_k(frame(spark, rows), F.col("vec_id") % 7 == 0, k=3)
    assert rows_of(got) == brute(rows, 3, lambda i: i % 7 == 0)


def test_scores_beyond_what_doubles_hold(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=6) * 2e6
    rows = [(i, (base + rng.normal(size=6) * 10).tolist()) for i in range(120)]
    want = brute(rows)
    assert max(abs(s) for *_, s in want) > 1 << 56
    assert rows_of(topk.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0)) == want


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [1.0, 0.0]) for i in range(30)] + [(100 + i, [0.0, 1.0]) for i in range(30)]
    assert rows_of(topk.top_k(frame(spark, rows), F.col("vec_id") == 3)) == [
        (3, at + 1, j, 65536) for at, j in enumerate([0, 1, 2, 4, 5])
    ]


def test_the_cutoff_leaves_most_pairs_out(spark):
    """The second phase is no exhaustive list, and what it lists is enough."""
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(3000, 16)))]
    seen = []
    whole_product = topk.product
    try:
        topk.product = lambda a, b: seen.append(1) or whole_product(a, b)
        assert rows_of(topk.top_k(frame(spark, rows), F.col("vec_id") % 50 == 0)) == brute(rows)
    finally:
        topk.product = whole_product
    assert len(seen) == 2  # heads and survivors only


def test_few_others_and_empty_tables(spark):
    assert rows_of(topk.top_k(frame(spark, []), F.col("vec_id") % 50 == 0)) == []
    assert rows_of(topk.top_k(frame(spark, [(50, [1.0])]), F.col("vec_id") % 50 == 0)) == []
    two = [(50, [1.0]), (51, [-1.0])]
    assert rows_of(topk.top_k(frame(spark, two), F.col("vec_id") % 50 == 0)) == [(50, 1, 51, -65536)]
    assert rows_of(topk.top_k(frame(spark, [(1, [1.0])]), F.col("vec_id") % 50 == 0)) == []


def test_query_against_sql(spark, tmp_path):
    rows = [r for r in odd(np.random.default_rng(5)) if r[0] not in (900, None)]
    frame(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = duck.execute(queries.REFERENCE_SQL["op11_exact_top_k"]).fetchall()
    assert rows_of(queries.op11_exact_top_k(spark, str(tmp_path))) == sorted(want) == brute(rows)
