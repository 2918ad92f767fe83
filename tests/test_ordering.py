"""Exact ranks and quantiles against brute force, with bins listed and narrowed."""

import random
from decimal import Decimal

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clientele.functions import ordering
from clientele.functions.ordering import Sample, Tiling


@pytest.fixture(params=["listed", "narrowed", "narrowed in few steps"])
def path(request, monkeypatch):
    if request.param != "listed":
        monkeypatch.setattr(ordering, "LISTED", 1)
    if request.param.endswith("few steps"):
        monkeypatch.setattr(ordering, "STEPS", 3)
        monkeypatch.setattr(ordering, "OCTAVE", 1)
    return request.param


def ntile(rows, tiles):
    """SQL NTILE by (value, id)."""
    ordered = sorted(rows, key=lambda r: (r[1], r[0]))
    size, extra = divmod(len(ordered), tiles)
    out, at = {}, 0
    for tile in range(1, tiles + 1):
        for _ in range(size + (1 if tile <= extra else 0)):
            out[ordered[at][0]] = tile
            at += 1
    return out


def tie_heavy(n=600, seed=3):
    """A third of the rows share one value."""
    rng = random.Random(seed)
    return [(i, 7 if rng.random() < 0.34 else rng.randrange(60)) for i in rng.sample(range(n * 3), n)]


CASES = {
    "ties": tie_heavy(),
    "distinct": [(i, (i * 7919) % 1009) for i in range(500)],
    "all equal": [(i, 5) for i in range(47)],
    "fewer rows than tiles": [(10, 3), (11, 1), (12, 2)],
    "one row": [(1, 1)],
}


@pytest.mark.parametrize("case", CASES)
def test_tiles_equal_sql_ntile(spark, path, case):
    rows = CASES[case]
    df = spark.createDataFrame(rows, "id long, v int").repartition(4)
    tiled = ordering.add_tiles(df, "id", [Tiling("v", "tile", 5)])
    assert {r.id: r.tile for r in tiled.collect()} == ntile(rows, 5)


def test_several_columns_at_once_and_reversed_labels(spark, path):
    rows = [(i, v, Decimal(v * 100 + i % 3) / 100) for i, v in tie_heavy(seed=9)]
    df = spark.createDataFrame(rows, "id long, v int, m decimal(18,2)")
    tiled = ordering.add_tiles(
        df, "id", [Tiling("v", "a", 5, descending_label=True), Tiling("m", "b", 4)]
    ).collect()
    assert {r.id: 6 - r.a for r in tiled} == ntile([(i, v) for i, v, _ in rows], 5)
    assert {r.id: r.b for r in tiled} == ntile([(i, m) for i, _, m in rows], 4)


def test_nulls_have_no_tile(spark, path):
    df = spark.createDataFrame([(1, None), (2, 4), (3, 9)], "id long, v int")
    tiled = ordering.add_tiles(df, "id", [Tiling("v", "tile", 2)])
    assert {r.id: r.tile for r in tiled.collect()} == {1: None, 2: 1, 3: 2}


def test_no_rows(spark, path):
    df = spark.createDataFrame([], "id long, v int")
    assert ordering.add_tiles(df, "id", [Tiling("v", "tile", 5)]).count() == 0
    assert ordering.percentiles(df, [(Sample(F.col("v")), [0.5])]) == [[None]]


def test_percentiles_are_exact(spark, path):
    rows = tie_heavy(seed=5)
    df = spark.createDataFrame(rows, "id long, v int").withColumn("x", F.col("v") * 1.5)
    probabilities = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    plain, doubled, part = ordering.percentiles(
        df,
        [
            (Sample(F.col("v")), probabilities),
            (Sample(F.col("x")), probabilities),
            (Sample(F.col("v"), F.col("id") % 2 == 0), probabilities),
        ],
    )
    values = [v for _, v in rows]
    assert plain == pytest.approx(np.quantile(values, probabilities))
    assert doubled == pytest.approx(np.quantile([v * 1.5 for v in values], probabilities))
    even = [v for i, v in rows if i % 2 == 0]
    assert part == pytest.approx(np.quantile(even, probabilities))


def test_row_numbers_follow_value_and_tie_break(spark, path):
    rows = tie_heavy(seed=8)
    df = spark.createDataFrame(rows, "id long, v int")
    numbered = ordering.add_row_number(df, "v", "id", "n").collect()
    expected = {
        i: n for n, (i, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])), start=1)
    }
    assert {r.id: r.n for r in numbered} == expected


def test_running_totals(spark):
    rows = [(k * 0.37, k % 5, 1) for k in range(400)]
    df = spark.createDataFrame(rows, "k double, a long, b long").repartition(4)
    got = {r.k: (r.upto_a, r.upto_b) for r in ordering.running_totals(df, "k", ["a", "b"]).collect()}
    a = b = 0
    for k, x, y in rows:
        a, b = a + x, b + y
        assert got[k] == (a, b)


def test_rank_quantile_ends_match_interpolated_edges():
    for n in (1, 4, 5, 7, 10, 99):
        edges = [1 + (n - 1) * k / 5 for k in range(1, 5)]
        ends = [sum(1 for rank in range(1, n + 1) if rank <= e + 1e-9) for e in edges]
        assert ordering.rank_quantile_ends(n, 5) == ends


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.integers(0, 12), min_size=1, max_size=60))
def test_any_values(spark, values):
    rows = list(enumerate(values))
    df = spark.createDataFrame(rows, "id long, v int")
    before = ordering.LISTED
    try:
        ordering.LISTED = 1
        tiled = ordering.add_tiles(df, "id", [Tiling("v", "tile", 5)]).collect()
    finally:
        ordering.LISTED = before
    assert {r.id: r.tile for r in tiled} == ntile(rows, 5)


def test_numbers_of_every_size(spark, path):
    inf, nan = float("inf"), float("nan")
    doubles = [0.0, 1e-300, -1e-300, 1e300, -1e300, 1.7e308, -1.7e308, inf, -inf, nan, nan, 3.5, 3.5, 0.25, -0.25, 1e-9]
    longs = [(1 << 62) + i for i in range(8)] + [-(1 << 63), (1 << 63) - 1, 0, 1, -1, 7, 7, 7]
    df = spark.createDataFrame([(d, n) for d, n in zip(doubles, longs)], "d double, n long")
    samples = [Sample(F.col("d")), Sample(F.col("n"))]
    sizes = ordering.counts(df, samples)
    assert list(sizes) == [16, 16]
    ranks = list(range(1, 17))
    by_d, by_n = ordering.standings(df, [(s, ranks) for s in samples], sizes)
    order = sorted(doubles, key=lambda v: (v != v, v if v == v else 0))
    assert [repr(by_d[k].value) for k in ranks] == [repr(v) for v in order]
    assert [by_n[k].value for k in ranks] == sorted(longs)
    assert (by_n[7].below, by_n[7].ties) == (4, 3) if sorted(longs)[6] == 7 else True


def test_running_totals_of_a_million_scores(spark):
    df = spark.range(1_000_000).select((F.col("id") * 37 % 1_000_003).cast("double").alias("k"), F.lit(1).cast("long").alias("a"))
    totals = ordering.running_totals(df, "k", ["a"])
    low, high, total, wrong = (
        totals.withColumn("n", F.rank().over(ordering.W.partitionBy(F.floor(F.col("k") / 1000)).orderBy("k")))
        .agg(F.min("upto_a"), F.max("upto_a"), F.countDistinct("upto_a"), F.count_if(F.col("upto_a") > F.col("k") + 1))
        .first()
    )
    assert (low, high, total, wrong) == (1, 1_000_000, 1_000_000, 0)


def test_sums_run_in_parts_of_the_data(spark):
    df = spark.range(5000).select((F.col("id") % 977).cast("double").alias("k"), (F.col("id") % 3).cast("string").alias("g"), F.lit(2).alias("a"))
    plan = ordering.prefix_sums(df, ["k"], ["a"], ["g"])._jdf.queryExecution().toString()
    assert "Window" in plan and "_part" in plan.split("Window")[-1]
    got = ordering.prefix_sums(df, ["k"], ["a"], ["g"]).groupBy("g").agg(F.max("upto_a").alias("m"), F.countDistinct("upto_a").alias("n"))
    for r in got.collect():
        rows = 1667 if r.g in "01" else 1666
        assert (r.m, r.n) == (2 * rows, rows)
