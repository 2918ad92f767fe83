import duckdb
import pytest
from pyspark.sql import functions as F

from clientele.llm import mixing, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, _row int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, "x", 7) for i, t, s in rows], SCHEMA)


def words(n):
    return " ".join(["w"] * n)


def water(sizes, weights, ceiling):
    """Share out by weight, stop at the ceiling, share the excess again."""
    target, total, open_ = dict.fromkeys(sizes, 0.0), sum(sizes.values()), set(sizes)
    while open_:
        left = total - sum(target[s] for s in sizes if s not in open_)
        w = sum(weights[s] for s in open_)
        over = {s for s in open_ if left * weights[s] / w > ceiling * sizes[s]}
        if not over:
            for s in open_:
                target[s] = left * weights[s] / w
            break
        for s in over:
            target[s] = float(ceiling * sizes[s])
        open_ -= over
    return target


def test_targets_share_the_excess_again(spark):
    sizes = {"a": 1000, "b": 10, "c": 20, "d": 400, "é": 5, None: 50}
    frame = spark.createDataFrame(list(sizes.items()), "source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(frame).collect()}
    names = sorted([s for s in sizes if s], key=str) + [None]
    weights = {s: i % 3 + 1 for i, s in enumerate(names)}
    assert got == pytest.approx(water(sizes, weights, 3))


def test_taken_words_come_near_the_target(spark):
    rows = [(i, words(1 + i * 7 % 90), f"s{i % 4}" if i % 3 else "s0") for i in range(900)]
    rows += [(5000 + i, words(12), "s0") for i in range(400)]
    frame = docs(spark, rows)
    sized = frame.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"))
    out = mixing.systematic_copies(sized).collect()
    assert len(out) == len(rows)
    for source in {r.source for r in out}:
        of = [r for r in out if r.source == source]
        taken = sum(r.size * r.copies for r in of)
        assert abs(taken - of[0].target) <= 2 * max(r.size for r in of)
        assert all(0 <= r.copies <= 3 for r in of)
    again = mixing.systematic_copies(sized.repartition(3)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, out))


def test_mix_repeats_whole_rows_and_keeps_the_columns(spark):
    frame = docs(spark, [(1, words(5), "a"), (1, words(5), "a"), (2, None, "a"), (3, "", None), (None, words(300), "b")])
    out = mixing.mix(frame)
    assert out.columns == frame.columns
    rows = out.collect()
    assert sum(r.doc_id == 3 for r in rows) == 0  # a source without words
    assert sum(r.doc_id == 1 for r in rows) >= 2 and {r["_row"] for r in rows} == {7}


def test_empty_and_wordless_tables(spark):
    assert mixing.mix(docs(spark, [])).count() == 0
    assert mixing.mix(docs(spark, [(1, None, None), (2, " \n", "a")])).count() == 0


def test_query_against_sql_with_nulls_and_repeats(spark, tmp_path):
    rows = [(i, words(i % 17), None if i % 5 == 0 else f"s{i % 6}") for i in range(200)]
    rows += [(7, words(3), "s1"), (7, words(3), "s1"), (8, None, None), (9, "a\u00a0b\x1fc", "Z")]
    frame = docs(spark, rows)
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op10_source_mix(spark, str(tmp_path))
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = duck.execute(queries.REFERENCE_SQL["op10_source_mix"])
    names = [c[0] for c in want.description]
    key = lambda r: tuple(-1 if v is None else v for v in r)
    assert sorted((tuple(r[c] for c in names) for r in got.collect()), key=key) == sorted(
        want.fetchall(), key=key
    )
