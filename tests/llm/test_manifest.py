import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from clientele.llm import manifest, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, root string, rank int, scope int"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    fields = [None if f is None else str(f) for f in (doc_id, source, lang, n_chars, text)]
    return h("".join("-" if f is None else f"{len(f.encode())}:{f}" for f in fields))


def climb(digests):
    """All levels from the leaves up."""
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h("".join(below[i : i + 8])) for i in range(0, len(below), 8)])
    return levels


def way(levels, at):
    out = []
    for level in levels[:-1]:
        run = level[at // 8 * 8 : at // 8 * 8 + 8]
        out.append((run[: at % 8], run[at % 8 + 1 :]))
        at //= 8
    return out


def brute(rows):
    scopes = {}
    for row in rows:
        scopes.setdefault(row[2], []).append(row)
    order = sorted(scopes, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for lang in order:
        own = sorted(scopes[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        trees[lang] = (own, climb([leaf(*r) for r in own]))
    top = climb([trees[lang][1][-1][0] for lang in order])
    out = []
    for place, lang in enumerate(order):
        own, levels = trees[lang]
        for at, row in enumerate(own):
            path = way(levels, at) + way(top, place)
            doc_id, text, *rest = row
            if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None:
                text = text.translate(LOWER)
            now = leaf(doc_id, text, *rest)
            for left, right in path:
                now = h("".join([*left, now, *right]))
            proof = h("".join("".join(left + right) for left, right in path))
            out.append((doc_id, levels[0][at], levels[-1][0], top[-1][0], proof, now, now == top[-1][0]))
    return out


def key(row):
    return tuple((v is not None, v) for v in row)


def rows_of(df):
    assert df.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, df.collect()), key=key)


def tampered(df):
    return manifest.manifest(df, manifest.lowered(F.col("text"), F.col("doc_id")))


def some(n, lang="en", first=0):
    return [(first + i, f"Text {i} Ünï", lang, f"s{i % 3}", i) for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65, 513])
def test_one_scope_of_every_shape(spark, n):
    rows = some(n)
    assert rows_of(tampered(frame(spark, rows))) == sorted(brute(rows), key=key)


def test_scopes_nulls_and_repeats(spark):
    rows = some(90) + some(1, None, 200) + some(17, "é", 300) + some(8, "", 400) + some(3, "EN", 500)
    rows += [(7, "Text", "en", None, None)] * 12 + [(7, "", "en", None, None), (7, None, "en", None, None)]
    rows += [(None, None, None, None, None)] * 9 + [(None, "A", "en", "b", 1), (12, "Ab " * 90_000, "en", "-", 3)]
    for i in range(70):
        rows += some(1, f"l{i}", 1000 + i)
    got = rows_of(tampered(frame(spark, rows)))
    assert got == sorted(brute(rows), key=key)
    assert {r[-1] for r in got} == {True, False}


def test_untouched_data_verify(spark):
    assert all(r.verified for r in manifest.manifest(frame(spark, some(100) + some(3, None))).collect())


def test_every_change_of_a_text_shows(spark):
    rows = some(40)
    changed = F.when(F.col("doc_id") == 11, F.concat("text", F.lit(" "))).otherwise(F.col("text"))
    out = {r.doc_id: r.verified for r in manifest.manifest(frame(spark, rows), changed).collect()}
    assert [i for i, ok in out.items() if not ok] == [11]
    gone = F.when(F.col("doc_id") == 11, F.lit(None)).otherwise(F.col("text"))
    out = {r.doc_id: r.verified for r in manifest.manifest(frame(spark, rows), gone).collect()}
    assert [i for i, ok in out.items() if not ok] == [11]


def test_empty_table(spark):
    assert rows_of(tampered(frame(spark, []))) == []


def test_query_against_sql(spark, tmp_path):
    rows = some(200) + some(30, None, 300) + [(5, "B", "de", None, None), (None, "C", "de", "s", 1)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    duck.execute(f"CREATE VIEW v AS {queries.REFERENCE_SQL['op12_merkle_manifest']}")
    got = queries.op12_merkle_manifest(spark, str(tmp_path))
    want = duck.execute(f"SELECT {', '.join(got.columns)} FROM v").fetchall()
    assert rows_of(got) == sorted(want, key=key) == sorted(brute(rows), key=key)
