import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clientele.llm import quality, queries

FOLDER = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score int, statistics string"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0, 1, "z") for i, t in rows], DOCS)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def texts(n=300):
    rng = np.random.default_rng(0)
    word = lambda: "".join(rng.choice(list("abcdefgh"), int(rng.integers(2, 9))))
    rows, known = [], []
    for i in range(n):
        words = [word() for _ in range(int(rng.integers(20, 120)))]
        bad = i % 5 == 0
        rows.append((i, ("!! ".join(words).upper() if bad else " ".join(words) + ".")))
        known.append((i, 0 if bad else 1, 0))
    return rows, known


def test_scores_equal_a_plain_discriminant_and_learn_no_held_out_label(spark, tmp_path):
    rows, known = texts()
    rows += [(1000, None), (1001, ""), (1002, "x " * 200_000), (None, "no id"), (7, rows[7][1])]
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, t) for i, q, t in known]
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    labels(spark, flipped + [(3, None, 0), (None, 1, 0), (4, 7, 0)]).write.parquet(f"{tmp_path}/labels.parquet")
    got = queries.op1_quality(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    truth = {i: q for i, q, _ in known}
    x = {i: np.array(quality.statistics(t)) for i, t in rows}
    seen = [i for i, _ in rows if i in truth and zlib.crc32(str(i).encode()) % 3 != 1]
    parts = [np.stack([x[i] for i in seen if truth[i] == c]) for c in (0, 1)]
    pooled = sum((p - p.mean(0)).T @ (p - p.mean(0)) for p in parts) / len(seen)
    level = np.trace(pooled) / quality.SIZE
    for r in got:
        held = r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 3 == 1
        assert r.held_out == held and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        density = []
        for p in parts:
            cov = 0.9 * np.cov(p.T, bias=True) + 0.1 * (0.9 * pooled + 0.1 * level * np.eye(quality.SIZE))
            d = x[r.doc_id] - p.mean(0)
            density.append(np.log(len(p) / len(seen)) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * d @ np.linalg.solve(cov, d))
        assert r.score == pytest.approx(1 / (1 + np.exp(np.clip(density[0] - density[1], -500, 500))), abs=1e-4)
    wrong = sum(r.predicted != truth[r.doc_id] for r in got if r.doc_id in truth)
    assert wrong <= 3


def test_held_out_accuracy_on_the_given_documents(spark):
    got = queries.op1_quality(spark, FOLDER).join(
        spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id"
    ).where("held_out").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert got[1] > 80 and got[0] >= 0.97


def test_keep_good_keeps_columns_and_clean_rows(spark):
    rows, known = texts()
    frame = docs(spark, rows)
    kept = quality.keep_good(frame, labels(spark, known))
    assert kept.columns == frame.columns
    truth = {i: q for i, q, _ in known}
    ids = {r.doc_id for r in kept.collect()}
    assert sum(truth[i] == 1 for i in ids) >= 0.99 * sum(truth.values())
    assert sum(truth[i] == 0 for i in ids) <= 2


def test_without_labels_of_both_classes(spark):
    frame = docs(spark, [(1, "a b"), (2, None)])
    assert quality.keep_good(frame, labels(spark, [])).count() == 2
    assert quality.keep_good(docs(spark, [(i, "a") for i in range(9)]), labels(spark, [(i, 0, 0) for i in range(9)])).count() == 0
    assert quality.keep_good(docs(spark, []), labels(spark, [])).count() == 0
