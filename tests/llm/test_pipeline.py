import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from clientele.llm import mixing, pii, quality, resemblance
from clientele.llm.common import table

FOLDER = "/root/testdata/sf0.001"


def test_every_stage_against_its_plain_form(spark, tmp_path):
    docs = table(spark, FOLDER, "documents")
    for at, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        before, after = docs.collect(), out.collect()
        if name != "pack":
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        {"quality": good, "near_duplicates": one, "personal_data": clean, "mix": mixed, "pack": packed}[name](spark, before, after)
        docs = out
    assert at == 4


def good(spark, before, after):
    points = spark.createDataFrame([(r.doc_id, quality.statistics(r.text)) for r in before], "doc_id long, statistics array<double>")
    model = quality.fit(points, table(spark, FOLDER, "labels"))
    scores = model.score(np.array([quality.statistics(r.text) for r in before]))
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r, s in zip(before, scores) if s >= 0.5)


def one(spark, before, after):
    sets = {r.doc_id: set(resemblance.shingle_set(r.text.encode()).tolist()) for r in before}
    root = {i: i for i in sets}
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and (sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    ]
    for _ in range(20):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert sorted(r.doc_id for r in after) == sorted(set(root.values())) and len(after) < len(before)


def clean(spark, before, after):
    was = {r.doc_id: r.text for r in before}
    assert len(after) == len(before)
    for r in after:
        assert not pii.base_spans(r.text) and r.n_chars == len(r.text)
        assert pii.base_spans(was[r.doc_id]) or r.text == was[r.doc_id] or "[" in r.text


def mixed(spark, before, after):
    sizes = spark.createDataFrame([(r.source, len(r.text.split())) for r in before], "source string, size long")
    targets = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    longest = max(len(r.text.split()) for r in before)
    for source, target in targets.items():
        assert abs(sum(len(r.text.split()) for r in after if r.source == source) - target) <= 2 * longest
    assert {tuple(r) for r in after} <= {tuple(r) for r in before}


def packed(spark, before, after):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = sum((tokenizer.encode(r.text, add_special_tokens=False).ids + [1] for r in before), [])
    got = np.concatenate([np.frombuffer(r["ids"], "<u4") for r in after])
    assert np.bincount(want).tolist() == np.bincount(got).tolist()


def test_run_on_odd_documents(spark, tmp_path):
    rows = [(1, None, None, None, None), (1, None, None, None, None), (None, "", "en", "a", 0), (3, "x " * 99_999, "en", "a", 1), (4, "a@b.co", None, "b", 6)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/a/documents.parquet")
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/b/documents.parquet")
    for f in "ab":
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{f}/labels.parquet")
    assert {r.doc_id for r in corpus_pipeline.run(spark, f"{tmp_path}/a").collect()} >= {3}
    assert corpus_pipeline.run(spark, f"{tmp_path}/b").count() == 0
