import numpy as np
import public_tokenizers
from tokenizers import Tokenizer, models, pre_tokenizers

from clientele.llm import queries, token_counts

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = [None, "", " ", "  a", " a b", "a▁b", "▁", "日本語テキスト<s> x</s><0x41>", "\n\n a\t\tb  ", "🙂🙂é́", "a" * 3000, "<unk>", "▁▁ x"]


def reference(vocabulary):
    t = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return t


def test_query_equals_the_tokenizer(spark, tmp_path):
    rng = np.random.default_rng(0)
    letters = list("etaoin shrdlu  ÉßñΣ中.,!\n0123▁")
    texts = ODD + ["".join(rng.choice(letters, int(rng.integers(1, 200)))) for _ in range(200)] + ["the cat " * 40_000]
    rows = [(i, t, 5) for i, t in enumerate(texts)] + [(1, "", 5), (None, "a b", 5)]
    spark.createDataFrame(rows, "doc_id long, text string, n_tokens int").write.parquet(f"{tmp_path}/documents.parquet")
    tokenizer = reference(token_counts.piece_scores(PATH))
    want = sorted((-1 if i is None else i, len(tokenizer.encode(t or "").ids)) for i, t, _ in rows)
    got = queries.op6_token_counts(spark, str(tmp_path)).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens) for r in got) == want


def test_ties_and_unknown_characters_follow_the_tokenizer():
    rng = np.random.default_rng(1)
    bytes_ = [(f"<0x{b:02X}>", -30.0) for b in range(256)]
    for _ in range(40):
        pieces = {"".join(rng.choice(list("ab▁"), int(rng.integers(1, 5)))) for _ in range(12)}
        pieces = {p for p in pieces if "▁" not in p[1:]}
        vocabulary = [("<unk>", 0.0), *bytes_, *((p, float(-rng.integers(1, 4))) for p in sorted(pieces))]
        counter, tokenizer = token_counts.Counter(vocabulary), reference(vocabulary)
        for _ in range(40):
            text = "".join(rng.choice(list("aabb cé"), int(rng.integers(1, 30))))
            assert counter.count(text) == len(tokenizer.encode(text).ids), (vocabulary[257:], text)


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.count_tokens(frame, PATH).count() == 0
