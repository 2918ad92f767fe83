import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from clientele.llm import packing, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start string, ids int"
PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " \n", "a<|endoftext|>b <|STARTOFTEXT|>", "<|startoftext|>", "J̌ Å é ẞ ΑΣ ΑΣ.", "x y z\x1cq\x85w",
    "日本語 テキスト", "don't I'LL 12345 !!?? ...", "́ ́", "İstanbul ǅ ﬁ", "a\u0000b", "É" * 50, "word " * 9000, "w" * 30000, "🙂👍🏽",
]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0, "x", 1) for i, t in rows], SCHEMA)


TOKENIZER = Tokenizer.from_file(PATH)


def want_ids(text):
    made = TOKENIZER.encode(text or "", add_special_tokens=False).ids
    return np.array([*made, 1], "<u4")


def test_ids_equal_the_tokenizer():
    encode = packing.WordIds(PATH)
    rng = np.random.default_rng(0)
    letters = list("aAbB éÉñ.,!'\n\t0123<|>@") + ["́", "̌", "Σ", "ß", "ﬀ", "\x0b", "\x1f", " "]
    texts = [t or "" for t in ODD] + ["".join(rng.choice(letters, 60)) for _ in range(400)]
    for t in texts + texts[:20]:
        got = np.frombuffer(b"".join(encode.of(t.encode())), "<u4")
        assert (got.tolist()) == want_ids(t)[:-1].tolist(), repr(t[:80])


def test_query_places_every_id_once_without_padding(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = list(enumerate(ODD)) + [(100 + i, "lorem ipsum dolor " * int(rng.integers(1, 900))) for i in range(150)]
    rows += [(3, ODD[3])] * 2
    docs(spark, rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    pieces = queries.op4_cost_packing(spark, str(tmp_path)).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    texts = dict(rows)
    assert set(by_doc) == set(texts)
    for doc, of in by_doc.items():
        ids, copies = want_ids(texts[doc]), 3 if doc == 3 else 1
        assert sum(p.length for p in of) == copies * len(ids) and {p.doc_tokens for p in of} == {len(ids)}
        if copies == 1:
            at = 0
            for p in sorted(of, key=lambda p: p.start):
                assert p.start == at and zlib.crc32(ids[at : at + p.length].tobytes()) == p.ids_crc32
                at += p.length
    for of in by_sequence.values():
        at = 0
        for p in sorted(of, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == 2048 or (at < 2048 and at & (at - 1) == 0)


def test_assignment_balances_cost_and_fills_everything():
    rng = np.random.default_rng(4)
    lengths = rng.integers(1, 1500, 400).tolist()
    full, rest = divmod(sum(lengths), 2048)
    capacities = [2048] * full + packing.powers(rest)
    pieces, rests = packing.assign(lengths, capacities)
    assert not rests and sum(p[2] for p in pieces) == sum(lengths)
    used = [0] * len(capacities)
    for _, _, n, s in pieces:
        used[s] += n
    assert used == capacities
    spent = np.zeros(full)
    for _, _, n, s in pieces:
        if s < full:
            spent[s] += packing.cost(n)
    in_order = np.zeros(full)
    flat = np.concatenate([np.full(n, i) for i, n in enumerate(lengths)])
    for s in range(full):
        counts = np.bincount(flat[s * 2048 : (s + 1) * 2048])
        in_order[s] = sum(packing.cost(int(c)) for c in counts if c)
    assert spent.std() < in_order.std() and spent.max() <= in_order.max()


def test_small_batches_give_whole_sequences_too(spark):
    frame = docs(spark, [(i, "one two three four five " * (i % 97)) for i in range(600)])
    pieces = packing.pack(frame.coalesce(1), PATH, capacity=64, batch=1000).collect()
    used = {}
    for p in pieces:
        used[p.sequence_id] = used.get(p.sequence_id, 0) + p.length
    assert all(u <= 64 for u in used.values()) and sum(u < 64 for u in used.values()) <= 6


def test_empty_table(spark):
    assert packing.pack(docs(spark, []), PATH).count() == 0


def test_words_of_short_texts_are_learnt_together_and_forgotten_ones_again(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 12)
    monkeypatch.setattr(packing, "TOGETHER", 60)
    texts = ["", "one two, three!", "Ünïcode <|x one", " ", *[f"w{i} common words, {i}th don't" for i in range(30)]]
    texts += ["long " + " ".join(f"t{i}x" for i in range(40)), "one two, three!", "<|endoftext|> a"]
    words, batches = packing.WordIds(PATH), []
    learn = words.learn
    monkeypatch.setattr(words, "learn", lambda some: (batches.append(len(some)), learn(some)))
    got = [b"".join(p) for p in words.of_all(t.encode() for t in texts)]
    assert [np.frombuffer(b, "<u4").tolist() for b in got] == [want_ids(t)[:-1].tolist() for t in texts]
    assert len(batches) < len(texts)
