import re

import numpy as np
import pandas as pd
import xxhash

from clientele.llm import queries, simhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, mark int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0, "f", 1) for i, t in rows], SCHEMA)


def slow_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints, reach=4):
    ids = sorted(prints)
    root = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if (prints[a] ^ prints[b]).bit_count() <= reach and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    return root


def texts():
    rng = np.random.default_rng(3)
    word = lambda: "".join(rng.choice(list("abcdeé"), 5))
    rows = []
    for i in range(60):
        base = [word() for _ in range(200)]
        rows.append((len(rows), " ".join(base)))
        if i % 3 == 0:
            for _ in range(3):
                base[int(rng.integers(200))] = word()
                rows.append((len(rows), "  ".join(base).upper()))
    rows += [(1000, None), (1001, ""), (1002, " \n\x0b"), (1003, "one"), (1004, "ONE"), (1005, "one two \x1fthree")]
    rows += [(1006, "long words " * 300_000), (5, rows[5][1])]
    return rows


def test_query_against_brute_force(spark, tmp_path):
    rows = texts()
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op8_simhash_duplicates(spark, str(tmp_path)).collect()
    prints = {i: slow_print(t) for i, t in rows}
    assert len(got) == len(rows)
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r.doc_id: r.component_id for r in got} == slow_components(prints)


def test_pieces_of_a_text_hash_like_the_whole(monkeypatch):
    text = " ".join(f"w{i % 91}" for i in range(5000)).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint(text) == whole


def test_pivots_discard_no_link():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    near = values.copy()
    for _ in range(4):
        near ^= np.uint64(1) << rng.integers(0, 64, 300).astype(np.uint64)
    both = np.concatenate([values, near])
    tables = simhash.pivot_table(both)
    i, j = np.triu_indices(600, 1)
    want = np.bitwise_count(both[i] ^ both[j]) <= 4
    assert (simhash.links_within(both, tables, i, j, 4) == want).all() and want.sum() >= 300
    assert (np.abs(tables[i] - tables[j]).max(axis=1) <= 4).sum() < want.sum() + 40


def test_large_band_values_are_cut_into_blocks(spark):
    rng = np.random.default_rng(2)
    flips = [np.uint64(1) << np.uint64(b) for b in range(0, 13)]
    prints = {0}
    while len(prints) < 400:
        prints.add(int(np.bitwise_xor.reduce(rng.choice(flips, int(rng.integers(1, 9))))))
    prints |= {(1 << 40) * k for k in range(1, 200, 3)}
    frame = spark.createDataFrame(pd.DataFrame({"fingerprint": sorted(prints)}))
    want = slow_components({p: p for p in prints})
    for block in (30, 5000):
        got = simhash.fingerprint_components(frame, block=block).collect()
        groups = lambda pairs: sorted(sorted(a for a, c in pairs if c == k) for k in {c for _, c in pairs})
        assert groups([tuple(r) for r in got]) == groups(list(want.items()))


def test_one_of_each_keeps_the_smallest_id_once(spark):
    rows = [(3, "a b c d e"), (1, "a b c d e"), (1, "A b c d E"), (1, "a b c d e"), (None, "a b c d e"), (7, "x y"), (7, "q r s"), (None, "z")]
    out = simhash.one_of_each(docs(spark, rows)).collect()
    assert sorted(((r.doc_id, r.text) for r in out), key=str) == sorted(
        [(1, max("a b c d e", "A b c d E", key=lambda t: -_mark(spark, t))), (7, "x y"), (7, "q r s"), (None, "z")], key=str
    )
    assert set(out[0].asDict()) == set(docs(spark, []).columns)


def _mark(spark, text):
    return spark.sql("SELECT xxhash64(:t)", args={"t": text}).first()[0]


def test_empty_table(spark):
    assert simhash.near_duplicates(docs(spark, [])).count() == 0
    assert simhash.one_of_each(docs(spark, [])).count() == 0
