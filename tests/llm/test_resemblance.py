import numpy as np
import pytest

from clientele.llm import resemblance

SCHEMA = "doc_id long, text string, node string, size string, component int, best string, mark int, _kept long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", 0, "z", 1, 2) for i, t in rows], SCHEMA)


def slow_sets(rows):
    out = {}
    for i, t in rows:
        words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "").split()
        out[i] = {" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()
    return out


def slow_kept(rows):
    sets = slow_sets(rows)
    ids = sorted(sets)
    root = {i: i for i in ids}
    links = [
        (a, b)
        for a in ids
        for b in ids
        if a < b and (sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]))
    ]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            if root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    return sorted(set(root.values()))


def edited(rng, words, count):
    out = list(words)
    for at in rng.choice(len(out), count, replace=False):
        out[at] = f"new{rng.integers(1 << 40)}"
    return out


def texts():
    rng = np.random.default_rng(5)
    rows, passage = [], [f"p{i}" for i in range(60)]
    for i in range(40):
        base = [f"w{rng.integers(5000)}" for _ in range(int(rng.integers(30, 400)))]
        if i % 2:
            base = base + passage
        rows.append((len(rows), " ".join(base)))
        for share in (0, 60, 40, 25):
            rows.append((len(rows), "  ".join(edited(rng, base, len(base) // share if share else 0)).upper()))
    rows += [(900, None), (901, ""), (902, " \n"), (903, "one two"), (904, "ONE  two"), (905, "one two three")]
    return rows


def test_against_all_pairs(spark):
    rows = texts()
    out = resemblance.one_of_each(docs(spark, rows)).collect()
    assert sorted(r.doc_id for r in out) == slow_kept(rows)
    by_id = dict(rows)
    assert all(r.text == by_id[r.doc_id] and r.node == "x" and r._kept == 2 for r in out)


@pytest.mark.parametrize("block", [25, 2000])
def test_large_group_in_blocks(spark, block):
    rng = np.random.default_rng(6)
    base = [f"w{i}" for i in range(250)]
    rows = [(i, " ".join(edited(rng, base, i % 4))) for i in range(120)]
    out = resemblance.one_of_each(docs(spark, rows), block=block).collect()
    assert [r.doc_id for r in out] == slow_kept(rows) == [0]


def family(rng, name, size, twins):
    """Texts of a similarity just under the threshold that share a passage; ``twins`` of them have one of 0.82."""
    shared = [f"{name}s{i}" for i in range(436)]
    rows = []
    for i in range(size):
        own = [f"{name}{i}w{j}" for j in range(60)]
        rows.append(" ".join(shared + own))
        if i < twins:
            rows.append(" ".join(shared + own[:12] + [f"{name}{i}v{j}" for j in range(48)]))
    order = rng.permutation(len(rows))
    return [rows[i] for i in order]


@pytest.mark.parametrize("block", [15, 2000])
def test_links_in_families_just_under_the_threshold(spark, block):
    rng = np.random.default_rng(9)
    rows = list(enumerate(t for name in "abc" for t in family(rng, name, 50, 12)))
    want = slow_kept(rows)
    assert len(want) == 150
    assert sorted(r.doc_id for r in resemblance.one_of_each(docs(spark, rows), block=block).collect()) == want


def test_similar_pairs_against_sets():
    rng = np.random.default_rng(10)
    sets = [np.unique(rng.integers(-30, 30, int(rng.integers(0, 60)))) for _ in range(60)]
    sets += [sets[3], np.arange(9000), np.arange(500, 9500)]
    block = rng.integers(0, 2, len(sets))
    for across in (None, block):
        want = [
            (i, j)
            for i in range(len(sets))
            for j in range(i + 1, len(sets))
            if len(np.intersect1d(sets[i], sets[j])) >= 0.6 * len(np.union1d(sets[i], sets[j]))
            and (across is None or block[i] != block[j])
        ]
        assert list(zip(*resemblance.similar_pairs(sets, 0.6, across))) == want


def test_forest_spans_with_least_cost():
    rng = np.random.default_rng(7)
    for size in (2, 9, 60):
        left, right = rng.integers(0, size, (2, 4 * size))
        cost = rng.integers(0, 5, 4 * size)
        taken = resemblance.forest(size, left, right, cost)
        root, total, edges = list(range(size)), 0, 0
        for at in np.argsort(cost, kind="stable"):
            a, b = root[left[at]], root[right[at]]
            if a != b:
                root = [a if r == b else r for r in root]
                total, edges = total + cost[at], edges + 1
        assert len(taken) == edges and cost[taken].sum() == total


def test_anchors_meet_at_the_threshold():
    rng = np.random.default_rng(8)
    met = 0
    for _ in range(300):
        both = rng.integers(0, 1 << 63, 80, dtype=np.uint64)
        own = rng.integers(0, 1 << 63, (2, 10), dtype=np.uint64)
        a, b = (resemblance.anchors(np.unique(np.concatenate([both, o]))) for o in own)
        met += any(x == y for x, y in zip(a, b))
    assert met >= 297


def test_ids_and_empty_tables(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (1, "q r s t u v"), (None, "a b c d e f"), (None, "z"), (2, "very long " * 200_000)]
    out = resemblance.one_of_each(docs(spark, rows)).collect()
    assert sorted(((r.doc_id, r.text[:9]) for r in out), key=str) == [(1, "a b c d e"), (1, "q r s t u"), (2, "very long"), (None, "z")]
    assert resemblance.one_of_each(docs(spark, [])).count() == 0
