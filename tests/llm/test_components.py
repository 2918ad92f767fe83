"""Connected components: rounds and tasks follow from the edges."""

import numpy as np
import pytest

from clientele.llm import components


def pairs(spark, edges):
    return spark.createDataFrame([(int(a), int(b)) for a, b in edges], "a long, b long")


def found(spark, edges):
    return {r["node"]: r["component"] for r in components.connected_components(pairs(spark, edges)).collect()}


@pytest.fixture
def many_partitions(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_few_edges_take_few_tasks_and_rounds(spark, many_partitions, monkeypatch):
    names = np.random.default_rng(3).permutation(400)
    kept = []

    def noted(df):
        kept.append(components_materialise(df))
        return kept[-1]

    components_materialise = components.materialise
    monkeypatch.setattr(components, "materialise", noted)
    of = found(spark, zip(names[:-1], names[1:]))
    assert of == {i: 0 for i in range(400)}
    assert len(kept) <= 4  # one chain of 400, dealt at random
    assert all(stars.rdd.getNumPartitions() == 1 for stars in kept[1:])


def test_several_tasks_give_the_same_components(spark, monkeypatch):
    rng = np.random.default_rng(5)
    edges = rng.integers(0, 600, (500, 2)).tolist() + [[7, 7], [1000, 2000], [2000, 3000], [3000, 1000]]
    whole = found(spark, edges)
    monkeypatch.setattr(components, "PARTITION", 50)
    assert found(spark, edges) == whole
    root = {n: n for e in edges for n in e if e[0] != e[1]}
    for _ in root:
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert whole == root
