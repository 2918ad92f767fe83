"""Random forests of many models, in tasks that hold a model's training rows and some of its trees.

Rows are the blocks of ``many_models``, of at most ``many_models.WHOLE`` training rows a model. The
trees of a model are dealt out in groups, each to a task, which gets the
model's binned rows once and grows its trees level by level with sums over
(node, input, bin, class). A tree draws every row as often as a Poisson variable
of mean one says, by a hash of the row's key and the tree; a node draws the root of the number of
inputs, by a hash of its place. Sums are whole numbers, so neither the order of
the rows nor how they are dealt out changes a tree.

As in Spark's forests, inputs with label indices are split by sets of labels, in the order of
their rows of the second class, classes weigh what balances them, and two leaves of
the same majority are one.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column

from clientele.functions.sums import settle
from clientele.operators.many_models import BINS, Block, Layout, binned, class_sizes, class_weights, predicted, uniform

#: Trees that a task grows.
TREES_A_TASK = 25
#: An impurity is lowered if it is by more than sums of doubles are off.
LEAST_GAIN = 1e-12
EVERY_BIN = np.uint32(0xFFFFFFFF)


@dataclass(frozen=True)
class Growing:
    """Sizes of a forest."""

    trees: int = 200
    depth: int = 12
    leaf_size: int = 5
    seed: int = 42


@dataclass
class Forest:
    """Trees one after the other: per node its input, the set of bins that go left, the left child, and what a leaf says.

    A right child follows its left one. A leaf is its own left child and sends every bin there.
    """

    inputs: list[str]
    edges: list[np.ndarray]
    depth: int
    roots: np.ndarray
    feature: np.ndarray
    left: np.ndarray
    child: np.ndarray
    value: np.ndarray
    importance: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        """The mean of what the trees' leaves say."""
        if not len(self.roots):
            return np.full(len(x), 0.5)
        flat, first = binned(x, self.edges).ravel(), np.arange(len(x)) * len(self.inputs)
        out = np.zeros(len(x))
        for root in self.roots:
            at = np.full(len(x), root, np.int64)
            for _ in range(self.depth):
                stays = self.left.take(at) >> flat.take(first + self.feature.take(at)) & 1
                at = self.child.take(at) + (stays == 0)
            out += self.value.take(at)
        return out / len(self.roots)

    def importances(self) -> list[tuple[str, float]]:
        """Mean share of the inputs in what a tree's splits lower impurity by."""
        total = self.importance.sum() or 1.0
        return list(zip(self.inputs, (self.importance / total).tolist()))

    def column(self) -> Column:
        return predicted(self, self.inputs)

    def to_json(self) -> str:
        arrays = {k: getattr(self, k).tolist() for k in ARRAYS}
        edges = [e.tolist() for e in self.edges]
        return json.dumps({"kind": "forest", "inputs": self.inputs, "edges": edges, "depth": self.depth, **arrays})

    @classmethod
    def of(cls, value: Mapping) -> Forest:
        """From what ``to_json`` wrote, without its kind."""
        arrays = {k: np.array(value[k], kind) for k, kind in ARRAYS.items()}
        edges = [np.array(e, float) for e in value["edges"]]
        return cls(inputs=value["inputs"], edges=edges, depth=value["depth"], **arrays)


ARRAYS = {
    "roots": np.int64, "feature": np.int16, "left": np.uint32, "child": np.int32, "value": np.float64,
    "importance": np.float64,
}


def poisson(key: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a tree draws each row: a Poisson variable of mean one."""
    u, out, term, below = uniform(key, tree, seed), np.zeros(len(key), np.uint8), np.exp(-1.0), 0.0
    for n in range(1, 16):
        below += term
        out += u >= below
        term /= n
    return out


def inputs_of(heap: np.ndarray, width: int, tree: int, seed: int) -> np.ndarray:
    """The inputs that nodes may split by, by the nodes' places in a complete tree."""
    wanted = int(np.ceil(np.sqrt(width)))
    ids = heap[:, None] * 4_096 + np.arange(width)
    u = uniform(ids.ravel(), tree, seed + 1).reshape(ids.shape)
    return np.sort(np.argsort(u, axis=1)[:, :wanted], axis=1)


def best_splits(counts: np.ndarray, weight: np.ndarray, by_label: np.ndarray, leaf_size: int):
    """The best split of every node from its counts by (class, node, input, bin).

    ``by_label`` says which of a node's inputs are label indices. Returns the
    number of the input among the node's, the bins that go left, by how much
    impurity falls (0: no split), and the left side's counts.
    """
    order = None
    nodes, inputs = np.nonzero(by_label)
    if len(nodes):
        there = counts[:, nodes, inputs]
        order = np.argsort(np.where(there.sum(axis=0) > 0, there[1], np.inf), axis=1, kind="stable")
        counts = counts.copy()
        counts[:, nodes, inputs] = np.take_along_axis(there, order[None], 2)
    left = counts.cumsum(axis=3)
    whole = left[:, :, :1, -1:]
    right = whole - left
    (a, b), (c, d) = left * weight[:, None, None, None], right * weight[:, None, None, None]
    (p, q) = whole * weight[:, None, None, None]
    with np.errstate(invalid="ignore", divide="ignore"):
        total = p + q
        gain = 2 * (p * q / total - a * b / (a + b) - c * d / (c + d)) / total
    fine = (left.sum(axis=0) >= leaf_size) & (right.sum(axis=0) >= leaf_size) & (gain > LEAST_GAIN)
    gain = np.where(fine, gain, 0.0).reshape(len(by_label), -1)
    best = gain.argmax(axis=1)
    which, last = np.divmod(best, BINS)
    row = np.arange(len(by_label))
    bins = ((np.uint64(2) << last.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)
    if order is not None:
        pair = np.full(by_label.shape, -1)
        pair[nodes, inputs] = np.arange(len(nodes))
        pair = pair[row, which]
        own = np.flatnonzero(pair >= 0)
        sets = np.bitwise_or.accumulate(np.uint32(1) << order[pair[own]].astype(np.uint32), axis=1)
        bins[own] = sets[np.arange(len(own)), last[own]]
    return which, bins, gain[row, best], left[:, row, which, last]


def grow(
    bins: np.ndarray, label: np.ndarray, drawn: np.ndarray, weight: np.ndarray, labels: np.ndarray, sizes: Growing, tree: int
) -> tuple[np.ndarray, ...]:
    """One tree on rows of binned inputs that it has ``drawn`` so often: ``feature``, ``left``, ``child``, ``value`` and importances."""
    width, own = bins.shape[1], np.flatnonzero(drawn)
    flat, first = bins.take(own, axis=0).ravel(), np.arange(len(own)) * width
    y, times = label.take(own).astype(np.int64), drawn.take(own).astype(np.float64)
    at = np.zeros(len(own), np.int64)
    feature, left, child, gains = [np.zeros(1, np.int64)], [np.array([EVERY_BIN])], [np.zeros(1, np.int64)], [np.zeros(1)]
    held = [np.bincount(y, times, 2)[:, None]]
    open_, heap, starts = np.zeros(1, np.int64), np.ones(1, np.int64), [0]
    for level in range(sizes.depth):
        nodes = len(open_)
        if not nodes or not len(at):
            break
        inputs = inputs_of(heap, width, tree, sizes.seed)
        counts = np.empty((2, nodes, inputs.shape[1], BINS))
        cell = (y * nodes + at) * BINS
        for j in range(inputs.shape[1]):
            seen = flat.take(first + inputs[:, j].take(at))
            counts[:, :, j] = np.bincount(cell + seen, times, 2 * nodes * BINS).reshape(2, nodes, BINS)
        which, sets, gain, lefts = best_splits(counts, weight, labels[inputs], sizes.leaf_size)
        split = np.flatnonzero(gain > 0)
        if not len(split):
            break
        chosen = inputs[np.arange(nodes), which]
        begin = starts[-1] + len(feature[-1])
        feature[-1][open_[split]], left[-1][open_[split]] = chosen[split], sets[split]
        child[-1][open_[split]], gains[-1][open_[split]] = begin + 2 * np.arange(len(split)), gain[split]
        below = np.empty((2, 2 * len(split)))
        below[:, 0::2] = lefts[:, split]
        below[:, 1::2] = held[-1][:, open_[split]] - lefts[:, split]
        now = (below > 0).all(axis=0) & (below.sum(axis=0) >= 2 * sizes.leaf_size)
        # the open nodes below, by twice the split's number and the side; what no split has comes last
        number = np.full(2 * len(split) + 2, -1)
        number[:-2][now] = np.arange(now.sum())
        rank = np.full(nodes, len(split))
        rank[split] = np.arange(len(split))
        side = sets.take(at) >> flat.take(first + chosen.take(at)) & 1 == 0
        at = number.take(2 * rank.take(at) + side)
        stay = np.flatnonzero(at >= 0)
        at, first, y, times = (a.take(stay) for a in (at, first, y, times))
        open_ = np.flatnonzero(now)
        heap = (2 * heap[split][:, None] + [0, 1]).ravel()[open_]
        starts.append(begin)
        feature.append(np.zeros(2 * len(split), np.int64))
        left.append(np.full(2 * len(split), EVERY_BIN))
        child.append(begin + np.arange(2 * len(split)))
        gains.append(np.zeros(2 * len(split)))
        held.append(below)
    weighed = np.concatenate(held, axis=1) * weight[:, None]
    return _pruned(*map(np.concatenate, (feature, left, child, gains)), weighed, starts, width)


def _pruned(feature, left, child, gain, weighed, starts, width) -> tuple[np.ndarray, ...]:
    """The tree without splits of leaves that say the same class, its nodes closed up."""
    leaf = child == np.arange(len(child))
    class_ = weighed[1] > weighed[0]
    ends = [*starts[1:], len(child)]
    for begin, end in reversed(list(zip(starts, ends))):
        at = np.arange(begin, end)
        at = at[~leaf[at]]
        under = child[at]
        same = leaf[under] & leaf[under + 1] & (class_[under] == class_[under + 1])
        leaf[at[same]] = True
    child = np.where(leaf, np.arange(len(child)), child)
    reached = np.zeros(len(child), bool)
    reached[0] = True
    for begin, end in zip(starts, ends):
        at = np.arange(begin, end)
        at = at[reached[at] & ~leaf[at]]
        reached[child[at]] = reached[child[at] + 1] = True
    kept = np.flatnonzero(reached)
    place = np.cumsum(reached) - 1
    leaf, total = leaf[kept], weighed[:, kept].sum(axis=0)
    importance = np.bincount(feature[kept], np.where(leaf, 0.0, gain[kept] * total), width)
    return (
        np.where(leaf, 0, feature[kept]).astype(np.int16),
        np.where(leaf, EVERY_BIN, left[kept]).astype(np.uint32),
        place[child[kept]].astype(np.int32),
        np.where(total > 0, weighed[1, kept] / np.where(total > 0, total, 1), 0.5),
        importance / (importance.sum() or 1.0),
    )


def label_edges(layout: Layout, labels: Mapping[str, int]) -> list[np.ndarray]:
    """The layout's edges, but a bin per label for inputs that are indices of so many ``labels``, where bins suffice."""
    return [
        np.arange(labels[c] - 1, dtype=np.float64) if c in labels and labels[c] <= BINS else e
        for c, e in zip(layout.inputs, layout.edges)
    ]


def apart(keys: np.ndarray) -> np.ndarray:
    """Keys of rows in order of their ids, in which rows of one id differ too."""
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    times = np.arange(len(keys)) - np.repeat(first, np.diff(np.append(first, len(keys))))
    with np.errstate(over="ignore"):
        return keys.astype(np.uint64) + times.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)


def forests(layout: Layout, sizes: Growing, labels: Mapping[str, int]) -> list[Forest]:
    """A forest for every model of the layout, groups of trees beside each other. ``labels`` has the inputs that are label indices."""
    keys, width = layout.keys, layout.width
    if not keys:
        return []
    edges, by_label = label_edges(layout, labels), np.array([c in labels for c in layout.inputs], bool)
    weight = class_weights(class_sizes(layout))
    groups = -(-sizes.trees // TREES_A_TASK)

    def dealt(row: Mapping) -> Iterator[tuple[int, tuple]]:
        block = Block(row, keys, width)
        bins, key = binned(block.x, edges), apart(block.key)
        for at, i in enumerate(block.models):
            own = block.training[at]
            if own.any():
                rows = bins[own].tobytes(), key[own].tobytes(), (block.label[own] > 0).tobytes()
                for group in range(groups):
                    yield i * groups + group, rows

    def grown(parts: Iterator) -> Iterator[tuple]:
        settle()
        held: dict[int, list] = {}
        for unit, rows in parts:
            held.setdefault(unit, []).append(rows)
        for unit, blocks in held.items():
            i, group = divmod(unit, groups)
            bins, key, label = (b"".join(b) for b in zip(*blocks))
            bins, label = np.frombuffer(bins, np.uint8).reshape(-1, width), np.frombuffer(label, bool)
            key = np.frombuffer(key, np.uint64)
            some = range(group * TREES_A_TASK, min(sizes.trees, (group + 1) * TREES_A_TASK))
            yield i, group, [grow(bins, label, poisson(key, t, sizes.seed), weight[i], by_label, sizes, t) for t in some]

    units = len(keys) * groups
    found = layout.values.partitions.flatMap(dealt).partitionBy(units, int).mapPartitions(grown).collect()
    trees = {i: [] for i in range(len(keys))}
    for i, _, some in sorted(found, key=lambda f: f[:2]):
        trees[i] += some
    return [_joined(layout.inputs, edges, sizes.depth, own) for own in trees.values()]


def _joined(inputs: Sequence[str], edges: Sequence[np.ndarray], depth: int, trees: Sequence[tuple]) -> Forest:
    roots = np.cumsum([0, *[len(t[0]) for t in trees]])
    empty = Forest(list(inputs), list(edges), depth, roots[:0], *[np.empty(0, k) for k in list(ARRAYS.values())[1:]])
    if not trees:
        return replace(empty, importance=np.zeros(len(inputs)))
    feature, left, child, value, importance = zip(*trees)
    return replace(
        empty,
        roots=roots[:-1],
        feature=np.concatenate(feature),
        left=np.concatenate(left),
        child=np.concatenate([c + r for c, r in zip(child, roots)]).astype(np.int32),
        value=np.concatenate(value),
        importance=np.sum(importance, axis=0),
    )
