"""Many models over one table, grown in the same jobs.

A model is a split of the table with one of its folds held out, or none. The
rows of all splits are laid out once as numeric blocks: inputs, their bins,
label, role and fold. Every step of a fit is one sum over all blocks, with a
slot for each model:

* boosted trees: a level of the current tree of every model is one sum of
  gradients and second derivatives by (model, node, input, bin), and the best
  splits are chosen where a model's sum is. A round's first level adds the last tree to the margins and holds them with
  the rows' gradients for the levels after it; margins are written every few rounds, so that a lost executor costs no
  more than that;
* logistic regression: a Newton step of every model is one sum of Gram matrices
  and gradients.

Only the sums of the latter and the trees are on the driver; none of them grows
with the rows. ``boost_apart`` gives the same trees without a job a level, a model
in a task, where a task holds the model's rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import cached_property
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.functions.sums import Blocks, Kept, settle
from clientele.sources.scratch import materialise

#: Rows of a block and of a partition of blocks.
BLOCK, PARTITION = 4_096, 16_384
#: Rows of a block where many steps over all rows follow within a task, each of which costs a block its calls.
JOINED = 16_384
#: Partitions beyond which they grow instead, and their rows at most.
PARTITIONS, LARGEST = 64, 131_072
#: Tasks of a boosting level beyond which they take several partitions each, up to ``LARGEST`` rows.
LEVEL_TASKS = 5
#: Tasks that complete the sums of a level.
REDUCERS = 2
#: Bins of an input, and the accuracy of the sketch that places their edges.
BINS, ACCURACY = 32, 10_000
#: Training rows of a model that a task holds at most: some 20 bytes each, and what a level makes of them.
WHOLE = 1 << 20
#: Rounds after which margins are written.
WRITTEN = 10
TRAIN, TEST = 0, 1


@dataclass(frozen=True)
class Boosting:
    """Sizes of boosted trees; names and defaults are the usual ones of second-order boosting."""

    rounds: int = 300
    depth: int = 5
    rate: float = 0.05
    subsample: float = 0.8
    columns: float = 0.8
    least_weight: float = 3.0
    least_gain: float = 0.1
    ridge: float = 1.0
    loss: str = "logistic"
    seed: int = 42


@dataclass(frozen=True)
class Key:
    """A model: a split by number, and the fold it leaves out (None: it takes all training rows)."""

    split: int
    fold: int | None = None


# --- layout ------------------------------------------------------------------


def bin_edges(rows: DataFrame, inputs: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Upper edges of the bins of every input, from one sketch over all rows."""
    share = [k / bins for k in range(1, bins)]
    found = rows.agg(
        *[F.percentile_approx(F.col(c).cast("double"), share, ACCURACY).alias(f"e{i}") for i, c in enumerate(inputs)]
    ).first()
    return [np.unique(np.array(e if e is not None else [], np.float64)) for e in found]


def binned(x: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    """The number of edges below each value."""
    out = np.empty(x.shape, np.uint8)
    for i, e in enumerate(edges):
        out[:, i] = np.searchsorted(e, x[:, i], "left")
    return out


@dataclass
class Layout:
    """Rows of several splits as blocks. ``tasks`` is the number of their partitions."""

    blocks: DataFrame
    tasks: int
    inputs: list[str]
    edges: list[np.ndarray]
    keys: list[Key]
    rows: int = 0

    @property
    def width(self) -> int:
        return len(self.inputs)

    @cached_property
    def values(self) -> Blocks:
        """Blocks with the inputs as they are."""
        return Blocks(self.blocks.drop("bins", "margin"), self.tasks)

    @cached_property
    def bins(self) -> DataFrame:
        """Blocks with the inputs' bins."""
        return self.blocks.drop("x")

    @property
    def level_tasks(self) -> int:
        """Partitions that a boosting level reads: a level is short, and every task costs it a start."""
        return min(self.tasks, max(LEVEL_TASKS, -(-self.rows // LARGEST)))

    def gathered(self) -> DataFrame:
        """``bins`` in ``level_tasks`` partitions, neighbours together and in order, so that sums are the same in every run."""
        if self.level_tasks == self.tasks:
            return self.bins
        group = F.floor(F.spark_partition_id() * self.level_tasks / F.lit(self.tasks)).cast("int")
        placed = self.bins.withColumns({"_group": group, "_place": F.monotonically_increasing_id()})
        together = placed.repartitionById(self.level_tasks, "_group").sortWithinPartitions("_place")
        return materialise(together.drop("_group", "_place"))


SCHEMA = "split int, rows int, key binary, x binary, bins binary, label binary, role binary, fold binary, margin binary"
BINNED = SCHEMA.replace("x binary, ", "")


def partitions(rows: int) -> int:
    """How many partitions of blocks there are for so many rows."""
    return max(1, min(-(-rows // PARTITION), max(PARTITIONS, -(-rows // LARGEST))))


def neighbours(pieces: Iterator[dict], most: int) -> Iterator[list[dict]]:
    """Pieces that follow each other in one split and have ``most`` rows together; a larger piece is by itself."""
    held: list[dict] = []
    for piece in pieces:
        if held and (held[0]["split"] != piece["split"] or sum(p["rows"] for p in held) + piece["rows"] > most):
            yield held
            held = []
        held.append(piece)
    if held:
        yield held


def lay_out(
    rows: DataFrame, inputs: Sequence[str], keys: Sequence[Key], id_column: str = "customer_id", joined: int = 0
) -> Layout:
    """Blocks of ``rows``, which have ``split`` (number), ``role``, ``fold``, ``label`` and ``inputs``.

    A row that belongs to several splits is there once for each. Blocks of a partition are
    brought together up to ``joined`` rows.
    """
    inputs, keys = list(inputs), list(keys)
    kept = materialise(
        rows.select(
            F.col("split").cast("int").alias("split"),
            F.col(id_column).cast("long").alias("key"),
            F.col("role").cast("int").alias("role"),
            F.coalesce(F.col("fold"), F.lit(-1)).cast("int").alias("fold"),
            F.col("label").cast("double").alias("label"),
            *[F.col(c).cast("double").alias(c) for c in inputs],
        )
    )
    edges = bin_edges(kept, inputs)
    count = kept.count()
    tasks = partitions(count)

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[dict]:
        for batch in batches:
            for split, part in batch.groupby("split"):
                for at in range(0, len(part), BLOCK):
                    some = part.iloc[at : at + BLOCK]
                    x = some[inputs].to_numpy(np.float64)
                    yield {
                        "split": split,
                        "rows": len(some),
                        "key": some["key"].to_numpy(np.int64).tobytes(),
                        "x": x.tobytes(),
                        "bins": binned(x, edges).tobytes(),
                        "label": some["label"].to_numpy(np.float64).tobytes(),
                        "role": some["role"].to_numpy(np.int8).tobytes(),
                        "fold": some["fold"].to_numpy(np.int8).tobytes(),
                    }

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in neighbours(pieces(batches), joined):
            parts = {k: [b"".join(p[k] for p in some)] for k in some[0] if k not in ("split", "rows")}
            yield pd.DataFrame({"split": [some[0]["split"]], "rows": [sum(p["rows"] for p in some)], **parts, "margin": [None]})

    # the hash deals equal shares; a fixed number of partitions keeps sums the same in every run
    placed = kept.repartition(tasks, F.xxhash64("key")).sortWithinPartitions("split", "key")
    return Layout(materialise(placed.mapInPandas(pack, SCHEMA)), tasks, inputs, edges, keys, count)


class Block:
    """One block as arrays, and what the models of its split see of it."""

    def __init__(self, row, keys: Sequence[Key], width: int):
        n = row["rows"]
        self.n, self.split = n, row["split"]
        self.key = np.frombuffer(row["key"], np.int64)
        self.x = np.frombuffer(row["x"]).reshape(n, width) if "x" in row else None
        self.bins = np.frombuffer(row["bins"], np.uint8).reshape(n, width) if "bins" in row else None
        self.label = np.frombuffer(row["label"])
        self.role = np.frombuffer(row["role"], np.int8)
        self.fold = np.frombuffer(row["fold"], np.int8)
        self.models = [i for i, k in enumerate(keys) if k.split == self.split]
        margin = row.get("margin")
        self.margin = None if margin is None else np.frombuffer(margin).reshape(len(self.models), n)
        self.training = np.array(
            [(self.role == TRAIN) & ((keys[i].fold is None) | (self.fold != keys[i].fold)) for i in self.models], bool
        ).reshape(len(self.models), n)

    def held_out(self, key: Key) -> np.ndarray:
        if key.fold is None:
            return self.role == TEST
        return (self.role == TRAIN) & (self.fold == key.fold)


def class_sizes(layout: Layout) -> np.ndarray:
    """Training rows, sum of labels and held-out rows of every model."""
    keys, width = layout.keys, layout.width

    def of(row) -> np.ndarray:
        block, out = Block(row, keys, width), np.zeros((len(keys), 3))
        for at, i in enumerate(block.models):
            own = block.training[at]
            out[i] = own.sum(), block.label[own].sum(), block.held_out(keys[i]).sum()
        return out

    found = layout.values.summed(of)
    return np.zeros((len(keys), 3)) if found is None else found


# --- boosted trees -----------------------------------------------------------


@dataclass
class Trees:
    """Complete binary trees of one model: per round the input and bin of every node, and the leaves' values."""

    base: float
    inputs: list[str]
    edges: list[np.ndarray]
    depth: int
    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    gain: np.ndarray = field(default_factory=lambda: np.empty(0))
    loss: str = "logistic"

    def margin(self, x: np.ndarray) -> np.ndarray:
        bins = binned(x, self.edges)
        out = np.full(len(x), self.base)
        for t in range(len(self.feature)):
            out += self.value[t][walk(bins, self.feature[t], self.bin[t], self.depth)]
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        """A probability, or the value itself."""
        margin = self.margin(x)
        return sigmoid(margin) if self.loss == "logistic" else margin

    def importances(self) -> list[tuple[str, float]]:
        """Share of the inputs in all gains."""
        total = self.gain.sum() or 1.0
        return list(zip(self.inputs, (self.gain / total).tolist()))

    def column(self) -> Column:
        return predicted(self, self.inputs)

    def to_json(self) -> str:
        arrays = {k: getattr(self, k).tolist() for k in ("feature", "bin", "value", "gain")}
        edges = [e.tolist() for e in self.edges]
        return json.dumps(
            {"kind": "trees", "base": self.base, "inputs": self.inputs, "edges": edges, "depth": self.depth, "loss": self.loss, **arrays}
        )


@dataclass
class Linear:
    """A logistic regression on inputs standardised by ``mean`` and ``deviation``."""

    inputs: list[str]
    mean: np.ndarray
    deviation: np.ndarray
    weights: np.ndarray
    intercept: float
    steps: int = 0

    def standardised(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / np.where(self.deviation > 0, self.deviation, 1.0)

    def predict(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.standardised(x) @ self.weights + self.intercept)

    def column(self) -> Column:
        return predicted(self, self.inputs)

    def to_json(self) -> str:
        arrays = {k: getattr(self, k).tolist() for k in ("mean", "deviation", "weights")}
        return json.dumps({"kind": "linear", "inputs": self.inputs, "intercept": self.intercept, "steps": self.steps, **arrays})


def from_json(text: str) -> Trees | Linear:
    value = json.loads(text)
    kind = value.pop("kind")
    if kind == "forest":
        from clientele.operators.forests import Forest  # which needs this module

        return Forest.of(value)
    if kind == "linear":
        arrays = {k: np.array(value.pop(k), float) for k in ("mean", "deviation", "weights")}
        return Linear(**value, **arrays)
    edges = [np.array(e, float) for e in value.pop("edges")]
    arrays = {k: np.array(value.pop(k), np.int64) for k in ("feature", "bin")}
    arrays |= {k: np.array(value.pop(k), float) for k in ("value", "gain")}
    return Trees(**value, **arrays, edges=edges)


def save_fitted(spark: SparkSession, model: Trees | Linear, path: str) -> None:
    spark.createDataFrame([(model.to_json(),)], "model string").coalesce(1).write.mode("overwrite").parquet(path)


def load_fitted(spark: SparkSession, path: str) -> Trees | Linear:
    return from_json(spark.read.parquet(path).first()[0])


def predicted(model: Trees | Linear, inputs: Sequence[str]) -> Column:
    @F.pandas_udf("double")
    def predict(rows: pd.DataFrame) -> pd.Series:
        return pd.Series(model.predict(rows.to_numpy(np.float64)))

    return predict(F.struct(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(inputs)]))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def walk(bins: np.ndarray, feature: np.ndarray, bin_: np.ndarray, levels: int) -> np.ndarray:
    """The node on level ``levels`` that each row comes to, counted from the level's left."""
    at = np.zeros(len(bins), np.int64)
    if levels:
        at += bins[:, feature[0]] > bin_[0]
    flat, first = bins.ravel(), np.arange(len(bins)) * bins.shape[1]
    for level in range(1, levels):
        nodes = slice((1 << level) - 1, (2 << level) - 1)
        split = bin_[nodes].take(at)
        place = feature[nodes].take(at)
        place += first
        at *= 2
        at += flat.take(place) > split
    return at


def margins(block: Block, base: np.ndarray, trees: tuple, depth: int) -> np.ndarray:
    """Margins of a block's rows for the models of its split, one row per model, after ``trees``."""
    if block.margin is None:
        out = np.repeat(base[block.models][:, None], block.n, axis=1)
    else:
        out = block.margin.copy()
    return grown(out, block, trees, depth)


def grown(out: np.ndarray, block: Block, trees: tuple, depth: int) -> np.ndarray:
    for f, b, v in zip(*trees):
        for at, i in enumerate(block.models):
            out[at] += v[i][walk(block.bins, f[i], b[i], depth)]
    return out


def sampled(key: np.ndarray, round_: int, share: float, seed: int) -> np.ndarray:
    """Which rows a round takes, by a hash of their key."""
    if share >= 1:
        return np.ones(len(key), bool)
    return uniform(key, round_, seed) < share


def uniform(key: np.ndarray, round_: int, seed: int) -> np.ndarray:
    """Numbers from 0 to below 1, by a hash of key and round."""
    with np.errstate(over="ignore"):
        z = key.astype(np.uint64) + np.uint64((seed * 1_000_003 + round_ + 1) & 0xFFFFFFFF) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = z ^ (z >> np.uint64(31))
    return (z >> np.uint64(11)).astype(np.float64) * 2.0**-53


def splits_of(g: np.ndarray, h: np.ndarray, allowed: np.ndarray, settings: Boosting):
    """The best split of every (model, node) from sums by (model, node, input, bin).

    Returns input, bin (rows up to it go left), gain, and both sides' sums. A
    node that no split improves sends everything left.
    """
    left_g, left_h = g.cumsum(axis=3), h.cumsum(axis=3)
    all_g, all_h = left_g[..., :1, -1:], left_h[..., :1, -1:]
    score = lambda a, b: a * a / (b + settings.ridge)
    right_g, right_h = all_g - left_g, all_h - left_h
    gain = (score(left_g, left_h) + score(right_g, right_h) - score(all_g, all_h)) / 2 - settings.least_gain
    fine = (left_h >= settings.least_weight) & (right_h >= settings.least_weight) & allowed[:, None]
    gain = np.where(fine, gain, -np.inf)
    m, nodes, width, bins = gain.shape
    flat = gain.reshape(m, nodes, -1)
    best = flat.argmax(axis=2)
    top = np.take_along_axis(flat, best[..., None], 2)[..., 0]
    splits = top > 0
    feature, bin_ = np.where(splits, best // bins, 0), np.where(splits, best % bins, bins - 1)
    pick = lambda a: np.take_along_axis(a.reshape(m, nodes, -1), (feature * bins + bin_)[..., None], 2)[..., 0]
    lg, lh = pick(left_g), pick(left_h)
    whole_g, whole_h = all_g[..., 0, 0], all_h[..., 0, 0]
    return feature, bin_, np.where(splits, top, 0.0), (lg, lh), (whole_g - lg, whole_h - lh)


def _start(sizes: np.ndarray, settings: Boosting) -> tuple[np.ndarray, np.ndarray]:
    """What positive rows of every model weigh, and its first margin."""
    negative, positive = sizes[:, 0] - sizes[:, 1], sizes[:, 1]
    if settings.loss != "logistic":
        return np.ones(len(sizes)), positive / np.maximum(sizes[:, 0], 1)
    weight = np.where((positive > 0) & (negative > 0), negative / np.maximum(positive, 1), 1.0)
    return weight, np.zeros(len(sizes))


def boost(layout: Layout, settings: Boosting = Boosting()) -> list[Trees]:
    """Boosted trees for every model of the layout, a level of all of them per job.

    With the logistic loss, positive rows weigh what balances the classes of the
    model's own training rows. A model without training rows, or with one class
    alone, has trees without splits.
    """
    keys, width, depth = layout.keys, layout.width, settings.depth
    weight, base = _start(class_sizes(layout), settings)
    stored, tasks = layout.gathered(), layout.level_tasks

    def written(stored: DataFrame, grown_since: tuple) -> DataFrame:
        def update(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = batch.to_dict("records")
                now = [margins(Block(r, keys, width), base, grown_since, depth).tobytes() for r in rows]
                yield batch.assign(margin=now)

        return materialise(stored.mapInPandas(update, BINNED))

    def again(grown_since: tuple) -> Blocks:
        nonlocal stored
        stored = written(stored, grown_since)
        return Blocks(stored, tasks)

    grown_trees = _rounds(Blocks(stored, tasks), keys, layout.edges, weight, base, settings, again)
    return _trees(layout, base, settings, *grown_trees)


def boost_apart(layout: Layout, settings: Boosting = Boosting()) -> list[Trees]:
    """The trees of ``boost``, to the bit, every model in a task of its own while that holds its training rows.

    Its rounds and levels then follow each other within the task, and the models run beside
    each other. Models of more than ``WHOLE`` rows grow over all blocks, by ``boost``.
    """
    keys, width, edges = layout.keys, layout.width, layout.edges
    sizes = class_sizes(layout)
    weight, base = _start(sizes, settings)
    whole = [i for i in np.argsort(-sizes[:, 0], kind="stable").tolist() if 0 < sizes[i, 0] <= WHOLE]
    tasks, levels, place_of = layout.tasks, layout.level_tasks, {i: at for at, i in enumerate(whole)}

    def dealt(index: int, rows: Iterator) -> Iterator[tuple[tuple[int, int, int], Mapping]]:
        for place, row in enumerate(rows):
            block = Block(row.asDict(), keys, width)
            for at, i in enumerate(block.models):
                if i in place_of and block.training[at].any():
                    yield (i, index, place), trained(block, block.training[at])

    def grow(rows: Iterator) -> Iterator[tuple]:
        settle()
        for i, own in groupby(rows, lambda r: r[0][0]):
            # as the tasks of a level would hold them
            parts = [[row for _, row in part] for _, part in groupby(own, lambda r: r[0][1] * levels // tasks)]
            key = [Key(keys[i].split)]
            yield i, _rounds(Kept(parts), key, edges, weight[[i]], base[[i]], settings)

    # without rows there is nothing to split
    bare = [i for i in range(len(keys)) if not sizes[i, 0]]
    found = {i: _trees(layout, base[[i]], settings, *_rounds(Kept([]), [keys[i]], edges, weight[[i]], base[[i]], settings))[0] for i in bare}
    if whole:
        apart = layout.bins.rdd.mapPartitionsWithIndex(dealt)
        apart = apart.repartitionAndSortWithinPartitions(len(whole), lambda k: place_of[k[0]])
        for i, grown_trees in apart.mapPartitions(grow).collect():
            found |= {i: _trees(layout, base[[i]], settings, *grown_trees)[0]}
    rest = [i for i in range(len(keys)) if i not in found]
    if rest:
        found |= dict(zip(rest, boost(replace(layout, keys=[keys[i] for i in rest]), settings)))
    return [found[i] for i in range(len(keys))]


def trained(block: Block, own: np.ndarray) -> dict:
    """The rows ``own`` of a block as a block of training rows alone."""
    n = int(own.sum())
    return {
        "split": block.split,
        "rows": n,
        "key": block.key[own].tobytes(),
        "bins": block.bins[own].tobytes(),
        "label": block.label[own].tobytes(),
        "role": np.full(n, TRAIN, np.int8).tobytes(),
        "fold": np.full(n, -1, np.int8).tobytes(),
    }


def _trees(layout: Layout, base: np.ndarray, settings: Boosting, feature, bin_, value, gains) -> list[Trees]:
    return [
        Trees(
            float(base[i]), layout.inputs, layout.edges, settings.depth, feature[:, i].copy(), bin_[:, i].copy(),
            value[:, i].copy(), gains[i], settings.loss,
        )
        for i in range(len(base))
    ]


def _rounds(
    blocks: Blocks | Kept,
    keys: Sequence[Key],
    edges: Sequence[np.ndarray],
    weight: np.ndarray,
    base: np.ndarray,
    settings: Boosting,
    again: Callable[[tuple], Blocks] | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Input, bin and value of every (round, model, node), and the gains of every (model, input).

    ``again`` stores margins and returns the blocks with them, every ``WRITTEN`` rounds.
    """
    width, depth, bins, m = len(edges), settings.depth, max(len(e) for e in edges) + 1, len(keys)
    logistic = settings.loss == "logistic"
    inner, leaves = (1 << depth) - 1, 1 << depth
    feature = np.zeros((settings.rounds, m, inner), np.int64)
    bin_ = np.full((settings.rounds, m, inner), bins - 1, np.int64)
    value = np.zeros((settings.rounds, m, leaves))
    gains = np.zeros((m, width))
    rng = np.random.default_rng(settings.seed)
    since = 0

    def trees(first: int, last: int) -> tuple:
        return feature[first:last].copy(), bin_[first:last].copy(), value[first:last].copy()

    def begun(round_: int, last: tuple) -> Blocks:
        """The blocks with margins after the ``last`` tree, and what the round's levels read: drawn rows, their g and h."""

        def of(row) -> dict:
            block, drawn_of = Block(row, keys, width), {}
            margin = margins(block, base, last, depth)
            drawn = sampled(block.key, round_, settings.subsample, settings.seed)
            for at, i in enumerate(block.models):
                own = np.flatnonzero(block.training[at] & drawn)
                y, f = block.label[own], margin[at, own]
                if logistic:
                    p, w = sigmoid(f), np.where(y > 0, weight[i], 1.0)
                    g, h = (p - y) * w, np.maximum(p * (1 - p), 1e-16) * w
                else:
                    g, h = f - y, np.ones(len(own))
                drawn_of[i] = own.astype(np.int32), g, h
            return {**row, "margin": margin.tobytes(), "drawn": drawn_of}

        return blocks.mapped(of)

    def level_splits(round_: int, level: int, allowed: np.ndarray) -> dict[int, tuple]:
        now_feature, now_bin = feature[round_], bin_[round_]
        # the first input gives the sums of whole nodes, allowed or not
        taken = np.flatnonzero(allowed | (np.arange(width) == 0))
        # an input has as many cells as bins
        cells = [len(edges[c]) + 1 for c in taken]
        ends = np.cumsum(cells)
        columns = list(zip(taken.tolist(), cells, (ends - cells).tolist()))

        def of(row) -> dict[int, np.ndarray]:
            out, all_bins = {}, np.frombuffer(row["bins"], np.uint8).reshape(row["rows"], width)
            for i, (own, g, h) in row["drawn"].items():
                b = all_bins.take(own, axis=0)
                node = walk(b, now_feature[i], now_bin[i], level)
                out[i], by_input = np.empty((2, 1 << level, ends[-1])), np.ascontiguousarray(b.T)
                for c, n, at in columns:
                    places = node * n
                    places += by_input[c]
                    for k, v in enumerate((g, h)):
                        out[i][k, :, at : at + n] = np.bincount(places, v, n << level).reshape(-1, n)
            return out

        def choose(_: int, sums: np.ndarray) -> tuple:
            even = np.zeros((2, 1, 1 << level, len(taken), bins))
            for j, (_, n, at) in enumerate(columns):
                even[:, 0, :, j, :n] = sums[:, :, at : at + n]
            f, *rest = splits_of(even[0], even[1], allowed[None, taken, None], settings)
            return taken[f], *rest

        return blocks.chosen(of, choose, min(m, REDUCERS))

    for round_ in range(settings.rounds):
        if again is not None and round_ - since == WRITTEN:
            stored = again(trees(since, round_))
            blocks.release()
            blocks, since = stored, round_
        before, blocks = blocks, begun(round_, trees(max(since, round_ - 1), round_))
        allowed = np.zeros(width, bool)
        allowed[rng.permutation(width)[: max(1, round(settings.columns * width))]] = True
        for level in range(depth):
            nodes = slice((1 << level) - 1, (2 << level) - 1)
            for i, (f, b, gain, left, right) in level_splits(round_, level, allowed).items():
                feature[round_][i, nodes], bin_[round_][i, nodes] = f[0], b[0]
                np.add.at(gains[i], f[0], gain[0])
                if level == depth - 1:
                    for side, (g, h) in enumerate((left, right)):
                        value[round_][i, side::2] = (-settings.rate * g / (h + settings.ridge))[0]
            if level == 0:
                before.release()
    blocks.release()
    return feature, bin_, value, gains


# --- logistic regression -----------------------------------------------------


def moments(layout: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per model: mean and sample deviation of the training rows, and both with classes balanced."""
    keys, width = layout.keys, layout.width
    sizes = class_sizes(layout)
    weight = class_weights(sizes)

    def by_class(row) -> np.ndarray:
        block, out = Block(row, keys, width), np.zeros((len(keys), 2, width))
        for at, i in enumerate(block.models):
            for c in (0, 1):
                out[i, c] = block.x[block.training[at] & (block.label == c)].sum(axis=0)
        return out

    sums = layout.values.summed(by_class)
    n = np.stack([sizes[:, 0] - sizes[:, 1], sizes[:, 1]], axis=1)
    total = np.maximum(n.sum(axis=1), 1)[:, None]
    mean = sums.sum(axis=1) / total
    w = np.maximum((n * weight).sum(axis=1), 1e-300)[:, None]
    weighted_mean = (sums * weight[..., None]).sum(axis=1) / w

    def spread(row) -> np.ndarray:
        block, out = Block(row, keys, width), np.zeros((len(keys), 2, 2, width))
        for at, i in enumerate(block.models):
            for c in (0, 1):
                x = block.x[block.training[at] & (block.label == c)]
                out[i, c] = np.square(x - mean[i]).sum(axis=0), np.square(x - weighted_mean[i]).sum(axis=0)
        return out

    squares = layout.values.summed(spread)
    deviation = np.sqrt(squares[:, :, 0].sum(axis=1) / np.maximum(total - 1, 1))
    # unbiased for weights that say how much a row counts
    left = w - ((n * weight**2).sum(axis=1)[:, None] / w)
    weighted = np.sqrt((squares[:, :, 1] * weight[..., None]).sum(axis=1) / np.where(left > 0, left, 1))
    return mean, deviation, weighted_mean, weighted


def class_weights(sizes: np.ndarray) -> np.ndarray:
    """n / (2 n_c) for both classes of every model; 0 for a class without rows."""
    n = np.stack([sizes[:, 0] - sizes[:, 1], sizes[:, 1]], axis=1)
    return np.where(n > 0, sizes[:, :1] / (2 * np.maximum(n, 1)), 0.0)


def logistic(layout: Layout, ridge: float, steps: int = 100, tolerance: float = 1e-10) -> list[Linear]:
    """Ridge-penalised logistic regressions by Newton's method, a step of all models per job.

    The mean loss over weighted training rows plus ``ridge`` / 2 times the
    squared weights of inputs brought to unit deviation; the intercept is free.
    A step that does not lower the loss is halved, in the next job.
    """
    keys, width = layout.keys, layout.width
    m = len(keys)
    mean, deviation, centre, scale = moments(layout)
    weight = class_weights(class_sizes(layout))
    safe = np.where(scale > 0, scale, 1.0)
    beta = np.zeros((m, width + 1))

    def at_point(point: np.ndarray) -> np.ndarray:
        """Loss, gradient and Gram matrix of every model."""

        def of(row) -> np.ndarray:
            block, out = Block(row, keys, width), np.zeros((m, 1 + (width + 1) * (width + 2) + 1))
            for at, i in enumerate(block.models):
                own = block.training[at]
                y = block.label[own]
                z = np.where(scale[i] > 0, (block.x[own] - centre[i]) / safe[i], 0.0)
                z = np.column_stack([z, np.ones(len(z))])
                w = weight[i][(y > 0).astype(int)]
                margin = z @ point[i]
                p = sigmoid(margin)
                loss = w @ (np.logaddexp(0, margin) - y * margin)
                gradient, gram = z.T @ (w * (p - y)), (z * (w * p * (1 - p))[:, None]).T @ z
                out[i] = np.concatenate([[loss], gradient, gram.ravel(), [w.sum()]])
            return out

        return layout.values.summed(of)

    penalty = np.append(np.full(width, ridge), 0.0)
    step, last, best = np.zeros_like(beta), np.full(m, np.inf), beta.copy()
    done, taken = np.zeros(m, bool), 0
    for taken in range(1, steps + 1):
        sums = at_point(beta)
        if sums is None:
            break
        for i in range(m):
            rows = sums[i, -1]
            if done[i] or rows == 0:
                done[i] = True
                continue
            loss = sums[i, 0] / rows + (penalty * beta[i] ** 2).sum() / 2
            if loss > last[i] * (1 + 1e-14) + 1e-15:
                step[i] /= 2
                beta[i] = best[i] + step[i]
                done[i] = np.abs(step[i]).max() < tolerance
                continue
            last[i], best[i] = loss, beta[i].copy()
            gradient = sums[i, 1 : width + 2] / rows + penalty * beta[i]
            gram = sums[i, width + 2 : -1].reshape(width + 1, -1) / rows + np.diag(penalty)
            step[i] = -np.linalg.lstsq(gram, gradient, rcond=1e-13)[0]
            done[i] = np.abs(step[i]).max() < tolerance
            beta[i] = best[i] + step[i]
        if done.all():
            break
    out = []
    for i in range(m):
        # from inputs of unit weighted deviation to inputs standardised by the training rows
        raw = np.where(scale[i] > 0, beta[i, :-1] / safe[i], 0.0)
        own = np.where(deviation[i] > 0, deviation[i], 1.0)
        intercept = beta[i, -1] + raw @ (mean[i] - centre[i])
        out.append(Linear(layout.inputs, mean[i], deviation[i], raw * own, float(intercept), taken))
    return out


# --- what the models say -----------------------------------------------------


def held_out_scores(layout: Layout, models: Sequence[Trees | Linear], name: str) -> DataFrame:
    """``model``, ``split``, ``fold``, ``label``, ``score``: every model on the rows it did not see.

    ``fold`` is null for models of all training rows, which are held against the
    split's test rows.
    """
    keys, width = layout.keys, layout.width
    models = list(models)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                block = Block(row, keys, width)
                for i in block.models:
                    own = block.held_out(keys[i])
                    if own.any():
                        yield pd.DataFrame(
                            {
                                "split": block.split,
                                "fold": -1 if keys[i].fold is None else keys[i].fold,
                                "label": block.label[own],
                                "score": models[i].predict(block.x[own]),
                            }
                        )

    found = layout.blocks.mapInPandas(score, "split int, fold int, label double, score double")
    return found.select(
        F.lit(name).alias("model"), "split", F.when(F.col("fold") >= 0, F.col("fold")).alias("fold"), "label", "score"
    )
