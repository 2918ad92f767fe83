"""Whitening of embeddings on their leading principal components, by Jacobi-Davidson.

The covariance matrix is never formed. All that touches the vectors is a
distributed product: every task centres its vectors, multiplies them with a few
given ones and adds up, and one small matrix per task comes back. The vectors
are laid out once as blocks of numbers.

The wanted eigenvectors are searched in a small subspace. A step takes the
leading Ritz pairs, solves their correction equations

    (I - Q Q') (A - theta I) (I - Q Q') t = -r

roughly by MINRES, for all wanted pairs in lockstep so that one product serves
them all, and extends the subspace by the corrections. Pairs whose residual has
come down to double precision are locked, from the first on; what is searched
afterwards stays orthogonal to them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.sources.scratch import materialise

SCALE = 256
COMPONENTS = 4
#: Vectors of a block of the layout, and of a task of a product.
BLOCK, PARTITION = 2048, 8192
#: Vectors the search starts with, and basis vectors beyond which it starts again from the best ones.
START, WIDEST = 32, 64
#: Inner steps of a correction, and the share of its residual that ends it sooner.
INNER, INNER_SHARE = 4, 0.02
#: Residuals, as a share of the largest eigenvalue, that count as double precision, and the most that is ever accepted.
TIGHT, ACCEPTED = 2e-14, 1e-11
#: Outer steps without progress after which rounding is taken to be reached, and outer steps in all.
STALLED, OUTER = 3, 300
SEED = 13
#: Eigenvalues below this share of the trace are none.
RANK = 1e-12

Product = Callable[[np.ndarray], np.ndarray]


# --- eigenvectors ----------------------------------------------------------


def orthonormal(new: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what ``new`` adds to ``bases``; dependent directions are left out."""
    kept = np.empty((len(new), 0))
    for column in new.T:
        size = np.linalg.norm(column)
        if not np.isfinite(size) or size == 0:
            continue
        column = column / size
        for _ in range(3):
            for basis in (*bases, kept):
                column = column - basis @ (basis.T @ column)
            left = np.linalg.norm(column)
            if left < 1e-10:
                break
            column = column / left
        else:
            kept = np.column_stack([kept, column])
    return kept


def minres(product: Product, theta: np.ndarray, q: np.ndarray, residuals: np.ndarray, steps: int, share: float) -> np.ndarray:
    """Rough solutions of the projected correction equations, all columns in lockstep."""

    def project(x: np.ndarray) -> np.ndarray:
        return x - q @ (q.T @ x)

    v = project(-residuals)
    beta = np.linalg.norm(v, axis=0)
    first = beta.copy()
    live = beta > 0
    v = np.where(live, v / np.where(live, beta, 1), 0)
    before, x = np.zeros_like(v), np.zeros_like(v)
    w, w_before = np.zeros_like(v), np.zeros_like(v)
    cos, cos_before = np.ones_like(beta), np.ones_like(beta)
    sin, sin_before = np.zeros_like(beta), np.zeros_like(beta)
    eta, last = beta.copy(), np.zeros_like(beta)
    for _ in range(steps):
        if not (live & (np.abs(eta) > share * first)).any():
            break
        av = project(product(v) - v * theta)
        alpha = np.einsum("ij,ij->j", v, av)
        after = av - v * alpha - before * last
        beta = np.linalg.norm(after, axis=0)
        # the two rotations so far, and the one that takes the new entry out
        delta = cos * alpha - cos_before * sin * last
        gamma = np.hypot(delta, beta)
        epsilon, rest = sin_before * last, sin * alpha + cos_before * cos * last
        live &= gamma > 0
        safe = np.where(gamma > 0, gamma, 1)
        cos_before, sin_before = cos, sin
        cos, sin = delta / safe, beta / safe
        w_before, w = w, (v - w * rest - w_before * epsilon) / safe
        x = x + np.where(live, w * (cos * eta), 0)
        eta = -sin * eta
        live &= beta > 1e-300
        before, v = v, np.where(live, after / np.where(beta > 0, beta, 1), 0)
        last = beta
    return project(x)


@dataclass
class Found:
    values: np.ndarray
    vectors: np.ndarray
    residual: float
    products: int


def jacobi_davidson(product: Product, dimension: int, wanted: int, seed: int = SEED) -> Found:
    """The ``wanted`` largest eigenvalues of a symmetric matrix given by its products, and their vectors."""
    calls = 0

    def multiply(x: np.ndarray) -> np.ndarray:
        nonlocal calls
        calls += 1
        return product(x)

    rng = np.random.default_rng(seed)
    basis = orthonormal(rng.normal(size=(dimension, min(dimension, START))))
    image = multiply(basis)
    locked, values, worst = np.empty((dimension, 0)), [], 0.0
    least, waited = np.inf, 0
    for _ in range(OUTER):
        small = basis.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        q, aq = basis @ turn, image @ turn
        norm = max([abs(theta[0]), *map(abs, values)], default=0.0) or 1.0
        need = wanted - len(values)
        r = aq[:, :need] - q[:, :need] * theta[:need]
        size = np.linalg.norm(r, axis=0) / norm
        first = size[0] if len(size) else 0.0
        waited = 0 if first < least / 2 else waited + 1
        least = min(least, first)
        done = 0
        while done < len(size) and (
            size[done] <= TIGHT or (waited >= STALLED and size[done] <= ACCEPTED and done == 0)
        ):
            done += 1
        if done:
            locked = np.column_stack([locked, q[:, :done]])
            values += theta[:done].tolist()
            worst = max(worst, float(size[:done].max()))
            basis, image = q[:, done:], aq[:, done:]
            theta, q, aq, r = theta[done:], q[:, done:], aq[:, done:], r[:, done:]
            need, least, waited = need - done, np.inf, 0
            # what is left must not fall back on what is locked
            image = image - locked @ (locked.T @ image)
        else:
            basis, image = q, aq
        if need == 0 or len(values) == dimension:
            return Found(np.array(values), locked, worst, calls)
        if basis.shape[1] > WIDEST:
            basis, image = basis[:, :START], image[:, :START]
        ritz = q[:, :need]
        t = minres(multiply, theta[:need], np.column_stack([locked, ritz]), r, INNER, INNER_SHARE)
        new = orthonormal(t, locked, basis)
        if not new.shape[1]:  # nothing to correct by: a fresh direction
            new = orthonormal(rng.normal(size=(dimension, need)), locked, basis)
        if new.shape[1]:
            basis = np.column_stack([basis, new])
            added = multiply(new)
            image = np.column_stack([image, added - locked @ (locked.T @ added)])
    raise RuntimeError("the eigenvectors did not converge")


# --- vectors on Spark -------------------------------------------------------


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite entry, whole entries that fit into a long."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) * SCALE < float(1 << 63))
    return F.coalesce(vector.isNotNull() & F.forall(vector, number), F.lit(False))


def whole_entries(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(SCALE))))


def stacked(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy())


def exact_sums(x: np.ndarray) -> list[int]:
    """Sums by column as whole numbers of any size."""
    if np.abs(x.astype(np.float64)).max(initial=0) * len(x) < 2.0**62:
        return [int(v) for v in x.sum(axis=0)]
    return [int(v) for v in x.astype(object).sum(axis=0)]


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the entries of (n * x - S)^2, exactly; null where it does not fit into a long."""
    rough = ((n * x.astype(np.float64) - np.array(sums, np.float64)) ** 2).sum(axis=1)
    out: list[int | None] = [None] * len(x)
    least = max(map(abs, sums), default=0) < 1 << 62
    # differences that fit, as their squares add up to less than 2^63
    small = (rough < 2.0**62) & least & (np.abs(x.astype(np.float64)).max(axis=1, initial=0) * n < 2.0**62)
    differences = n * x[small] - np.array(sums if least else [0] * len(sums), np.int64)
    for at, value in zip(np.flatnonzero(small), (differences * differences).sum(axis=1)):
        out[at] = int(value)
    for at in np.flatnonzero(~small & (rough < 2.0**64)):
        value = sum((n * int(c) - s) ** 2 for c, s in zip(x[at], sums))
        out[at] = value if value < 1 << 63 else None
    return out


def laid_out(distinct: DataFrame) -> DataFrame:
    """The vectors as blocks of numbers: ``block`` has the bytes of up to ``BLOCK`` vectors."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), BLOCK):
                yield pd.DataFrame({"block": [stacked(batch["x"][at : at + BLOCK]).astype("<i8").tobytes()]})

    return materialise(distinct.mapInPandas(pack, "block binary"))


class Fit:
    """The distinct vectors of one dimension, by what can be summed up over them."""

    def __init__(self, distinct: DataFrame, dimension: int):
        self.blocks, self.dimension = laid_out(distinct), dimension
        self.n, self.sums = self._count()
        self.mean = np.array([s / self.n for s in self.sums])
        # some 45 products follow; they need the tasks that the vectors fill, however many these were dealt over
        self.blocks = self.blocks.coalesce(max(1, -(-self.n // PARTITION)))

    def _count(self) -> tuple[int, list[int]]:
        dimension = self.dimension

        def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            n, sums = 0, [0] * dimension
            for batch in batches:
                for block in batch["block"]:
                    x = np.frombuffer(block, "<i8").reshape(-1, dimension)
                    n += len(x)
                    sums = [a + b for a, b in zip(sums, exact_sums(x))]
            yield pd.DataFrame({"n": [n], "sums": [[str(s) for s in sums]]})

        # one row per task
        rows = self.blocks.mapInPandas(add, "n long, sums array<string>").collect()
        return sum(r.n for r in rows), [sum(int(r.sums[i]) for r in rows) for i in range(dimension)]

    def total(self, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        """The sum over all vectors of what ``of`` makes of a block of centred ones.

        One small matrix per task comes back, and they are added in the order of
        the tasks, so that the sum is the same in every run.
        """
        dimension, mean = self.dimension, self.mean

        def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums = None
            for batch in batches:
                for block in batch["block"]:
                    x = np.frombuffer(block, "<i8").reshape(-1, dimension)
                    part = of(x.astype(np.float64) - mean)
                    sums = part if sums is None else sums + part
            if sums is not None:
                yield pd.DataFrame({"sums": [sums.astype("<f8").tobytes()], "rows": [len(sums)]})

        rows = (
            self.blocks.mapInPandas(add, "sums binary, rows int")
            .withColumn("task", F.spark_partition_id())
            .collect()
        )
        return sum(
            np.frombuffer(r.sums, "<f8").reshape(r.rows, -1) for r in sorted(rows, key=lambda r: r.task)
        )

    def product(self, w: np.ndarray) -> np.ndarray:
        """The covariance matrix times ``w``, without the matrix."""
        return self.total(lambda x: x.T @ (x @ w)) / self.n


@dataclass
class Whitening:
    """``n`` distinct vectors with sums ``sums``; leading eigenvalues and eigenvectors (columns) of their covariance."""

    n: int
    sums: list[int]
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float
    residual: float
    products: int

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return (x.astype(np.float64) - self.mean) @ (self.vectors / np.sqrt(self.values))


def fit(distinct: DataFrame, dimension: int, components: int = COMPONENTS) -> Whitening:
    """Whitening of the vectors in ``x``, each taken once.

    Directions without variance are no components: there are at most as many as
    the vectors span.
    """
    of = Fit(distinct, dimension)
    trace = float(of.total(lambda x: np.array([[np.square(x).sum()]]))[0, 0]) / of.n
    if trace > 0:
        found = jacobi_davidson(of.product, dimension, min(components, dimension))
    else:
        found = Found(np.empty(0), np.empty((dimension, 0)), 0.0, 0)
    kept = found.values > RANK * trace
    values, vectors = found.values[kept], found.vectors[:, kept]
    # of either sign, the one with the larger entry up
    largest = np.abs(vectors).argmax(axis=0)
    vectors = vectors * np.sign(vectors[largest, np.arange(len(values))])
    to = vectors / np.sqrt(values)
    error = 0.0
    if len(values):
        centre = of.total(lambda x: (x @ to).sum(axis=0, keepdims=True)) / of.n
        second = of.total(lambda x: (x @ to - centre).T @ (x @ to - centre)) / of.n
        error = float(np.abs(second - np.eye(len(values))).max())
    return Whitening(
        of.n, of.sums, of.mean, values, vectors, values / (trace or 1.0), error, found.residual, found.products
    )


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Every vector on the leading principal components of the distinct ones, one row per vector and component.

    Only ``vec_id`` and ``embedding`` are read. Entries c count as
    floor(256 * c). Vectors that are null, have a null or non-finite entry or one
    whose whole number does not fit into a long are left out; zero vectors take
    part. Equal vectors are fitted once, and every row of the table has its
    rows, repeated rows and rows without an id too. Vectors of different length
    are whitened apart, a fit for each length. Components without variance have
    no rows, so that equal vectors alone, a single one, empty ones and empty
    tables give none. Equal eigenvalues have any orthonormal vectors. A deviation
    that does not fit into a long is null.
    """
    spark = vectors.sparkSession
    rows = materialise(
        vectors.where(usable(F.col("embedding"))).select(
            F.col("vec_id").cast("long").alias("vec_id"), whole_entries(F.col("embedding")).alias("x")
        )
    )
    lengths = [r[0] for r in rows.select(F.size("x").alias("length")).distinct().orderBy("length").collect()]
    out = spark.createDataFrame([], OUT)
    for length in lengths:
        if length == 0:
            continue
        own = rows.where(F.size("x") == length)
        model = fit(own.select("x").distinct(), length, components)

        def project(batches: Iterator[pd.DataFrame], model: Whitening = model) -> Iterator[pd.DataFrame]:
            k = len(model.values)
            for batch in batches:
                if batch.empty or not k:
                    continue
                x = stacked(batch["x"])
                yield pd.DataFrame(
                    {
                        "vec_id": batch["vec_id"].astype("Int64").repeat(k).to_numpy(),
                        "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)),
                        "n": model.n,
                        "deviation": pd.array(deviations(x, model.n, model.sums), "Int64").repeat(k),
                        "whitened": model(x).ravel(),
                        "explained": np.tile(model.explained, len(x)),
                        "identity_error": model.identity_error,
                    }
                )

        out = out.unionByName(own.mapInPandas(project, OUT))
    return out
