"""A quality classifier: regularised quadratic discriminant analysis.

Statistics of a whole text, on scales where they are about normal, are scored
by the difference of two Gaussian log-densities. Each class has a covariance of
its own, shrunk towards the pooled one and towards a multiple of the identity.
Fitting needs counts, sums and products only, which Spark adds up over all
labelled rows; the Cholesky factors are computed once and kept in the model.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import give_back, giving_back

FEATURES = (
    "words", "word_length", "word_length_spread", "upper_case", "digits", "symbols", "stops",
    "letters", "line_length", "repeated_words", "vocabulary", "repeated_lines",
)
SIZE = len(FEATURES)
#: What the class covariances are shrunk by, and how much of that goes to the identity.
SHRINKAGE = 0.1
IDENTITY = 0.1
#: Shares enter as log(share + FLOOR).
FLOOR = 0.002

OTHER, LOWER, CAPITAL, DIGIT, SPACE, STOP, SYMBOL = range(7)
_KINDS = np.full(256, OTHER, np.uint8)
_KINDS[33:127] = SYMBOL
_KINDS[[9, 10, 11, 12, 13, 32]] = SPACE
_KINDS[48:58], _KINDS[65:91], _KINDS[97:123] = DIGIT, CAPITAL, LOWER
_KINDS[[ord(c) for c in ".,;:?'-"]] = STOP
_KINDS[192:223], _KINDS[223:256] = CAPITAL, LOWER
_KINDS[[215, 247]] = SYMBOL


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of a whole text; null is empty."""
    text = text or ""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = np.bincount(_KINDS[np.minimum(points, 255)], minlength=7)
    kinds[OTHER] -= (points > 255).sum()  # letters of other scripts have no case here
    letters = int(kinds[LOWER] + kinds[CAPITAL] + (points > 255).sum())
    words = text.split()
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    lines = text.split("\n")
    n, solid = max(1, len(words)), max(1, len(points) - int(kinds[SPACE]))
    share = lambda a, b: math.log(a / max(1, b) + FLOOR)
    return [
        math.log1p(len(words)),
        math.log1p(lengths.sum() / n),
        math.log1p(lengths.std() if len(words) else 0.0),
        share(kinds[CAPITAL], letters),
        share(kinds[DIGIT], solid),
        share(kinds[SYMBOL], solid),
        share(kinds[STOP], n),
        share(letters, solid),
        math.log1p(len(words) / len(lines)),
        share(sum(map(eq, words, words[1:])), n),
        math.log(1 + len(set(words))) / math.log(1 + n),
        share(len(lines) - len(set(lines)), len(lines)),
    ]


def text_statistics(text: Column) -> Column:
    """The statistics of each whole text as an array of doubles."""

    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        found = pd.Series([statistics(t) for t in texts], dtype=object)
        give_back()
        return found

    return of(text)


@dataclass(frozen=True)
class Model:
    """Two Gaussians: means, inverse Cholesky factors, log-determinants and log-priors."""

    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray

    @staticmethod
    def of(counts: np.ndarray, sums: np.ndarray, products: np.ndarray) -> Model:
        means = sums / counts[:, None]
        scatter = products - counts[:, None, None] * means[:, :, None] * means[:, None, :]
        pooled = scatter.sum(axis=0) / counts.sum()
        level = max(np.trace(pooled) / SIZE, 1e-6)
        factors, constants = [], []
        for n, s in zip(counts, scatter):
            shrunk = (1 - SHRINKAGE) * s / n + SHRINKAGE * (
                (1 - IDENTITY) * pooled + IDENTITY * level * np.eye(SIZE)
            )
            root = np.linalg.cholesky(shrunk)
            factors.append(np.linalg.inv(root))
            constants.append(math.log(n / counts.sum()) - np.log(np.diag(root)).sum())
        return Model(means, np.array(factors), np.array(constants))

    def score(self, points: np.ndarray) -> np.ndarray:
        """Probability of class 1."""
        density = [
            c - 0.5 * np.square((points - m) @ f.T).sum(axis=1)
            for m, f, c in zip(self.means, self.factors, self.constants)
        ]
        return 1 / (1 + np.exp((density[0] - density[1]).clip(-500, 500)))


@dataclass(frozen=True)
class Constant:
    """What a fit without rows of both classes gives: the smoothed share of class 1."""

    value: float

    def score(self, points: np.ndarray) -> np.ndarray:
        return np.full(len(points), self.value)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from: crc32 of the id's digits leaves 1 by 3. A null id is held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(True))


def fit(points: DataFrame, labels: DataFrame) -> Model | Constant:
    """Fit on rows of ``points`` (``doc_id``, ``statistics``) with a label and not held out.

    ``labels`` has ``doc_id`` and ``quality``. Labels other than 0 and 1 do not
    count, of several labels of a document the more frequent holds, a tie none.
    Repeated rows of ``points`` count as often as they are there; without rows
    of both classes, or with empty tables, the score is the smoothed share of 1.
    At most 2 x 157 numbers come to the driver.
    """
    known = (
        labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.avg(F.col("quality").cast("double")).alias("share"))
        .where(F.col("share") != 0.5)
        .select("doc_id", (F.col("share") > 0.5).cast("int").alias("label"))
    )

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, 1 + SIZE + SIZE * SIZE))
        for batch in batches:
            if batch.empty:
                continue
            x, label = np.stack(batch["statistics"].to_numpy()), batch["label"].to_numpy()
            for c in (0, 1):
                of = x[label == c]
                total[c] += np.concatenate([[len(of)], of.sum(axis=0), (of.T @ of).ravel()])
        yield pd.DataFrame({"label": [0, 1], "total": list(total)})

    rows = (
        points.where(~held_out(F.col("doc_id")))
        .join(known, "doc_id")
        .select("label", "statistics")
        .mapInPandas(giving_back(summed), "label int, total array<double>")
        .select("label", F.posexplode("total").alias("at", "value"))
        .groupBy("label", "at")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    total = np.zeros((2, 1 + SIZE + SIZE * SIZE))
    for r in rows:
        total[r["label"], r["at"]] = r["value"]
    counts = total[:, 0]
    if counts.min() < 2:
        return Constant((counts[1] + 1) / (counts.sum() + 2))
    return Model.of(counts, total[:, 1 : 1 + SIZE], total[:, 1 + SIZE :].reshape(2, SIZE, SIZE))


def score(points: Column, model: Model | Constant) -> Column:
    """Score of a column of statistics, 0 to 1. Every row has one, repeated rows the same."""

    @F.pandas_udf("double")
    def scored(series: pd.Series) -> pd.Series:
        if series.empty:
            return pd.Series([], dtype="float64")
        return pd.Series(model.score(np.stack(series.to_numpy())))

    return scored(points)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose whole text scores at least ``threshold``, columns as they were.

    Null and empty texts are scored like any other. The model is fitted on
    ``docs`` and ``labels`` as ``fit`` says; without labels of both classes it
    keeps all rows or none by the more frequent label, all if there is none.
    """
    points = docs.where(~held_out(F.col("doc_id"))).select(
        "doc_id", text_statistics(F.col("text")).alias("statistics")
    )
    model = fit(points, labels)
    return docs.where(score(text_statistics(F.col("text")), model) >= threshold)
