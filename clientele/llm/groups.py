"""Working through sorted partitions group by group, and splitting large groups.

``blocked`` cuts groups of more than a given number of rows into blocks and
deals out pairs of blocks, so that no task holds more than two blocks of any
group and every pair of rows meets in exactly one of them.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCKS = ["low", "high"]


def blocked(rows: DataFrame, keys: Sequence[str], spread: str, size: int) -> DataFrame:
    """Add ``low``, ``high`` (the pair of blocks) and ``block`` (the row's own).

    ``spread`` is a column whose hash deals the rows of a large group out to
    blocks of about ``size`` rows. Groups of up to ``size`` rows are one block
    and are not copied.
    """
    large = (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > size)
        .select(*keys, F.ceil(F.col("_n") / size).cast("int").alias("_blocks"))
    )
    blocks = F.coalesce("_blocks", F.lit(1))
    return (
        rows.join(large, list(keys), "left")
        .withColumn("block", F.pmod(F.xxhash64(spread), blocks).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .withColumn("low", F.least("block", "_other"))
        .withColumn("high", F.greatest("block", "_other"))
        .drop("_other", "_blocks")
    )


def whole_groups(batches: Iterable[pd.DataFrame], keys: Sequence[str]) -> Iterator[pd.DataFrame]:
    """Frames of whole groups from batches that are sorted by ``keys``."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        starts = group_starts(batch, keys)
        if held and not all(held[-1][k].iloc[-1] == batch[k].iloc[0] for k in keys):
            yield pd.concat(held, ignore_index=True)
            held = []
        if starts[-1] == 0:
            held.append(batch)
            continue
        held.append(batch.iloc[: starts[-1]])
        yield pd.concat(held, ignore_index=True)
        held = [batch.iloc[starts[-1] :]]
    if held:
        yield pd.concat(held, ignore_index=True)


def group_starts(frame: pd.DataFrame, keys: Sequence[str]) -> np.ndarray:
    new = np.zeros(len(frame), bool)
    new[0] = True
    for k in keys:
        values = frame[k].to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def local_roots(size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``size`` items reaches over the given pairs."""
    root = np.arange(size)
    while len(left):
        least = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, root[left], least)
        np.minimum.at(new, root[right], least)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root
