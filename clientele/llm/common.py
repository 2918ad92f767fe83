"""What several operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters that are no ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def packed(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct, so that added columns cannot clash with them."""
    return F.struct(*[F.col(quoted(c)) for c in df.columns])


def unpacked(df: DataFrame, row: str, names: list[str]) -> DataFrame:
    """The columns that ``packed`` put away."""
    return df.select(*[F.col(row).getField(n).alias(n) for n in names])


def finite_vector(vector: Column) -> Column:
    """Whether a vector takes part: not null, not zero, all components there and finite."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(
        vector.isNotNull() & F.forall(vector, number) & F.exists(vector, lambda x: x != 0),
        F.lit(False),
    )


def give_back() -> None:
    """Hand memory that is free in this worker back to the system.

    Workers outlive their tasks, and what their allocators keep would count
    against the executor for as long.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def giving_back(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task function that gives memory back after every batch of its input and at its end."""

    @wraps(run)
    def wrapped(batches: Iterator) -> Iterator:
        def taken() -> Iterator:
            for batch in batches:
                yield batch
                del batch
                give_back()

        try:
            yield from run(taken())
        finally:
            give_back()

    return wrapped
