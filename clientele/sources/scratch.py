"""The shared folder for data that must outlive an executor."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A local session that names none (a laptop, a test) gets a temporary one; on
    a cluster, where such a folder is not shared, a name is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = _temporary_folder()
    return folder


@cache
def _temporary_folder() -> str:
    return tempfile.mkdtemp(prefix="clientele-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/clientele/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Checkpoint ``df``: computed once, then read back from the shared folder.

    Used where several jobs read the same aggregate. The rows are the same in
    every job, also when executors are lost in between.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)
