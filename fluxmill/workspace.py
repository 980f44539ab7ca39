"""Shared scratch folders and tables whose size is known before they are joined."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_RUN: ContextVar[str | None] = ContextVar("run", default=None)


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under spark.checkpoint.dir, the folder every executor can reach.

    Only a local master may run without that setting, and then gets a temporary folder. Within a
    scratch() block the path lies in its folder.
    """
    if run := _RUN.get():
        return f"{run}/{label}-{uuid.uuid4().hex}"
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="fluxmill-")
    return f"{base.rstrip('/')}/fluxmill/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, label: str = "run") -> Iterator[str]:
    """What is stored within the block goes when it ends, so results have to be written by then, elsewhere.

    Results read lazily need their stored tables: leave the block only after the last action on them.
    """
    folder = new_folder(spark, label)
    token = _RUN.set(folder)
    try:
        yield folder
    finally:
        _RUN.reset(token)
        remove(spark, folder)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store its path names; nothing happens if it is gone."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write an aggregated table to the shared folder and read it back.

    The lineage ends there, an executor loss does not repeat the work behind it, and the
    planner knows its real size, so joins to it are broadcast only when it is small.
    """
    path = new_folder(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
