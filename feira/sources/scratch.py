"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from contextvars import ContextVar
from functools import partial
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from feira.sources.files import delete
from feira.sources.parallel import run_all

_local_folder: str | None = None
# Of the run the current thread belongs to; two runs side by side have folders of their own.
_run_folder: ContextVar[str | None] = ContextVar("run folder", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session; only a local session gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="feira-")
    return _local_folder


def new_path(spark: SparkSession, label: str) -> str:
    """A folder that does not exist yet, inside the folder of the current run if there is one."""
    return f"{_run_folder.get() or f'{shared_folder(spark)}/feira'}/{label}-{uuid4().hex}"


@contextmanager
def scratch_of_run(spark: SparkSession) -> Iterator[None]:
    """What is kept inside the block is deleted at its end, also after an error.

    A block inside another one uses the outer one's folder.
    """
    if _run_folder.get() is not None:
        yield
        return
    folder = new_path(spark, "run")
    before = _run_folder.set(folder)
    try:
        yield
    finally:
        _run_folder.reset(before)
        delete(spark, folder)


def keep(df: DataFrame, label: str, codec: str = "zstd") -> DataFrame:
    """Write `df` once and go on from the written table.

    Later readers neither repeat the work nor depend on the executors that did it. Zstandard takes a quarter less room
    than Spark's default codec.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def keep_all(frames: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """`keep` on frames that do not depend on each other, by label."""
    return dict(zip(frames, run_all(partial(keep, df, label) for label, df in frames.items())))
