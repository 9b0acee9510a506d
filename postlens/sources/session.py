"""Session settings and staged tables."""

from __future__ import annotations

import os
import posixpath
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.sources.files import remove

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "postlens", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the models rely on: UTC days and adaptive plans."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        # regions that are rebuilt at the same time share the executors
        .config("spark.scheduler.mode", "FAIR")
    )
    if master:
        builder = builder.master(master)
    for key, value in extra.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


PARTITION_BYTES = 512 * 2**20


def shuffle_partitions(input_bytes: int, per_partition: int = PARTITION_BYTES, least: int = 200) -> int:
    """Partitions that keep a shuffle of the whole input at a size a task can sort."""
    return max(least, -(-input_bytes // per_partition))


def input_bytes(df: DataFrame) -> int:
    """Size of the files that ``df`` reads, from their listing; 0 if it reads none."""
    folders = sorted({unquote(posixpath.dirname(f)) for f in df.inputFiles()})
    if not folders:
        return 0
    listed = df.sparkSession.read.format("binaryFile").load(folders)
    return listed.agg(F.sum("length")).first()[0] or 0


def size_shuffles(df: DataFrame, per_partition: int = PARTITION_BYTES) -> int:
    """Raise the session's shuffle partitions to fit ``df``, the largest input of a run.

    The adaptive plan merges small partitions but never adds any, so the start has
    to be ample; a higher setting of the cluster stays. Where files are packed much
    tighter than rows in a shuffle, give a smaller ``per_partition``.
    """
    spark, key = df.sparkSession, "spark.sql.shuffle.partitions"
    wanted = shuffle_partitions(input_bytes(df), per_partition, least=int(spark.conf.get(key)))
    spark.conf.set(key, wanted)
    return wanted


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only in local mode."""
    folder = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="postlens-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def stage(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write a result that several plans read, and read it back.

    Unlike a cached DataFrame the files outlive an executor, readers still prune
    columns and push filters, and later joins are planned from the real size. They lie in the
    shared folder, or in one that the caller removes.
    """
    path = os.path.join(folder or checkpoint_folder(df.sparkSession), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def staging(spark: SparkSession, name: str) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A ``stage`` whose tables go when the block ends; nothing that outlives the block may read them."""
    folder = os.path.join(checkpoint_folder(spark), f"{name}-{uuid.uuid4().hex}")
    try:
        yield lambda df, table: stage(df, table, folder)
    finally:
        remove(spark, folder)
