"""Small helpers that the operators share."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.sources import checkpoint_folder

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WORDS = re.compile(WORD)


#: Texts reach a Python worker so many bytes at a time, on both sides of the socket.
BATCH_BYTES = 4 * 2**20
_BATCH_BYTES_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"

_shipped: set[str] = set()
_turn: list = ["", lambda: None]


def take_turn(owner: str, forget: Callable[[], None]) -> None:
    """To be called where an operator's task begins to use what it keeps in its worker process.

    Spark reuses workers from stage to stage. When another owner takes its turn, the one
    before forgets what it kept, so caches of different operators never add up.
    """
    if _turn[0] != owner:
        _turn[1]()
        give_back()
    _turn[:] = owner, forget


def give_back() -> None:
    """Free memory goes back to the system: what Arrow keeps, and what the C library does."""
    pa.default_memory_pool().release_unused()
    pa.system_memory_pool().release_unused()


def _bound_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``BATCH_BYTES``; a lower setting stays. Ten thousand rows of long texts are too many for a worker."""
    size = re.fullmatch(r"(\d+)([kmg]?)b?", spark.conf.get(_BATCH_BYTES_KEY).lower())
    if not (size and int(size[1]) << 10 * " kmg".index(size[2] or " ") <= BATCH_BYTES):
        spark.conf.set(_BATCH_BYTES_KEY, BATCH_BYTES)


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once in an application; on a cluster as well as from a checkout."""
    _bound_batches(spark)
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_remainder(column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % modulus


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back; readers keep column pruning, and a lost executor costs nothing.

    ``df`` is planned once, here, so columns that depend on where a row lies
    (partition ids, positions) are fixed from now on.
    """
    path = os.path.join(checkpoint_folder(df.sparkSession), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

