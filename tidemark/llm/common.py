"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import math
import pickle
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_dir, shuffles_cleared
from tidemark.sources.files import FileSystem

#: Bytes of input text aimed at in one range or hash partition of a text shuffle.
TARGET_PARTITION_BYTES = 256 << 20
#: For SQL that lower-cases these letters only.
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Ids (8 bytes each) up to which rows are picked by a broadcast join.
BROADCAST_IDS = 2_000_000


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back.

    The table cuts the lineage: a lost executor re-reads files that every
    other one sees, and loops do not replay their earlier rounds.  What was
    shuffled for it is deleted with the step.
    """
    spark = df.sparkSession
    path = shared_dir(spark, "llm", label)
    with shuffles_cleared(spark):
        df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def spent(*frames: DataFrame) -> None:
    """Deletes tables of :func:`written` that no frame still to be run reads."""
    for df in frames:
        FileSystem(df.sparkSession, df.written_to).delete(df.written_to)


def picked(df: DataFrame, ids: DataFrame, col: str, how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose ``col`` is in the written table ``ids`` (``left_anti``: is not).

    Up to ``BROADCAST_IDS`` ids are broadcast, so ``df`` is not shuffled; more are joined by a shuffle.
    """
    ids = ids.select(col).distinct()
    few = ids.count() <= BROADCAST_IDS
    return df.join(F.broadcast(ids) if few else ids, col, how)


def pieces(batches, rows: int = 512):
    """Arrow batches in slices of at most ``rows`` rows, so that what a task makes of one stays small.

    When the task's input ends, memory that Arrow holds back goes to the system: the Python worker lives on.
    """
    for batch in batches:
        for i in range(0, batch.num_rows, rows):
            yield batch.slice(i, rows)
    pa.default_memory_pool().release_unused()


def text_slices(batch: pa.RecordBatch, column: int, limit: int):
    """Slices of a batch with about ``limit`` bytes of text in ``column``, or one longer text more."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
    cuts = np.searchsorted(ends, np.arange(0, ends[-1:].sum(), limit)).tolist()
    for a, b in pairwise(sorted({0, *cuts, batch.num_rows})):
        yield batch.slice(a, b - a)


def partitions_for(spark: SparkSession, total_bytes: int | None) -> int:
    """Partitions for a text shuffle: the session's number, more when a partition would be too large."""
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(floor, math.ceil((total_bytes or 0) / TARGET_PARTITION_BYTES))


def text_or_empty(col: str):
    """The text column with null as the empty string."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


class WordHashes(dict):
    """64-bit hashes of words (bytes), computed once while the cache holds them."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def share(spark: SparkSession, value):
    """Broadcast ``value`` pickled by value; tasks get it back with :func:`shared`."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shared(broadcast):
    return pickle.loads(broadcast.value)
