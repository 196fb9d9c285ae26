"""Intermediate tables in the shared folder, and size-checked broadcasts.

Every table that cuts lineage is written as Parquet below the folder that
``spark.checkpoint.dir`` names, so any executor (or a retry after one is
lost) reads the same rows.
"""

from __future__ import annotations

import contextlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .shingles import hash_longs
from .workers import give_back

BROADCAST_ROWS = 500_000     # narrow rows (<= 64 bytes each): 32 MB at most
BITMAP_BITS = 1 << 21        # 256 KB
BITMAP_MOST = 1 << 24        # 2 MB, whatever the number of ids
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession):
    """Shuffle files of the queries made in here go as soon as each has ended,
    not when the driver happens to collect its garbage (a later read that
    misses them runs the stage again).  Spark reads the setting when a
    DataFrame is made and when a write begins."""
    was = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, was)


class Scratch:
    """Tables of one operator run; removed when the session ends, or earlier
    by ``drop``."""

    def __init__(self, spark: SparkSession, owner: str):
        self.spark = spark
        self.base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{owner}-{uuid.uuid4().hex}"
        fs = self._fs(self.base)
        fs.mkdirs(self._path(self.base))                    # deleteOnExit ignores a path that isn't there yet
        fs.deleteOnExit(self._path(self.base))

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        with freed_shuffles(self.spark):
            df.write.parquet(path)
        give_back()         # what the driver's Python collected for this step
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            self._fs(self.base).delete(self._path(self.path(name)), True)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` (narrow rows, a written table) with a broadcast hint when it has
    at most ``rows`` rows; beyond that Spark shuffles both sides."""
    return F.broadcast(df) if df.count() <= rows else df


def bitmap_bits(ids: int) -> int:
    """Slots for so many ids: some 16 each, within BITMAP_BITS and BITMAP_MOST."""
    return min(BITMAP_MOST, max(BITMAP_BITS, 1 << (16 * ids).bit_length()))


def slot_of(*cols, bits: int = BITMAP_BITS) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(bits))


def slots_set(words: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which of the longs fall into a set slot of a ``Bitmap`` of one long
    column, by its ``words``: ``Bitmap.has`` for tasks in Python."""
    h = hash_longs(ids, 42)
    word = words.view(np.uint64)[(h & np.uint64(64 * len(words) - 1)) >> np.uint64(6)]
    return (word >> (h & np.uint64(63))) & np.uint64(1) > 0


class Bitmap:
    """Which of ``bits`` hash slots some ids fall into: a fixed-size prefilter
    in front of an exact join.  False positives only cost shuffle."""

    def __init__(self, ids: DataFrame, *cols: str, bits: int = BITMAP_BITS):
        slot = slot_of(*cols, bits=bits)
        self.bits, self.spark = bits, ids.sparkSession
        self.words = np.zeros(bits // 64, np.int64)
        with freed_shuffles(self.spark):
            # ids -> one 64-bit word per 64 slots: at most bits / 64 rows reach the driver
            got = (ids.select(F.floor(slot / 64).cast("int").alias("w"),
                              F.expr(f"shiftleft(1L, cast(pmod(xxhash64({', '.join(cols)}), 64L) as int))").alias("b"))
                   .groupBy("w").agg(F.bit_or("b").alias("b")).toArrow())
        self.words[got["w"].to_numpy()] = got["b"].to_numpy()
        del got
        give_back()

    def any(self) -> bool:
        return bool(self.words.any())

    def has(self, *cols) -> Column:
        """Spark condition: the slot of ``cols`` is set."""
        # a subquery, as a literal's 650 KB would be part of every text of the plan, and each stage that ends makes one
        slot = slot_of(*cols, bits=self.bits)
        table = self.spark.createDataFrame(pa.table({"words": pa.array([self.words], pa.list_(pa.int64()))}))
        word = F.element_at(table.scalar(), (F.floor(slot / 64) + 1).cast("int"))
        bit = F.pmod(F.xxhash64(*cols), F.lit(64)).cast("int")
        return F.getbit(word, bit) == 1
