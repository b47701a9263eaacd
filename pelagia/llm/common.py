"""What the corpus operators share: reading tables, shared scratch tables, and hashing."""

from __future__ import annotations

import atexit

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.session import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def split_of(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a NULL id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), F.lit(folds))


ROW = "__row"


def numbered(docs: DataFrame, scratch: Scratch, stored: bool) -> DataFrame:
    """The rows with a number of their own in ``ROW``, the same each time they are read.

    Filters name rows by it, as ids may repeat or be NULL. ``stored`` says that ``docs`` is a table as
    read from storage, so that its rows keep their places; anything else is stored first.
    """
    rows = docs if stored else scratch.keep(docs, "rows")
    return rows.withColumn(ROW, F.monotonically_increasing_id())


def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """Numbered rows less those whose ``ROW`` is in ``gone``. What goes grows with the corpus: it is
    merged, not broadcast, at every size."""
    return rows.join(gone.select(ROW).distinct().hint("merge"), ROW, "left_anti").drop(ROW)


class Scratch:
    """Tables written to the shared folder of the cluster and read back.

    Writing cuts lineage: what is lost with an executor is read again, not computed again.
    ``drop`` removes what nothing reads any more; the rest goes when the driver ends.
    """

    def __init__(self, spark: SparkSession, purpose: str):
        self.spark = spark
        self.root = scratch_dir(spark, purpose)
        atexit.register(self._remove, self.root)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table once; the shuffle files behind it are not needed any more and go."""
        path, cleanup = f"{self.root}/{name}", "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        before = self.spark.conf.get(cleanup, "false")
        self.spark.conf.set(cleanup, "true")
        try:
            df.write.mode("overwrite").parquet(path)
        finally:
            self.spark.conf.set(cleanup, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def together(self, kept: list[DataFrame]) -> DataFrame:
        """Kept tables of one schema as one scan, however many they are."""
        return self.spark.read.schema(kept[0].schema).parquet(*[f for df in kept for f in df.inputFiles()]) if len(kept) > 1 else kept[0]

    def drop(self, *names: str) -> None:
        for name in names:
            self._remove(f"{self.root}/{name}")

    def _remove(self, path: str) -> None:
        context = self.spark.sparkContext
        if context._jsc is None or context._jsc.sc().isStopped():
            return
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal inputs give equal, evenly spread outputs."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """word -> 64-bit hash, remembered up to ``limit`` words at a time."""

    def __init__(self, limit: int = 500_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` words; a shorter text is one run, an empty one none."""
    if not len(words):
        return words
    n = min(n, len(words))
    with np.errstate(over="ignore"):
        out = np.full(len(words) - n + 1, 0x9E3779B97F4A7C15 + n, np.uint64)
        for k in range(n):
            out = mix(out * np.uint64(0x100000001B3) + words[k : len(words) - n + 1 + k])
    return out
