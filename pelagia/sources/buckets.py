"""A keyed table in hash buckets, of which a change rewrites only those it touches.

    <path>/data/<version>/bucket=<n>/   the rows of a bucket, as one write left them
    <path>/manifest/<number>/           one line per bucket: ``bucket version``, and their number

A write stores the buckets it changed under a version of its own and then a manifest that names
it for them, and the old versions for all others. The manifest appears whole, as Spark moves a
finished folder into place, so readers see the state before or after, and a job that fails leaves
the table as it was. Files of untouched buckets are neither read nor written.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import remove_dir

BUCKET = "bucket"


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class State:
    """One manifest: its number, how many buckets there are, and where each non-empty one lies."""

    number: int
    buckets: int
    versions: dict[int, str]


def _states(spark: SparkSession, path: str) -> list[State]:
    """The states whose manifests are complete, oldest first. A manifest has a line per bucket."""
    try:
        lines = spark.read.text(f"{path}/manifest/*").collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    found: dict[int, State] = {}
    for number, buckets, bucket, version in (r.value.split(" ") for r in lines):
        state = found.setdefault(int(number), State(int(number), int(buckets), {}))
        if version != "-":
            state.versions[int(bucket)] = version
    return [found[n] for n in sorted(found)]


def current(spark: SparkSession, path: str) -> State | None:
    states = _states(spark, path)
    return states[-1] if states else None


def _read(spark: SparkSession, path: str, state: State, schema, only: list[int] | None = None) -> DataFrame:
    chosen = sorted(state.versions) if only is None else [b for b in only if b in state.versions]
    if not chosen:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/data/{state.versions[b]}/{BUCKET}={b}" for b in chosen])


def read_buckets(spark: SparkSession, path: str, schema) -> DataFrame:
    """The whole table as it is now."""
    state = current(spark, path)
    if state is None:
        raise FileNotFoundError(f"no table at {path}")
    return _read(spark, path, state, schema)


def _store(spark: SparkSession, path: str, before: list[State], rows: DataFrame, key: str, buckets: int, touched: list[int], keep: int) -> None:
    version = uuid.uuid4().hex
    placed = rows.withColumn(BUCKET, bucket_of(key, buckets))
    # A bucket is one task's: its rows lie together, sorted, in as few files as they fill.
    placed.repartition(BUCKET).sortWithinPartitions(BUCKET, key).write.partitionBy(BUCKET).parquet(f"{path}/data/{version}")
    filled = spark.read.schema(placed.schema).parquet(f"{path}/data/{version}").select(BUCKET).distinct()
    now = {r[0] for r in filled.collect()}
    old = {b: v for b, v in before[-1].versions.items() if b not in touched} if before and before[-1].buckets == buckets else {}
    state = State(before[-1].number + 1 if before else 1, buckets, old | dict.fromkeys(now, version))
    lines = [(f"{state.number} {buckets} {b} {v}",) for b, v in sorted(state.versions.items())] or [(f"{state.number} {buckets} 0 -",)]
    spark.createDataFrame(lines, "value string").coalesce(1).write.text(f"{path}/manifest/{state.number:012d}")
    kept = [*before, state][-keep:]
    for gone in before[: max(0, len(before) + 1 - keep)]:
        remove_dir(spark, f"{path}/manifest/{gone.number:012d}")
        for b, v in gone.versions.items():
            if all(s.versions.get(b) != v for s in kept):
                remove_dir(spark, f"{path}/data/{v}/{BUCKET}={b}")


def write_buckets(rows: DataFrame, path: str, key: str, buckets: int, keep: int = 2) -> DataFrame:
    """Store a whole table; also the way to change the number of buckets of a stored one."""
    spark = rows.sparkSession
    _store(spark, path, _states(spark, path), rows, key, buckets, list(range(buckets)), keep)
    return read_buckets(spark, path, rows.schema)


def merge_buckets(spark: SparkSession, path: str, schema, batch: DataFrame, key: str, merge: Callable[[DataFrame, DataFrame], DataFrame], keep: int = 2) -> DataFrame:
    """``merge(stored rows, batch)`` in the buckets that the batch has keys of; all others stay.

    The driver learns the numbers of those buckets, as many as there are at most.
    """
    before = _states(spark, path)
    if not before:
        raise FileNotFoundError(f"no table at {path}")
    state = before[-1]
    touched = [r[0] for r in batch.select(bucket_of(key, state.buckets)).distinct().collect()]
    if touched:
        stored = _read(spark, path, state, schema, touched)
        _store(spark, path, before, merge(stored, batch), key, state.buckets, touched, keep)
    return read_buckets(spark, path, schema)
