"""Parquet snapshots: a product is computed once and read back by its dependants.

A snapshot is a folder of versions and a pointer, a one-line text folder naming the version that
holds. A write makes a new version first and then turns the pointer, so a failed job leaves the
old version in place, and a job may read the snapshot it writes.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from ..session import remove_dir


def _pointers(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    """(number, version) of every complete pointer, oldest first."""
    try:
        rows = spark.read.text(f"{path}/pointer/*").collect()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted((int(n), v) for n, v in (r.value.split(" ", 1) for r in rows))


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_pointers(spark, path))


def write_snapshot(df: DataFrame, path: str, keep: int = 2, by: str | None = None) -> DataFrame:
    """Write a product as the next version, then return it as read from storage.

    Reading back cuts the lineage: a lost executor re-reads files instead of recomputing
    every upstream product. The last ``keep`` versions stay, so that readers of the one
    before are not cut off. ``by`` lays the rows of each of its few values in a folder of their own.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    (df.write.partitionBy(by) if by else df.write).parquet(f"{path}/version/{version}")
    turn_pointer(spark, path, version, keep)
    return read_snapshot(spark, path, df.schema)


def turn_pointer(spark: SparkSession, path: str, version: str, keep: int) -> list[str]:
    """Make a written version the current one, and remove and return those that are too old."""
    before = _pointers(spark, path)
    number = before[-1][0] + 1 if before else 1
    # The pointer appears whole: Spark moves a finished file into place.
    line = spark.range(1).selectExpr(f"'{number} {version}' AS value").coalesce(1)
    line.write.text(f"{path}/pointer/{number:012d}")
    gone = before[: max(0, len(before) + 1 - keep)]
    for n, old in gone:
        remove_dir(spark, f"{path}/pointer/{n:012d}")
        remove_dir(spark, f"{path}/version/{old}")
        remove_dir(spark, f"{path}/layout/{old}")
    return [old for _, old in gone]


def read_pointer(spark: SparkSession, path: str) -> str:
    """The current version."""
    found = _pointers(spark, path)
    if not found:
        raise FileNotFoundError(f"no snapshot at {path}")
    return found[-1][1]


def read_snapshot(spark: SparkSession, path: str, schema=None) -> DataFrame:
    version = read_pointer(spark, path)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{path}/version/{version}")
