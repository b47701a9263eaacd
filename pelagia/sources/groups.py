"""Ingest all tables of a published product group from a landing folder."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..schemas import PRODUCT_GROUPS, TABLES
from .csv import read_table
from .snapshot import write_snapshot


def tables_of(group: str, substring: bool = False) -> list[str]:
    """Tables of one group; with ``substring``, of every group whose name contains the text."""
    hits = [g for g in PRODUCT_GROUPS if g == group or (substring and group in g)]
    if not hits:
        raise ValueError(f"no product group matches {group!r}")
    return [t for g in hits for t in PRODUCT_GROUPS[g]]


def ingest_tables(
    spark: SparkSession, names: list[str], landing: str, out: str, **options: str
) -> dict[str, DataFrame]:
    """Read ``landing/<table>.csv`` for each table and store it as typed Parquet.

    Tables are independent, so their jobs are handed to Spark together.
    """

    def one(name: str) -> DataFrame:
        return write_snapshot(read_table(spark, f"{landing}/{name}.csv", TABLES[name], **options), f"{out}/{name}")

    with ThreadPoolExecutor(max(1, len(names))) as pool:
        return dict(zip(names, pool.map(one, names)))


def ingest_group(
    spark: SparkSession, group: str, landing: str, out: str, substring: bool = False, **options: str
) -> dict[str, DataFrame]:
    return ingest_tables(spark, tables_of(group, substring), landing, out, **options)
