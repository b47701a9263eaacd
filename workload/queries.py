"""Registered queries: every product, then every operator on its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pelagia.plans import PRODUCTS

from . import oracle
from .frames import catalog, comparable

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def _product(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(catalog(spark, sf_dir)[name], oracle.INDEX_ROUNDING if "indices" in name else None)

    return run


for _name in PRODUCTS:
    QUERIES[_name] = _product(_name)
    SQL[_name] = oracle.product_sql(_name)

from . import operators  # noqa: E402

QUERIES.update(operators.QUERIES)
SQL.update(operators.SQL)
