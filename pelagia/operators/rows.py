"""Row-choosing and key-set operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def first_per_group(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each group under an explicit, total order.

    Spark turns ``row_number = 1`` into a group limit ahead of the shuffle, so each task
    sends at most one row per group however large the group is.
    """
    spec = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("__rank", F.row_number().over(spec))
    return ranked.filter(F.col("__rank") == 1).drop("__rank")


def lowest(fields: dict[str, Column], *order: Column, where: Column | None = None) -> Column:
    """Aggregate: ``fields`` of the row that comes first under ``order``, of rows ``where`` holds.

    Lowest values win, and the fields themselves break remaining ties. Several of these
    share one pass and one shuffle, with partial aggregation on the map side.
    """
    ranks = [o.alias(f"__o{i}") for i, o in enumerate(order)]
    row = F.struct(*ranks, *[c.alias(n) for n, c in fields.items()])
    return F.min(row if where is None else F.when(where, row))


def in_any(df: DataFrame, key: str, sources: list[DataFrame]) -> DataFrame:
    """Rows whose key occurs in at least one source.

    One semi join against the united key set; ``distinct`` shrinks every source on the
    map side before its keys are shuffled.
    """
    keys = reduce(DataFrame.unionByName, [s.select(key) for s in sources]).distinct()
    return df.join(keys, key, "left_semi")


def union_distinct(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames).distinct()


def salted_join(big: DataFrame, small: DataFrame, key: str, salts: int = 16, how: str = "inner") -> DataFrame:
    """Inner or left join of many rows per key with one row per key, safe for a key that owns many.

    Spark splits a skewed join by itself only where both inputs come straight from a shuffle;
    an input that was just aggregated on the key does not. Here the rows of a key are spread
    over ``salts`` tasks, and the small side is copied to each.
    """
    names = [c for c in big.columns if c != key]
    spread = F.pmod(F.hash(F.spark_partition_id(), *names), F.lit(salts))
    copies = small.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return big.withColumn("__salt", spread).join(copies, [key, "__salt"], how).drop("__salt")


def star(base: DataFrame, key: str, facts: list[DataFrame]) -> DataFrame:
    """Left-join pre-aggregated facts, one row per key each, onto a base table.

    All sides are partitioned on the same key, so the base is shuffled once at most.
    """
    return reduce(lambda left, fact: left.join(fact, key, "left"), facts, base)
