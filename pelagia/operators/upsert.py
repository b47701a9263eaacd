"""Keyed upsert of a batch into a stored index."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import is_multipoint
from ..schemas import TABLES
from ..sources.buckets import current, merge_buckets, write_buckets

INDEX = TABLES["detection_file_index"]
INDEX_KEY = "tag_deployment_id"
#: Hash buckets of a new stored index.
BUCKETS = 16
# Columns a known key takes over from the batch; every other column keeps its first value.
REFRESHED = ("time_coverage_start", "time_coverage_end", "size", "geom")


def empty_index(spark: SparkSession) -> DataFrame:
    """The index before its first batch."""
    return spark.createDataFrame([], INDEX.struct)


def staged_batch(batch: DataFrame) -> DataFrame:
    """Check the geometry text of a batch and name it as in the index.

    Text that is no multipoint fails the batch, as a geometry column would.
    """
    bad = F.raise_error(F.concat(F.lit("not a MULTIPOINT: "), F.col("geom_df")))
    geom = F.when(F.col("geom_df").isNull() | is_multipoint("geom_df"), F.col("geom_df")).otherwise(bad)
    return batch.withColumn("geom", geom.cast("string")).drop("geom_df")


def one_per_key(batch: DataFrame, key: str) -> DataFrame:
    """The batch unchanged, failing as it is read if a key occurs twice."""
    rest = [c for c in batch.columns if c != key]
    packed = batch.groupBy(key).agg(F.count("*").alias("__n"), *[F.min(c).alias(c) for c in rest])
    repeated = F.raise_error(F.concat(F.lit("key occurs more than once in the batch: "), F.col(key).cast("string")))
    checked = F.when(F.col("__n") == 1, F.col(key)).otherwise(repeated.cast(batch.schema[key].dataType))
    return packed.select(checked.alias(key), *rest)


def upsert(
    stored: DataFrame,
    batch: DataFrame,
    key: str,
    refreshed: Sequence[str],
    on_insert: dict[str, Column],
    on_update: dict[str, Column],
) -> DataFrame:
    """The next state of ``stored``: new keys inserted, known keys partly refreshed.

    ``refreshed`` columns of a known key come from the batch, even where it holds NULL.
    ``on_insert`` and ``on_update`` give computed columns for new and for touched rows.
    """
    incoming = one_per_key(batch, key)
    new = incoming.select(
        F.col(key), F.lit(True).alias("__in"), *[F.col(c).alias(f"__b_{c}") for c in incoming.columns if c != key]
    )
    both = stored.withColumn("__had", F.lit(True)).join(new, key, "full")
    had, given = F.col("__had").isNotNull(), F.col("__in").isNotNull()

    def column(name: str) -> Column:
        kind = stored.schema[name].dataType
        if name == key:
            return F.col(key)
        fresh = F.col(f"__b_{name}").cast(kind) if name in incoming.columns else F.lit(None).cast(kind)
        insert = on_insert[name].cast(kind) if name in on_insert else fresh
        update = F.col(name)
        if name in on_update:
            update = on_update[name].cast(kind)
        elif name in refreshed:
            update = fresh
        return F.when(~had, insert).when(given, update).otherwise(F.col(name)).alias(name)

    return both.select(*[column(c) for c in stored.columns])


def upsert_index(stored: DataFrame, batch: DataFrame, now: Column | None = None) -> DataFrame:
    """Merge a harvested batch of file records into the detection index.

    ``now`` is the indexing time; pass a literal to make a run repeatable.
    """
    now = F.current_timestamp() if now is None else now
    return upsert(
        stored,
        staged_batch(batch),
        INDEX_KEY,
        REFRESHED,
        on_insert={"first_indexed": now, "last_indexed": now},
        on_update={"last_indexed": now},
    )


def create_index(rows: DataFrame, path: str, buckets: int = BUCKETS) -> DataFrame:
    """Store a whole index, or store it anew with another number of buckets."""
    return write_buckets(rows.select(*INDEX.columns), path, INDEX_KEY, buckets)


def store_index(spark: SparkSession, path: str, batch: DataFrame, now: Column | None = None, buckets: int = BUCKETS) -> DataFrame:
    """Create the stored index if it is absent, merge a batch into it, and return what is stored.

    Only buckets that the batch has keys of are read and rewritten. A batch that fails leaves the
    index as it was. ``buckets`` counts for a new index; choose it so that a bucket is a file or
    a few, and :func:`create_index` anew when the index has outgrown it.
    """
    if current(spark, path) is None:
        create_index(empty_index(spark), path, buckets)
    return merge_buckets(spark, path, INDEX.struct, batch, INDEX_KEY, lambda stored, new: upsert_index(stored, new, now))
