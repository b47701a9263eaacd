"""Joins on time: all pairs inside a band, and the nearest match inside a tolerance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

DAY_SECONDS = 86_400


def micros(c: Column | str) -> Column:
    """Microseconds since 1970 of a UTC time (the session zone is UTC)."""
    return F.unix_micros((F.col(c) if isinstance(c, str) else c).cast("timestamp"))


def band_join(
    left: DataFrame,
    right: DataFrame,
    by: str,
    left_time: str,
    right_time: str,
    seconds: int = DAY_SECONDS,
) -> DataFrame:
    """All (left, right) pairs with equal ``by`` whose times differ by at most ``seconds``.

    Times fall into buckets as wide as the band, and each left row is offered to the three
    buckets it can reach. That makes bucket and ``by`` one equi-join key, so a busy ``by``
    value is spread over its days. The pairs are the result asked for; to find only the
    best one use :func:`nearest_in_time`, which never forms them.
    """
    width = seconds * 1_000_000
    reach = left.withColumn("__lt", micros(left_time)).withColumn(
        "__bucket",
        F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda k: F.floor(F.col("__lt") / width) + k)),
    )
    slots = right.withColumn("__rt", micros(right_time)).withColumn(
        "__bucket", F.floor(F.col("__rt") / width)
    )
    pairs = reach.join(slots, [by, "__bucket"]).filter(
        F.abs(F.col("__lt") - F.col("__rt")) <= width
    )
    return pairs.drop("__bucket", "__lt", "__rt")


def _hit(at: Column, match_id: Column) -> Column:
    return F.struct(at.alias("at"), match_id.alias("id"))


def nearest_in_time(
    left: DataFrame,
    right: DataFrame,
    by: str,
    left_time: str,
    right_time: str,
    right_id: str,
    seconds: int = DAY_SECONDS,
    bucket_seconds: int = 3_600,
) -> DataFrame:
    """Left rows with the nearest right row of the same ``by`` value, within a tolerance.

    Adds ``right_id``, ``right_time`` and ``time_difference`` (an interval); left rows
    without a match are dropped. Equal distances go to the smaller id.

    No pairs are formed. Both sides are merged into one row per distinct (``by``, time),
    which removes any pile-up of equal times before the shuffle. Rows are then sorted
    inside short time buckets, where the latest match before and the earliest after are
    running values. What lies beyond a bucket's edge comes from a summary of the buckets
    within the tolerance, so a ``by`` value with a large share of all rows is worked on by
    as many tasks as it has buckets.
    """
    width = bucket_seconds * 1_000_000
    moments = (
        left.select(by, micros(left_time).alias("__t"), F.lit(1).alias("__left"), F.lit(None).cast(right.schema[right_id].dataType).alias("__id"))
        .unionByName(
            right.select(by, micros(right_time).alias("__t"), F.lit(0).alias("__left"), F.col(right_id).alias("__id"))
        )
        .filter(F.col(by).isNotNull() & F.col("__t").isNotNull())
        .groupBy(by, "__t")
        .agg(F.max("__left").alias("__left"), F.min("__id").alias("__id"))
        .withColumn("__bucket", F.floor(F.col("__t") / width))
    )
    t = F.col("__t")

    # One row per bucket: its first and last match, and whether a left row asks for one. Only buckets
    # within the tolerance can hold a nearer one. Spans are as long as that, so a bucket's rows are
    # shown to its own span and the two beside it, and the nearest on either side is a running value
    # over the buckets of three spans: nothing walks along all buckets of a ``by`` value.
    match = F.when(F.col("__id").isNotNull(), _hit(t, F.col("__id")))
    buckets = moments.groupBy(by, "__bucket").agg(F.min(match).alias("__first"), F.max(match).alias("__last"), F.max("__left").alias("__asks"))
    span = -(-seconds // bucket_seconds)
    steps = F.when(F.col("__first").isNotNull(), F.array(F.lit(0), F.lit(-1), F.lit(1))).otherwise(F.array(F.lit(0)))
    shown = buckets.withColumn("__step", F.explode(steps)).withColumn("__span", F.floor(F.col("__bucket") / span) + F.col("__step"))
    of_span = Window.partitionBy(by, "__span")
    past = of_span.orderBy(F.asc("__bucket")).rowsBetween(Window.unboundedPreceding, -1)
    ahead = of_span.orderBy(F.desc("__bucket")).rowsBetween(Window.unboundedPreceding, -1)
    carried = shown.select(
        by,
        "__bucket",
        ((F.col("__asks") == 1) & (F.col("__step") == 0)).alias("__asks"),
        F.last("__last", ignorenulls=True).over(past).alias("__before"),
        F.last("__first", ignorenulls=True).over(ahead).alias("__after"),
    ).filter("__asks").drop("__asks")

    up = Window.partitionBy(by, "__bucket").orderBy(F.asc("__t")).rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy(by, "__bucket").orderBy(F.desc("__t")).rowsBetween(Window.unboundedPreceding, 0)
    hit = F.when(F.col("__id").isNotNull(), _hit(t, F.col("__id")))
    inside = (
        moments.select(
            by,
            "__bucket",
            "__t",
            "__left",
            F.last(hit, ignorenulls=True).over(up).alias("__prev"),
            F.last(hit, ignorenulls=True).over(down).alias("__next"),
        )
        .filter("__left = 1")
        .drop("__left")
    )

    def candidate(hit: Column) -> Column:
        gap = F.abs(t - hit["at"])
        return F.when(
            gap <= seconds * 1_000_000,
            F.struct(gap.alias("gap"), hit["id"].alias("id"), hit["at"].alias("at")),
        )

    best = (
        inside.join(carried, [by, "__bucket"], "left")
        .select(
            by,
            "__t",
            F.least(
                candidate(F.coalesce("__prev", "__before")),
                candidate(F.coalesce("__next", "__after")),
            ).alias("__best"),
        )
        .filter(F.col("__best").isNotNull())
    )
    zone_less = left.schema[left_time].dataType.typeName() == "timestamp_ntz"
    at = F.timestamp_micros("__best.at")
    return (
        left.withColumn("__t", micros(left_time))
        .join(best, [by, "__t"])
        .select(
            *[F.col(f"`{c}`") for c in left.columns],
            F.col("__best.id").alias(right_id),
            (at.cast("timestamp_ntz") if zone_less else at).alias(right_time),
            F.make_dt_interval(secs=(F.col("__best.gap") / F.lit(1_000_000)).cast("decimal(18,6)")).alias("time_difference"),
        )
    )
