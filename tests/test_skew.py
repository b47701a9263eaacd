"""One key with half of all rows: same results, and work that is split."""

import pytest
from pyspark.sql import functions as F

from pelagia.operators.profile import below_reference, reference_level
from pelagia.operators.rows import first_per_group, in_any, salted_join
from pelagia.operators.taxa import sightings_with_changelog

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
}


@pytest.fixture
def tiny_limits(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(name):
    return F.when(F.col("id") % 2 == 0, F.lit("HOT")).otherwise(F.concat(F.lit(name), (F.col("id") % 97).cast("string")))


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_to_changelog_is_split(spark, tiny_limits):
    raw = spark.range(0, 60000, 1, 8).select(
        F.concat(F.lit("k"), (F.col("id") % 11).cast("string")).alias("k"), hot("T").alias("taxon_name"), F.lit("G").alias("genus"), (F.col("id") % 7).cast("double").alias("v")
    )
    log = raw.select("taxon_name").distinct().select("taxon_name", F.lit("2010-01-01").cast("date").alias("startdate"), F.lit("Old x").alias("parent_name"))
    # Stored, as changelogs are, so that both inputs of the join come straight from a shuffle.
    log = spark.createDataFrame(log.collect(), log.schema)
    rows = sightings_with_changelog(raw, log, ["k"], F.col("genus"), "v", "genus").rows
    assert "SortMergeJoin(skew=true)" in final_plan(rows)
    total = raw.groupBy("k").agg(F.sum("v").alias("v"))
    assert sorted((r.k, r.value) for r in rows.collect()) == sorted((r.k, r.v) for r in total.collect())


def test_salted_join_equals_plain_join(spark, tiny_limits):
    big = spark.range(0, 5000, 1, 6).select(hot("T").alias("k"), F.col("id").alias("x"))
    one = big.groupBy("k").agg(F.count("*").alias("n"))
    salted = sorted(map(tuple, salted_join(big, one, "k", salts=5).select("k", "x", "n").collect()))
    assert salted == sorted(map(tuple, big.join(one, "k").select("k", "x", "n").collect()))


def test_profile_of_a_hot_trip(spark, tiny_limits):
    rows = spark.range(0, 20000, 1, 8).select(
        hot("T").alias("trip"), (F.col("id") % 3001).cast("double").alias("z"),
        (20 - (F.col("id") % 3001) / 1000).alias("t"), (35 - (F.col("id") % 3001) / 10000).alias("s"), ((F.col("id") * 7919) % 1009).cast("double").alias("c"),
    )
    levels = reference_level(rows, "trip", "z", "t", "s")
    got = below_reference(rows, levels, "trip", "z", "t", "s", "c").filter("trip = 'HOT'").first()
    pdf = rows.filter("trip = 'HOT'").toPandas()
    ref = pdf.loc[(pdf.z - 10).abs().sort_values(kind="stable").index].sort_values(["z"], kind="stable", key=lambda z: (z - 10).abs()).iloc[0]
    below = pdf[pdf.z > ref.z]
    top = below.sort_values(["c", "z"], ascending=[False, True]).iloc[0].z
    mld = below.assign(d=(below.t - (ref.t - 0.4)).abs()).sort_values(["d", "z"]).iloc[0].z
    assert (got.DCM_m, got.MLDtemp_m) == (top, mld)


def test_picks_and_key_sets(spark):
    df = spark.range(0, 4000, 1, 8).select(hot("T").alias("k"), "id")
    picked = first_per_group(df, ["k"], [F.desc("id")])
    want = df.groupBy("k").agg(F.max("id").alias("id"))
    assert sorted(map(tuple, picked.collect())) == sorted(map(tuple, want.collect()))
    kept = in_any(df, "k", [df.filter("id = 0"), df.filter("id = 1"), df.filter("id = 2")])
    assert {r.k for r in kept.select("k").distinct().collect()} == {"HOT", "T1"}
