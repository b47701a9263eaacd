"""State and exchanges of wide aggregates stay as narrow as what they hold."""

import re

from pyspark.sql import functions as F

from pelagia.operators.distinct import dense_codes, distinct_counts, value_bitmaps
from workload.frames import catalog


def test_a_key_with_few_values_holds_few_words(spark):
    rows = spark.range(6400).select((F.col("id") % 3200).alias("k"), (F.col("id") % 2000).alias("v"))
    bits = value_bitmaps(rows, ["k"], "v", dense_codes(rows, "v"))
    # A row used to hold a buffer of 4 KB, in the aggregate and stored.
    assert dict(bits.dtypes)["bits"] == "bigint" and bits.filter("bits = 0").count() == 0
    want = {r.k: r.n for r in rows.groupBy("k").agg(F.countDistinct("v").alias("n")).collect()}
    assert {r.k: r.n for r in distinct_counts(bits, ["k"]).collect()} == want
    assert distinct_counts(bits.withColumn("all", F.lit(0)), ["all"]).first().n == 2000


def test_laboratory_rows_are_placed_before_they_are_wide(spark, sf_dir):
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("bgc_pigments_data", "combined_bgc_data"):
            plan = catalog(spark, sf_dir)[name]._jdf.queryExecution().executedPlan().toString()
            above = re.findall(r"Exchange[^\n]*\n[^\n]*?(\w+Aggregate\([^\n]*max|SortMergeJoin[^\n]*|Project \[[^\n]*phytin_a[^\n]*)", plan)
            # Dozens of values a line were shuffled between two aggregates, and again to meet the trips.
            assert not above, (name, [a[:200] for a in above])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
