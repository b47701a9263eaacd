"""Snapshots stored by key: joins on the key without an exchange, without a metastore."""

import re

import pytest
from pyspark.sql import functions as F

from pelagia.plans import build
from pelagia.plans.indices import NRS_FACTS
from pelagia.sources.placed import read_placed, write_placed
from pelagia.sources.snapshot import exists
from workload.frames import catalog


@pytest.fixture
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in names}
    for k in names:
        spark.conf.set(k, "-1")
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stored_by_key_joins_without_exchange(spark, tmp_path, no_broadcast):
    left = spark.range(500).select(F.concat(F.lit("k"), F.col("id") % 90).alias("k"), "id")
    right = spark.range(120).select(F.concat(F.lit("k"), "id").alias("k"), (F.col("id") * 2).alias("twice"))
    a, b = write_placed(left, str(tmp_path / "a"), "k", 6), write_placed(right, str(tmp_path / "b"), "k", 6)
    met = a.join(b, "k", "left")
    assert "Exchange" not in plan_of(met) and "SortMergeJoin" in plan_of(met)
    assert sorted(map(tuple, met.collect())) == sorted(map(tuple, left.join(right, "k", "left").collect()))
    assert "Exchange" not in plan_of(a.groupBy("k").count())
    assert len(list((tmp_path / "a" / "version").glob("*/*.parquet"))) <= 6


def test_another_session_reads_the_layout(spark, tmp_path, no_broadcast):
    rows = spark.range(50).select((F.col("id") % 7).cast("string").alias("Key Col"), F.create_map(F.lit("a"), F.col("id").cast("double")).alias("m"), F.lit("2020-01-01 00:00:00").cast("timestamp_ntz").alias("t"))
    path = str(tmp_path / "s")
    write_placed(rows, path, "Key Col", 3)
    for name in [t.name for t in spark.catalog.listTables() if t.name.startswith("placed_")]:
        spark.sql(f"DROP TABLE {name}")  # external: files stay, the session forgets
    again = read_placed(spark, path)
    assert again.dtypes == rows.dtypes and again.count() == 50
    assert "Exchange" not in plan_of(again.groupBy("`Key Col`").count())


def test_versions_and_pointer_are_those_of_a_snapshot(spark, tmp_path):
    path = str(tmp_path / "s")
    write_placed(spark.range(5).withColumn("k", F.col("id")), path, "k", 2)
    for _ in range(3):
        write_placed(read_placed(spark, path).withColumn("id", F.col("id") + 1), path, "k", 2)
    assert sorted(r.id for r in read_placed(spark, path).collect()) == [3, 4, 5, 6, 7]
    assert exists(spark, path) and len(list((tmp_path / "s" / "version").iterdir())) == 2 == len(list((tmp_path / "s" / "layout").iterdir()))
    bad = read_placed(spark, path).withColumn("id", F.when(F.col("id") > 6, F.raise_error(F.lit("no")).cast("bigint")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="no"):
        write_placed(bad, path, "k", 2)
    assert read_placed(spark, path).count() == 5


def test_index_product_over_stored_facts_has_no_exchange(spark, sf_dir, tmp_path, no_broadcast):
    name = "nrs_derived_indices_data"
    c = catalog(spark, sf_dir)
    built = build(c, str(tmp_path), [name], buckets=4)[name]
    c.forget(name)
    plan = plan_of(c[name])
    assert not re.search("Exchange", plan) and plan.count("SortMergeJoin") == len(NRS_FACTS)
    plain = catalog(spark, sf_dir)[name]
    assert sorted(map(repr, built.collect())) == sorted(map(repr, plain.select(*built.columns).collect()))
