import datetime as dt

import pytest
from pyspark.sql import functions as F

from pelagia.operators.upsert import empty_index, upsert_index

A, B, C = (dt.datetime(2020, 1, d) for d in (1, 2, 3))
BATCH = (
    "tag_deployment_id string, transmitter_id string, species string, species_scientific_name string, tagging_project string, "
    "time_coverage_start timestamp_ntz, time_coverage_end timestamp_ntz, url string, size bigint, geom_df string"
)


def batch(spark, *keys, size=1, project="p", geom="MULTIPOINT((1 2))", start=A):
    return spark.createDataFrame([(k, "t", "s", "sn", project, start, B, "u", size, geom) for k in keys], BATCH)


def at(t):
    return F.lit(t).cast("timestamp_ntz")


def state(df):
    return {r.tag_deployment_id: (r.tagging_project, r.size, r.time_coverage_start, r.first_indexed, r.last_indexed, r.geom) for r in df.collect()}


def test_insert_refresh_and_keep(spark):
    first = upsert_index(empty_index(spark), batch(spark, "x", "y"), at(A))
    point = "MULTIPOINT((1 2))"
    assert state(first) == {k: ("p", 1, A, A, A, point) for k in "xy"}
    second = upsert_index(first, batch(spark, "y", "z", size=None, project="new", start=C), at(B))
    assert state(second) == {
        "x": ("p", 1, A, A, A, point),
        "y": ("p", None, C, A, B, point),
        "z": ("new", None, C, B, B, point),
    }
    # The same batch at the same time changes nothing more.
    again = upsert_index(second, batch(spark, "y", "z", size=None, project="new", start=C), at(B))
    assert state(again) == state(second)


def test_repeated_key_is_refused(spark):
    with pytest.raises(Exception, match="more than once"):
        upsert_index(empty_index(spark), batch(spark, "x", "y", "x"), at(A)).collect()


def test_bad_geometry_is_refused(spark):
    with pytest.raises(Exception, match="not a MULTIPOINT"):
        upsert_index(empty_index(spark), batch(spark, "x", geom="POINT(1 2)"), at(A)).collect()
