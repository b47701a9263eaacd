import datetime as dt
import random
import re

from pyspark.sql import functions as F

from pelagia.operators.nearest import band_join, nearest_in_time
from pelagia.plans import Catalog

T0 = dt.datetime(2012, 1, 10, 12)


def hours(h):
    return T0 + dt.timedelta(hours=h)


def frames(spark, trips, casts):
    return (
        spark.createDataFrame(trips, "trip string, site string, t timestamp_ntz"),
        spark.createDataFrame(casts, "site string, file_id bigint, c timestamp_ntz"),
    )


def brute(trips, casts, seconds=86400):
    out = {}
    for trip, site, t in trips:
        near = [(abs((t - c).total_seconds()), f) for s, f, c in casts if s == site and abs((t - c).total_seconds()) <= seconds]
        if near:
            out[trip] = min(near)
    return out


def run(spark, trips, casts, **options):
    left, right = frames(spark, trips, casts)
    found = nearest_in_time(left, right, "site", "t", "c", "file_id", **options)
    gap = F.col("time_difference").cast("interval second").cast("decimal(18,6)").cast("double").alias("gap")
    return {r.trip: (r.gap, r.file_id) for r in found.select("trip", "file_id", gap).collect()}


def test_tolerance_ties_and_sites(spark):
    trips = [("none", "A", hours(1000)), ("near", "A", hours(0)), ("edge", "B", hours(0)), ("past", "C", hours(0)), ("tie", "D", hours(0)), ("other", "Z", hours(0))]
    casts = [
        ("A", 1, hours(2)), ("A", 2, hours(-3)), ("B", 3, hours(24)), ("C", 4, hours(-24) - dt.timedelta(microseconds=1)),
        ("D", 6, hours(-1)), ("D", 5, hours(1)), ("D", 9, hours(-1)),
    ]
    got = run(spark, trips, casts)
    assert got == {"near": (7200.0, 1), "edge": (86400.0, 3), "tie": (3600.0, 5)}
    assert got == brute(trips, casts)


def test_random_against_brute_force(spark):
    rng = random.Random(5)
    # Two thirds of everything is at one site, with many equal times.
    site = lambda: "hot" if rng.random() < 0.67 else rng.choice("abc")
    when = lambda: T0 + dt.timedelta(minutes=rng.randrange(0, 60 * 24 * 20, 7))
    trips = [(f"t{i}", site(), when()) for i in range(400)]
    casts = [(site(), i, when()) for i in range(150)]
    for bucket in (600, 3600, 90000):
        assert run(spark, trips, casts, bucket_seconds=bucket) == brute(trips, casts)


def test_band_join_against_brute_force(spark):
    rng = random.Random(6)
    trips = [(f"t{i}", rng.choice("ab"), hours(rng.uniform(0, 200))) for i in range(60)] + [("x", "a", hours(0))]
    casts = [(rng.choice("ab"), i, hours(rng.uniform(0, 200))) for i in range(60)] + [("a", 99, hours(24)), ("a", 98, hours(-24))]
    left, right = frames(spark, trips, casts)
    got = {(r.trip, r.file_id) for r in band_join(left, right, "site", "t", "c").collect()}
    want = {(n, f) for n, s, t in trips for q, f, c in casts if q == s and abs((t - c).total_seconds()) <= 86400}
    assert got == want


def test_station_filed_under_another_site(spark):
    trip = "projectname string, stationname string, stationcode string, latitude double, longitude double, trip_code string, sampledateutc timestamp_ntz, sampledatelocal timestamp_ntz, phytosampledepth_m double, zoopsampledepth_m double, biomass_mgm3 double, ashfreebiomass_mgm3 double, secchi_m double, sampletype string"
    rows = [(p, "n", s, 1.0, 2.0, t, T0, T0, None, None, None, None, None, "P") for p, s, t in (("NRS", "VBM", "v"), ("NRS", "MAI", "m"), ("SOTS", "MAI", "s"))]
    casts = spark.createDataFrame([(1, "VBM100", T0), (2, "NRSVBM", T0), (3, "NRSMAI", T0), (4, "SOTSMAI", T0)], "file_id bigint, site_code string, time_coverage_start timestamp_ntz")
    c = Catalog(spark, {"bgc_trip": spark.createDataFrame(rows, trip), "deployments": casts})
    assert {(r.trip_code, r.file_id) for r in c["nrs_depth_binned_ctd_map"].collect()} == {("v", 1), ("m", 3)}


def test_a_bucket_is_shown_to_three_spans(spark):
    left, right = frames(spark, [("a", "A", hours(0))], [("A", 1, hours(2))])
    found = nearest_in_time(left, right, "site", "t", "c", "file_id")
    made = re.findall(r"Generate explode\(([^\n]*)", found._jdf.queryExecution().optimizedPlan().toString())
    # An offer to each bucket within a day would be 48 rows a bucket.
    assert made and all(not re.search(r"-24, ?-23", m) and "[0,-1,1]" in m for m in made)


def test_matches_on_both_ends_of_the_tolerance(spark):
    trips = [(f"t{h}", "A", hours(h)) for h in range(-60, 60)]
    for casts in ([("A", 1, hours(-24)), ("A", 2, hours(24))], [("A", 1, hours(0.5))], [("A", k, hours(k * 47 + 0.25)) for k in range(-1, 2)]):
        assert run(spark, trips, casts) == brute(trips, casts)
