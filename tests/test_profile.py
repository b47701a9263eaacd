from pelagia.operators.profile import below_reference, reference_level, surface_values

SCHEMA = "trip string, z double, t double, tq string, s double, sq string, c double, cq string"
MEASURES = {"T": ("t", "tq"), "S": ("s", "sq"), "C": ("c", "cq")}


def test_surface_values(spark):
    rows = [
        ("tie", 9.0, 20.0, "1", 35.0, "4", 1.0, None), ("tie", 11.0, 21.0, "1", 36.0, "1", 2.0, "1"),
        ("far", 16.0, 20.0, "1", 35.0, "1", 1.0, "1"), ("far", 4.5, 20.0, "1", 35.0, "1", 1.0, "1"),
        ("edge", 15.0, 20.0, "3", 35.0, "2", None, "1"),
    ]
    got = {r["trip"]: r for r in surface_values(spark.createDataFrame(rows, SCHEMA), "trip", "z", MEASURES).collect()}
    assert set(got) == {"tie", "edge"}
    # The shallower depth wins the tie; a bad flag masks its value, a missing flag keeps it.
    assert (got["tie"].z, got["tie"].depth_diff, got["tie"]["T"], got["tie"]["S"], got["tie"]["C"]) == (9.0, 1.0, 20.0, None, 1.0)
    assert (got["edge"]["T"], got["edge"]["S"], got["edge"]["C"]) == (None, 35.0, None)


def profile(spark, rows):
    return spark.createDataFrame(rows, "trip string, z double, t double, s double, c double")


def picks(spark, rows, **options):
    df = profile(spark, rows)
    levels = reference_level(df, "trip", "z", "t", "s")
    out = below_reference(df, levels, "trip", "z", "t", "s", "c", **options)
    return {r.trip: (r.MLDtemp_m, r.MLDsal_m, r.DCM_m) for r in out.collect()}, {r.trip: r.ref_depth for r in levels.collect()}


def test_reference_depth_by_station(spark):
    rows = [(t, z, 20.0, 35.0, 1.0) for t in ("DAR1", "YON1", "MAI1") for z in (5.0, 10.0, 20.0)]
    assert picks(spark, rows)[1] == {"DAR1": 5.0, "YON1": 5.0, "MAI1": 10.0}


def test_mixed_layer_and_maximum(spark):
    rows = [("M", 10.0, 20.0, 35.0, 1.0), ("M", 20.0, 19.8, 34.99, 3.0), ("M", 30.0, 19.5, 34.96, 5.0), ("M", 40.0, 18.0, 34.0, 5.0)]
    assert picks(spark, rows)[0] == {"M": (30.0, 30.0, 30.0)}


def test_null_values_in_picks(spark):
    rows = [
        ("N", 10.0, 20.0, 35.0, 1.0), ("N", 20.0, 19.6, 34.9, None), ("N", 30.0, 19.0, 34.97, 9.0),
        ("A", 10.0, None, 35.0, 1.0), ("A", 30.0, None, 34.97, 2.0), ("A", 20.0, None, 34.0, 1.0),
        ("S", 10.0, 20.0, 35.0, 1.0),
    ]
    got, _ = picks(spark, rows)
    # A NULL chlorophyll outranks every number; NULL differences rank last but still count.
    assert got == {"N": (20.0, 30.0, 20.0), "A": (20.0, 30.0, 30.0)}
    assert picks(spark, rows, skip_null_chlorophyll=True)[0]["N"][2] == 30.0
