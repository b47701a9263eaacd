"""Defaults of gap filling are never rows of a shuffle, and the merge keeps its rules."""

import datetime as dt

from pelagia.operators import taxa as op

OLD, NEW = dt.datetime(2005, 6, 1), dt.datetime(2015, 6, 1)


def _case(spark):
    meta = spark.createDataFrame([("a", OLD), ("a", NEW), ("a", NEW), (None, NEW), ("b", None)], "key string, t timestamp_ntz")
    rows = spark.createDataFrame([("a", "LM", "x", -1.0), ("a", "LM", "x", -2.0), ("a", None, "z", None), (None, "LM", "z", 7.0)], "key string, method string, taxon string, value double")
    affected = spark.createDataFrame([("x", "LM", dt.date(2010, 1, 1)), ("y", "LM", None), ("y", None, dt.date(2010, 1, 1))], "taxon string, method string, start date")
    return meta, op.Sightings(rows, affected)


def test_no_default_is_shuffled(spark):
    meta, found = _case(spark)
    for out in (
        op.fill_gaps(meta, "key", "t", op.Sightings(found.rows.drop("method"), found.affected.drop("method").dropDuplicates(["taxon"])), "m"),
        op.fill_gaps_by_method(meta, "key", "method", "t", found, "m"),
    ):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        # A default used to be a row of a union that was placed by key.
        assert "Union" not in plan and "__slice" not in plan


def test_merge_of_observed_values_and_defaults(spark):
    meta, found = _case(spark)
    got = sorted(((r.key, r.t, r.Method, tuple((r.m or {}).items())) for r in op.fill_gaps_by_method(meta, "key", "method", "t", found, "m").collect()), key=repr)
    null_old, null_new = (("y", None), ("z", None)), (("y", 0.0), ("z", None))
    want = [
        ("a", OLD, "LM", (("x", -1.0), ("y", 0.0))), ("a", OLD, None, null_old),
        *2 * [("a", NEW, "LM", (("x", 0.0), ("y", 0.0)))], *2 * [("a", NEW, None, null_new)],
        (None, NEW, "LM", (("x", 0.0), ("y", 0.0))), (None, NEW, None, (("y", 0.0),)),
        ("b", None, "LM", (("x", 0.0), ("y", 0.0))), ("b", None, None, (("y", 0.0),)),
    ]
    assert got == sorted(want, key=repr)
    listless = op.Sightings(found.rows, found.affected.limit(0))
    assert {(r.key, r.Method): r.m for r in op.fill_gaps_by_method(meta, "key", "method", "t", listless, "m").collect()} == {
        ("a", "LM"): {"x": -1.0}, ("a", None): {"z": None}, (None, None): None, ("b", None): None,
    }


def test_rows_of_a_key_with_two_times(spark):
    meta, found = _case(spark)
    one = op.Sightings(found.rows.filter("method = 'LM'").drop("method"), found.affected.filter("method = 'LM'").drop("method"))
    got = {(r.key, r.taxon): r.value for r in op.filled_rows(meta, "key", "t", one).collect()}
    assert got == {("a", "x"): 0.0, ("a", "y"): 0.0, (None, "x"): 0.0, (None, "y"): 0.0, ("b", "x"): 0.0, ("b", "y"): 0.0}
