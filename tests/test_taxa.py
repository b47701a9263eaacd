import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pelagia.operators import taxa as op
from pelagia.plans import taxa as plans

OLD, MID, NEW = (dt.datetime(y, 6, 1) for y in (2005, 2010, 2015))
START = dt.date(2010, 1, 1)


def meta(spark, rows):
    return spark.createDataFrame(rows, "key string, t timestamp_ntz")


def changelog(spark, rows):
    return spark.createDataFrame(rows, "taxon_name string, startdate date, parent_name string")


RAW = "key string, taxon_name string, genus string, species string, v double"


def genus_maps(spark, m, raw, log, **options):
    found = op.sightings_with_changelog(raw, log, ["key"], F.col("genus"), "v", "genus", **options)
    return {r.key: r.m for r in op.fill_gaps(m, "key", "t", found, "m").collect()}


def test_not_looked_for_and_not_found(spark):
    m = meta(spark, [("old", OLD), ("new", NEW), ("seen", OLD), ("empty", NEW)])
    raw = spark.createDataFrame(
        [("old", "B b", "B", "b", 1.0), ("new", "B b", "B", "b", 2.0), ("seen", "A a", "A", "a", 3.0), ("off", "A a", "A", "a", 9.0)], RAW
    )
    log = changelog(spark, [("A a", START, "Old a"), ("B b", START, "B old"), ("C c", START, "Old c")])
    # B keeps its genus, so it is not affected; C was never seen; 'off' is not in the metadata.
    assert genus_maps(spark, m, raw, log) == {
        "old": {"A": None, "B": 1.0}, "new": {"A": 0.0, "B": 2.0}, "seen": {"A": 3.0}, "empty": {"A": 0.0},
    }


def test_parent_unknown_or_no_changelog(spark):
    m = meta(spark, [("k", NEW), ("none", NEW)])
    raw = spark.createDataFrame([("k", "A a", "A", "a", 1.0)], RAW)
    assert genus_maps(spark, m, raw, changelog(spark, [("A a", START, None)])) == {"k": {"A": 1.0}, "none": None}
    assert genus_maps(spark, m, raw, changelog(spark, [])) == {"k": {"A": 1.0}, "none": None}


def test_largest_part_not_total(spark):
    m = meta(spark, [("k", NEW)])
    raw = spark.createDataFrame([("k", "A a", "A", "a", 5.0), ("k", "A b", "A", "b", 7.0), ("k", "A c", "A", "c", 1.0)], RAW)
    log = changelog(spark, [("A a", START, "Old a")])
    assert genus_maps(spark, m, raw, log) == {"k": {"A": 8.0}}
    assert genus_maps(spark, m, raw, log, combine="sum") == {"k": {"A": 13.0}}


def test_earliest_start_counts(spark):
    m = meta(spark, [("k", MID), ("seen", NEW)])
    raw = spark.createDataFrame([("seen", "A a", "A", "a", 1.0), ("seen", "A b", "A", "b", 1.0)], RAW)
    log = changelog(spark, [("A a", dt.date(2014, 1, 1), "O a"), ("A b", dt.date(2009, 1, 1), "O b")])
    assert genus_maps(spark, m, raw, log)["k"] == {"A": 0.0}


def test_default_hides_an_unmeasured_value(spark):
    m = meta(spark, [("k", NEW), ("o", OLD)])
    raw = spark.createDataFrame([("k", "A a", "A", "a", None), ("o", "A a", "A", "a", None)], RAW)
    log = changelog(spark, [("A a", START, "O a")])
    assert genus_maps(spark, m, raw, log) == {"k": {"A": 0.0}, "o": {"A": None}}


def method_rows(spark, raw, log, m, **options):
    found = op.sightings_with_changelog(raw, log, ["key", "methods"], F.col("genus"), "v", "genus")
    out = op.fill_gaps_by_method(m, "key", "methods", "t", found, "m", **options)
    return {(r.key, r.Method): r.m for r in out.collect()}


def test_methods(spark):
    schema = "key string, methods string, taxon_name string, genus string, v double"
    raw = spark.createDataFrame(
        [("both", "LM", "A a", "A", 1.0), ("both", "SEM", "B b", "B", 2.0), ("lm", "LM", "B b", "B", 3.0), ("null", None, "B b", "B", 4.0)], schema
    )
    m = meta(spark, [("both", NEW), ("lm", NEW), ("null", NEW), ("none", OLD)])
    log = changelog(spark, [("A a", START, "O a")])
    # The default reaches every key for the affected method, also where it was not used.
    assert method_rows(spark, raw, log, m) == {
        ("both", "LM"): {"A": 1.0}, ("both", "SEM"): {"B": 2.0}, ("lm", "LM"): {"A": 0.0, "B": 3.0},
        ("null", None): {"B": 4.0}, ("null", "LM"): {"A": 0.0}, ("none", "LM"): {"A": None},
    }
    # Observed methods only: unused methods and the NULL method go, the key stays.
    assert method_rows(spark, raw, log, m, observed_only=True) == {
        ("both", "LM"): {"A": 1.0}, ("both", "SEM"): {"B": 2.0}, ("lm", "LM"): {"A": 0.0, "B": 3.0},
        ("null", None): None, ("none", None): None,
    }


def test_null_taxon_raises(spark):
    raw = spark.createDataFrame([("k", None, 1.0)], "key string, taxon string, v double")
    with pytest.raises(Exception, match="(?i)null"):
        op.to_maps(raw, ["key"], "taxon", "v", "m").collect()


def test_repeated_key_in_raw_map(spark):
    raw = spark.createDataFrame([("k", "A", 1.0), ("k", "A", 3.0), ("k", "B", None)], "key string, taxon string, v double")
    assert op.to_maps(raw, ["key"], "taxon", "v", "m").first().m == {"A": 3.0, "B": None}


def test_rows_equal_maps_and_brute_force(spark):
    rng = random.Random(3)
    times = {f"k{i}": dt.datetime(2004 + rng.randrange(12), 1 + rng.randrange(12), 3) for i in range(40)}
    names = {f"G{i} s{j}": (f"G{i}", f"s{j}") for i in range(6) for j in range(4)}
    log = {n: (dt.date(2004 + rng.randrange(12), 1, 1), rng.choice([None, "Old x", f"{names[n][0]} y"])) for n in rng.sample(sorted(names), 12)}
    raw = [(rng.choice([*times, "hot"]) if rng.random() < 0.6 else "k0", n, *names[n], float(rng.randrange(9))) for n in rng.choices(sorted(names), k=600)]
    m = meta(spark, list(times.items()))
    found = op.sightings_with_changelog(
        spark.createDataFrame(raw, RAW), changelog(spark, [(n, d, p) for n, (d, p) in log.items()]), ["key"], F.col("genus"), "v", "genus"
    )
    got = {(r.key, r.taxon): r.value for r in op.filled_rows(m, "key", "t", found, slices=4).collect()}
    maps = {r.key: r.m for r in op.fill_gaps(m, "key", "t", found, "m").collect()}

    moved = {n: log[n][0] for n in log if log[n][1] and log[n][1].split()[0] != n.split()[0]}
    parts = {}
    for k, n, g, _s, v in raw:
        flag = None if n not in log or log[n][1] is None else log[n][1].split()[0] != g
        parts.setdefault((k, g), {}).setdefault((log[n][0] if n in log else None, flag), []).append(v)
    want = {kg: max(sum(v) for v in p.values()) for kg, p in parts.items() if kg[0] in times}
    seen = {n for _k, n, *_ in raw}
    for k, t in times.items():
        for n, start in moved.items():
            if n in seen:
                kg = (k, n.split()[0])
                default = 0.0 if t >= dt.datetime.combine(start, dt.time()) else None
                known = [x for x in (want.get(kg), default) if x is not None]
                want[kg] = max(known) if known else None
    assert got == want
    assert {(k, g): v for k, mm in maps.items() for g, v in (mm or {}).items()} == want


def test_built_in_group_lists():
    assert plans.BGC_ZOOP_GROUPS.groups[0] == "Ciliophora" and plans.CPR_ZOOP_GROUPS.groups[0] == "Ciliate"
    assert set(plans.BGC_PHYTO_GROUPS.methods) == {"LM", "SEM"}


def test_affected_taxa_are_read_off_distinct_names(spark):
    raw = spark.createDataFrame(
        [("k1", "A a", "A", "a", 1.0), ("k2", "A a", "A", "a", 2.0), ("k2", "B b", "B", "b", 3.0), ("k3", None, None, "c", 4.0), (None, "D d", "D", "d", 5.0)], RAW
    )
    log = changelog(spark, [("A a", START, "Old a"), ("A a", dt.date(2009, 1, 1), "Older a"), ("B b", START, "B old"), ("D d", None, "Old d")])
    level = op.Level(F.col("genus"), F.col("genus").isNotNull(), F.col("taxon_name"), "genus")
    found = op.sightings_of_level(raw.groupBy("key", "taxon_name", "genus").agg(F.sum("v").alias("v")), log, ["key"], level, "v")
    cells = op.sightings_of(op.level_cells(raw, log, ["key"], {"genus": level}, ["v"]), ["key"], "v")
    assert sorted(map(str, found.affected.collect())) == sorted(map(str, cells.affected.collect()))
    assert sorted(map(str, found.rows.collect())) == sorted(map(str, cells.rows.collect()))
    # Nothing is placed by its key to find them.
    assert "hashpartitioning(key" not in found.affected._jdf.queryExecution().executedPlan().toString()
