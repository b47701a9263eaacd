import math
import random

import pytest
from pyspark.sql import functions as F

from pelagia.operators.diversity import (
    phytoplankton_indices,
    shares_of_total,
    zooplankton_indices,
)

ZOOP = "k string, taxon_name string, copepod string, genus string, species string, zoop_abundance_m3 double, taxon_count double"
PHYTO = "k string, taxon_group string, genus string, species string, n double, b double"


def zoop(spark, rows, info=()):
    table = spark.createDataFrame(list(info), "taxon_name string, length_mm double, diet string")
    return {r.k: r for r in zooplankton_indices(spark.createDataFrame(rows, ZOOP), table, "k").collect()}


def phyto(spark, rows):
    df = spark.createDataFrame(rows, PHYTO)
    return {r.k: r for r in phytoplankton_indices(df, "k", "n", "b", "carbon", "cells").collect()}


def test_copepods(spark):
    rows = [
        ("one", "A a", "COPEPOD", "A", "a", 4.0, 2.0),
        ("zero", "A a", "COPEPOD", "A", "a", 0.0, 0.0), ("zero", "B b", "COPEPOD", "B", "b", 0.0, 0.0),
        ("mix", "A a", "COPEPOD", "A", "a (x)", 1.0, 1.0), ("mix", "A a f", "COPEPOD", "A", "a", 2.0, 3.0),
        ("mix", "B b", "COPEPOD", "B", "b", 3.0, 4.0), ("mix", "C s", "COPEPOD", "C", "spp.", 5.0, 9.0),
        ("mix", "D d", "NON-COPEPOD", "D", "d", 7.0, 9.0), ("mix", "E n", "COPEPOD", None, "e", 1.0, 8.0),
        ("other", "D d", "NON-COPEPOD", "D", "d", 7.0, 9.0),
    ]
    info = [("A a", 2.0, "Carnivore"), ("A a f", 3.0, "Omnivore"), ("B b", None, "Herbivore"), ("D d", 9.0, "Carnivore")]
    got = zoop(spark, rows, info)
    assert (got["one"].NoCopepodSpecies_Sample, got["one"].ShannonCopepodDiversity, got["one"].CopepodEvenness) == (1, 0.0, None)
    assert (got["zero"].NoCopepodSpecies_Sample, got["zero"].ShannonCopepodDiversity, got["zero"].AvgTotalLengthCopepod_mm) == (2, None, None)
    mix = got["mix"]
    # A nameless but identified species is a group of its own.
    assert mix.NoCopepodSpecies_Sample == 3
    counts = [4.0, 4.0, 8.0]
    h = -sum(c / 16 * math.log(c / 16) for c in counts)
    assert mix.ShannonCopepodDiversity == pytest.approx(h)
    assert mix.CopepodEvenness == pytest.approx(h / math.log(3))
    assert (mix.ZoopAbundance_m3, mix.CopeAbundance_m3) == (19.0, 12.0)
    assert mix.AvgTotalLengthCopepod_mm == pytest.approx((2 + 6) / 12)
    assert mix.OmnivoreCarnivoreCopepodRatio == pytest.approx(5 / 6)
    assert got["other"].CopeAbundance_m3 is None and got["other"].NoCopepodSpecies_Sample is None


def test_absent_class_gives_null(spark):
    got = phyto(spark, [("d", "Centric diatom", "A", "a", 5.0, 10.0), ("d", "Other", "X", "x", 99.0, 1.0), ("u", "Ciliate", "A", "spp.", 2.0, None)])
    assert got["d"].cells == 5.0
    assert got["d"].DiatomDinoflagellateRatio is None
    assert (got["d"].NoDiatomSpecies_Sample, got["d"].ShannonDiatomDiversity, got["d"].DiatomEvenness) == (1, 0.0, None)
    assert (got["d"].NoDinoSpecies_Sample, got["d"].ShannonDinoDiversity) == (0, None)
    assert (got["u"].NoPhytoSpecies_Sample, got["u"].ShannonPhytoDiversity, got["u"].carbon) == (0, None, None)


def test_diversity_without_shares_equals_shares(spark):
    rng = random.Random(9)
    groups = ["Centric diatom", "Pennate diatom", "Dinoflagellate", "Ciliate"]
    rows = [
        (f"k{rng.randrange(6)}", rng.choice(groups), f"G{rng.randrange(4)}", rng.choice(["a", "b", "b x", "cf. c", None]), float(rng.choice([0, 0, 1, 5, 30])), 3.0)
        for _ in range(400)
    ]
    got = phyto(spark, rows)
    for key in got:
        for name, keep in (("Phyto", lambda g: True), ("Diatom", lambda g: g.endswith("diatom")), ("Dino", lambda g: g == "Dinoflagellate")):
            sums = {}
            for k, g, genus, s, n, _b in rows:
                if k == key and keep(g) and s is not None and "cf." not in s:
                    sums[genus, s.split()[0]] = sums.get((genus, s.split()[0]), 0) + n
            total = sum(sums.values())
            h = -sum(v / total * math.log(v / total) for v in sums.values() if v) if total else None
            value = got[key][f"Shannon{name}Diversity"]
            assert value == pytest.approx(h, abs=1e-12), (key, name)
            even = got[key][{"Phyto": "PhytoEvenness", "Diatom": "DiatomEvenness", "Dino": "DinoflagellateEvenness"}[name]]
            assert even is None or -1e-12 <= even <= 1 + 1e-12


def test_shares_sum_to_one(spark):
    rows = [(k, i % 7, float(i)) for i, k in enumerate("aabbbccccc" * 3)]
    out = shares_of_total(spark.createDataFrame(rows, "k string, i bigint, v double"), "k", "i", "v")
    for r in out.groupBy("k").agg(F.sum("share").alias("s")).collect():
        assert r.s == pytest.approx(1)


def test_distinct_counts_merge_exactly(spark):
    from pelagia.operators.distinct import dense_codes, distinct_counts, merged, value_bitmaps

    rows = spark.range(40_000).select((F.col("id") % 37).alias("a"), (F.col("id") % 5).alias("b"), F.when(F.col("id") % 11 > 0, F.concat(F.lit("v"), (F.col("id") * 7919) % 36_000)).alias("v"))
    codes = dense_codes(rows, "v", parts=16)
    got = codes.agg(F.count("*"), F.min("code"), F.max("code"), F.count_distinct("code"), F.count_distinct("v")).first()
    assert got[0] == got[3] == got[4] == got[2] + 1 and got[1] == 0
    bits = value_bitmaps(rows, ["a", "b"], "v", codes)
    assert bits.select("bucket").distinct().count() > 1  # values of several bitmaps
    for keys in (["a", "b"], ["a"], ["b"]):
        want = rows.groupBy(*keys).agg(F.count_distinct("v").alias("n"))
        assert sorted(map(tuple, distinct_counts(bits, keys).collect())) == sorted(map(tuple, want.collect()))
        assert sorted(map(tuple, distinct_counts(merged(bits, keys), keys).collect())) == sorted(map(tuple, want.collect()))
    nothing = rows.limit(0)
    assert distinct_counts(value_bitmaps(nothing, ["a"], "v", dense_codes(nothing, "v")), ["a"]).count() == 0
