import datetime as dt

import pytest
from pyspark.sql import functions as F

from pelagia.functions import measures as M
from pelagia.functions import text as X
from pelagia.functions.parse import parse, readable
from pelagia.functions.times import is_multipoint, point_wkt


def one(spark, column, **values):
    names = list(values)
    kinds = {str: "string", float: "double", int: "bigint"}
    schema = ", ".join(f"{n} {kinds.get(type(v), 'string')}" for n, v in values.items())
    return spark.createDataFrame([tuple(values[n] for n in names)], schema).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    "text, word",
    [("acuta (small)", "acuta"), ("(small)", None), ("", None), (None, None), ("åcuta b", "åcuta"), ("a/b", "a")],
)
def test_first_word(spark, text, word):
    assert one(spark, X.first_word("t"), t=text) == word


def test_concatenation_of_null(spark):
    assert one(spark, X.sample_id("a", F.col("b")), a="T1", b=None) == "T1_"
    assert one(spark, X.binomial("a", "b"), a="Acartia", b=None) is None
    assert one(spark, X.binomial("a", "b", whole=True), a="Acartia", b="danae (x)") == "Acartia danae (x)"


@pytest.mark.parametrize(
    "number, text",
    [(10.0, "10"), (10.5, "10.5"), (0.0, "0"), (-0.25, "-0.25"), (100.0, "100"), (1e8, "100000000"), (1e-5, "0.00001"), (151.2064, "151.2064")],
)
def test_number_text(spark, number, text):
    assert one(spark, X.number_text("n"), n=number) == text


def test_species_rules_differ(spark):
    texts = [None, "spp.", "cf. acuta", "a/b", "x grp", "x complex", "x type", "x group", "x cyst", "acuta (small)"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    kept = {
        marks: {r.s for r in df.filter(X.identified_species("s", marks)).collect()}
        for marks in (X.ZOOP_MARKS, X.PHYTO_ABUNDANCE_MARKS, X.PHYTO_BIOVOLUME_MARKS)
    }
    assert kept[X.ZOOP_MARKS] == {"x type", "x group", "x cyst", "acuta (small)"}
    assert kept[X.PHYTO_ABUNDANCE_MARKS] == {"x grp", "acuta (small)"}
    assert kept[X.PHYTO_BIOVOLUME_MARKS] == {"x grp", "x group", "acuta (small)"}


@pytest.mark.parametrize(
    "kind, text, value",
    [
        ("double", "1.5", 1.5), ("double", "5d", None), ("double", "null", None), ("double", " 2e3 ", 2000.0), ("double", "NaN", None),
        ("bigint", "7", 7), ("bigint", "7.0", None), ("boolean", "true", True), ("boolean", "0", False), ("boolean", "yes", None),
        ("date", "1944-10-01", dt.date(1944, 10, 1)), ("date", "1944-10-01 00:00:00", None), ("date", "2020-02-30", None),
        ("datetime", "2010-01-02 03:04:05", dt.datetime(2010, 1, 2, 3, 4, 5)), ("datetime", "2010-01-02", None),
        ("datetime_t", "2010-01-02T03:04:05", dt.datetime(2010, 1, 2, 3, 4, 5)), ("datetime_t", "2010-01-02 03:04:05", None),
        ("datetime_z", "2010-01-02 03:04:05Z", dt.datetime(2010, 1, 2, 3, 4, 5)), ("datetime_z", "2010-01-02 03:04:05", None),
        ("date_any", "2010-01-02T03:04:05Z", dt.date(2010, 1, 2)), ("date_any", "3/4/2010", dt.date(2010, 3, 4)),
        ("date_any", "20100304", dt.date(2010, 3, 4)), ("date_any", "4 Mar 2010", dt.date(2010, 3, 4)), ("date_any", "soon", None),
    ],
)
def test_parse(spark, kind, text, value):
    assert one(spark, parse(F.col("t"), kind), t=text) == value


def test_not_a_number_is_readable_but_null(spark):
    assert one(spark, readable(F.col("t"), "double"), t="NaN") is True
    assert one(spark, readable(F.col("t"), "double"), t="null") is False


def test_guards(spark):
    assert one(spark, M.ratio(F.col("a"), F.col("b")), a=1.0, b=0.0) is None
    assert one(spark, M.ln_pos(F.col("a")), a=0.0) is None
    assert one(spark, M.evenness(F.col("h"), F.col("s")), h=0.0, s=1) is None
    assert one(spark, M.share_of_two(F.col("a"), F.col("b")), a=3.0, b=None) is None
    assert one(spark, M.diet_class(F.col("d")), d="Detritivore") is None


def test_carbon(spark):
    def carbon(n, b, g):
        return one(spark, M.carbon_biomass(F.col("n"), F.col("b"), F.col("g")), n=n, b=b, g=g)

    assert carbon(0.0, 5.0, "Ciliate") == 0
    assert carbon(2.0, 20.0, "Dinoflagellate") == pytest.approx(2 * 0.76 * 10**0.819)
    assert carbon(2.0, 20.0, "Ciliate") == pytest.approx(2 * 0.22 * 10**0.939)
    assert carbon(2.0, 20.0, "Cyanobacteria") == pytest.approx(0.4)
    assert carbon(2.0, 20.0, "Centric diatom") == pytest.approx(2 * 0.288 * 10**0.811)


def test_places(spark):
    assert one(spark, point_wkt("x", "y"), x=151.0, y=-34.25) == "POINT(151 -34.25)"
    good = ["MULTIPOINT((1 2), (3.5 -4))", "multipoint (1 2, 3 4)", "MULTIPOINT EMPTY"]
    bad = ["POINT(1 2)", "MULTIPOINT(1)", "LINESTRING(1 2, 3 4)", ""]
    for text in good + bad:
        assert one(spark, is_multipoint("t"), t=text) is (text in good), text
