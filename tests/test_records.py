"""Quoted CSV from any split: equal to a read of the whole file, by many tasks, without Python."""

import csv
import io
import random
import re

import pytest

from pelagia.schemas import TABLES
from pelagia.sources.csv import ODD_ROW, read_table, scan_rows
from pelagia.sources.records import records

SPEC = TABLES["bgc_stationinfo"].only("stationcode", "stationname", "statecode")


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def written(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows([["STATIONCODE", "STATIONNAME", "STATECODE"], *rows])
    return out.getvalue()


def sample(seed, n=120):
    rng = random.Random(seed)
    bits = ["a", "b,c", '"', '""', "\n", "\r\n", "\n\n", "x y", ",", '"\n"', "é"]
    return [[f"k{k}", "t" + "".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) + "t", rng.choice(["NSW", "SA"])] for k in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_splits_give_the_rows_of_a_whole_read(spark, tmp_path, small_splits, end):
    for k in range(2):
        (tmp_path / f"{k}.csv").write_bytes(("" if k else "\n\n").encode() + written(sample(k), end).encode() + b"\n\n")
    (tmp_path / "none.csv").write_bytes(written([], end).encode())
    path = str(tmp_path)
    frame = read_table(spark, path, SPEC, in_splits=True)
    want = sorted((r[0], r[1], r[2]) for k in range(2) for r in sample(k))
    assert sorted((r.stationcode, r.stationname, r.statecode) for r in frame.select("stationcode", "stationname", "statecode").collect()) == want
    if end == "\n":
        plain = read_table(spark, path, SPEC, in_splits=False)
        assert sorted(map(repr, plain.collect())) == sorted(map(repr, frame.collect()))
    assert len(spark.read.text(str(tmp_path / "0.csv")).selectExpr("spark_partition_id() AS p").distinct().collect()) > 20
    assert not re.search("Python|Pandas|Arrow|CartesianProduct", frame._jdf.queryExecution().executedPlan().toString())


def test_a_record_longer_than_several_splits(spark, tmp_path, small_splits):
    rows = [["a", "one", "X"], ["b", "line\n" * 200 + "end", "Y"], ["c", '"\n' * 150, "Z"], ["d", "last", "X"]]
    (tmp_path / "s.csv").write_text(written(rows))
    got = {r.stationcode: r.stationname for r in read_table(spark, str(tmp_path / "s.csv"), SPEC, in_splits=True).collect()}
    assert got == {r[0]: r[1] for r in rows}


def test_odd_rows_keep_their_text(spark, tmp_path, small_splits):
    (tmp_path / "s.csv").write_text('STATIONCODE,STATIONNAME,STATECODE\na,"two\nlines",N\nb,short\nc,"x\ny",N,more\n')
    wide = scan_rows(spark, str(tmp_path / "s.csv"), SPEC, in_splits=True)
    plain = scan_rows(spark, str(tmp_path / "s.csv"), SPEC, in_splits=False)
    assert sorted(map(repr, wide.collect())) == sorted(map(repr, plain.collect()))
    assert {r.stationcode for r in wide.filter(f"{ODD_ROW} IS NOT NULL").collect()} == {"b", "c"}


def test_a_quote_that_is_never_closed_is_refused(spark, tmp_path, small_splits):
    path = str(tmp_path / "s.csv")
    (tmp_path / "s.csv").write_text('A,B\n1,"open\n' + "x,y\n" * 400)
    with pytest.raises(Exception, match="not closed"):
        records(spark, path, longest=1000).collect()
    assert records(spark, path, longest=10_000).count() == 2


def test_files_with_another_header_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("STATIONCODE,STATIONNAME\na,b\n")
    (tmp_path / "b.csv").write_text("STATIONNAME,STATIONCODE\na,b\n")
    with pytest.raises(Exception, match="header"):
        read_table(spark, str(tmp_path), SPEC, in_splits=True).collect()


def test_large_files_are_read_in_splits(spark, tmp_path, small_splits):
    (tmp_path / "s.csv").write_text(written(sample(5)))
    assert "Window" in read_table(spark, str(tmp_path / "s.csv"), SPEC)._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128MB")
    assert "Window" not in read_table(spark, str(tmp_path / "s.csv"), SPEC)._jdf.queryExecution().executedPlan().toString()
