"""Ingest with validation in one scan; many links in one shuffle."""

import re

from pelagia.operators import quality as Q
from pelagia.operators.ingest import FAULTS, ingest_all, ingest_checked
from pelagia.schemas import TABLES
from pelagia.sources.csv import header_of, scan_rows, scan_text
from pelagia.sources.snapshot import read_snapshot

SPEC = TABLES["bgc_stationinfo"].only("stationcode", "stationname", "longitude", "stationstartdate")
LANDED = """STATIONCODE,STATIONNAME,LONGITUDE,STATIONSTARTDATE,EXTRA
PHB,"Port, ""x""\nbreak",151.2,2009-01-01,
KAI,Kangaroo,abc,2009-11-16 00:00:00,
KAI,Again,200.5,2009-01-01,
,no code,1,2009-01-01,
ROT,short
YON,more,1,2009-01-01,,cells
"""


def faults(df):
    return sorted(((r["table"], r["rule"], r["column"], r["key"], r["value"], r["n"]) for r in df.collect()), key=repr)


def test_ingest_finds_what_separate_scans_find(spark, tmp_path):
    path = str(tmp_path / "s.csv")
    (tmp_path / "s.csv").write_text(LANDED)
    got = ingest_checked(spark, path, str(tmp_path / "out"), SPEC)
    names = header_of(spark, path)
    rows = scan_rows(spark, path, SPEC)
    plain = Q.table_faults(scan_text(spark, path, SPEC), SPEC).unionByName(Q.row_faults(rows, SPEC, len(names))).unionByName(Q.header_faults(spark, names, SPEC))
    assert faults(got.faults) == faults(plain) != []
    assert {f[1] for f in faults(plain)} >= {"required", "type-error", "range-warning", "primary-key", "extra-cell", "missing-cell", "extra-field"}
    assert got.table.columns == SPEC.columns and got.table.count() == 6
    told = [f for f in faults(plain) if f[1] not in ("primary-key", "extra-field", "missing-field")]
    assert got.counted["rows"] == 6
    assert {r: n for r, n in got.counted.items() if n and r != "rows"} == {r: sum(f[5] for f in told if f[1] == r) for r in {f[1] for f in told}}


def test_the_landing_is_scanned_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "s.csv").write_text(LANDED)
    got = ingest_checked(spark, str(tmp_path / "in" / "s.csv"), str(tmp_path / "out"), SPEC)
    (tmp_path / "in" / "s.csv").write_text("gone")  # nothing reads it again
    assert all("/out/" in f for f in got.faults.inputFiles())
    plan = got.faults._jdf.queryExecution().executedPlan().toString()
    assert "FileScan csv" not in plan and faults(got.faults)
    # Readers of the table do not read the faults.
    assert FAULTS not in re.search(r"ReadSchema: \S+", got.table._jdf.queryExecution().executedPlan().toString())[0]
    assert FAULTS in read_snapshot(spark, str(tmp_path / "out")).columns


def test_tables_and_links_together(spark, tmp_path):
    trip = TABLES["bgc_trip"].only("projectname", "trip_code", "stationcode")
    tss = TABLES["bgc_tss"].only("trip_code", "tss_mgl")
    (tmp_path / "bgc_trip.csv").write_text("PROJECTNAME,TRIP_CODE,STATIONCODE\nNRS,A,X\nNRS,B,X\n")
    (tmp_path / "bgc_tss.csv").write_text("TRIP_CODE,TSS_MGL\nA,1\nC,2\nC,3\n,4\n")
    found, told = ingest_all(spark, str(tmp_path), str(tmp_path / "out"), {"bgc_trip": trip, "bgc_tss": tss})
    assert [f for f in faults(told) if f[1] == "foreign-key"] == [("bgc_tss", "foreign-key", "trip_code", "C", "bgc_trip", 2)]
    assert found["bgc_tss"].table.count() == 4


def test_many_links_take_one_shuffle(spark):
    key = lambda name, *v: spark.createDataFrame([(x,) for x in v], f"{name} string")
    trips, samples = key("trip_code", "a", "b", "b"), key("sample", "s")
    tables = {"bgc_trip": trips, "cpr_samp": samples}
    tables |= {n: key("trip_code", "a", "x", "x", None) for n in ("bgc_tss", "bgc_pigments", "bgc_chemistry", "bgc_phyto_raw")}
    tables |= {n: key("sample", "s", "t") for n in ("cpr_phyto_raw", "cpr_zoop_raw")}
    out = Q.all_link_faults(tables)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan
    one_by_one = [
        Q.link_faults(tables[c], tables[p], c, k, pk, p)
        for c, k, p, pk in __import__("pelagia.schemas", fromlist=["LINKS"]).LINKS if c in tables and p in tables
    ]
    want = sorted((f for df in one_by_one for f in faults(df)), key=repr)
    assert faults(out) == want and len(want) == 6
    assert Q.all_link_faults({"bgc_trip": trips}) is None
