import datetime as dt

from pelagia.operators import quality as Q
from pelagia.schemas import LINKS, PRODUCT_GROUPS, TABLES
from pelagia.sources.csv import check_header, header_of, read_table, scan_text
from pelagia.sources.export import long_rows, map_keys, widen, with_json, write_wide_csv
from pelagia.sources.groups import ingest_group, tables_of

STATIONS = '''FID,PROJECTNAME,stationcode,STATIONNAME,NODE,STATECODE,LONGITUDE,LATITUDE,STATIONSTARTDATE,STATIONDEPTH_M,SAMPLINGEFFORT,IMCRA,IMCRA_PB,MANAGEMENTREGION
s.1,NRS,PHB,"Port, Hacking ""PH""",N,NSW,151.2,-34.1,1944-10-01 00:00:00,100,m,,,
s.2,NRS,KAI,Kangaroo Island,N,SA,136.4,-35.8,2009-11-16 00:00:00,112,m,,,
s.3,NRS,MAI,Maria Island,N,TAS,148.2,-42.6,2009-05-12 00:00:00,90,m,,,
s.4,NRS,ROT,Rottnest,N,WA,115.4,-32.0,2009-01-01,null,m,,,
s.5,NRS,YON,Yongala,N,QLD,147.6,-19.3,2009-01-01,28,m,,,
s.6,NRS,DAR,Darwin,N,NT,130.8,-12.4,2009-01-01,22,m,,,
s.7,NRS,YON,Yongala again,N,QLD,200.5,-19.3,2009-01-01,28,m,,,
'''


def station_file(tmp_path):
    path = tmp_path / "bgc_stationinfo.csv"
    path.write_text(STATIONS)
    return str(path)


def test_every_declared_table_is_well_formed():
    assert len(TABLES) == 28
    for t in TABLES.values():
        assert len(set(t.columns)) == len(t.columns)
        assert set(t.key) <= set(t.columns)
    assert len(LINKS) == 11
    for child, column, parent, key in LINKS:
        assert column in TABLES[child].columns and key in TABLES[parent].columns
    assert [len(v) for v in PRODUCT_GROUPS.values()] == [5, 6, 2, 2, 5]


def test_typed_scan(spark, tmp_path):
    df = read_table(spark, station_file(tmp_path), TABLES["bgc_stationinfo"])
    assert df.columns == TABLES["bgc_stationinfo"].columns
    first, *_ = df.filter("stationcode = 'PHB'").collect()
    assert first.stationname == 'Port, Hacking "PH"'
    assert (first.longitude, first.stationstartdate, first.imcra) == (151.2, None, None)
    assert df.filter("stationcode = 'ROT'").first().stationstartdate == dt.date(2009, 1, 1)


def test_worked_report(spark, tmp_path):
    """Four type errors and one repeated key, as in the published example."""
    spec = TABLES["bgc_stationinfo"]
    text = scan_text(spark, station_file(tmp_path), spec)
    faults = Q.table_faults(text, spec).cache()
    found = sorted((r["rule"], r["column"], r["key"], r["value"]) for r in faults.collect())
    assert found == [
        ("primary-key", "stationcode", "YON", "2"),
        ("range-warning", "longitude", "YON", "200.5"),
        ("type-error", "stationdepth_m", "ROT", "null"),
        ("type-error", "stationstartdate", "KAI", "2009-11-16 00:00:00"),
        ("type-error", "stationstartdate", "MAI", "2009-05-12 00:00:00"),
        ("type-error", "stationstartdate", "PHB", "1944-10-01 00:00:00"),
    ]
    tables = spark.createDataFrame([("bgc_stationinfo",), ("bgc_trip",)], "table string")
    report = Q.report(faults, tables, shown=2)
    got = {r["table"]: (r.valid, r.errors, r.warnings, len(r.messages)) for r in report.collect()}
    assert got == {"bgc_stationinfo": (False, 5, 1, 2), "bgc_trip": (True, 0, 0, 0)}
    assert Q.invalid_tables(report) == 1


def test_header_rules(spark, tmp_path):
    spec = TABLES["bgc_stationinfo"]
    names = header_of(spark, station_file(tmp_path))
    assert check_header(names, spec).ok
    report = check_header([*[n for n in names if n != "NODE"], "Extra"], spec)
    assert (report.missing, report.extra) == (("node",), ("extra",))


def test_missing_tokens_and_patterns(spark, tmp_path):
    spec = TABLES["acoustic_summary_qc"].only("animal_id", "date_utc", "nb_detections", "animal_sex", "receiver_recovery_datetime_utc")
    path = tmp_path / "a.csv"
    path.write_text(
        "animal_ID,date_UTC,nb_detections,animal_sex,receiver_recovery_datetime_UTC\n"
        "A69-1303-123_45_6,2010-01-01,3,NA,2010-01-01\n"
        "A69-1303-123_45_6 x,2010-01-01, ,F,2010-01-01 10:00:00\n"
        "A180-1303-12345_A69-1303-9_45_6,2010-1-1,3,,2010-01-01 10:00\n"
    )
    text = scan_text(spark, str(path), spec)
    assert [r.animal_sex for r in text.collect()] == [None, "F", None]
    found = sorted((r["rule"], r["column"], r["value"]) for r in Q.cell_faults(text, spec).collect())
    assert found == [
        ("pattern", "animal_id", "A69-1303-123_45_6 x"),
        ("pattern", "receiver_recovery_datetime_utc", "2010-01-01 10:00"),
        ("required", "nb_detections", None),
    ]


def test_links_and_keys(spark):
    parent = spark.createDataFrame([("a",), ("b",)], "trip_code string")
    child = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "trip_code string")
    faults = Q.all_link_faults({"bgc_trip": parent, "bgc_tss": child, "bgc_pigments": parent})
    assert [(r["table"], r["key"], r.n) for r in faults.collect()] == [("bgc_tss", "x", 2)]
    pairs = spark.createDataFrame([("a", 1), ("a", 1), ("a", 1), ("a", 2), ("b", None), ("b", None)], "k string, i bigint")
    assert [(r["key"], r.n) for r in Q.unique_faults(pairs, "t", ("k", "i")).collect()] == [("a|1", 2)]


def test_groups(spark, tmp_path):
    assert tables_of("bgc_lfish") == ["bgc_lfish_countraw", "bgc_lfish_samples"]
    assert len(tables_of("bgc", substring=True)) == 13
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "phytoinfo.csv").write_text("FID,SPCODE,TAXON_NAME\nf.1,3,Alpha\n")
    (tmp_path / "in" / "zoopinfo.csv").write_text("FID,TAXON_NAME,LENGTH_MM\nf.1,Beta,2.5\n")
    got = ingest_group(spark, "derived_indices", str(tmp_path / "in"), str(tmp_path / "out"))
    assert got["phytoinfo"].select("spcode", "taxon_name").collect() == [(3, "Alpha")]
    assert got["zoopinfo"].select("taxon_name", "length_mm", "diet").collect() == [("Beta", 2.5, None)]


def test_wide_export(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", {"z": 1.0, "m": None}), ("b", None), ("c", {"k": 2.0})], "id string, taxa map<string,double>"
    )
    assert map_keys(df, "taxa") == ["k", "m", "z"]
    assert {r.id: r.taxa for r in with_json(df, "taxa").collect()}["c"] == '{"k":2.0}'
    assert '"m":null' in with_json(df, "taxa").filter("id = 'a'").first().taxa
    wide = widen(df, "taxa")
    assert wide.columns == ["id", "k", "m", "z"]
    assert sorted(map(tuple, wide.collect())) == [("a", None, None, 1.0), ("b", None, None, None), ("c", 2.0, None, None)]
    assert write_wide_csv(df, "taxa", str(tmp_path / "w")) == ["id", "k", "m", "z"]
    back = spark.read.option("header", True).csv(str(tmp_path / "w"))
    assert sorted(map(tuple, back.collect()))[2] == ("c", "2.0", None, None)
    assert sorted(map(tuple, long_rows(df, "taxa").collect()), key=repr) == [
        ("a", "m", None), ("a", "z", 1.0), ("b", None, None), ("c", "k", 2.0)
    ]


def test_landed_files_are_packed_and_read_whole(spark, tmp_path):
    from pelagia.schemas import TABLES
    from pelagia.sources.csv import scan_text
    from workload.operators import _land_csv

    rows = spark.createDataFrame([(f"S{i}", f'C"{i}"', f"Region\n{i % 3}, x") for i in range(200)], "sample string, trip_code string, region string").repartition(3)
    _land_csv(rows, str(tmp_path / "t.csv"))
    parts = [p for p in (tmp_path / "t.csv").iterdir() if p.name.startswith("part-")]
    assert parts and all(p.name.endswith(".csv.gz") for p in parts)
    want = sorted(map(tuple, rows.collect()))
    for in_splits in (False, True):
        got = scan_text(spark, str(tmp_path / "t.csv"), TABLES["cpr_samp"], in_splits).select("sample", "trip_code", "region")
        assert sorted(map(tuple, got.collect())) == want
