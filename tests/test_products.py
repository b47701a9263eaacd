"""Products against their SQL, plan shape, and the stored pipeline."""

import datetime as dt
import os
import re

import pytest

import __spark_entry__ as entry
from pelagia.plans import PRODUCTS, Catalog, build
from pelagia.sources.snapshot import exists, read_snapshot
from workload.check import compare, connect
from workload.frames import catalog
from workload.queries import QUERIES, SQL

# A cross-section runs by default; PELAGIA_FULL=1 runs every registered query.
CHOSEN = (
    "nrs_derived_indices_data", "cpr_derived_indices_data", "combined_bgc_data", "bgc_larval_fish_count_raw_data",
    "bgc_phytoplankton_abundance_htg_data", "bgc_phytoplankton_biovolume_genus_data", "bgc_zooplankton_abundance_copepods_data",
    "cpr_phytoplankton_abundance_species_data", "gap_fill_rows", "nearest_match", "index_upsert", "dq_report", "typed_csv_scan",
)


def names():
    return list(QUERIES) if os.environ.get("PELAGIA_FULL") else list(CHOSEN)


@pytest.mark.parametrize("name", names())
def test_query_matches_sql(spark, sf_dir, name):
    sql = entry.oracle_sql()[name]
    assert compare(spark, connect(sf_dir), sf_dir, entry.queries()[name], sql).startswith("ok")


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL) and set(QUERIES) <= set(entry.queries())
    assert len(PRODUCTS) == 45


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["nrs_derived_indices_data", "bgc_phytoplankton_abundance_genus_data", "combined_bgc_data", "cpr_zooplankton_abundance_htg_data"])
def test_plan_has_no_cross_join_and_no_python(spark, sf_dir, name):
    plan = plan_of(catalog(spark, sf_dir)[name])
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|Python|Pandas", plan)


def test_first_row_is_chosen_before_the_shuffle(spark, sf_dir):
    assert "WindowGroupLimit" in plan_of(entry.queries()["first_per_group"](spark, sf_dir))


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    plan = plan_of(entry.queries()["semi_any_of"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThan(l_quantity,48.0)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def lab_catalog(spark):
    t = dt.datetime(2012, 1, 1, 10)
    pig = [c for c in __import__("pelagia.plans.water", fromlist=["PIGMENTS"]).PIGMENTS if c != "pigments_flag"]
    chem = "salinity silicate nitrate phosphate ammonium nitrite oxygen".split()

    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    trips = frame(
        [("NRS", "T1", t), ("NRS", "T2", t), ("SOTS", "T3", t)],
        "projectname string, trip_code string, sampledateutc timestamp_ntz",
    ).selectExpr(
        "*", "'n' stationname", "'c' stationcode", "1D latitude", "2D longitude", "sampledateutc sampledatelocal", "1D phytosampledepth_m",
        "1D zoopsampledepth_m", "1D biomass_mgm3", "1D ashfreebiomass_mgm3", "1D secchi_m", "'P' sampletype",
    )
    chemistry = frame([("T1", 10.0, t), ("T1", 10.5, t), ("T3", 1.0, t)], "trip_code string, sampledepth_m double, sampledatelocal timestamp_ntz").selectExpr(
        "*", *[f"35D {c}_{'psu' if c == 'salinity' else 'umoll'}" for c in chem], *[f"1L {c}_flag" for c in chem],
        "1D dic_umolkg", "1L carbon_flag", "1D talkalinity_umolkg", "1L alkalinity_flag", "'m' microbiomesample_id",
    )
    text = "trip_code string, sampledepth_m string, sampledatelocal timestamp_ntz"
    pigments = frame([("T1", "10", t), ("T1", "WC", None), ("T9", "1", t)], text).selectExpr("*", *[f"2D {c}" for c in pig], "1L pigments_flag")
    tss = frame([("T1", "WC", t)], text).selectExpr("*", "1D tss_mgl", "2D inorganicfraction_mgl", "3D organicfraction_mgl", "1L tss_flag")
    pico = frame([("T1", "10", t), ("T2", "5", t)], text).selectExpr(
        "*", *[f"1D {c}_cellsml" for c in ("prochlorococcus", "synecochoccus", "picoeukaryotes")],
        *[f"1L {c}_flag" for c in ("prochlorococcus", "synecochoccus", "picoeukaryotes")],
    )
    return Catalog(spark, {"bgc_trip": trips, "bgc_chemistry": chemistry, "bgc_pigments": pigments, "bgc_tss": tss, "bgc_picoplankton": pico})


def test_combined_depths_meet_across_number_and_text(spark):
    got = {
        r.SampleID: (r.Salinity, r.CphlA_mgm3, r.TSS_mgL, r.Prochlorococcus_cellsmL, r.SampleTime_Local)
        for r in lab_catalog(spark)["combined_bgc_data"].collect()
    }
    t = "2012-01-01 10:00:00"
    assert got == {
        "T1_10": (35.0, 2.0, None, 1.0, t), "T1_10.5": (35.0, None, None, None, t),
        "T1_WC": (None, 2.0, 1.0, None, t), "T2_5": (None, None, None, 1.0, t),
    }


def test_sample_with_two_volumes_repeats(spark):
    t = dt.datetime(2012, 1, 1, 10)
    samp = spark.createDataFrame([("s1", t), ("s2", t)], "sample string, sampledateutc timestamp_ntz").selectExpr(
        "*", "'c' trip_code", "'r' region", "1D latitude", "2D longitude", "sampledateutc sampledatelocal", "1D pci", "1D biomass_mgm3",
        "'PZ' sampletype", "1D ghrsst_6d_degc", "1D chloc3_mgm3",
    )
    raw = spark.createDataFrame(
        [("s1", "A", 1.0, 2.5), ("s1", "B", 2.0, 5.0), ("s1", "C", 3.0, 5.0), ("s2", "A", 4.0, 5.0)],
        "sample string, taxon_name string, phyto_abundance_m3 double, sampvol_m3 double",
    )
    c = Catalog(spark, {"cpr_samp": samp, "cpr_phyto_raw": raw})
    got = sorted((r.Sample_ID, r.SampleVolume_m3, len(r.abundances)) for r in c["cpr_phytoplankton_abundance_raw_data"].collect())
    assert got == [("s1", 2.5, 3), ("s1", 5.0, 3), ("s2", 5.0, 1)]


def test_pipeline_stores_products(spark, sf_dir, tmp_path):
    wanted = ["bgc_zooplankton_abundance_raw_data", "nrs_derived_indices_data", "cpr_phytoplankton_abundance_htg_data"]
    built = build(catalog(spark, sf_dir), str(tmp_path), wanted)
    for name in wanted:
        assert exists(spark, str(tmp_path / name))
        assert sorted(map(repr, read_snapshot(spark, str(tmp_path / name)).collect())) == sorted(map(repr, built[name].collect()))
        assert "FileScan parquet" in plan_of(built[name])
    direct = catalog(spark, sf_dir)["nrs_derived_indices_data"]
    assert sorted(map(repr, built["nrs_derived_indices_data"].collect())) == sorted(map(repr, direct.collect()))
    assert not exists(spark, str(tmp_path / "nrs_depth_binned_ctd_map"))


def zoop_catalog(spark, tmp_path):
    t, old = dt.datetime(2014, 1, 1, 10), dt.datetime(2012, 1, 1, 10)
    trips = spark.createDataFrame(
        [("T1", t, "Z"), ("T1", t, "PZ"), ("T2", old, "Z"), ("T3", t, "Z"), ("T4", t, "Z"), ("T5", t, "P"), (None, t, "Z")],
        "trip_code string, sampledateutc timestamp_ntz, sampletype string",
    ).selectExpr(
        "*", "'NRS' projectname", "'n' stationname", "'c' stationcode", "1D latitude", "2D longitude", "sampledateutc sampledatelocal",
        "1D phytosampledepth_m", "1D zoopsampledepth_m", "1D biomass_mgm3", "1D ashfreebiomass_mgm3", "1D secchi_m",
    )
    # T2 has only rows that do not count, T3 none, T4 one without a group; keys repeat and may be NULL.
    rows = [("T1", "a", "Copepod", 1.0), ("T1", "a", "Copepod", 2.0), ("T1", "b", "Ciliophora", None), ("T1", "c", "Other", 9.0),
            ("T2", "c", "Other", 9.0), ("T4", "d", None, 4.0), ("T5", "a", "Copepod", 1.0), (None, "a", "Copepod", 1.0)]
    path = str(tmp_path / "raw")
    spark.createDataFrame(rows, "trip_code string, taxon_name string, taxon_group string, zoop_abundance_m3 double").write.parquet(path)
    measured = "psal temp dox2 cphl turb cndc dens".split()
    casts = spark.createDataFrame([("NRSc", 1, t)], "site_code string, file_id long, time_coverage_start timestamp_ntz")
    levels = spark.createDataFrame([(1, 10.0)], "file_id long, depth double").selectExpr("*", *[x for m in measured for x in (f"3D {m}", f"'1' {m}_quality_control")])
    return Catalog(spark, {"bgc_trip": trips, "bgc_zoop_raw": spark.read.parquet(path), "deployments": casts, "measurements": levels})


def test_groups_read_raw_rows_once(spark, tmp_path):
    c = zoop_catalog(spark, tmp_path)
    out = c["bgc_zooplankton_abundance_htg_data"]
    none, null = {"Ciliophora": 0.0, "Foraminifera": 0.0}, {"Ciliophora": None, "Foraminifera": None}
    got = sorted(((r.TripCode, r.CTDSST_degC, r.abundances) for r in out.collect()), key=repr)
    assert got == sorted([*2 * [("T1", 3.0, {**none, "Copepod": 3.0})], ("T2", None, null), ("T4", 3.0, none)], key=repr)
    # The raw rows were read for the counts, and again for the trips that are shown.
    assert out._jdf.queryExecution().optimizedPlan().toString().count(" parquet") == 1
    assert "bgc_zooplankton_map" in c.reads("bgc_zooplankton_abundance_htg_data")


def test_groups_read_a_stored_map(spark, tmp_path):
    c = zoop_catalog(spark, tmp_path)
    name, map_name = "bgc_zooplankton_abundance_htg_data", "bgc_zooplankton_map"
    direct = c[name]
    built = build(c, str(tmp_path / "out"), [name, map_name])
    assert c.stored(map_name) and direct.columns == built[name].columns
    assert sorted(map(repr, direct.collect())) == sorted(map(repr, built[name].collect()))
    c.forget(map_name)
    assert not c.stored(map_name)
