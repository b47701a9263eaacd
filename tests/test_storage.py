"""Whole CSV rows, stored versions, builds by dependency, and what no longer has a bound."""

import re

import pytest
from pelagia.operators import quality as Q
from pelagia.operators import taxa as op
from pelagia.operators.upsert import INDEX, INDEX_KEY, create_index, store_index, upsert_index
from pelagia.plans import Catalog, build
from pelagia.plans.pipeline import build_order
from pelagia.plans.taxa import all_cells, raw_readers
from pelagia.schemas import TABLES
from pelagia.sources.buckets import bucket_of, current, read_buckets
from pelagia.sources.csv import header_of, read_table, scan_rows
from pelagia.sources.export import map_keys, write_wide_csv
from pelagia.sources.snapshot import exists, read_snapshot, write_snapshot
from pyspark.sql import functions as F
from workload.frames import catalog, derived


def test_csv_rows_stay_whole_and_odd_ones_are_faults(spark, tmp_path):
    spec = TABLES["bgc_stationinfo"].only("stationcode", "stationdepth_m", "stationname")
    path = str(tmp_path / "s.csv")
    (tmp_path / "s.csv").write_text('STATIONCODE,STATIONDEPTH_M,STATIONNAME\na,1.0,one\nb,1.5,"two\nlines, ""quoted"""\nc,2.5\nd,3,x,extra\n\ne,4,"x,y"\n')
    got = {r.stationcode: (r.stationdepth_m, r.stationname) for r in read_table(spark, path, spec).collect()}
    assert got["b"] == (1.5, 'two\nlines, "quoted"') and got["c"] == (2.5, None) and set(got) == set("abcde")
    faults = Q.row_faults(scan_rows(spark, path, spec), spec, len(header_of(spark, path))).collect()
    assert sorted((r["rule"], r["key"], r["value"]) for r in faults) == [("extra-cell", "d", "4"), ("missing-cell", "c", "2")]
    assert scan_rows(spark, path, spec).filter("stationcode = 'b'").count() == 1


def test_a_snapshot_may_be_written_from_itself_and_survives_a_failed_write(spark, tmp_path):
    path = str(tmp_path / "s")
    assert not exists(spark, path)
    with pytest.raises(FileNotFoundError):
        read_snapshot(spark, path)
    write_snapshot(spark.range(5), path)
    for _ in range(3):
        write_snapshot(read_snapshot(spark, path).withColumn("id", F.col("id") + 1), path)
    assert sorted(r.id for r in read_snapshot(spark, path).collect()) == [3, 4, 5, 6, 7]
    bad = read_snapshot(spark, path).withColumn("id", F.when(F.col("id") > 6, F.raise_error(F.lit("no")).cast("bigint")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="no"):
        write_snapshot(bad, path)
    assert read_snapshot(spark, path).count() == 5
    assert len(list((tmp_path / "s" / "pointer").iterdir())) == 2


def test_a_stored_index_takes_batches_and_keeps_its_state_on_a_bad_one(spark, sf_dir, tmp_path):
    path, batch = str(tmp_path / "index"), derived(spark, sf_dir, "detection_index_batch")
    now = F.lit("2020-06-01 00:00:00").cast("timestamp_ntz")
    first = store_index(spark, path, batch, now).collect()
    again = store_index(spark, path, batch, now).collect()
    assert len(first) == batch.count() and sorted(map(repr, first)) == sorted(map(repr, again))
    with pytest.raises(Exception, match="MULTIPOINT"):
        store_index(spark, path, batch.withColumn("geom_df", F.lit("POINT(1 2)")), now)
    assert read_buckets(spark, path, INDEX.struct).count() == len(first)


def files_by_bucket(state, path):
    return {b: sorted(str(f) for f in (path / "data" / v / f"bucket={b}").glob("*.parquet")) for b, v in state.versions.items()}


def test_a_small_batch_leaves_the_other_buckets_in_place(spark, sf_dir, tmp_path):
    path, now = tmp_path / "index", F.lit("2020-06-01 00:00:00").cast("timestamp_ntz")
    rows = derived(spark, sf_dir, "detection_file_index")
    create_index(rows, str(path), buckets=32)
    before = current(spark, str(path))
    old = files_by_bucket(before, path)
    few = sorted(r[0] for r in rows.select(bucket_of(INDEX_KEY, 32)).distinct().collect())[:3]
    renamed = {"geom": "geom_df"}
    batch = rows.filter(bucket_of(INDEX_KEY, 32).isin(few)).drop("first_indexed", "last_indexed").withColumnsRenamed(renamed)
    batch = batch.withColumn("size", F.lit(7).cast("bigint"))
    plain = upsert_index(rows, batch, now)
    got = store_index(spark, str(path), batch, now)
    assert sorted(map(repr, got.collect())) == sorted(map(repr, plain.select(*got.columns).collect()))
    after = files_by_bucket(current(spark, str(path)), path)
    assert {b for b in old if old[b] != after[b]} == set(few) and len(old) > 10
    assert all(old[b] == after[b] for b in old if b not in few)
    read = [f for df in (got,) for f in df.inputFiles()]
    assert len(read) == sum(map(len, after.values()))


def test_buckets_can_be_changed_and_old_files_go(spark, sf_dir, tmp_path):
    path, now = tmp_path / "index", F.lit("2020-06-01 00:00:00").cast("timestamp_ntz")
    batch = derived(spark, sf_dir, "detection_index_batch")
    first = sorted(map(repr, store_index(spark, str(path), batch, now, buckets=4).collect()))
    for _ in range(3):
        store_index(spark, str(path), batch, now)
    assert len(list((path / "manifest").iterdir())) == 2
    assert len(list(path.glob("data/*/bucket=*"))) <= 8
    stored = read_buckets(spark, str(path), INDEX.struct)
    create_index(stored, str(path), buckets=9)
    assert current(spark, str(path)).buckets == 9
    assert sorted(map(repr, read_buckets(spark, str(path), INDEX.struct).collect())) == first
    empty = store_index(spark, str(path), batch.limit(0), now)
    assert empty.count() == len(first)
    with pytest.raises(FileNotFoundError):
        read_buckets(spark, str(tmp_path / "none"), INDEX.struct)


def test_one_product_builds_from_its_own_tables(spark, sf_dir, tmp_path):
    raw = {n: derived(spark, sf_dir, n) for n in ("cpr_samp", "cpr_phyto_raw")}
    built = build(Catalog(spark, raw), str(tmp_path), ["cpr_phytoplankton_map"])
    assert list(built) == ["cpr_phytoplankton_map"] and built["cpr_phytoplankton_map"].count() > 0
    order = build_order(catalog(spark, sf_dir))
    assert len(order) == 45 and order.index("bgc_trip_metadata") < order.index("nrs_depth_binned_ctd_map") < order.index("nrs_depth_binned_ctd_data")


def test_put_drops_what_was_planned_over_the_old_frame(spark, sf_dir, tmp_path):
    c = catalog(spark, sf_dir)
    before = c["bgc_zooplankton_map"]
    build(c, str(tmp_path), ["nrs_ctd_surface_values"])
    after = c["bgc_zooplankton_map"]
    assert after is not before and any("nrs_ctd_surface_values" in f for f in after.inputFiles())


def test_the_eight_products_of_a_raw_table_read_it_once(spark, sf_dir, tmp_path):
    c, plain = catalog(spark, sf_dir), catalog(spark, sf_dir)
    plain["bgc_phyto_raw"].write.parquet(str(tmp_path / "bgc_phyto_raw"))
    c.put("bgc_phyto_raw", spark.read.parquet(str(tmp_path / "bgc_phyto_raw")))
    eight = sorted(raw_readers()["bgc_phyto_raw"])
    assert len(eight) == 8
    plan = all_cells(c, "bgc_phyto_raw")._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet \[[^\]]*cell_l", plan)) == 1
    built = build(c, str(tmp_path / "out"), eight)
    for name in eight:
        c.forget(name)
        read = {f.split("/version/")[0].rsplit("/", 1)[-1] for f in c[name].inputFiles() if "bgc_phyto_raw" in f}
        assert read == {"bgc_phyto_raw_cells"}  # planned over the stored cells
        assert sorted(map(repr, built[name].collect())) == sorted(map(repr, plain[name].select(*built[name].columns).collect()))
    made = (tmp_path / "out" / "bgc_phyto_raw_cells" / "version").glob("*/level=*")
    assert len({p.name for p in made}) == 5


def test_defaults_are_made_for_observed_methods_only(spark):
    meta = spark.createDataFrame([(k, "2013-01-01") for k in range(30)], "key long, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    affected = spark.createDataFrame([(t, m) for t in "abc" for m in ("LM", "SEM")], "taxon string, method string").withColumn("start", F.lit("2012-01-01").cast("date"))
    rows = spark.createDataFrame([(k, "LM" if k % 2 else "SEM", "z", 1.0) for k in range(20)] + [(3, None, "z", 1.0)], "key long, method string, taxon string, value double")
    out = op.fill_gaps_by_method(meta, "key", "method", "t", op.Sightings(rows, affected), "m", observed_only=True)
    assert "Expand" not in (plan := out._jdf.queryExecution().executedPlan().toString()) and "explode" not in plan
    got = {(r.key, r.Method): r.m for r in out.collect()}
    assert len(got) == 30 and got[3, "LM"] == {"a": 0.0, "b": 0.0, "c": 0.0, "z": 1.0} and got[25, None] is None


def test_a_wide_file_has_no_column_limit(spark, tmp_path):
    df = spark.range(1).select(F.lit("a").alias("id"), F.map_from_entries(F.transform(F.sequence(F.lit(1), F.lit(12_000)), lambda i: F.struct(F.concat(F.lit("k"), i.cast("string")).alias("k"), i.cast("double").alias("v")))).alias("m"))
    keys = map_keys(df, "m")
    assert len(keys) == 12_000 and keys == sorted(keys)
    assert len(write_wide_csv(df, "m", str(tmp_path / "w"), keys)) == 12_001


def one_task_exchanges(df):
    return re.findall(r"Exchange SinglePartition.*", df._jdf.queryExecution().executedPlan().toString())


def test_gap_filling_gathers_no_list_in_one_task(spark):
    meta = spark.createDataFrame([(k, f"2012-01-{1 + k % 28:02d}") for k in range(40)], "key long, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    affected = spark.range(5000).select(F.concat(F.lit("t"), "id").alias("taxon"), F.lit("2012-01-15").cast("date").alias("start"))
    rows = spark.createDataFrame([(k, "t7", 2.0) for k in range(0, 40, 2)], "key long, taxon string, value double")
    out = op.fill_gaps(meta, "key", "t", op.Sightings(rows, affected), "m")
    assert not one_task_exchanges(out)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Subquery" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    got = {r.key: r.m for r in out.collect()}
    assert all(len(m) == 5000 for m in got.values()) and got[2]["t7"] == 2.0 and got[1]["t7"] is None and got[21]["t7"] == 0.0


def test_a_pivot_sums_raw_rows_before_they_move(spark):
    """A key with very many raw rows must not be one task's before they are one row per taxon, so
    the first exchange goes by (key, taxon), behind a partial aggregate; only the second by key."""
    raw = spark.range(1000).select((F.col("id") % 10).alias("key"), (F.col("id") % 50).cast("string").alias("taxon"), F.col("id").cast("double").alias("v"))
    plan = op.to_maps(raw, ["key"], "taxon", "v", "m")._jdf.queryExecution().executedPlan().toString()
    first, second = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)[::-1]
    assert "taxon" in first and "taxon" not in second
    assert re.search(r"partial_max\(v", plan.split("Exchange hashpartitioning")[-1])
