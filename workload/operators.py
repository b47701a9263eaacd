"""Operators on their own, each with the SQL that states its result."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pelagia.functions import measures as M
from pelagia.functions import text as X
from pelagia.functions.parse import parse
from pelagia.functions.times import point_wkt
from pelagia.operators import quality as Q
from pelagia.operators import rows as R
from pelagia.operators import taxa, upsert
from pelagia.operators.diversity import (
    phytoplankton_indices,
    shares_of_total,
    zooplankton_indices,
)
from pelagia.operators.distinct import dense_codes, distinct_counts, value_bitmaps
from pelagia.operators.ingest import ingest_all
from pelagia.operators.nearest import band_join, nearest_in_time
from pelagia.operators.profile import below_reference, reference_level
from pelagia.plans import taxa as taxon_plans
from pelagia.plans.indices import chemistry_means, pigment_means
from pelagia.schemas import TABLES
from pelagia.session import remove_dir, scratch_dir, tune
from pelagia.sources.csv import header_of, read_table, scan_rows
from pelagia.sources.export import long_rows, write_wide_csv
from pelagia.sources.groups import ingest_group, tables_of
from pelagia.sources.snapshot import write_snapshot

from .frames import base, catalog, comparable, derived
from .oracle import compose, even, ln, over, stamp
from .tables import TABLES as DERIVED

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Register a query under its function name together with its SQL."""

    def keep(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        QUERIES[fn.__name__] = run
        SQL[fn.__name__] = compose(sql)
        return fn

    return keep


# ---- aggregates ------------------------------------------------------------------------


@query("SELECT l_partkey, sum(l_quantity) AS total FROM {lineitem} GROUP BY l_partkey")
def group_sum(spark, sf):
    return base(spark, sf, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("total"))


@query("""SELECT l_orderkey, sum(l_quantity) FILTER (l_returnflag = 'R') AS returned,
       sum(l_quantity) FILTER (l_returnflag = 'A') AS accepted FROM {lineitem} GROUP BY l_orderkey""")
def filtered_sum(spark, sf):
    flag, q = F.col("l_returnflag"), F.col("l_quantity")
    return base(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        M.sum_if(flag == "R", q).alias("returned"), M.sum_if(flag == "A", q).alias("accepted")
    )


@query("SELECT * FROM {chemistry_means}")
def filtered_avg_qc(spark, sf):
    return chemistry_means(derived(spark, sf, "bgc_chemistry"))


@query("SELECT * FROM {pigment_means}")
def shallow_mean_of_text_depth(spark, sf):
    return pigment_means(derived(spark, sf, "bgc_pigments"))


@query(f"SELECT l_suppkey, {over('sum(l_quantity * l_linenumber)', 'sum(l_quantity)')} AS mean FROM {{lineitem}} GROUP BY l_suppkey")
def weighted_mean(spark, sf):
    q = F.col("l_quantity")
    return base(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        M.ratio(F.sum(q * F.col("l_linenumber")), F.sum(q)).alias("mean")
    )


@query(f"""SELECT l_partkey, {over("sum(CASE l_linestatus WHEN 'F' THEN l_quantity ELSE 0 END)", "sum(CASE l_linestatus WHEN 'O' THEN l_quantity ELSE 0 END)")} AS f_per_o
FROM {{lineitem}} GROUP BY l_partkey""")
def ratio_of_sums(spark, sf):
    def part(status):
        return F.sum(F.when(F.col("l_linestatus") == status, F.col("l_quantity")).otherwise(0.0))

    return base(spark, sf, "lineitem").groupBy("l_partkey").agg(M.ratio(part("F"), part("O")).alias("f_per_o"))


@query("""SELECT l_suppkey, count(*) AS lines, count(DISTINCT l_partkey) AS parts,
       count(DISTINCT l_partkey) FILTER (l_returnflag = 'R') AS returned_parts,
       count(DISTINCT l_partkey) FILTER (l_linestatus = 'F') AS filled_parts FROM {lineitem} GROUP BY l_suppkey""")
def count_distinct_filtered(spark, sf):
    # FILTER on one distinct column keeps the expansion at one row per input row.
    return base(spark, sf, "lineitem").groupBy("l_suppkey").agg(
        F.count("*").alias("lines"),
        F.expr("count(DISTINCT l_partkey)").alias("parts"),
        F.expr("count(DISTINCT l_partkey) FILTER (WHERE l_returnflag = 'R')").alias("returned_parts"),
        F.expr("count(DISTINCT l_partkey) FILTER (WHERE l_linestatus = 'F')").alias("filled_parts"),
    )


@query("""SELECT l_orderkey, count(*) AS kinds, sum(n) AS total, max(n) AS largest
FROM (SELECT l_orderkey, l_partkey, nullif(sum(CASE WHEN l_suppkey % 5 = 0 THEN 0 ELSE l_quantity END), 0) AS n
      FROM {lineitem} GROUP BY ALL) x GROUP BY l_orderkey""")
def two_level_agg(spark, sf):
    amount = F.when(F.col("l_suppkey") % 5 == 0, 0.0).otherwise(F.col("l_quantity"))
    kinds = base(spark, sf, "lineitem").groupBy("l_orderkey", "l_partkey").agg(
        F.nullif(F.sum(amount), F.lit(0.0)).alias("n")
    )
    return kinds.groupBy("l_orderkey").agg(
        F.count("*").alias("kinds"), F.sum("n").alias("total"), F.max("n").alias("largest")
    )


@query(f"""SELECT trip_code, taxon_name, {over("sum(taxon_count)", "sum(sum(taxon_count)) OVER (PARTITION BY trip_code)")} AS share
FROM {{bgc_zoop_raw}} GROUP BY trip_code, taxon_name""")
def share_of_total(spark, sf):
    return shares_of_total(derived(spark, sf, "bgc_zoop_raw"), "trip_code", "taxon_name", "taxon_count")


@query("""SELECT trip_code, species AS kinds, round(h, 6) AS diversity, round(evenness, 6) AS evenness FROM {zoop_by_trip}""")
def shannon_counts(spark, sf):
    z = zooplankton_indices(derived(spark, sf, "bgc_zoop_raw"), derived(spark, sf, "zoopinfo"), "trip_code")
    return z.select(
        "trip_code",
        F.col("NoCopepodSpecies_Sample").alias("kinds"),
        F.round("ShannonCopepodDiversity", 6).alias("diversity"),
        F.round("CopepodEvenness", 6).alias("evenness"),
    )


@query("""SELECT sample, round(h, 6) AS h_all, round(h_diatom, 6) AS h_diatom, round(h_dino, 6) AS h_dino,
       round(e_all, 6) AS e_all, diatom_ratio FROM {phyto_by_sample}""")
def shannon_shares(spark, sf):
    p = phytoplankton_indices(derived(spark, sf, "cpr_phyto_raw"), "sample", "phyto_abundance_m3", "biovol_um3m3", "carbon", "cells")
    return p.select(
        "sample",
        F.round("ShannonPhytoDiversity", 6).alias("h_all"),
        F.round("ShannonDiatomDiversity", 6).alias("h_diatom"),
        F.round("ShannonDinoDiversity", 6).alias("h_dino"),
        F.round("PhytoEvenness", 6).alias("e_all"),
        F.col("DiatomDinoflagellateRatio").alias("diatom_ratio"),
    )


@query(f"""SELECT l_suppkey, round(h, 6) AS diversity, kinds, round({even("h", "kinds")}, 6) AS evenness FROM (
  SELECT l_suppkey, count(*) AS kinds, {ln("sum(n)")} - {over("sum(n * ln(n))", "sum(n)")} AS h
  FROM (SELECT l_suppkey, l_partkey, sum(l_quantity) AS n FROM {{lineitem}} GROUP BY ALL) x GROUP BY l_suppkey) y""")
def pielou_evenness(spark, sf):
    kinds = base(spark, sf, "lineitem").groupBy("l_suppkey", "l_partkey").agg(F.sum("l_quantity").alias("n"))
    n = F.col("n")
    sums = kinds.groupBy("l_suppkey").agg(
        F.count("*").alias("kinds"), F.sum(n).alias("total"), F.sum(M.n_log_n(n)).alias("nlogn")
    )
    h = M.shannon_counts(F.col("total"), F.col("nlogn"))
    return sums.select(
        "l_suppkey", F.round(h, 6).alias("diversity"), "kinds", F.round(M.evenness(h, F.col("kinds")), 6).alias("evenness")
    )


@query("""SELECT trip_code, taxon_name, methods, round(CASE WHEN cell_l = 0 THEN 0
       WHEN taxon_group = 'Dinoflagellate' THEN cell_l * 0.76 * pow(biovolume_um3l / cell_l, 0.819)
       WHEN taxon_group = 'Ciliate' THEN cell_l * 0.22 * pow(biovolume_um3l / cell_l, 0.939)
       WHEN taxon_group = 'Cyanobacteria' THEN cell_l * 0.2
       ELSE cell_l * 0.288 * pow(biovolume_um3l / cell_l, 0.811) END, 5) AS carbon FROM {bgc_phyto_raw}""")
def carbon_biomass(spark, sf):
    carbon = M.carbon_biomass(F.col("cell_l"), F.col("biovolume_um3l"), F.col("taxon_group"))
    return derived(spark, sf, "bgc_phyto_raw").select(
        "trip_code", "taxon_name", "methods", F.round(carbon, 5).alias("carbon")
    )


@query("""SELECT l_orderkey, a / nullif(a + n, 0) AS share FROM (
  SELECT l_orderkey, sum(l_quantity) FILTER (l_returnflag = 'A') AS a, sum(l_quantity) FILTER (l_returnflag = 'N') AS n
  FROM {lineitem} GROUP BY l_orderkey) x""")
def two_class_ratio(spark, sf):
    flag, q = F.col("l_returnflag"), F.col("l_quantity")
    return base(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        M.share_of_two(M.sum_if(flag == "A", q), M.sum_if(flag == "N", q)).alias("share")
    )


# ---- taxon maps ------------------------------------------------------------------------

_GENUS_ROWS = """SELECT r.sample, genus AS taxon, startdate AS start, zoop_abundance_m3 AS value,
    nullif(regexp_extract(r.taxon_name, '^\\w+'), '') <> nullif(regexp_extract(c.parent_name, '^\\w+'), '') AS moved
  FROM {cpr_zoop_raw} r LEFT JOIN {cpr_zoop_changelog} c ON c.taxon_name = r.taxon_name
  WHERE genus IS NOT NULL AND genus NOT LIKE '%cf.%'"""


@query(f"""SELECT * FROM (WITH observed AS (SELECT sample, taxon, max(v) AS v FROM (
    SELECT sample, taxon, sum(value) AS v FROM ({_GENUS_ROWS}) z GROUP BY sample, taxon, start, moved) y GROUP BY ALL),
  affected AS (SELECT taxon, min(start) AS start FROM ({_GENUS_ROWS}) z WHERE moved GROUP BY taxon),
  trips AS (SELECT DISTINCT sample, "SampleTime_UTC" AS t FROM {{cpr_zooplankton_map}}),
  defaults AS (SELECT sample, taxon, CASE WHEN t >= start THEN 0.0 END AS v FROM trips, affected)
SELECT coalesce(o.sample, d.sample) AS sample, coalesce(o.taxon, d.taxon) AS taxon, greatest(o.v, d.v) AS value
FROM (SELECT * FROM observed WHERE sample IN (SELECT sample FROM trips)) o
FULL JOIN defaults d ON d.sample = o.sample AND d.taxon = o.taxon) whole""")
def gap_fill_rows(spark, sf):
    """Gap filling as rows: no list of taxa is ever held whole."""
    c = catalog(spark, sf)
    family = next(f for f in taxon_plans.ZOOP if f.key == "sample")
    found = taxon_plans.genus_sightings(c, family)
    return taxa.filled_rows(c["cpr_zooplankton_map"], "sample", "SampleTime_UTC", found)


@query(f"""SELECT sample, taxon, sum(value) AS total, max(part) AS largest FROM (
  SELECT sample, taxon, value, sum(value) OVER (PARTITION BY sample, taxon, start, moved) AS part FROM ({_GENUS_ROWS}) z) y
GROUP BY sample, taxon""")
def largest_part_against_total(spark, sf):
    """The published 'largest part' rule beside the plain total."""
    c = catalog(spark, sf)
    family = next(f for f in taxon_plans.ZOOP if f.key == "sample")
    largest = taxon_plans.genus_sightings(c, family).rows.groupBy("sample", "taxon").agg(F.max("value").alias("largest"))
    total = taxon_plans.genus_sightings(c, family, combine="sum").rows.withColumnRenamed("value", "total")
    return total.join(largest, ["sample", "taxon"])


@query("""SELECT sample, string_agg(taxon_name || '=' || CAST(CAST(zoop_abundance_m3 AS DECIMAL(38, 6)) AS VARCHAR), ';' ORDER BY taxon_name) AS taxa
FROM {cpr_zoop_raw} GROUP BY sample""")
def object_pivot(spark, sf):
    return comparable(taxa.to_maps(derived(spark, sf, "cpr_zoop_raw"), ["sample"], "taxon_name", "zoop_abundance_m3", "taxa"))


_WIDE_GROUPS = ("Ciliate", "Copepod", "Foraminifera", "Jelly")


@query(
    "SELECT sample, "
    + ", ".join(f"sum(zoop_abundance_m3) FILTER (taxon_group = '{g}') AS \"{g}\"" for g in (*_WIDE_GROUPS, "Ciliophora", "Other"))
    + " FROM {cpr_zoop_raw} GROUP BY sample"
)
def wide_export(spark, sf):
    """Written as wide CSV and read back."""
    sums = derived(spark, sf, "cpr_zoop_raw").groupBy("sample", "taxon_group").agg(F.sum("zoop_abundance_m3").alias("v"))
    path = scratch_dir(spark, "wide")
    names = write_wide_csv(taxa.to_maps(sums, ["sample"], "taxon_group", "v", "m"), "m", path)
    schema = ", ".join(f"`{n}` {'string' if n == 'sample' else 'double'}" for n in names)
    return spark.read.schema(schema).option("header", True).csv(path)


@query("""SELECT sample, taxon_group AS taxon, sum(zoop_abundance_m3) AS value FROM {cpr_zoop_raw} GROUP BY ALL""")
def long_export(spark, sf):
    sums = derived(spark, sf, "cpr_zoop_raw").groupBy("sample", "taxon_group").agg(F.sum("zoop_abundance_m3").alias("v"))
    return long_rows(taxa.to_maps(sums, ["sample"], "taxon_group", "v", "m"), "m")


# ---- joins and picks -------------------------------------------------------------------

_PAIRS = """FROM {events} p JOIN {events} v ON v.user_id = p.user_id AND v.event_type = 'view'
  AND abs(epoch_us(p.ts) - epoch_us(v.ts)) <= 86400000000
WHERE p.event_type = 'purchase'"""


def _sides(spark, sf):
    events = base(spark, sf, "events")
    left = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = events.filter("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts"))
    return left, right


@query(f"SELECT p.event_id, v.event_id AS view_id {_PAIRS}")
def band_join_pairs(spark, sf):
    left, right = _sides(spark, sf)
    return band_join(left, right, "user_id", "ts", "view_ts").select("event_id", "view_id")


@query(f"""SELECT event_id, view_id, seconds FROM (
  SELECT p.event_id, v.event_id AS view_id, round(abs(epoch_us(p.ts) - epoch_us(v.ts)) / 1000000, 3) AS seconds,
         row_number() OVER (PARTITION BY p.event_id ORDER BY abs(epoch_us(p.ts) - epoch_us(v.ts)), v.event_id) AS place {_PAIRS}) x
WHERE place = 1""")
def nearest_match(spark, sf):
    left, right = _sides(spark, sf)
    gap = F.col("time_difference").cast("interval second").cast("decimal(18,6)").cast("double")
    return nearest_in_time(left, right, "user_id", "ts", "view_ts", "view_id").select(
        "event_id", "view_id", F.round(gap, 3).alias("seconds")
    )


@query("""SELECT user_id, event_type, event_id, value FROM {events}
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC NULLS FIRST, event_id) = 1""")
def first_per_group(spark, sf):
    events = base(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    return R.first_per_group(events, ["user_id", "event_type"], [F.desc_nulls_first("value"), F.asc("event_id")])


@query("SELECT * FROM {reference_level}")
def reference_level_query(spark, sf):
    rows = catalog(spark, sf)["nrs_depth_binned_ctd_data"]
    return reference_level(rows, "trip_code", "SampleDepth_m", "Temperature_degC", "Salinity_psu")


@query("""SELECT t.*, s."MLDsal_m", c."DCM_m" FROM {mld_temp} t JOIN {mld_sal} s ON s.trip_code = t.trip_code JOIN {dcm} c ON c.trip_code = t.trip_code""")
def mixed_layer_and_chlorophyll(spark, sf):
    rows = catalog(spark, sf)["nrs_depth_binned_ctd_data"]
    names = ("trip_code", "SampleDepth_m", "Temperature_degC", "Salinity_psu")
    return below_reference(rows, reference_level(rows, *names), *names, "Chla_mgm3")


@query("""SELECT o_orderkey, o_custkey FROM {orders} WHERE o_orderkey IN (
  SELECT l_orderkey FROM {lineitem} WHERE l_quantity > 48 UNION SELECT l_orderkey FROM {lineitem} WHERE l_discount > 0.09)""")
def semi_any_of(spark, sf):
    lines = base(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return R.in_any(
        base(spark, sf, "orders").select("o_orderkey", "o_custkey"),
        "o_orderkey",
        [lines.filter("l_quantity > 48"), lines.filter("l_discount > 0.09")],
    )


@query("""SELECT l_orderkey, l_linenumber FROM {lineitem} WHERE l_returnflag = 'A'
UNION SELECT l_orderkey, l_linenumber FROM {lineitem} WHERE l_returnflag = 'N'
UNION SELECT l_orderkey, l_linenumber FROM {lineitem} WHERE l_linestatus = 'F'""")
def union_keys(spark, sf):
    lines = base(spark, sf, "lineitem")
    pair = ("l_orderkey", "l_linenumber")
    return R.union_distinct(
        [lines.filter(f).select(*pair) for f in ("l_returnflag = 'A'", "l_returnflag = 'N'", "l_linestatus = 'F'")]
    )


@query("""SELECT c.trip_code, c.sampledepth_m, c.salinity_psu, t.tss_mgl FROM {bgc_chemistry} c
LEFT JOIN {bgc_tss} t ON t.trip_code = c.trip_code AND t.sampledepth_m = regexp_replace(CAST(c.sampledepth_m AS VARCHAR), '\\.0$', '')""")
def composite_join(spark, sf):
    """Numeric depth met with depth text in one plain notation."""
    chemistry = derived(spark, sf, "bgc_chemistry").select("trip_code", "sampledepth_m", "salinity_psu", X.number_text("sampledepth_m").alias("depth"))
    solids = derived(spark, sf, "bgc_tss").select("trip_code", F.col("sampledepth_m").alias("depth"), "tss_mgl")
    return chemistry.join(solids, ["trip_code", "depth"], "left").drop("depth")


@query("""SELECT o.o_orderkey, a.lines, b.shipped, c.returned FROM {orders} o
LEFT JOIN (SELECT l_orderkey, count(*) AS lines FROM {lineitem} GROUP BY ALL) a ON a.l_orderkey = o.o_orderkey
LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS shipped FROM {lineitem} WHERE l_linestatus = 'F' GROUP BY ALL) b ON b.l_orderkey = o.o_orderkey
LEFT JOIN (SELECT l_orderkey, sum(l_quantity) AS returned FROM {lineitem} WHERE l_returnflag = 'R' GROUP BY ALL) c ON c.l_orderkey = o.o_orderkey""")
def metadata_star(spark, sf):
    lines = base(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    q = F.sum("l_quantity")
    return R.star(
        base(spark, sf, "orders").select("o_orderkey"),
        "o_orderkey",
        [
            lines.groupBy("o_orderkey").agg(F.count("*").alias("lines")),
            lines.filter("l_linestatus = 'F'").groupBy("o_orderkey").agg(q.alias("shipped")),
            lines.filter("l_returnflag = 'R'").groupBy("o_orderkey").agg(q.alias("returned")),
        ],
    )


# ---- scalar rules ----------------------------------------------------------------------


def _like(marks: str) -> str:
    tests = " AND ".join(f"species NOT LIKE '%{m}%'" for m in marks.split())
    return f"coalesce(species IS NOT NULL AND species <> 'spp.' AND {tests}, false)"


@query(f"""SELECT p_partkey, {_like("cf. / grp complex")} AS zoop, {_like("cf. / complex type group cyst")} AS phyto,
       {_like("cf. / complex type cyst")} AS phyto_volume, coalesce(genus IS NOT NULL AND genus NOT LIKE '%cf.%', false) AS genus_ok
FROM {{taxon}}""")
def name_rules(spark, sf):
    def rule(marks):
        return F.coalesce(X.identified_species("species", marks), F.lit(False))

    return derived(spark, sf, "taxon").select(
        "p_partkey",
        rule(X.ZOOP_MARKS).alias("zoop"),
        rule(X.PHYTO_ABUNDANCE_MARKS).alias("phyto"),
        rule(X.PHYTO_BIOVOLUME_MARKS).alias("phyto_volume"),
        F.coalesce(X.identified_genus("genus"), F.lit(False)).alias("genus_ok"),
    )


@query("""SELECT p_partkey, nullif(regexp_extract(species, '^\\w+'), '') AS word,
       genus || ' ' || nullif(regexp_extract(species, '^\\w+'), '') AS short_name, genus || ' ' || species AS whole_name,
       suffix(species, 'cyst') AS is_cyst FROM {taxon}""")
def first_word(spark, sf):
    return derived(spark, sf, "taxon").select(
        "p_partkey",
        X.first_word("species").alias("word"),
        X.binomial("genus", "species").alias("short_name"),
        X.binomial("genus", "species", whole=True).alias("whole_name"),
        F.col("species").endswith("cyst").alias("is_cyst"),
    )


@query("""SELECT taxon_name, CASE diet WHEN 'Carnivore' THEN 'CC' WHEN 'Omnivore' THEN 'CO' WHEN 'Herbivore' THEN 'CO' END AS diet_class FROM {zoopinfo}""")
def diet_recode(spark, sf):
    return derived(spark, sf, "zoopinfo").select("taxon_name", M.diet_class(F.col("diet")).alias("diet_class"))


@query("""SELECT concat(trip_code, '_', regexp_replace(CAST(depth AS VARCHAR), '\\.0$', '')) AS sample_id, place FROM (
  SELECT trip_code, CASE WHEN secchi_m > 15 THEN NULL ELSE secchi_m END AS depth,
         'POINT(' || regexp_replace(CAST(longitude AS VARCHAR), '\\.0$', '') || ' ' || regexp_replace(CAST(latitude AS VARCHAR), '\\.0$', '') || ')' AS place
  FROM {bgc_trip}) x""")
def sample_ids_and_points(spark, sf):
    trips = derived(spark, sf, "bgc_trip").withColumn("depth", F.when(F.col("secchi_m") <= 15, F.col("secchi_m")))
    return trips.select(
        X.sample_id("trip_code", X.number_text("depth")).alias("sample_id"), point_wkt("longitude", "latitude").alias("place")
    )


@query("""SELECT file_id, depth, CASE WHEN temp_quality_control IN ('3', '4') THEN NULL ELSE temp END AS temp,
       CASE WHEN psal_quality_control IN ('3', '4') THEN NULL ELSE psal END AS psal FROM {measurements} WHERE abs(depth - 10) <= 5""")
def qc_mask_near_surface(spark, sf):
    rows = derived(spark, sf, "measurements").filter(F.abs(F.col("depth") - 10) <= 5)
    return rows.select(
        "file_id", "depth", *[M.qc_masked(F.col(m), F.col(f"{m}_quality_control")).alias(m) for m in ("temp", "psal")]
    )


# ---- sources, sinks, state -------------------------------------------------------------


def _land_csv(df: DataFrame, path: str) -> None:
    """Write a frame the way files arrive: upper-case header, a leading row id, and packed by gzip."""
    text = comparable(df)
    named = text.select(F.monotonically_increasing_id().alias("FID"), *[F.col(c).alias(c.upper()) for c in text.columns])
    named.write.option("header", True).option("escape", '"').option("compression", "gzip").csv(path)


@query(f"SELECT * REPLACE ({stamp('sampledateutc')} AS sampledateutc, {stamp('sampledatelocal')} AS sampledatelocal) FROM {{cpr_samp}}")
def typed_csv_scan(spark, sf):
    path = scratch_dir(spark, "csv")
    _land_csv(derived(spark, sf, "cpr_samp"), path)
    return comparable(read_table(spark, path, TABLES["cpr_samp"]))


_GROUP = "bgc_plankton"


def _content(table: str, columns: list[str]) -> str:
    """Rows of one table as text, in DuckDB: column=value in column order."""
    typed = TABLES[table]
    parts = []
    for c in sorted(columns):
        kind = typed[c].kind
        text = stamp(c) if kind.startswith("datetime") else f"CAST(CAST({c} AS DECIMAL(38, 6)) AS VARCHAR)" if kind == "double" else f"CAST({c} AS VARCHAR)"
        parts.append(f"'{c}=' || coalesce({text}, '-')")
    return f"""SELECT '{table}' AS "table", {" || ' ' || ".join(parts)} AS content FROM {{{table}}}"""


def _content_of(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    def text(c: str):
        kind = TABLES[table][c].kind
        value = F.date_format(c, "yyyy-MM-dd HH:mm:ss") if kind.startswith("datetime") else F.col(c).cast("decimal(38,6)").cast("string") if kind == "double" else F.col(c).cast("string")
        return F.concat(F.lit(f"{c}="), F.coalesce(value, F.lit("-")))

    return df.select(F.lit(table).alias("table"), F.concat_ws(" ", *[text(c) for c in sorted(columns)]).alias("content"))


# The columns that the derived tables fill; all others are NULL after ingest.
_FILLED = {t: [c for c in TABLES[t].columns if re.search(rf"\b{c}\b", DERIVED[t])] for t in tables_of(_GROUP)}


@query(" UNION ALL ".join(_content(t, c) for t, c in _FILLED.items()))
def group_ingest(spark, sf):
    """All five tables of a group landed as CSV, ingested, and read from storage, row by row."""
    landing, out = scratch_dir(spark, "landing"), scratch_dir(spark, "ingested")
    seen: dict = {}
    for t in _FILLED:
        _land_csv(derived(spark, sf, t, seen), f"{landing}/{t}.csv")
    tables = ingest_group(spark, _GROUP, landing, out)
    remove_dir(spark, landing)
    return reduce(DataFrame.unionByName, [_content_of(tables[t], t, c) for t, c in _FILLED.items()])


@query(f"""SELECT * REPLACE ({stamp('"CastTimeUTC"')} AS "CastTimeUTC", {stamp('"SampleTime_UTC"')} AS "SampleTime_UTC")
FROM {{nrs_depth_binned_ctd_map}}""")
def snapshot_round_trip(spark, sf):
    """A product stored twice under one path, the second time from its own stored rows."""
    path = scratch_dir(spark, "snapshot")
    stored = write_snapshot(catalog(spark, sf)["nrs_depth_binned_ctd_map"], path)
    return comparable(write_snapshot(stored, path))


# The last digit of a sample decides how its landed line is written.
_SAMP_KEYS = ("sample", "trip_code", "region")


def _land_lines(df: DataFrame, path: str, of_file: int = 50_000) -> None:
    """CSV lines as they come from elsewhere: line breaks in quotes, cells too many or too few."""
    files = 1 + df.count() // of_file
    digit = F.substring("sample", -1, 1)
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    region = F.when(digit == "5", F.concat(F.col("region"), F.lit(", first\nsecond line"))).otherwise(F.col("region"))
    cells = F.concat_ws(",", quoted(F.col("sample")), quoted(F.col("trip_code")), quoted(region))
    line = F.when(digit == "3", F.concat(cells, F.lit(",stray"))).when(digit == "7", F.concat_ws(",", quoted(F.col("sample")), quoted(F.col("trip_code")))).otherwise(cells)
    rows = df.select(F.pmod(F.crc32("sample"), F.lit(files)).cast("int").alias("file"), F.lit(1).alias("place"), line.alias("value"))
    heads = df.sparkSession.range(files).select(F.col("id").cast("int").alias("file"), F.lit(0).alias("place"), F.lit(",".join(_SAMP_KEYS).upper()).alias("value"))
    heads.unionByName(rows).repartitionById(files, "file").sortWithinPartitions("file", "place").select("value").write.text(path)


@query("""SELECT 'cpr_samp' AS "table", CASE sample[-1] WHEN '3' THEN 'extra-cell' ELSE 'missing-cell' END AS rule, CAST(NULL AS VARCHAR) AS "column",
  sample AS key, CASE sample[-1] WHEN '3' THEN '4' ELSE '2' END AS value, CAST(1 AS BIGINT) AS n
FROM {cpr_samp} WHERE sample[-1] IN ('3', '7')
UNION ALL SELECT 'cpr_samp', 'missing-field', c, NULL, c, 1 FROM (SELECT unnest(['latitude', 'longitude', 'sampledateutc', 'sampledatelocal', 'pci', 'biomass_mgm3', 'sampletype', 'ghrsst_6d_degc', 'chloc3_mgm3']) AS c)""")
def dq_rows(spark, sf):
    """Faults of a landed table's rows and of its header."""
    path = scratch_dir(spark, "rows")
    _land_lines(derived(spark, sf, "cpr_samp"), path)
    names, spec = header_of(spark, path), TABLES["cpr_samp"]
    faults = Q.row_faults(scan_rows(spark, path, spec), spec, len(names))
    return faults.unionByName(Q.header_faults(spark, names, spec))


@query("""SELECT sample, trip_code, CASE sample[-1] WHEN '5' THEN region || ', first' || chr(10) || 'second line' WHEN '7' THEN NULL ELSE region END AS region FROM {cpr_samp}""")
def csv_rows_whole(spark, sf):
    """Every landed row once, with quoted line breaks inside its cells; files are read in splits."""
    path = scratch_dir(spark, "whole")
    _land_lines(derived(spark, sf, "cpr_samp"), path)
    return read_table(spark, path, TABLES["cpr_samp"], in_splits=True).select(*_SAMP_KEYS)


@query("""SELECT animal_id AS id, CASE event_id % 7 WHEN 0 THEN NULL WHEN 1 THEN NULL WHEN 2 THEN 'n/a' ELSE event_type END AS animal_sex, CAST(NULL AS BIGINT) AS nb_detections
FROM (SELECT *, 'A69-1303-1_2_' || CAST(event_id AS VARCHAR) AS animal_id FROM {events}) e""")
def missing_tokens(spark, sf):
    """Missing-value tokens of a declared table become NULL; other text stays."""
    kind = F.pmod("event_id", F.lit(7))
    sex = F.when(kind == 0, "NA").when(kind == 1, " ").when(kind == 2, "n/a").otherwise(F.col("event_type"))
    rows = base(spark, sf, "events").select(F.concat(F.lit("A69-1303-1_2_"), "event_id").alias("animal_ID"), sex.alias("animal_sex"), F.lit("NA").alias("nb_detections"))
    path = scratch_dir(spark, "tokens")
    rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    spec = TABLES["acoustic_summary_qc"].only("animal_id", "animal_sex", "nb_detections")
    return read_table(spark, path, spec).select(F.col("animal_id").alias("id"), "animal_sex", "nb_detections")


def _written_times(events: DataFrame) -> DataFrame:
    """One time of each event in the declared forms, by turns."""
    day, clock = F.date_format("ts", "yyyy-MM-dd"), F.date_format("ts", "HH:mm:ss")
    flag = F.element_at(F.array(*[F.lit(v) for v in ("true", "false", "True", "0", "maybe")]), (F.pmod("event_id", F.lit(5)) + 1).cast("int"))
    return events.select("event_id", F.concat(day, F.lit("T"), clock).alias("t"), F.concat(day, F.lit(" "), clock, F.lit("Z")).alias("z"), F.concat(day, F.lit(" "), clock).alias("plain"), flag.alias("flag"))


@query("""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS t, strftime(ts, '%Y-%m-%d %H:%M:%S') AS z, CAST(NULL AS VARCHAR) AS crossed,
  CASE event_id % 5 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 3 THEN false END AS flag FROM {events}""")
def time_forms(spark, sf):
    """The T and Z forms of a time, a form that is not the declared one, and truth values."""
    rows = _written_times(base(spark, sf, "events"))
    return comparable(rows.select("event_id", parse(F.col("t"), "datetime_t").alias("t"), parse(F.col("z"), "datetime_z").alias("z"), parse(F.col("plain"), "datetime_t").alias("crossed"), parse(F.col("flag"), "boolean").alias("flag")))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d') AS short, strftime(ts, '%Y-%m-%d') AS long FROM {events}")
def any_date(spark, sf):
    """A date by itself, and one followed by a time."""
    rows = _written_times(base(spark, sf, "events"))
    return comparable(rows.select("event_id", parse(F.substring("plain", 1, 10), "date_any").alias("short"), parse(F.col("t"), "date_any").alias("long")))


_NOW = "2020-06-01 00:00:00"
_INDEX_TIMES = ("time_coverage_start", "time_coverage_end", "first_indexed", "last_indexed")


def _merged(kept: str, time: str) -> str:
    return f"CASE WHEN s.tag_deployment_id IS NULL THEN b.{kept} ELSE s.{kept} END AS {time}"


@query(f"""SELECT coalesce(s.tag_deployment_id, b.tag_deployment_id) AS tag_deployment_id,
  {", ".join(_merged(c, c) for c in ("transmitter_id", "species", "species_scientific_name", "tagging_project"))},
  {stamp("CASE WHEN b.tag_deployment_id IS NULL THEN s.time_coverage_start ELSE b.time_coverage_start END")} AS time_coverage_start,
  {stamp("CASE WHEN b.tag_deployment_id IS NULL THEN s.time_coverage_end ELSE b.time_coverage_end END")} AS time_coverage_end,
  CASE WHEN b.tag_deployment_id IS NULL THEN s.geom ELSE b.geom_df END AS geom,
  {stamp(f"coalesce(s.first_indexed, TIMESTAMP '{_NOW}')")} AS first_indexed,
  {stamp(f"CASE WHEN b.tag_deployment_id IS NULL THEN s.last_indexed ELSE TIMESTAMP '{_NOW}' END")} AS last_indexed,
  {_merged("url", "url")}, CASE WHEN b.tag_deployment_id IS NULL THEN s.size ELSE b.size END AS size
FROM {{detection_file_index}} s FULL JOIN {{detection_index_batch}} b ON b.tag_deployment_id = s.tag_deployment_id""")
def index_upsert(spark, sf):
    """Stored: the index as it is, then a batch that came as CSV, was checked, and is merged twice."""
    path, landed = scratch_dir(spark, "index"), scratch_dir(spark, "batch")
    now, spec = F.lit(_NOW).cast("timestamp_ntz"), TABLES["detection_index_batch"]
    upsert.create_index(derived(spark, sf, "detection_file_index"), path)
    t_form = {c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss") for c in ("time_coverage_start", "time_coverage_end")}
    _land_csv(derived(spark, sf, "detection_index_batch").withColumns(t_form), landed)
    batch = read_table(spark, landed, spec)
    upsert.store_index(spark, path, batch, now)
    return comparable(upsert.store_index(spark, path, batch, now))


@query(f"""SELECT tag_deployment_id, transmitter_id, species, species_scientific_name, tagging_project,
  {stamp("time_coverage_start")} AS time_coverage_start, {stamp("time_coverage_end")} AS time_coverage_end, geom_df AS geom,
  '{_NOW}' AS first_indexed, '{_NOW}' AS last_indexed, url, size FROM {{detection_index_batch}}""")
def index_first_load(spark, sf):
    """The first batch into an index that does not exist yet."""
    now = F.lit(_NOW).cast("timestamp_ntz")
    batch = derived(spark, sf, "detection_index_batch")
    return comparable(upsert.upsert_index(upsert.empty_index(spark), batch, now))


# ---- data quality ----------------------------------------------------------------------

TRIP = TABLES["bgc_trip"]
_FAULT = "'{t}' AS \"table\", '{r}' AS rule, '{c}' AS \"column\", {k} AS key, {v} AS value, CAST({n} AS BIGINT) AS n"


def _fault_sql(rule: str, column: str, where: str, key: str = "trip_code", value: str | None = None, n: str = "1", table: str = "bgc_trip", source: str = "{dirty_trip}") -> str:
    return f"SELECT {_FAULT.format(t=table, r=rule, c=column, k=key, v=value or column, n=n)} FROM {source} WHERE {where}"


_REQUIRED = [_fault_sql("required", c, f"{c} IS NULL") for c in ("projectname", "stationcode")]
_TYPE = [
    _fault_sql("type-error", "longitude", "longitude = 'null'"),
    _fault_sql("type-error", "sampledatelocal", "TRY_CAST(sampledatelocal AS TIMESTAMP) IS NULL"),
    _fault_sql("type-error", "sampledateutc", "length(sampledateutc) <> 19"),
]
_RANGE = [
    _fault_sql("range-warning", "latitude", "CAST(latitude AS DOUBLE) NOT BETWEEN -90 AND 90"),
    _fault_sql("range-warning", "longitude", "TRY_CAST(longitude AS DOUBLE) NOT BETWEEN -180 AND 180"),
]
_UNIQUE = [
    """SELECT 'bgc_trip' AS "table", 'primary-key' AS rule, 'trip_code' AS "column", trip_code AS key,
    CAST(count(*) AS VARCHAR) AS value, count(*) - 1 AS n FROM {dirty_trip} GROUP BY trip_code HAVING count(*) > 1"""
]


def _dirty(spark, sf):
    """The faulty visits as text, and the declared fields they carry."""
    text = derived(spark, sf, "dirty_trip")
    return text, TRIP.only(*text.columns)


def _of_rule(spark, sf, *rules: str) -> DataFrame:
    return Q.cell_faults(*_dirty(spark, sf)).filter(F.col("rule").isin(*rules))


@query(" UNION ALL ".join(_REQUIRED))
def dq_required(spark, sf):
    return _of_rule(spark, sf, "required")


@query(" UNION ALL ".join(_TYPE))
def dq_type(spark, sf):
    return _of_rule(spark, sf, "type-error")


@query(" UNION ALL ".join(_RANGE))
def dq_range(spark, sf):
    return _of_rule(spark, sf, "range-warning")


@query(_UNIQUE[0])
def dq_unique(spark, sf):
    return Q.unique_faults(derived(spark, sf, "dirty_trip"), "bgc_trip", ("trip_code",))


_DETECTION = {"table": "acoustic_summary_qc", "source": "{dirty_detection}", "key": "CAST(NULL AS VARCHAR)"}


@query(" UNION ALL ".join([
    _fault_sql("pattern", "animal_id", r"NOT regexp_full_match(animal_id, '(A(69|180)-\d{4}-\d{1,5}_){1,3}\d{1,10}_\d{1,10}')", **_DETECTION),
    _fault_sql("pattern", "receiver_deployment_datetime_utc", r"length(receiver_deployment_datetime_utc) NOT IN (10, 19)", **_DETECTION),
    _fault_sql("required", "animal_id", "animal_id IS NULL", **_DETECTION),
    _fault_sql("type-error", "date_utc", "contains(date_utc, '/')", **_DETECTION),
    _fault_sql("type-error", "nb_detections", "nb_detections = 'many'", **_DETECTION),
]))
def dq_pattern(spark, sf):
    text = derived(spark, sf, "dirty_detection")
    return Q.cell_faults(text, TABLES["acoustic_summary_qc"].only(*text.columns))


@query("""SELECT 'bgc_phyto_raw' AS "table", 'foreign-key' AS rule, 'trip_code' AS "column", trip_code AS key, 'bgc_trip' AS value, count(*) AS n
FROM {orphan_counts} WHERE trip_code NOT IN (SELECT trip_code FROM {bgc_trip}) GROUP BY trip_code""")
def dq_link(spark, sf):
    return Q.link_faults(
        derived(spark, sf, "orphan_counts"), derived(spark, sf, "bgc_trip"), "bgc_phyto_raw", "trip_code", "trip_code", "bgc_trip"
    )


@query("""SELECT 'cpr_phyto_raw' AS "table", 'volume-warning' AS rule, 'sampvol_m3' AS "column", sample AS key,
  CAST(min(sampvol_m3) AS VARCHAR) || ' to ' || CAST(max(sampvol_m3) AS VARCHAR) AS value, CAST(1 AS BIGINT) AS n
FROM {cpr_phyto_raw} GROUP BY sample HAVING min(sampvol_m3) < max(sampvol_m3)""")
def dq_sample_volumes(spark, sf):
    return Q.volume_faults(derived(spark, sf, "cpr_phyto_raw"), "cpr_phyto_raw")


_ALL_TRIP = " UNION ALL ".join(_REQUIRED + _TYPE + _RANGE + _UNIQUE)


_REPORT = f"""SELECT * FROM (WITH faults AS ({_ALL_TRIP}), errors AS (SELECT * FROM faults WHERE rule <> 'range-warning')
SELECT t."table", (SELECT coalesce(sum(n), 0) FROM errors e WHERE e."table" = t."table") = 0 AS valid,
  CAST((SELECT coalesce(sum(n), 0) FROM errors e WHERE e."table" = t."table") AS BIGINT) AS errors,
  CAST((SELECT coalesce(sum(n), 0) FROM faults f WHERE f."table" = t."table" AND rule = 'range-warning') AS BIGINT) AS warnings,
  coalesce((SELECT string_agg(rule || ' in "' || "column" || '": ' || coalesce(value, 'NULL'), ' / ' ORDER BY place)
   FROM (SELECT *, row_number() OVER (PARTITION BY "table" ORDER BY rule, "column", key NULLS LAST, value NULLS LAST) AS place FROM errors) r
   WHERE place <= 5 AND r."table" = t."table"), '') AS messages
FROM (VALUES ('bgc_trip'), ('cpr_samp')) t("table")) whole"""


@query(_REPORT)
def dq_report(spark, sf):
    """The faulty visits and a clean table, as one report."""
    clean = comparable(derived(spark, sf, "cpr_samp"))
    faults = Q.table_faults(*_dirty(spark, sf)).unionByName(Q.table_faults(clean, TABLES["cpr_samp"]))
    listed = spark.createDataFrame([("bgc_trip",), ("cpr_samp",)], "table string")
    return Q.report(faults, listed).withColumn("messages", F.array_join("messages", " / "))


_LINKED = {
    "bgc_phyto_raw": ("trip_code", "{orphan_counts}", "bgc_trip"),
    "bgc_zoop_raw": ("trip_code", "{bgc_zoop_raw}", "bgc_trip"),
    "bgc_pigments": ("trip_code", "{bgc_pigments}", "bgc_trip"),
    "cpr_phyto_raw": ("sample", "{cpr_phyto_raw}", "cpr_samp"),
    "cpr_zoop_raw": ("sample", "{cpr_zoop_raw}", "cpr_samp"),
}
# Parents without some of their rows, so that links of both programmes have orphans.
_PARENTS = {"bgc_trip": "SELECT * FROM {bgc_trip} WHERE NOT trip_code LIKE '%7'", "cpr_samp": "SELECT * FROM {cpr_samp} WHERE NOT sample LIKE '%3'"}


@query(" UNION ALL ".join(f"""SELECT '{child}' AS "table", 'foreign-key' AS rule, '{key}' AS "column", CAST({key} AS VARCHAR) AS key, '{parent}' AS value, count(*) AS n
FROM {source} c WHERE NOT EXISTS (SELECT 1 FROM ({_PARENTS[parent]}) p WHERE p.{key} = c.{key}) AND {key} IS NOT NULL GROUP BY {key}"""
    for child, (key, source, parent) in _LINKED.items()))
def dq_links(spark, sf):
    """All declared links between the tables at hand, in one shuffle."""
    tables = {child: derived(spark, sf, source.strip("{}")) for child, (_, source, _) in _LINKED.items()}
    tables["bgc_trip"] = derived(spark, sf, "bgc_trip").filter(~F.col("trip_code").like("%7"))
    tables["cpr_samp"] = derived(spark, sf, "cpr_samp").filter(~F.col("sample").like("%3"))
    return Q.all_link_faults(tables)


@query(_REPORT)
def ingest_report(spark, sf):
    """The same tables landed as CSV: stored and validated with one scan, and reported."""
    landing, out = scratch_dir(spark, "landing"), scratch_dir(spark, "checked")
    dirty, trip = _dirty(spark, sf)
    _land_csv(dirty, f"{landing}/bgc_trip.csv")
    _land_csv(derived(spark, sf, "cpr_samp"), f"{landing}/cpr_samp.csv")
    _, faults = ingest_all(spark, landing, out, {"bgc_trip": trip, "cpr_samp": TABLES["cpr_samp"]})
    listed = spark.createDataFrame([("bgc_trip",), ("cpr_samp",)], "table string")
    return Q.report(faults, listed).withColumn("messages", F.array_join("messages", " / "))


_VISITED = "SELECT taxon_name, t.* FROM {bgc_phyto_raw} r JOIN (SELECT trip_code, stationcode, CAST(year(sampledateutc) AS VARCHAR) AS year FROM {bgc_trip}) t ON t.trip_code = r.trip_code"


@query(f"""SELECT 'trip' AS level, trip_code AS key, count(DISTINCT taxon_name) AS n FROM ({_VISITED}) v GROUP BY trip_code
UNION ALL SELECT 'station', stationcode, count(DISTINCT taxon_name) FROM ({_VISITED}) v GROUP BY stationcode
UNION ALL SELECT 'year', year, count(DISTINCT taxon_name) FROM ({_VISITED}) v GROUP BY year""")
def distinct_taxa_merged(spark, sf):
    """Taxa per visit, station and year, each counted from one stored table of bitmaps."""
    seen: dict = {}
    trips = derived(spark, sf, "bgc_trip", seen).select("trip_code", "stationcode", F.year("sampledateutc").cast("string").alias("year"))
    rows = derived(spark, sf, "bgc_phyto_raw", seen).select("trip_code", "taxon_name").join(trips, "trip_code")
    keys = ["trip_code", "stationcode", "year"]
    bitmaps = write_snapshot(value_bitmaps(rows, keys, "taxon_name", dense_codes(rows, "taxon_name")), scratch_dir(spark, "bitmaps"))
    levels = [distinct_counts(bitmaps, [k]).select(F.lit(name).alias("level"), F.col(k).alias("key"), "n") for name, k in zip(("trip", "station", "year"), keys)]
    return reduce(DataFrame.unionByName, levels)
