"""Marine tables derived from the benchmark tables, in SQL both engines read alike.

Orders play the station visits and samples, line items with their parts the counted taxa,
laboratory values and profile rows, events the CTD casts, customers the tagged animals.
Every table grows with the table it is derived from. ``{name}`` marks a table read.
"""

from __future__ import annotations

import re

BASE = ("orders", "lineitem", "part", "events", "customer")


def trip(k: str) -> str:
    return (
        f"(CASE {k} % 7 WHEN 0 THEN 'DAR' WHEN 1 THEN 'YON' ELSE 'MAI' END || CAST({k} AS STRING))"
    )


# 1995-2001 becomes 2009-2015, so the visits straddle every start date in use.
UTC = "(o_orderdate + INTERVAL '5114' DAY + INTERVAL '1' MINUTE * (o_orderkey % 1440))"
LOCAL = f"({UTC} + INTERVAL '10' HOUR)"
LAB_TIME = "max(l_shipdate + INTERVAL '5114' DAY)"


def nullif(condition: str, value: str) -> str:
    return f"CASE WHEN {condition} THEN NULL ELSE {value} END"


SAMPLE_TYPE = """CASE o_orderpriority WHEN '1-URGENT' THEN 'P' WHEN '2-HIGH' THEN 'Z'
    WHEN '3-MEDIUM' THEN 'PZ' WHEN '4-NOT SPECIFIED' THEN 'HPZ' ELSE 'H' END"""

TABLES: dict[str, str] = {}

TABLES["bgc_trip"] = f"""
SELECT CASE WHEN o_orderstatus = 'F' THEN 'SOTS' ELSE 'NRS' END AS projectname,
       {trip("o_orderkey")} AS trip_code,
       'Station ' || CAST(o_custkey % 9 AS STRING) AS stationname,
       CASE WHEN o_custkey % 9 = 0 THEN 'VBM' ELSE 'S' || CAST(o_custkey % 9 AS STRING) END AS stationcode,
       CAST(110 + (o_custkey % 160) * 0.25 AS DOUBLE) AS longitude,
       CAST(-45 + (o_orderkey % 120) * 0.25 AS DOUBLE) AS latitude,
       {nullif("o_orderkey % 4 = 0", "CAST(o_orderkey % 50 AS DOUBLE)")} AS zoopsampledepth_m,
       CAST(o_orderkey % 30 AS DOUBLE) AS phytosampledepth_m,
       {LOCAL} AS sampledatelocal,
       {UTC} AS sampledateutc,
       {nullif("o_orderkey % 11 = 0", "CAST((o_orderkey % 700) * 0.125 AS DOUBLE)")} AS biomass_mgm3,
       {nullif("o_orderkey % 3 = 0", "CAST((o_orderkey % 300) * 0.25 AS DOUBLE)")} AS ashfreebiomass_mgm3,
       {nullif("o_orderkey % 6 = 0", "CAST((o_orderkey % 40) * 0.5 AS DOUBLE)")} AS secchi_m,
       {SAMPLE_TYPE} AS sampletype
FROM {{orders}}
"""

# One taxon per part. The species text runs through every form the name rules tell apart.
TABLES["taxon"] = """
SELECT p_partkey, p_size, adjective, noun, genus, species,
       CAST((length(adjective) * 5 + least(p_size % 12, 10)) % 10 AS INT) AS code,
       coalesce(genus, 'Unknown ' || adjective) || ' ' || coalesce(species, 'sp') AS taxon_name
FROM (
    SELECT p_partkey, p_size, adjective, noun,
           CASE WHEN p_size % 12 = 0 AND p_partkey % 2 = 0 THEN NULL
                WHEN p_partkey % 15 = 0 THEN 'cf. ' || adjective
                WHEN p_size % 3 = 0 THEN adjective || 'ella'
                WHEN p_size % 3 = 1 THEN adjective || 'ium'
                ELSE adjective END AS genus,
           CASE p_size % 12
                WHEN 0 THEN NULL
                WHEN 1 THEN 'spp.'
                WHEN 2 THEN 'cf. ' || noun
                WHEN 3 THEN noun || '/bolt'
                WHEN 4 THEN noun || ' grp'
                WHEN 5 THEN noun || ' complex'
                WHEN 6 THEN noun || ' type'
                WHEN 7 THEN noun || ' group'
                WHEN 8 THEN noun || ' cyst'
                WHEN 9 THEN noun || ' (small)'
                ELSE noun END AS species
    FROM (
        SELECT p_partkey, p_size,
               split_part(p_name, ' ', 1) AS adjective, split_part(p_name, ' ', 2) AS noun
        FROM {part}
    ) words
) named
"""

# Both follow from the taxon name alone, so grouping by them adds no groups.
GROUP = """CASE code WHEN 0 THEN 'Dinoflagellate' WHEN 1 THEN 'Ciliate' WHEN 2 THEN 'Cyanobacteria'
    WHEN 3 THEN 'Centric diatom' WHEN 4 THEN 'Pennate diatom' WHEN 5 THEN 'Other' WHEN 6 THEN 'Foraminifera'
    WHEN 7 THEN 'Radiozoa' WHEN 8 THEN 'Coccolithophore' ELSE 'Silicoflagellate' END"""
ZOOP_GROUP = """CASE code WHEN 0 THEN 'Copepod' WHEN 1 THEN 'Ciliophora' WHEN 3 THEN 'Foraminifera'
    WHEN 4 THEN 'Ciliate' WHEN 5 THEN 'Jelly' WHEN 8 THEN 'Other' ELSE 'Copepod' END"""
CELLS = "CASE WHEN l_suppkey % 17 = 0 THEN 0 ELSE l_quantity END"
VOLUME = nullif("l_suppkey % 13 = 0", "CAST(round(l_extendedprice * 4) AS BIGINT)")
COPEPOD = "CASE WHEN code IN (4, 5, 8) THEN 'NON-COPEPOD' ELSE 'COPEPOD' END"
METHOD = "CASE WHEN l_linenumber = 7 THEN NULL WHEN l_linestatus = 'F' THEN 'LM' ELSE 'SEM' END"
SAMPLE = "'S' || CAST({k} AS STRING)"


def _phyto(key: str, key_name: str, method: str, cells: str, volume: str) -> str:
    select_method = f"{method} AS methods," if method else ""
    group_method = f", {method}" if method else ""
    return f"""
SELECT {key} AS {key_name}, taxon_name, {GROUP} AS taxon_group, genus, species, {select_method}
       CAST(sum({CELLS}) AS DOUBLE) AS {cells},
       CAST(sum({VOLUME}) AS DOUBLE) / CAST(4 AS DOUBLE) AS {volume},
       max(CASE WHEN l_orderkey % 10 = 0 AND l_linenumber > 3 THEN CAST(5 AS DOUBLE) ELSE CAST(2.5 AS DOUBLE) END) AS sampvol_m3
FROM {{lineitem}} JOIN {{taxon}} ON p_partkey = l_partkey
GROUP BY {key}, taxon_name, code, genus, species{group_method}
"""


def _zoop(key: str, key_name: str) -> str:
    return f"""
SELECT {key} AS {key_name}, taxon_name, {COPEPOD} AS copepod, {ZOOP_GROUP} AS taxon_group, genus, species,
       CAST(sum(l_quantity) AS DOUBLE) AS zoop_abundance_m3,
       CAST(sum(CASE WHEN l_suppkey % 11 = 0 THEN 0 ELSE l_linenumber END) AS DOUBLE) AS taxon_count,
       max(CASE WHEN l_orderkey % 10 = 1 AND l_linenumber > 3 THEN CAST(5 AS DOUBLE) ELSE CAST(2.5 AS DOUBLE) END) AS sampvol_m3
FROM {{lineitem}} JOIN {{taxon}} ON p_partkey = l_partkey
GROUP BY {key}, taxon_name, code, genus, species
"""


def _changelog(shift: int, nouns: str) -> str:
    return f"""
SELECT taxon_name,
       min(CAST('2009-01-01' AS DATE) + (37 * p_size + {shift})) AS startdate,
       min(CASE p_partkey % 4 WHEN 0 THEN NULL WHEN 1 THEN genus || ' ancient' ELSE 'Oldname ' || noun END) AS parent_name
FROM {{taxon}}
WHERE noun IN ({nouns}) AND (species IS NULL OR species IN ('spp.', noun, noun || ' (small)'))
GROUP BY taxon_name
"""


_S = SAMPLE.format(k="l_orderkey")
TABLES["bgc_phyto_raw"] = _phyto(trip("l_orderkey"), "trip_code", METHOD, "cell_l", "biovolume_um3l")
TABLES["cpr_phyto_raw"] = _phyto(_S, "sample", "", "phyto_abundance_m3", "biovol_um3m3")
TABLES["bgc_zoop_raw"] = _zoop(trip("l_orderkey"), "trip_code")
TABLES["cpr_zoop_raw"] = _zoop(_S, "sample")
TABLES["bgc_phyto_changelog"] = _changelog(0, "'ring', 'bolt'")
TABLES["bgc_zoop_changelog"] = _changelog(90, "'ring', 'widget'")
TABLES["cpr_phyto_changelog"] = _changelog(180, "'bolt', 'rod'")
TABLES["cpr_zoop_changelog"] = _changelog(270, "'plate', 'ring'")

TABLES["zoopinfo"] = """
SELECT CASE WHEN p_size < 45 THEN taxon_name ELSE taxon_name || ' (old name)' END AS taxon_name,
       max(CAST(p_size * 0.0625 AS DOUBLE)) AS length_mm,
       max(CASE p_partkey % 5 WHEN 0 THEN 'Carnivore' WHEN 1 THEN 'Omnivore' WHEN 2 THEN 'Herbivore'
           WHEN 3 THEN 'Detritivore' ELSE NULL END) AS diet
FROM {taxon} GROUP BY CASE WHEN p_size < 45 THEN taxon_name ELSE taxon_name || ' (old name)' END
"""

# Laboratory tables. Grouping makes (trip, depth) unique, as their keys declare.
_DEPTH_TEXT = "CASE WHEN l_linenumber = 7 THEN 'WC' ELSE CAST(l_linenumber * 10 AS STRING) END"
_CHEM = ("silicate", "nitrate", "phosphate", "ammonium", "nitrite", "oxygen")


def _value(i: int) -> str:
    return f"max({nullif(f'l_suppkey % 7 = {i % 7}', f'l_quantity + {i}')})"


def _flag(i: int) -> str:
    return f"CAST(max((l_suppkey + {i}) % 5) AS BIGINT)"


def _lab(columns: dict[str, str], depth: str, extra_keys: dict[str, str] | None = None) -> str:
    keys = {"trip_code": trip("l_orderkey"), "sampledepth_m": depth, **(extra_keys or {})}
    return (
        "\nSELECT "
        + ", ".join(f"{e} AS {n}" for n, e in keys.items())
        + f", {LAB_TIME} AS sampledatelocal, "
        + ", ".join(f"{e} AS {n}" for n, e in columns.items())
        + "\nFROM {lineitem}\nGROUP BY "
        + ", ".join(keys.values())
        + "\n"
    )


TABLES["bgc_chemistry"] = _lab(
    {
        **{f"{q}_umoll": _value(i) for i, q in enumerate(_CHEM)},
        **{f"{q}_flag": _flag(i) for i, q in enumerate(_CHEM)},
        "salinity_psu": _value(6),
        "salinity_flag": _flag(6),
        "dic_umolkg": _value(7),
        "carbon_flag": _flag(7),
        "talkalinity_umolkg": _value(8),
        "alkalinity_flag": _flag(8),
        "microbiomesample_id": f"max({nullif('l_suppkey % 3 = 0', chr(39) + 'M' + chr(39) + ' || CAST(l_partkey AS STRING)')})",
    },
    "CAST(l_linenumber * 10 + (CASE WHEN l_suppkey % 5 = 0 THEN 0.5 ELSE 0 END) AS DOUBLE)",
)

# The declared pigments.
PIGMENT_COLUMNS = (
    "cphl_c3",
    "mg_dvp",
    "cphl_c2",
    "cphl_c1",
    "cphl_c1c2",
    "cphlide_a",
    "phide_a",
    "perid",
    "pyrophide_a",
    "but_fuco",
    "fuco",
    "neo",
    "keto_hex_fuco",
    "pras",
    "viola",
    "hex_fuco",
    "asta",
    "diadchr",
    "diadino",
    "dino",
    "anth",
    "allo",
    "myxo",
    "diato",
    "zea",
    "lut",
    "cantha",
    "gyro",
    "dv_cphl_b",
    "cphl_b",
    "dv_cphl_b_and_cphl_b",
    "dv_cphl_a",
    "cphl_a",
    "dv_cphl_a_and_cphl_a",
    "echin",
    "phytin_b",
    "phytin_a",
    "lyco",
    "beta_epi_car",
    "beta_beta_car",
    "alpha_beta_car",
    "pyrophytin_a",
)
TABLES["bgc_pigments"] = _lab(
    {**{p: _value(i) for i, p in enumerate(PIGMENT_COLUMNS)}, "pigments_flag": _flag(0)},
    _DEPTH_TEXT,
)

_TSS = {
    "tss_mgl": _value(1),
    "inorganicfraction_mgl": _value(2),
    "organicfraction_mgl": _value(3),
    "tss_flag": _flag(1),
}
TABLES["bgc_tss"] = _lab(_TSS, _DEPTH_TEXT)
TABLES["bgc_tss_meta"] = _lab(
    {
        **_TSS,
        "tss_comments": f"max({nullif('l_suppkey % 4 = 0', chr(39) + 'filter ' + chr(39) + ' || CAST(l_suppkey AS STRING)')})",
        "blankadjustavailable": "max(CASE WHEN l_suppkey % 2 = 0 THEN 'Y' ELSE 'N' END)",
    },
    _DEPTH_TEXT,
    {"replicate": "CAST(1 + l_suppkey % 3 AS BIGINT)"},
)

_PICO = ("prochlorococcus", "synecochoccus", "picoeukaryotes", "bacteria", "virus")
_PICO_COLUMNS = {
    **{f"{q}_cellsml": _value(i) for i, q in enumerate(_PICO)},
    **{f"{q}_flag": _flag(i) for i, q in enumerate(_PICO)},
}
TABLES["bgc_picoplankton"] = _lab(_PICO_COLUMNS, _DEPTH_TEXT)
TABLES["bgc_picoplankton_meta"] = _lab(
    {
        **_PICO_COLUMNS,
        "pico_comments": "max(CASE WHEN l_suppkey % 4 = 0 THEN 'thawed' ELSE NULL END)",
        "analysis_location": "max('Lab ' || CAST(l_suppkey % 3 AS STRING))",
        "analysis_date": f"CAST({LAB_TIME} AS DATE)",
        "analyst_name": "max('Analyst ' || CAST(l_suppkey % 5 AS STRING))",
        "temp_thawed_degc": _value(5),
        "internal_standard": "max('beads')",
        "instrument_brand_model": "max('Cytometer ' || CAST(l_suppkey % 2 AS STRING))",
        "instrument_serial_number": "max(CAST(l_suppkey AS STRING))",
        "laser_nm": "max(CASE WHEN l_suppkey % 2 = 0 THEN '488' ELSE '405/488' END)",
        "mode_type": "max('log')",
        "analysis_volume_ul": _value(6),
        "flow_rate_ul_per_min": "CAST(max(l_suppkey % 60) AS BIGINT)",
        "analysis_time_minutes": "CAST(max(l_suppkey % 9) AS BIGINT)",
        "batch_comments": "max(CASE WHEN l_suppkey % 8 = 0 THEN 'rerun' ELSE NULL END)",
    },
    _DEPTH_TEXT,
    {"sample_code": "'P' || CAST(l_orderkey AS STRING) || '-' || CAST(l_suppkey AS STRING)", "replicate": "CAST(1 + l_suppkey % 2 AS BIGINT)"},
)

TABLES["deployments"] = """
SELECT event_id AS file_id,
       CASE WHEN user_id % 9 = 0 THEN 'VBM100' ELSE 'NRSS' || CAST(user_id % 9 AS STRING) END AS site_code,
       ts - INTERVAL '5478' DAY + INTERVAL '1' DAY * (event_id % 2400) AS time_coverage_start
FROM {events}
"""

_CTD = ("psal", "temp", "dox2", "cphl", "turb", "cndc", "dens")
TABLES["measurements"] = (
    "\nSELECT l_orderkey AS file_id, CAST(l_linenumber * 4 - 3 + l_suppkey % 3 AS DOUBLE) AS depth, "
    + ", ".join(
        f"max({nullif(f'l_suppkey % 9 = {i}', f'l_quantity * 0.25 + {i}')}) AS {m}, "
        f"CAST(max({nullif(f'l_suppkey % 6 = {i % 6}', f'1 + (l_suppkey + {i}) % 4')}) AS STRING) AS {m}_quality_control"
        for i, m in enumerate(_CTD)
    )
    + "\nFROM {lineitem}\nGROUP BY l_orderkey, CAST(l_linenumber * 4 - 3 + l_suppkey % 3 AS DOUBLE)\n"
)

TABLES["bgc_lfish_samples"] = f"""
SELECT o_orderkey AS i_sample_id, 'NRS' AS projectname, {trip("o_orderkey")} AS trip_code,
       {LOCAL} AS sampledatelocal, {nullif("o_orderkey % 8 = 0", UTC)} AS sampledateutc,
       CAST(-45 + (o_orderkey % 120) * 0.25 AS DOUBLE) AS latitude,
       CAST(110 + (o_custkey % 160) * 0.25 AS DOUBLE) AS longitude,
       'Station ' || CAST(o_custkey % 9 AS STRING) AS stationname,
       CAST((o_orderkey % 90) * 0.5 AS DOUBLE) AS sampvol_m3,
       'Vessel ' || CAST(o_custkey % 4 AS STRING) AS vessel,
       CASE o_orderkey % 2 WHEN 0 THEN 'Bongo' ELSE 'Ring' END AS towtype,
       CASE o_orderkey % 5 WHEN 0 THEN NULL ELSE CAST(o_orderkey % 100 AS STRING) END AS geardepth_m,
       '500' AS gearmesh_um,
       CAST(o_orderkey % 200 AS DOUBLE) AS depth_m,
       {nullif("o_orderkey % 2 = 0", "CAST((o_orderkey % 80) * 0.25 AS DOUBLE)")} AS temperature_c,
       {nullif("o_orderkey % 3 = 0", "CAST(30 + (o_orderkey % 40) * 0.125 AS DOUBLE)")} AS salinity_psu,
       o_orderkey % 4 AS qc_flag
FROM {{orders}}
"""
TABLES["bgc_lfish_countraw"] = f"""
SELECT l_orderkey AS i_sample_id, {trip("l_orderkey")} AS trip_code, taxon_name AS scientificname,
       CAST(sum(l_linenumber) AS BIGINT) AS taxon_count
FROM {{lineitem}} JOIN {{taxon}} ON p_partkey = l_partkey
GROUP BY l_orderkey, taxon_name
"""

TABLES["cpr_samp"] = f"""
SELECT 'C' || CAST(o_custkey AS STRING) AS trip_code, {SAMPLE.format(k="o_orderkey")} AS sample,
       'Region ' || CAST(o_custkey % 6 AS STRING) AS region,
       CAST(-45 + (o_orderkey % 120) * 0.25 AS DOUBLE) AS latitude,
       CAST(110 + (o_custkey % 160) * 0.25 AS DOUBLE) AS longitude,
       {UTC} AS sampledateutc, {nullif("o_orderkey % 12 = 0", LOCAL)} AS sampledatelocal,
       {nullif("o_orderkey % 5 = 0", "CAST(o_orderkey % 4 AS DOUBLE)")} AS pci,
       CAST((o_orderkey % 500) * 0.125 AS DOUBLE) AS biomass_mgm3,
       {SAMPLE_TYPE} AS sampletype,
       CAST((o_orderkey % 120) * 0.25 AS DOUBLE) AS ghrsst_6d_degc,
       {nullif("o_orderkey % 9 = 0", "CAST((o_orderkey % 64) * 0.125 AS DOUBLE)")} AS chloc3_mgm3
FROM {{orders}}
"""

# Tagged animals: those of one market segment are indexed under another tag than the batch has.
_TAG = "'A69-' || CAST(1000 + c_custkey % 9000 AS STRING) || '-' || CAST(c_custkey AS STRING)"
_OLD_TAG = f"CASE WHEN c_mktsegment = 'BUILDING' THEN 'A180-7-' || CAST(c_custkey AS STRING) ELSE {_TAG} END"
_GEOM = "'MULTIPOINT((' || CAST(100 + c_custkey % 60 AS STRING) || ' ' || CAST(-40 + c_custkey % 30 AS STRING) || '))'"
_T0 = "CAST('2015-01-01 00:00:00' AS TIMESTAMP)"
TABLES["detection_file_index"] = f"""
SELECT {_OLD_TAG} AS tag_deployment_id, 'A69-' || CAST(c_custkey % 97 AS STRING) AS transmitter_id,
       'Species ' || CAST(c_nationkey AS STRING) AS species, c_mktsegment AS species_scientific_name,
       'Project ' || CAST(c_custkey % 5 AS STRING) AS tagging_project,
       {_T0} + INTERVAL '1' HOUR * c_custkey AS time_coverage_start,
       {_T0} + INTERVAL '1' HOUR * (2 * c_custkey) AS time_coverage_end,
       {_GEOM} AS geom, {_T0} AS first_indexed, {_T0} AS last_indexed,
       'https://files.example/' || CAST(c_custkey AS STRING) AS url, c_custkey % 1000 AS size
FROM {{customer}}
"""
TABLES["detection_index_batch"] = f"""
SELECT {_TAG} AS tag_deployment_id, 'A69-new' AS transmitter_id,
       'New ' || CAST(c_nationkey AS STRING) AS species, c_mktsegment AS species_scientific_name,
       'Project new' AS tagging_project,
       {_T0} + INTERVAL '1' HOUR * (c_custkey + 5) AS time_coverage_start,
       {_T0} + INTERVAL '1' HOUR * (3 * c_custkey) AS time_coverage_end,
       {_GEOM} AS geom_df, 'https://files.example/new' AS url,
       {nullif("c_custkey % 10 = 0", "c_custkey % 700")} AS size
FROM {{customer}}
"""

# Visits as text with faults of every kind in them, and detections with broken identifiers.
TABLES["dirty_trip"] = f"""
SELECT CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE 'NRS' END AS projectname,
       CASE WHEN o_orderkey % 40 = 1 THEN {trip("(o_orderkey - 1)")} ELSE {trip("o_orderkey")} END AS trip_code,
       'Station ' || CAST(o_custkey % 9 AS STRING) AS stationname,
       CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE 'S' || CAST(o_custkey % 9 AS STRING) END AS stationcode,
       CASE WHEN o_orderkey % 29 = 0 THEN 'null' ELSE CAST(100 + o_custkey % 90 AS STRING) END AS longitude,
       CAST(o_orderkey % 100 - 45 - (CASE WHEN o_orderkey % 61 = 0 THEN 80 ELSE 0 END) AS STRING) AS latitude,
       CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE CAST(o_orderkey % 30 AS STRING) END AS zoopsampledepth_m,
       CASE WHEN o_orderkey % 47 = 0 THEN '2009-13-45 00:00:00'
            ELSE substr(CAST(o_orderdate AS STRING), 1, 10) || ' 10:00:00' END AS sampledatelocal,
       CASE WHEN o_orderkey % 37 = 0 THEN substr(CAST(o_orderdate AS STRING), 1, 10)
            ELSE substr(CAST(o_orderdate AS STRING), 1, 10) || ' 00:00:00' END AS sampledateutc
FROM {{orders}}
"""
TABLES["dirty_detection"] = """
SELECT CASE WHEN event_id % 13 = 0 THEN 'B69-1303-' || CAST(user_id AS STRING) || '_1_2'
            WHEN event_id % 19 = 0 THEN 'A69-1303-' || CAST(user_id AS STRING) || '_1_2x'
            WHEN event_id % 23 = 0 THEN NULL
            ELSE 'A69-1303-' || CAST(user_id AS STRING) || '_' || CAST(event_id AS STRING) || '_7' END AS animal_id,
       CASE WHEN event_id % 29 = 0 THEN '2024/01/05' ELSE substr(CAST(ts AS STRING), 1, 10) END AS date_utc,
       CASE WHEN event_id % 31 = 0 THEN 'many' ELSE CAST(event_id % 50 AS STRING) END AS nb_detections,
       CASE WHEN event_id % 17 = 0 THEN substr(CAST(ts AS STRING), 1, 10) || ' 1:00'
            ELSE substr(CAST(ts AS STRING), 1, 10) END AS receiver_deployment_datetime_utc
FROM {events}
"""
TABLES["orphan_counts"] = f"""
SELECT CASE WHEN l_suppkey % 21 = 0 THEN NULL WHEN l_linenumber = 6 THEN 'X' || CAST(l_partkey % 50 AS STRING)
            ELSE {trip("l_orderkey")} END AS trip_code
FROM {{lineitem}}
"""


def reads(sql: str) -> list[str]:
    """Names of the tables a text reads."""
    return sorted(set(re.findall(r"\{([a-z]\w*)\}", sql)))


def plain(sql: str) -> str:
    """The text with its table marks replaced by the bare names."""
    return re.sub(r"\{([a-z]\w*)\}", r"\1", sql)
