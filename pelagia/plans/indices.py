"""Derived-index products of both programmes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.measures import avg_if
from ..functions.times import local_parts, point_wkt
from ..operators.diversity import phytoplankton_indices, zooplankton_indices
from ..operators.profile import below_reference, reference_level, surface_means
from ..operators.rows import star
from .catalog import Catalog, product

PROJECT = "NRS"
GOOD_FLAG_BELOW = 3
SHALLOW_PIGMENT_M = 25

# Published mean -> (chemistry column, its flag).
CHEMISTRY_MEANS = {
    "Silicate_umolL": ("silicate_umoll", "silicate_flag"),
    "Phosphate_umolL": ("phosphate_umoll", "phosphate_flag"),
    "Ammonium_umolL": ("ammonium_umoll", "ammonium_flag"),
    "Nitrate_umolL": ("nitrate_umoll", "nitrate_flag"),
    "Nitrite_umolL": ("nitrite_umoll", "nitrite_flag"),
    "Oxygen_umolL": ("oxygen_umoll", "oxygen_flag"),
    "DIC_umolkg": ("dic_umolkg", "carbon_flag"),
    "Alkalinity_umolkg": ("talkalinity_umolkg", "alkalinity_flag"),
    "Salinity": ("salinity_psu", "salinity_flag"),
}

ZOOP_COLUMNS = (
    "ZoopAbundance_m3",
    "CopeAbundance_m3",
    "AvgTotalLengthCopepod_mm",
    "OmnivoreCarnivoreCopepodRatio",
    "NoCopepodSpecies_Sample",
    "ShannonCopepodDiversity",
    "CopepodEvenness",
)
PHYTO_COLUMNS = (
    "DiatomDinoflagellateRatio",
    "AvgCellVol_um3",
    "NoPhytoSpecies_Sample",
    "ShannonPhytoDiversity",
    "PhytoEvenness",
    "NoDiatomSpecies_Sample",
    "ShannonDiatomDiversity",
    "DiatomEvenness",
    "NoDinoSpecies_Sample",
    "ShannonDinoDiversity",
    "DinoflagellateEvenness",
)


def chemistry_means(chemistry: DataFrame) -> DataFrame:
    """Mean of each quantity over all depths of a trip, good flags only."""
    return chemistry.groupBy("trip_code").agg(
        *[
            avg_if(F.col(flag) < GOOD_FLAG_BELOW, F.col(value)).alias(name)
            for name, (value, flag) in CHEMISTRY_MEANS.items()
        ]
    )


def pigment_means(pigments: DataFrame) -> DataFrame:
    """Mean chlorophyll a above 25 m. Depth text that is no number ('WC') is left out."""
    shallow = F.col("sampledepth_m").try_cast("double") < SHALLOW_PIGMENT_M
    return (
        pigments.filter(shallow)
        .groupBy("trip_code")
        .agg(F.avg("dv_cphl_a_and_cphl_a").alias("PigmentChla_mgm3"))
    )


def of_a_trip(rows: DataFrame) -> DataFrame:
    """Rows without a trip meet none. Said before they are used, it holds for all readers of the rows
    alike, so that what lies below them is planned once."""
    return rows.filter(F.col("trip_code").isNotNull())


def profile_indices(c: Catalog) -> DataFrame:
    """Per trip: the picks below the reference level, and the surface means taken with that level."""
    names = ("trip_code", "SampleDepth_m", "Temperature_degC", "Salinity_psu", "Chla_mgm3")
    rows = of_a_trip(c["nrs_depth_binned_ctd_data"].select(*names))
    key, depth, temp, sal, chl = names
    levels = reference_level(
        rows,
        key,
        depth,
        temp,
        sal,
        surface_means(
            depth,
            {"CTDTemperature_degC": temp, "CTDChlaF_mgm3": chl, "CTDSalinity_PSU": sal},
        ),
    )
    return below_reference(rows, levels, key, depth, temp, sal, chl, keep_all=True)


# ---- facts: what the index products join, one row per key each ----------------------------

Fact = Callable[[Catalog], DataFrame]

# The trips are joined in this order. Whether zooplankton moves to meet its lengths is known once those are there,
# so it does not come first: the trips would go to where it was planned to be, and then after it.
NRS_FACTS: dict[str, Fact] = {
    "nrs_phytoplankton_fact": lambda c: phytoplankton_indices(
        of_a_trip(c["bgc_phyto_raw"]), "trip_code", "cell_l", "biovolume_um3l", "PhytoBiomassCarbon_pgL", "PhytoAbundance_CellsL"
    ),
    "nrs_zooplankton_fact": lambda c: zooplankton_indices(of_a_trip(c["bgc_zoop_raw"]), c["zoopinfo"], "trip_code"),
    "nrs_profile_fact": profile_indices,
    "nrs_chemistry_fact": lambda c: chemistry_means(c["bgc_chemistry"]),
    "nrs_pigment_fact": lambda c: pigment_means(c["bgc_pigments"]),
}
CPR_FACTS: dict[str, Fact] = {
    "cpr_zooplankton_fact": lambda c: zooplankton_indices(c["cpr_zoop_raw"], c["zoopinfo"], "sample"),
    "cpr_phytoplankton_fact": lambda c: phytoplankton_indices(
        c["cpr_phyto_raw"], "sample", "phyto_abundance_m3", "biovol_um3m3", "PhytoBiomassCarbon_pgm3", "PhytoAbundance_Cellsm3"
    ),
}
# Index product -> the key of its star, its base as it is stored by key, and its facts.
STARS: dict[str, tuple[str, str, dict[str, Fact]]] = {
    "nrs_derived_indices_data": ("trip_code", "nrs_trips_by_key", NRS_FACTS),
    "cpr_derived_indices_data": ("sample", "cpr_samples_by_key", CPR_FACTS),
}
BASES: dict[str, Fact] = {"nrs_trips_by_key": lambda c: c["bgc_trip_metadata"], "cpr_samples_by_key": lambda c: c["cpr_samp"]}


def stored_or_made(c: Catalog, name: str, make: Fact) -> DataFrame:
    """A fact that a build has stored by its key, else as planned from its tables."""
    return c[name] if c.has(name) else make(c)


def facts_of(c: Catalog, facts: dict[str, Fact]) -> list[DataFrame]:
    return [stored_or_made(c, name, make) for name, make in facts.items()]


@product("nrs_derived_indices_data")
def nrs_indices(c: Catalog) -> DataFrame:
    trips = stored_or_made(c, "nrs_trips_by_key", BASES["nrs_trips_by_key"]).filter(F.col("Project") == PROJECT)
    facts = facts_of(c, NRS_FACTS)
    return star(trips, "trip_code", facts).select(
        "Project",
        "StationName",
        "TripCode",
        "SampleTime_Local",
        "SampleTime_UTC",
        "Latitude",
        "Longitude",
        "Biomass_mgm3",
        "AshFreeBiomass_mgm3",
        F.col("secchi_m").alias("Secchi_m"),
        *ZOOP_COLUMNS,
        "PhytoBiomassCarbon_pgL",
        "PhytoAbundance_CellsL",
        *PHYTO_COLUMNS,
        "MLDtemp_m",
        "MLDsal_m",
        "DCM_m",
        "CTDTemperature_degC",
        "CTDChlaF_mgm3",
        "CTDSalinity_PSU",
        *CHEMISTRY_MEANS,
        "PigmentChla_mgm3",
        "geom",
    )


@product("cpr_derived_indices_data")
def cpr_indices(c: Catalog) -> DataFrame:
    samples = stored_or_made(c, "cpr_samples_by_key", BASES["cpr_samples_by_key"])
    return star(samples, "sample", facts_of(c, CPR_FACTS)).select(
        F.col("trip_code").alias("TripCode"),
        F.col("sample").alias("Sample_ID"),
        F.col("latitude").alias("Latitude"),
        F.col("longitude").alias("Longitude"),
        F.col("sampledateutc").alias("SampleTime_UTC"),
        *local_parts("sampledatelocal"),
        F.col("pci").alias("PCI"),
        F.col("biomass_mgm3").alias("BiomassIndex_mgm3"),
        F.col("region").alias("Region"),
        *ZOOP_COLUMNS,
        "PhytoBiomassCarbon_pgm3",
        "PhytoAbundance_Cellsm3",
        *PHYTO_COLUMNS,
        point_wkt("longitude", "latitude").alias("geom"),
    )
