"""Trip, sample and map products: one row of place and time per visit or sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import local_parts, point_wkt
from ..operators.rows import in_any
from .catalog import Catalog, product


@product("bgc_trip_metadata")
def trip_metadata(c: Catalog) -> DataFrame:
    return c["bgc_trip"].select(
        F.col("projectname").alias("Project"),
        F.col("stationname").alias("StationName"),
        F.col("stationcode").alias("StationCode"),
        F.col("latitude").alias("Latitude"),
        F.col("longitude").alias("Longitude"),
        F.col("trip_code").alias("TripCode"),
        F.col("sampledateutc").alias("SampleTime_UTC"),
        *local_parts("sampledatelocal"),
        "phytosampledepth_m",
        "zoopsampledepth_m",
        F.col("biomass_mgm3").alias("Biomass_mgm3"),
        F.col("ashfreebiomass_mgm3").alias("AshFreeBiomass_mgm3"),
        "secchi_m",
        "sampletype",
        "trip_code",
        point_wkt("longitude", "latitude").alias("geom"),
    )


_TRIP_COLUMNS = (
    "Project",
    "StationName",
    "StationCode",
    "Latitude",
    "Longitude",
    "TripCode",
    "SampleTime_UTC",
    "SampleTime_Local",
    "Year_Local",
    "Month_Local",
    "Day_Local",
    "Time_Local24hr",
)
_SURFACE_COLUMNS = ("CTDSST_degC", "CTDChlaSurf_mgm3", "CTDSalinity_psu")


def _trip_map(c: Catalog, code: str, raw: str | None, depth: str, extra: tuple[str, ...]) -> DataFrame:
    """Trips sampled for ``code``, with CTD surface values if any: those that have raw rows, or all."""
    trips = c["bgc_trip_metadata"].filter(F.col("sampletype").contains(code))
    sampled = trips if raw is None else in_any(trips, "trip_code", [c[raw]])
    surface = c["nrs_ctd_surface_values"].select("trip_code", *_SURFACE_COLUMNS)
    return sampled.join(surface, "trip_code", "left").select(
        *_TRIP_COLUMNS,
        F.col(depth).alias("SampleDepth_m"),
        *_SURFACE_COLUMNS,
        *extra,
        "trip_code",
        "geom",
    )


@product("bgc_phytoplankton_map")
def bgc_phytoplankton_map(c: Catalog) -> DataFrame:
    return _trip_map(c, "P", "bgc_phyto_raw", "phytosampledepth_m", ())


@product("bgc_zooplankton_map")
def bgc_zooplankton_map(c: Catalog, raw: str | None = "bgc_zoop_raw") -> DataFrame:
    return _trip_map(c, "Z", raw, "zoopsampledepth_m", ("Biomass_mgm3", "AshFreeBiomass_mgm3"))


# Maps without the condition that a trip has raw rows, for products that read those rows anyway.
ALL_TRIPS = {"bgc_zooplankton_map": lambda c: bgc_zooplankton_map(c, None)}


# Tables whose trips make up the combined map.
LAB_TABLES = ("bgc_chemistry", "bgc_picoplankton", "bgc_pigments", "bgc_tss")


def lab_trips(c: Catalog) -> DataFrame:
    """All trips in the columns of the combined map.

    A row of a lab table always finds its trip in the combined map if it finds it here, so
    joins from those tables can skip working out which trips the map keeps.
    """
    return c["bgc_trip_metadata"].select(
        "Project",
        "StationName",
        "TripCode",
        F.to_date("SampleTime_UTC").alias("TripDate_UTC"),
        "Latitude",
        "Longitude",
        F.col("secchi_m").alias("SecchiDepth_m"),
        "trip_code",
        "geom",
    )


@product("combined_bgc_map")
def combined_bgc_map(c: Catalog) -> DataFrame:
    trips = lab_trips(c)
    return in_any(trips, "trip_code", [c[t] for t in LAB_TABLES]).select(*trips.columns)


def _sample_map(c: Catalog, code: str, raw: str, extra: list) -> DataFrame:
    """One row per sample and sampled volume."""
    # Raw rows shrink to distinct (sample, volume) before they meet the samples.
    volumes = c[raw].select("sample", F.col("sampvol_m3").alias("SampleVolume_m3")).distinct()
    samples = c["cpr_samp"].filter(F.col("sampletype").contains(code))
    return (
        samples.join(volumes, "sample")
        .select(
            F.col("trip_code").alias("TripCode"),
            F.col("sample").alias("Sample_ID"),
            F.col("region").alias("Region"),
            F.col("latitude").alias("Latitude"),
            F.col("longitude").alias("Longitude"),
            F.col("sampledateutc").alias("SampleTime_UTC"),
            *local_parts("sampledatelocal"),
            F.col("ghrsst_6d_degc").alias("SatSST_degC"),
            F.col("chloc3_mgm3").alias("SatChlaSurf_mgm3"),
            F.col("pci").alias("PCI"),
            *extra,
            "SampleVolume_m3",
            "trip_code",
            "sample",
            point_wkt("longitude", "latitude").alias("geom"),
        )
        .distinct()
    )


@product("cpr_phytoplankton_map")
def cpr_phytoplankton_map(c: Catalog) -> DataFrame:
    return _sample_map(c, "P", "cpr_phyto_raw", [])


@product("cpr_zooplankton_map")
def cpr_zooplankton_map(c: Catalog) -> DataFrame:
    return _sample_map(c, "Z", "cpr_zoop_raw", [F.col("biomass_mgm3").alias("BiomassIndex_mgm3")])
