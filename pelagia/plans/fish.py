"""Larval fish products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import local_parts, point_wkt
from ..operators.taxa import to_maps
from .catalog import Catalog, product


@product("bgc_larval_fish_map")
def larval_fish_map(c: Catalog) -> DataFrame:
    """Fish samples; temperature and salinity fall back to the CTD surface values."""
    surface = c["nrs_ctd_surface_values"].select("trip_code", "CTDSST_degC", "CTDSalinity_psu")
    return (
        c["bgc_lfish_samples"]
        .join(surface, "trip_code", "left")
        .select(
            F.col("projectname").alias("Project"),
            F.col("stationname").alias("StationName"),
            F.col("latitude").alias("Latitude"),
            F.col("longitude").alias("Longitude"),
            F.col("trip_code").alias("TripCode"),
            F.col("sampledateutc").alias("SampleTime_UTC"),
            *local_parts("sampledatelocal"),
            F.col("geardepth_m").alias("SampleDepth_m"),
            F.coalesce("temperature_c", "CTDSST_degC").alias("Temperature_degC"),
            F.coalesce("salinity_psu", "CTDSalinity_psu").alias("Salinity_psu"),
            F.col("sampvol_m3").alias("Volume_m3"),
            F.col("vessel").alias("Vessel"),
            F.col("towtype").alias("TowType"),
            F.col("gearmesh_um").alias("GearMesh_um"),
            F.col("depth_m").alias("Bathymetry_m"),
            F.col("qc_flag").alias("QC_flag"),
            "i_sample_id",
            point_wkt("longitude", "latitude").alias("geom"),
        )
    )


@product("bgc_larval_fish_count_raw_data")
def larval_fish_counts(c: Catalog) -> DataFrame:
    maps = to_maps(
        c["bgc_lfish_countraw"], ["i_sample_id"], "scientificname", "taxon_count", "abundances"
    )
    meta = c["bgc_larval_fish_map"]
    return meta.join(maps, "i_sample_id", "left").select(*meta.columns, "abundances")
