"""CTD products: casts matched to trips, their depth rows, and surface values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import joined
from ..functions.times import utc_ntz
from ..operators.nearest import nearest_in_time
from ..operators.profile import surface_values
from .catalog import Catalog, product

PROJECT = "NRS"
# Station whose casts are filed under another site code.
SITE_OF_STATION = {"VBM": "VBM100"}

# Measured quantity -> (published value, published flag).
PUBLISHED = {
    "psal": ("Salinity_psu", "Salinity_flag"),
    "temp": ("Temperature_degC", "Temperature_flag"),
    "dox2": ("DissolvedOxygen_umolkg", "DissolvedOxygen_flag"),
    "cphl": ("Chla_mgm3", "Chla_flag"),
    "turb": ("Turbidity_NTU", "Turbidity_flag"),
    "cndc": ("Conductivity_Sm", "Conductivity_flag"),
    "dens": ("WaterDensity_kgm3", "WaterDensity_flag"),
}


def _site_code():
    out = joined("Project", "StationCode")
    for station, site in SITE_OF_STATION.items():
        out = F.when(F.col("StationCode") == station, site).otherwise(out)
    return out


@product("nrs_depth_binned_ctd_map")
def ctd_map(c: Catalog) -> DataFrame:
    """Each project trip with the cast nearest in time, within a day, at its site.

    The metadata row itself is matched, so nothing has to be joined back to it.
    """
    trips = c["bgc_trip_metadata"].filter(F.col("Project") == PROJECT).select(
        "Project",
        "StationName",
        "TripCode",
        "Latitude",
        "Longitude",
        "SampleTime_Local",
        "SampleTime_UTC",
        "trip_code",
        "geom",
        _site_code().alias("site_code"),
    )
    casts = c["deployments"].select(
        "site_code", "file_id", utc_ntz("time_coverage_start").alias("CastTimeUTC")
    )
    matched = nearest_in_time(trips, casts, "site_code", "SampleTime_UTC", "CastTimeUTC", "file_id")
    return matched.select(
        "Project",
        "StationName",
        "TripCode",
        "CastTimeUTC",
        "Latitude",
        "Longitude",
        "file_id",
        "SampleTime_Local",
        "SampleTime_UTC",
        "trip_code",
        "geom",
    )


@product("nrs_depth_binned_ctd_data")
def ctd_data(c: Catalog) -> DataFrame:
    rows = c["measurements"].select(
        "file_id",
        F.col("depth").alias("SampleDepth_m"),
        *[
            column
            for m in PUBLISHED
            for column in (
                F.col(m).alias(PUBLISHED[m][0]),
                F.col(f"{m}_quality_control").alias(PUBLISHED[m][1]),
            )
        ],
    )
    trips = c["nrs_depth_binned_ctd_map"]
    # Stated as columns of the map first, whichever side the join puts the key on.
    return trips.join(rows, "file_id").select(
        *trips.columns, *[x for x in rows.columns if x != "file_id"]
    )


@product("nrs_ctd_surface_values")
def ctd_surface_values(c: Catalog) -> DataFrame:
    return surface_values(
        c["nrs_depth_binned_ctd_data"],
        "trip_code",
        "SampleDepth_m",
        {
            "CTDSST_degC": ("Temperature_degC", "Temperature_flag"),
            "CTDChlaSurf_mgm3": ("Chla_mgm3", "Chla_flag"),
            "CTDSalinity_psu": ("Salinity_psu", "Salinity_flag"),
        },
    )
