"""Laboratory products: chemistry, pigments, picoplankton, suspended solids, and all combined."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import number_text, sample_id
from ..functions.times import stamp_text
from .catalog import Catalog, product
from .metadata import LAB_TABLES, lab_trips

COMBINED_PROJECT = "NRS"

# Lab column -> published name, in published order.
CHEMISTRY = {
    "salinity_psu": "Salinity",
    "salinity_flag": "Salinity_flag",
    "dic_umolkg": "DIC_umolkg",
    "carbon_flag": "DIC_flag",
    "talkalinity_umolkg": "Alkalinity_umolkg",
    "alkalinity_flag": "Alkalinity_flag",
    "oxygen_umoll": "Oxygen_umolL",
    "oxygen_flag": "Oxygen_flag",
    "ammonium_umoll": "Ammonium_umolL",
    "ammonium_flag": "Ammonium_flag",
    "nitrate_umoll": "Nitrate_umolL",
    "nitrate_flag": "Nitrate_flag",
    "nitrite_umoll": "Nitrite_umolL",
    "nitrite_flag": "Nitrite_flag",
    "phosphate_umoll": "Phosphate_umolL",
    "phosphate_flag": "Phosphate_flag",
    "silicate_umoll": "Silicate_umolL",
    "silicate_flag": "Silicate_flag",
}
MICROBIOME = {"microbiomesample_id": "AustralianMicrobiomeId"}

PIGMENTS = {
    "allo": "Allo_mgm3",
    "alpha_beta_car": "AlphaBetaCar_mgm3",
    "anth": "Anth_mgm3",
    "asta": "Asta_mgm3",
    "beta_beta_car": "BetaBetaCar_mgm3",
    "beta_epi_car": "BetaEpiCar_mgm3",
    "but_fuco": "Butfuco_mgm3",
    "cantha": "Cantha_mgm3",
    "cphl_a": "CphlA_mgm3",
    "cphl_b": "CphlB_mgm3",
    "cphl_c1": "CphlC1_mgm3",
    "cphl_c2": "CphlC2_mgm3",
    "cphl_c3": "CphlC3_mgm3",
    "cphl_c1c2": "CphlC1C2_mgm3",
    "cphlide_a": "CphlideA_mgm3",
    "diadchr": "Diadchr_mgm3",
    "diadino": "Diadino_mgm3",
    "diato": "Diato_mgm3",
    "dino": "Dino_mgm3",
    "dv_cphl_a_and_cphl_a": "DvCphlA+CphlA_mgm3",
    "dv_cphl_a": "DvCphlA_mgm3",
    "dv_cphl_b_and_cphl_b": "DvCphlB+CphlB_mgm3",
    "dv_cphl_b": "DvCphlB_mgm3",
    "echin": "Echin_mgm3",
    "fuco": "Fuco_mgm3",
    "gyro": "Gyro_mgm3",
    "hex_fuco": "Hexfuco_mgm3",
    "keto_hex_fuco": "Ketohexfuco_mgm3",
    "lut": "Lut_mgm3",
    "lyco": "Lyco_mgm3",
    "mg_dvp": "MgDvp_mgm3",
    "neo": "Neo_mgm3",
    "perid": "Perid_mgm3",
    "phide_a": "PhideA_mgm3",
    "phytin_a": "PhytinA_mgm3",
    "phytin_b": "PhytinB_mgm3",
    "pras": "Pras_mgm3",
    "pyrophide_a": "PyrophideA_mgm3",
    "pyrophytin_a": "PyrophytinA_mgm3",
    "viola": "Viola_mgm3",
    "zea": "Zea_mgm3",
    "pigments_flag": "Pigments_flag",
}

PICOPLANKTON = {
    "prochlorococcus_cellsml": "Prochlorococcus_cellsmL",
    "prochlorococcus_flag": "Prochlorococcus_flag",
    "synecochoccus_cellsml": "Synechococcus_cellsmL",
    "synecochoccus_flag": "Synechococcus_flag",
    "picoeukaryotes_cellsml": "Picoeukaryotes_cellsmL",
    "picoeukaryotes_flag": "Picoeukaryotes_flag",
}
PICOPLANKTON_REPLICATES = {
    "replicate": "Replicate",
    **PICOPLANKTON,
    "bacteria_cellsml": "Bacteria_cellsmL",
    "bacteria_flag": "Bacteria_flag",
    "virus_cellsml": "Virus_cellsmL",
    "virus_flag": "Virus_flag",
    "pico_comments": "PicoplankComments",
    "analysis_location": "AnalysisLocation",
    "analysis_date": "AnalysisDate",
    "analyst_name": "AnalystName",
    "temp_thawed_degc": "TempThawed_DegC",
    "internal_standard": "InternalStandard",
    "instrument_brand_model": "InstrumentBrandModel",
    "instrument_serial_number": "InstrumentSerialNumber",
    "laser_nm": "Laser_nm",
    "mode_type": "ModeType",
    "analysis_volume_ul": "AnalysisVolume_uL",
    "flow_rate_ul_per_min": "Flowrate_uLmin",
    "analysis_time_minutes": "AnalysisTime_min",
    "batch_comments": "BatchComments",
}

SOLIDS = {
    "organicfraction_mgl": "TSSorganic_mgL",
    "inorganicfraction_mgl": "TSSinorganic_mgL",
    "tss_mgl": "TSS_mgL",
    "tss_flag": "TSSall_flag",
}
SOLIDS_REPLICATES = {
    "replicate": "Replicate",
    **SOLIDS,
    "tss_comments": "TSScomments",
    "blankadjustavailable": "BlankAdjustAvailable",
}

TRIP_FRONT = ("Project", "StationName", "TripCode", "TripDate_UTC")
TRIP_PLACE = ("Latitude", "Longitude", "SecchiDepth_m")


def _renamed(names: dict[str, str]) -> list:
    return [F.col(f"`{raw}`").alias(public) for raw, public in names.items()]


def _lab_product(c: Catalog, table: str, names: dict[str, str], numeric_depth: bool = False) -> DataFrame:
    """Lab rows of one table under public names, with the metadata of their trip."""
    depth_text = number_text("sampledepth_m") if numeric_depth else F.col("sampledepth_m")
    lab = c[table].select(
        "trip_code",
        stamp_text("sampledatelocal").alias("SampleTime_Local"),
        sample_id("trip_code", depth_text).alias("SampleID"),
        F.col("sampledepth_m").alias("SampleDepth_m"),
        *_renamed(names),
    )
    own = [f"`{n}`" for n in names.values()]
    trips = lab_trips(c) if table in LAB_TABLES else c["combined_bgc_map"]
    return lab.join(trips, "trip_code").select(
        *TRIP_FRONT, "SampleTime_Local", *TRIP_PLACE, "SampleID", "SampleDepth_m", *own, "geom"
    )


@product("bgc_chemistry_data")
def chemistry_data(c: Catalog) -> DataFrame:
    return _lab_product(c, "bgc_chemistry", {**CHEMISTRY, **MICROBIOME}, numeric_depth=True)


@product("bgc_pigments_data")
def pigments_data(c: Catalog) -> DataFrame:
    return _lab_product(c, "bgc_pigments", PIGMENTS)


@product("bgc_picoplankton_data")
def picoplankton_data(c: Catalog) -> DataFrame:
    return _lab_product(c, "bgc_picoplankton_meta", PICOPLANKTON_REPLICATES)


@product("bgc_tss_data")
def suspended_solids_data(c: Catalog) -> DataFrame:
    return _lab_product(c, "bgc_tss_meta", SOLIDS_REPLICATES)


@product("combined_bgc_data")
def combined_data(c: Catalog) -> DataFrame:
    """All lab values of one project side by side, per trip and depth.

    Depth is text here, since two of the tables hold the word for 'whole column' in it;
    numeric chemistry depths take the same plain notation so that both sides can meet.
    The pairs are placed by trip while they are narrow and meet their trips first, so that no
    exchange carries the columns of all tables side by side.
    """
    trips = lab_trips(c).filter(F.col("Project") == COMBINED_PROJECT)

    def lab(table: str, names: dict[str, str], numeric_depth: bool = False) -> DataFrame:
        depth = number_text("sampledepth_m") if numeric_depth else F.col("sampledepth_m")
        tag = f"__time_{table}"
        return c[table].select(
            F.col("trip_code").alias("TripCode"),
            depth.alias("SampleDepth_m"),
            stamp_text("sampledatelocal").alias(tag),
            *_renamed(names),
        )

    labs = {
        "bgc_chemistry": lab("bgc_chemistry", {**CHEMISTRY, **MICROBIOME}, numeric_depth=True),
        "bgc_pigments": lab("bgc_pigments", PIGMENTS),
        "bgc_tss": lab("bgc_tss", SOLIDS),
        "bgc_picoplankton": lab("bgc_picoplankton", PICOPLANKTON),
    }
    pair = ["TripCode", "SampleDepth_m"]
    found = reduce(DataFrame.unionByName, [df.select(*pair) for df in labs.values()])
    out = found.repartition("TripCode").distinct().join(trips, "TripCode")
    for df in labs.values():
        out = out.join(df, pair, "left")
    times = [F.col(f"__time_{t}") for t in labs]
    columns = [
        *CHEMISTRY.values(),
        *SOLIDS.values(),
        *PICOPLANKTON.values(),
        *PIGMENTS.values(),
        *MICROBIOME.values(),
    ]
    return out.select(
        *TRIP_FRONT,
        F.coalesce(*times).alias("SampleTime_Local"),
        *TRIP_PLACE,
        "SampleDepth_m",
        sample_id("TripCode", F.col("SampleDepth_m")).alias("SampleID"),
        *[f"`{n}`" for n in columns],
        "geom",
    )
