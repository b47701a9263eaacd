"""Declared tables, the links between them, and the groups they are published in."""

from . import acoustic, bgc, cpr, ctd
from .spec import Field, Table

TABLES: dict[str, Table] = {
    t.name: t for t in (*bgc.TABLES, *cpr.TABLES, *acoustic.TABLES, *ctd.TABLES)
}

# Fixed values: (child table, column, parent table, parent key).
LINKS: tuple[tuple[str, str, str, str], ...] = (
    ("bgc_chemistry", "trip_code", "bgc_trip", "trip_code"),
    ("bgc_lfish_countraw", "i_sample_id", "bgc_lfish_samples", "i_sample_id"),
    ("bgc_phyto_raw", "trip_code", "bgc_trip", "trip_code"),
    ("bgc_picoplankton", "trip_code", "bgc_trip", "trip_code"),
    ("bgc_picoplankton_meta", "trip_code", "bgc_trip", "trip_code"),
    ("bgc_pigments", "trip_code", "bgc_trip", "trip_code"),
    ("bgc_tss", "trip_code", "bgc_trip", "trip_code"),
    ("bgc_tss_meta", "trip_code", "bgc_trip", "trip_code"),
    ("bgc_zoop_raw", "trip_code", "bgc_trip", "trip_code"),
    ("cpr_phyto_raw", "sample", "cpr_samp", "sample"),
    ("cpr_zoop_raw", "sample", "cpr_samp", "sample"),
)

# Published group -> tables delivered together.
PRODUCT_GROUPS: dict[str, tuple[str, ...]] = {
    "bgc_plankton": (
        "bgc_trip",
        "bgc_phyto_changelog",
        "bgc_phyto_raw",
        "bgc_zoop_changelog",
        "bgc_zoop_raw",
    ),
    "bgc_combined": (
        "bgc_chemistry",
        "bgc_picoplankton",
        "bgc_picoplankton_meta",
        "bgc_pigments",
        "bgc_tss",
        "bgc_tss_meta",
    ),
    "bgc_lfish": ("bgc_lfish_countraw", "bgc_lfish_samples"),
    "derived_indices": ("phytoinfo", "zoopinfo"),
    "cpr": (
        "cpr_samp",
        "cpr_phyto_changelog",
        "cpr_phyto_raw",
        "cpr_zoop_changelog",
        "cpr_zoop_raw",
    ),
}

__all__ = ["LINKS", "PRODUCT_GROUPS", "TABLES", "Field", "Table"]
