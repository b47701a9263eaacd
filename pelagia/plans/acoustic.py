"""Acoustic tracking: the detection file index as a map layer."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .catalog import Catalog, product


@product("animal_tracking_acoustic_qc_detection_map")
def detection_map(c: Catalog) -> DataFrame:
    """The index without its bookkeeping columns."""
    return c["detection_file_index"].select(
        "tag_deployment_id",
        "url",
        "size",
        "transmitter_id",
        "species",
        "species_scientific_name",
        "tagging_project",
        "time_coverage_start",
        "time_coverage_end",
        "geom",
    )
