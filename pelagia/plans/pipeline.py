"""Build every product in dependency order, one Parquet snapshot each."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..sources.placed import write_placed
from ..sources.snapshot import write_snapshot
from . import acoustic, ctd, fish, indices, metadata, taxa, water  # noqa: F401  (register products)
from .catalog import PRODUCTS, Catalog

# Views of the published set that are a projection, or read by one product only: recomputed
# on use. (The surface values are a view too, but three products read them.)
PLAIN_VIEWS = (
    "bgc_trip_metadata",
    "nrs_depth_binned_ctd_map",
    "animal_tracking_acoustic_qc_detection_map",
)


def build_order(catalog: Catalog, names: list[str] | None = None) -> list[str]:
    """The named products (or all) and the products they read, each after what it reads."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for read in sorted(catalog.reads(name)):
            if read in PRODUCTS:
                visit(read)
        order.append(name)

    for name in list(PRODUCTS) if names is None else names:
        visit(name)
    return order


def build(
    catalog: Catalog, out: str, names: list[str] | None = None, store_views: bool = False, buckets: int | None = None
) -> dict[str, DataFrame]:
    """Compute and store products under ``out/<name>``; dependants read the stored copy.

    Raw counts that several of the products show are reduced first, once for all of them, and
    stored by level of naming under ``out/<raw table>_cells``.

    With ``buckets`` the facts of the index products and what they are joined to are stored by
    key, in so many buckets, so that their joins move no rows; choose it so that a bucket of the
    largest fact fits a task.
    """
    built = {}
    order = build_order(catalog, names)
    for raw, readers in taxa.raw_readers().items():
        if len(readers & set(order)) > 1:
            cells = write_snapshot(taxa.all_cells(catalog, raw), f"{out}/{taxa.cells_name(raw)}", by="level")
            catalog.put(taxa.cells_name(raw), cells)
            for reader in readers & set(order):
                catalog.forget(reader)
    for name in order:
        if buckets and name in indices.STARS:
            key, base, facts = indices.STARS[name]
            for fact, make in {base: indices.BASES[base], **facts}.items():
                catalog.put(fact, write_placed(make(catalog), f"{out}/{fact}", key, buckets))
            catalog.forget(name)
        df = catalog[name]
        if store_views or name not in PLAIN_VIEWS:
            df = write_snapshot(df, f"{out}/{name}")
            catalog.put(name, df)
        built[name] = df
    return built
