"""Taxon products: raw, higher group, genus and species maps of both programmes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import (
    PHYTO_ABUNDANCE_MARKS,
    PHYTO_BIOVOLUME_MARKS,
    ZOOP_MARKS,
    binomial,
    identified_genus,
    identified_species,
)
from ..operators import taxa as op
from .catalog import PRODUCTS, Catalog
from .metadata import ALL_TRIPS

# Groups that are not counted as plankton of the product.
PHYTO_NOT_GROUPS = ("Other", "Coccolithophore", "Diatom", "Protozoa")
ZOOP_NOT_GROUPS = ("Other",)


@dataclass(frozen=True)
class NewGroups:
    """Higher groups first counted from a known date."""

    groups: tuple[str, ...]
    since: str
    methods: tuple[str, ...] = ()


# The built-in changelogs of the higher-group products.
BGC_PHYTO_GROUPS = NewGroups(
    ("Ciliate", "Silicoflagellate", "Radiozoa", "Foraminifera"), "2012-08-07", ("SEM", "LM")
)
BGC_ZOOP_GROUPS = NewGroups(("Ciliophora", "Foraminifera"), "2013-03-01")
CPR_PHYTO_GROUPS = NewGroups(("Ciliate", "Foraminifera"), "2013-03-01")
CPR_ZOOP_GROUPS = NewGroups(("Ciliate", "Foraminifera"), "2013-03-01")


@dataclass(frozen=True)
class Family:
    """What the products of one raw table and one measured value share."""

    prefix: str
    raw: str
    changelog: str
    meta: str
    key: str
    value: str
    out: str
    new_groups: NewGroups
    not_groups: tuple[str, ...]
    marks: tuple[str, ...]
    whole_species: bool = False
    method: str | None = None

    @property
    def keys(self) -> list[str]:
        return [self.key] + ([self.method] if self.method else [])


def _phyto(programme: str, measure: str, value: str, marks: tuple[str, ...]) -> Family:
    bgc = programme == "bgc"
    return Family(
        prefix=f"{programme}_phytoplankton_{measure}",
        raw=f"{programme}_phyto_raw",
        changelog=f"{programme}_phyto_changelog",
        meta=f"{programme}_phytoplankton_map",
        key="trip_code" if bgc else "sample",
        value=value,
        out="abundances" if measure == "abundance" else "biovolumes",
        new_groups=BGC_PHYTO_GROUPS if bgc else CPR_PHYTO_GROUPS,
        not_groups=PHYTO_NOT_GROUPS,
        marks=marks,
        whole_species=True,
        method="methods" if bgc else None,
    )


def _zoop(programme: str) -> Family:
    bgc = programme == "bgc"
    return Family(
        prefix=f"{programme}_zooplankton_abundance",
        raw=f"{programme}_zoop_raw",
        changelog=f"{programme}_zoop_changelog",
        meta=f"{programme}_zooplankton_map",
        key="trip_code" if bgc else "sample",
        value="zoop_abundance_m3",
        out="abundances",
        new_groups=BGC_ZOOP_GROUPS if bgc else CPR_ZOOP_GROUPS,
        not_groups=ZOOP_NOT_GROUPS,
        marks=ZOOP_MARKS,
    )


PHYTO = (
    _phyto("bgc", "abundance", "cell_l", PHYTO_ABUNDANCE_MARKS),
    _phyto("bgc", "biovolume", "biovolume_um3l", PHYTO_BIOVOLUME_MARKS),
    _phyto("cpr", "abundance", "phyto_abundance_m3", PHYTO_ABUNDANCE_MARKS),
    _phyto("cpr", "biovolume", "biovol_um3m3", PHYTO_BIOVOLUME_MARKS),
)
ZOOP = (_zoop("bgc"), _zoop("cpr"))


def _publish(c: Catalog, f: Family, found: op.Sightings, observed_only: bool = False) -> DataFrame:
    meta = c[f.meta]
    if f.method:
        return op.fill_gaps_by_method(
            meta, f.key, f.method, "SampleTime_UTC", found, f.out, observed_only
        )
    return op.fill_gaps(meta, f.key, "SampleTime_UTC", found, f.out)


# ---- cells: raw rows reduced once for all products of a raw table -------------------------

RAW, GROUP, GENUS = "raw", "group", "genus"
_COPEPODS = {"copepods": "COPEPOD", "non_copepods": "NON-COPEPOD"}


def _species_level(f: Family, copepod: str | None = None) -> str:
    """Species of the two measures are told by different marks, so they are levels of their own."""
    return f"species {f.out}" if copepod is None else f"species {copepod}"


def levels_of(f: Family) -> dict[str, op.Level]:
    """The levels of naming that a family's products show."""
    name = binomial("genus", "species", whole=f.whole_species)
    # The phytoplankton changelog is looked up under the simplified name.
    lookup = name if f.whole_species else F.col("taxon_name")
    known = identified_species("species", f.marks)
    kinds = [None] if f.whole_species else list(_COPEPODS.values())
    species = {
        _species_level(f, kind): op.Level(name, known if kind is None else known & (F.col("copepod") == kind), lookup, "name") for kind in kinds
    }
    return {
        RAW: op.Level(F.col("taxon_name")),
        GROUP: op.Level(F.col("taxon_group"), ~F.col("taxon_group").isin(*f.not_groups)),
        GENUS: op.Level(F.col("genus"), identified_genus("genus"), F.col("taxon_name"), "genus"),
        **species,
    }


def cells_name(raw: str) -> str:
    return f"{raw}_cells"


def all_cells(c: Catalog, raw: str) -> DataFrame:
    """The cells of all levels and measures of a raw table; the table is read once."""
    families = [f for f in (*PHYTO, *ZOOP) if f.raw == raw]
    levels = {n: v for f in families for n, v in levels_of(f).items()}
    values = list(dict.fromkeys(f.value for f in families))
    return op.level_cells(c[raw], c[families[0].changelog], families[0].keys, levels, values)


def cells(c: Catalog, f: Family, level: str) -> DataFrame:
    """The cells of one level: stored ones where a build has put them, else only what is asked."""
    if c.has(cells_name(f.raw)):
        return c[cells_name(f.raw)].filter(F.col("level") == level)
    chosen = levels_of(f)[level]
    changelog = c[f.changelog] if chosen.lookup is not None else None
    return op.level_cells(c[f.raw], changelog, f.keys, {level: chosen}, [f.value])


def sightings(c: Catalog, f: Family, level: str) -> op.Sightings:
    """What gap filling needs of one level: from stored cells, else from the raw rows."""
    if c.has(cells_name(f.raw)):
        return op.sightings_of(cells(c, f, level), f.keys, f.value)
    return op.sightings_of_level(c[f.raw], c[f.changelog], f.keys, levels_of(f)[level], f.value)


# ---- products ------------------------------------------------------------------------------


def raw_product(c: Catalog, f: Family) -> DataFrame:
    """Every raw taxon as observed; no gaps are filled."""
    maps = op.to_maps(cells(c, f, RAW), f.keys, "taxon", f"max_{f.value}", f.out)
    meta = c[f.meta]
    joined = meta.join(maps, f.key, "left")
    method = [F.col(f.method).alias("Method")] if f.method else []
    return joined.select(*meta.columns, *method, f.out)


def new_group_rows(c: Catalog, new: NewGroups) -> DataFrame:
    """The built-in changelog as rows (taxon[, methods], start)."""
    groups = F.array(*[F.lit(g) for g in new.groups])
    rows = c.spark.range(1).select(F.explode(groups).alias("taxon"), F.lit(new.since).cast("date").alias("start"))
    if new.methods:
        rows = rows.withColumn("methods", F.explode(F.array(*[F.lit(m) for m in new.methods])))
    return rows


def group_product(c: Catalog, f: Family) -> DataFrame:
    """Sums per higher taxonomic group; methods a trip did not use are left out."""
    meta = c[f.meta]
    if f.meta in ALL_TRIPS and not c.stored(f.meta) and not c.has(cells_name(f.raw)):
        # The raw rows say which trips are shown, and what was counted there: they are read once for both.
        rows = op.marked_rows(c[f.raw], f.keys, levels_of(f)[GROUP], f.value)
        found = op.Sightings(rows, new_group_rows(c, f.new_groups), marked=True)
        # Columns in the order of the map, with all trips.
        return op.fill_gaps(ALL_TRIPS[f.meta](c).select(*meta.columns), f.key, "SampleTime_UTC", found, f.out)
    found = op.Sightings(op.sightings_of(cells(c, f, GROUP), f.keys, f.value).rows, new_group_rows(c, f.new_groups))
    return _publish(c, f, found, observed_only=True)


def genus_sightings(c: Catalog, f: Family, combine: str = "max") -> op.Sightings:
    raw = c[f.raw].filter(identified_genus("genus"))
    return op.sightings_with_changelog(
        raw, c[f.changelog], f.keys, F.col("genus"), f.value, "genus", combine
    )


def genus_product(c: Catalog, f: Family) -> DataFrame:
    return _publish(c, f, sightings(c, f, GENUS))


def species_product(c: Catalog, f: Family, copepod: str | None = None) -> DataFrame:
    return _publish(c, f, sightings(c, f, _species_level(f, copepod)))


def raw_readers() -> dict[str, set[str]]:
    """Raw table -> the products that show its counts."""
    kinds = {f: ("raw", "htg", "genus", *(("species",) if f.whole_species else tuple(_COPEPODS))) for f in (*PHYTO, *ZOOP)}
    out: dict[str, set[str]] = {}
    for f, own in kinds.items():
        out.setdefault(f.raw, set()).update(f"{f.prefix}_{k}_data" for k in own)
    return out


def _register() -> None:
    for f in PHYTO:
        PRODUCTS[f"{f.prefix}_raw_data"] = lambda c, f=f: raw_product(c, f)
        PRODUCTS[f"{f.prefix}_htg_data"] = lambda c, f=f: group_product(c, f)
        PRODUCTS[f"{f.prefix}_genus_data"] = lambda c, f=f: genus_product(c, f)
        PRODUCTS[f"{f.prefix}_species_data"] = lambda c, f=f: species_product(c, f)
    for f in ZOOP:
        PRODUCTS[f"{f.prefix}_raw_data"] = lambda c, f=f: raw_product(c, f)
        PRODUCTS[f"{f.prefix}_htg_data"] = lambda c, f=f: group_product(c, f)
        PRODUCTS[f"{f.prefix}_genus_data"] = lambda c, f=f: genus_product(c, f)
        PRODUCTS[f"{f.prefix}_copepods_data"] = lambda c, f=f: species_product(c, f, "COPEPOD")
        PRODUCTS[f"{f.prefix}_non_copepods_data"] = lambda c, f=f: species_product(c, f, "NON-COPEPOD")


_register()
