"""Per-key abundance, diversity and biomass indices from raw taxon counts.

Each programme's raw table is read once. A first aggregate goes to (key, species) and a
second to the key; every index is a function of the sums those leave, so no group total is
joined back to its rows and no distinct count needs rows expanded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import measures as M
from ..functions.text import (
    PHYTO_INDEX_MARKS,
    ZOOP_MARKS,
    binomial,
    identified_species,
    lacks,
)
from .rows import salted_join


def zooplankton_indices(raw: DataFrame, info: DataFrame, key: str) -> DataFrame:
    """Zooplankton totals and copepod indices per key.

    A species whose counts sum to zero counts as a species but adds nothing to diversity.
    """
    lengths = info.select("taxon_name", "length_mm", M.diet_class(F.col("diet")).alias("diet"))
    copepod = F.col("copepod") == "COPEPOD"
    amount = F.col("zoop_abundance_m3")
    named = F.coalesce(copepod & identified_species("species", ZOOP_MARKS), F.lit(False))
    per_species = (
        salted_join(raw, lengths, "taxon_name", how="left")
        .groupBy(
            key,
            named.alias("named"),
            F.when(named, binomial("genus", "species")).alias("species"),
        )
        .agg(
            F.sum(amount).alias("all"),
            M.sum_if(copepod, amount).alias("cope"),
            M.sum_if(copepod, amount * F.col("length_mm")).alias("cope_len"),
            M.sum_if(copepod & (F.col("diet") == "CC"), amount).alias("cc"),
            M.sum_if(copepod & (F.col("diet") == "CO"), amount).alias("co"),
            M.sum_if(named, F.col("taxon_count")).alias("n"),
        )
    )
    n = F.nullif(F.col("n"), F.lit(0))
    per_key = per_species.groupBy(key).agg(
        F.sum("all").alias("ZoopAbundance_m3"),
        F.sum("cope").alias("CopeAbundance_m3"),
        F.sum("cope_len").alias("cope_len"),
        F.sum("cc").alias("cc"),
        F.sum("co").alias("co"),
        F.sum(F.when(F.col("named"), 1)).alias("NoCopepodSpecies_Sample"),
        F.sum(n).alias("total"),
        F.sum(M.n_log_n(n)).alias("nlogn"),
    )
    diversity = M.shannon_counts(F.col("total"), F.col("nlogn"))
    return per_key.select(
        key,
        "ZoopAbundance_m3",
        "CopeAbundance_m3",
        M.ratio(F.col("cope_len"), F.col("CopeAbundance_m3")).alias("AvgTotalLengthCopepod_mm"),
        M.share_of_two(F.col("co"), F.col("cc")).alias("OmnivoreCarnivoreCopepodRatio"),
        "NoCopepodSpecies_Sample",
        diversity.alias("ShannonCopepodDiversity"),
        M.evenness(diversity, F.col("NoCopepodSpecies_Sample")).alias("CopepodEvenness"),
    )


def phytoplankton_indices(
    raw: DataFrame, key: str, cells: str, biovolume: str, carbon_name: str, abundance_name: str
) -> DataFrame:
    """Phytoplankton totals, biomass and diversity per key, for all, diatoms and dinoflagellates."""
    group, count, volume = F.col("taxon_group"), F.col(cells), F.col(biovolume)
    species = F.col("species")
    unnamed = (species == "spp.") | ~lacks(species, *PHYTO_INDEX_MARKS)
    classes = {
        "All": F.lit(True),
        "Diatom": group.endswith("diatom"),
        "Dino": group == "Dinoflagellate",
    }
    per_species = (
        raw.filter(group != "Other")
        .groupBy(
            key,
            F.when(unnamed, F.lit(None)).otherwise(binomial("genus", "species")).alias("species"),
        )
        .agg(
            F.sum(M.carbon_biomass(count, volume, group)).alias("carbon"),
            F.sum(volume).alias("volume"),
            *[M.sum_if(c, count).alias(f"n{k}") for k, c in classes.items()],
            *[F.max(F.when(c, True)).alias(f"has{k}") for k, c in classes.items()],
        )
    )
    named = F.col("species").isNotNull()
    sums = []
    for k in classes:
        n = F.when(named, F.col(f"n{k}"))
        sums += [
            F.sum(f"n{k}").alias(f"all{k}"),
            F.count(F.when(named & F.col(f"has{k}"), 1)).alias(f"kinds{k}"),
            F.sum(n).alias(f"named{k}"),
            F.sum(F.when(n > 0, n)).alias(f"pos{k}"),
            F.sum(M.n_log_n(n)).alias(f"nlogn{k}"),
        ]
    per_key = per_species.groupBy(key).agg(
        F.sum("carbon").alias(carbon_name), F.sum("volume").alias("volume"), *sums
    )

    def block(k: str, count_name: str, diversity_name: str, even_name: str):
        h = M.shannon_shares(F.col(f"named{k}"), F.col(f"pos{k}"), F.col(f"nlogn{k}"))
        return [
            F.col(f"kinds{k}").alias(count_name),
            h.alias(diversity_name),
            M.evenness(h, F.col(f"kinds{k}")).alias(even_name),
        ]

    return per_key.select(
        key,
        carbon_name,
        F.col("allAll").alias(abundance_name),
        M.share_of_two(F.col("allDiatom"), F.col("allDino")).alias("DiatomDinoflagellateRatio"),
        M.ratio(F.col("volume"), F.col("allAll")).alias("AvgCellVol_um3"),
        *block("All", "NoPhytoSpecies_Sample", "ShannonPhytoDiversity", "PhytoEvenness"),
        *block("Diatom", "NoDiatomSpecies_Sample", "ShannonDiatomDiversity", "DiatomEvenness"),
        *block("Dino", "NoDinoSpecies_Sample", "ShannonDinoDiversity", "DinoflagellateEvenness"),
    )


def shares_of_total(df: DataFrame, key: str, item: str, value: str) -> DataFrame:
    """Each item's share of its key's total, from one row per (key, item)."""
    items = df.groupBy(key, item).agg(F.sum(value).alias("__v"))
    totals = items.groupBy(key).agg(F.sum("__v").alias("__total"))
    return salted_join(items, totals, key).select(
        key, item, M.ratio(F.col("__v"), F.col("__total")).alias("share")
    )
