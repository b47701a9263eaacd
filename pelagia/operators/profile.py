"""Measures read off a depth profile: surface values, reference level, mixed layer, chlorophyll maximum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.measures import avg_if, qc_masked
from .rows import first_per_group, lowest, salted_join

# Fixed values of the profile rules.
SURFACE_TARGET_M = 10
SURFACE_REACH_M = 5
SHALLOW_PREFIXES = ("DAR", "YON")
SHALLOW_REFERENCE_M = 5
REFERENCE_M = 10
TEMPERATURE_STEP = 0.4
SALINITY_STEP = 0.03
SURFACE_LAYER_M = 10


def surface_values(profile: DataFrame, key: str, depth: str, measures: dict[str, tuple[str, str]]) -> DataFrame:
    """Per key, the QC-masked row nearest 10 m, within 5 m to 15 m; the shallower on a tie.

    ``measures``: published name -> (value column, flag column).
    """
    d = F.col(depth)
    off = F.abs(d - SURFACE_TARGET_M)
    near = profile.filter((d >= SURFACE_TARGET_M - SURFACE_REACH_M) & (d <= SURFACE_TARGET_M + SURFACE_REACH_M))
    picked = first_per_group(near, [key], [off.asc(), d.asc()])
    return picked.select(
        key,
        depth,
        off.alias("depth_diff"),
        *[qc_masked(F.col(v), F.col(f)).alias(n) for n, (v, f) in measures.items()],
    )


def reference_depth(key: str) -> Column:
    return F.when(F.substring(key, 1, 3).isin(*SHALLOW_PREFIXES), SHALLOW_REFERENCE_M).otherwise(REFERENCE_M)


def reference_level(profile: DataFrame, key: str, depth: str, temperature: str, salinity: str, extra: dict[str, Column] | None = None
) -> DataFrame:
    """Per key: depth nearest the target level and the thresholds derived from it.

    ``extra`` aggregates ride along in the same pass over the profile.
    """
    extra = extra or {}
    off = F.abs(F.col(depth) - reference_depth(key))
    level = lowest(
        {"depth": F.col(depth), "t": F.col(temperature), "s": F.col(salinity)},
        off.isNull(),
        off,
        F.col(depth),
    )
    return profile.groupBy(key).agg(level.alias("__ref"), *[a.alias(n) for n, a in extra.items()]).select(
        key,
        F.col("__ref.depth").alias("ref_depth"),
        (F.col("__ref.t") - TEMPERATURE_STEP).alias("ref_temp"),
        (F.col("__ref.s") - SALINITY_STEP).alias("ref_sal"),
        *extra,
    )


def surface_means(depth: str, measures: dict[str, str]) -> dict[str, Column]:
    """Averages over the top 10 m, as aggregates; no quality control applied."""
    top = F.col(depth) < SURFACE_LAYER_M
    return {n: avg_if(top, F.col(v)) for n, v in measures.items()}


def below_reference(
    profile: DataFrame, levels: DataFrame, key: str, depth: str, temperature: str, salinity: str, chlorophyll: str,
    skip_null_chlorophyll: bool = False, keep_all: bool = False,
) -> DataFrame:
    """Per key, below the reference depth: mixed-layer depths and the chlorophyll maximum.

    All three picks share one join and one aggregate, and what else ``levels`` holds per key is
    carried through both, so no level is computed twice. Keys with nothing below their level are
    left out, or have NULL picks with ``keep_all``. A NULL difference sorts last; a NULL
    chlorophyll sorts *first*, as the published product has it, unless it is skipped.
    """
    d = F.col(depth)
    carried = [c for c in levels.columns if c not in (key, "ref_depth", "ref_temp", "ref_sal")]
    rows = salted_join(profile.select(key, depth, temperature, salinity, chlorophyll), levels, key, salts=4)
    below = d > F.col("ref_depth")
    if not keep_all:
        rows = rows.filter(below)
    dt = F.abs(F.col(temperature) - F.col("ref_temp"))
    ds = F.abs(F.col(salinity) - F.col("ref_sal"))
    chl = F.col(chlorophyll)
    null_rank = chl.isNull() if skip_null_chlorophyll else chl.isNotNull()
    return rows.groupBy(key).agg(
        lowest({"d": d}, dt.isNull(), dt, where=below)["d"].alias("MLDtemp_m"),
        lowest({"d": d}, ds.isNull(), ds, where=below)["d"].alias("MLDsal_m"),
        lowest({"d": d}, null_rank, -chl, where=below)["d"].alias("DCM_m"),
        *[F.first(c).alias(c) for c in carried],
    )
