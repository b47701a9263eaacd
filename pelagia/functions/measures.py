"""Guarded arithmetic and the ecological measures built from it.

Every division and logarithm is guarded, so one zero gives NULL in its own cell rather
than failing a whole product.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(top: Column, bottom: Column) -> Column:
    return top / F.nullif(bottom, F.lit(0))


def share_of_two(a: Column, b: Column) -> Column:
    """``a / (a + b)``; NULL when either class is absent."""
    return ratio(a, a + b)


def sum_if(condition: Column, value: Column) -> Column:
    """Sum over matching rows; NULL when none matches."""
    return F.sum(F.when(condition, value))


def avg_if(condition: Column, value: Column) -> Column:
    return F.avg(F.when(condition, value))


def ln_pos(x: Column) -> Column:
    """Natural logarithm of a positive number, else NULL."""
    return F.when(x > 0, F.ln(x))


def n_log_n(n: Column) -> Column:
    return n * ln_pos(n)


def shannon_counts(total: Column, sum_n_log_n: Column) -> Column:
    """Diversity from counts: ``ln N - sum(n ln n) / N``."""
    return ln_pos(total) - ratio(sum_n_log_n, total)


def shannon_shares(total: Column, positive: Column, sum_n_log_n: Column) -> Column:
    """Diversity ``-sum(p ln p)`` with ``p = n / total``, without forming the shares.

    Expanding the logarithm leaves three plain sums - all ``n``, the positive ``n`` and
    ``n ln n`` - so the group total never has to be joined back to its rows.
    """
    return ratio(ln_pos(total) * positive - sum_n_log_n, total)


def evenness(diversity: Column, kinds: Column) -> Column:
    """Pielou evenness ``H / ln S``; NULL for one kind or none."""
    return ratio(diversity, ln_pos(kinds))


# Carbon per cell = factor * (volume per cell) ** exponent.
CARBON_BY_GROUP = {
    "Dinoflagellate": (0.76, 0.819),
    "Ciliate": (0.22, 0.939),
}
CARBON_CYANOBACTERIA = 0.2
CARBON_DEFAULT = (0.288, 0.811)


def carbon_biomass(cells: Column, biovolume: Column, group: Column) -> Column:
    """Carbon content of counted cells from their volume and taxon group."""
    per_cell = ratio(biovolume, cells)

    def power_law(factor: float, exponent: float) -> Column:
        return cells * F.lit(factor) * F.pow(per_cell, F.lit(exponent))

    out = F.when(cells == 0, F.lit(0.0))
    for name, law in CARBON_BY_GROUP.items():
        out = out.when(group == name, power_law(*law))
    out = out.when(group == "Cyanobacteria", cells * F.lit(CARBON_CYANOBACTERIA))
    return out.otherwise(power_law(*CARBON_DEFAULT))


# Diet -> copepod feeding class.
DIET_CLASS = {"Carnivore": "CC", "Omnivore": "CO", "Herbivore": "CO"}


def diet_class(diet: Column) -> Column:
    """Recode a diet; anything else becomes NULL."""
    out = None
    for name, code in DIET_CLASS.items():
        out = F.when(diet == name, code) if out is None else out.when(diet == name, code)
    return out


def qc_masked(value: Column, flag: Column, bad: tuple[str, ...] = ("3", "4")) -> Column:
    """The value, or NULL where its flag is bad. A missing flag keeps the value."""
    return F.when(flag.isin(*bad), F.lit(None)).otherwise(value)
