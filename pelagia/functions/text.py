"""Text helpers with the NULL behaviour the products need."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_word(c: Column | str) -> Column:
    """Leading run of word characters, or NULL when the text starts with anything else.

    ``(?U)`` makes the word class Unicode-aware, so accented names stay whole.
    """
    return F.regexp_substr(_col(c), F.lit(r"(?U)^\w+"))


def joined(*parts: Column | str) -> Column:
    """Concatenate, skipping NULL parts."""
    return F.concat_ws("", *[_col(p) for p in parts])


def number_text(c: Column | str) -> Column:
    """Plain decimal text of a number: no exponent, no trailing zeros (10.0 -> '10').

    Used wherever a number becomes part of an identifier or is matched against text.
    """
    value = _col(c).cast("double")
    shortest = value.cast("string")
    # Java prints a double in scientific notation outside [1e-3, 1e7).
    plain = F.when(
        shortest.contains("E"), shortest.cast("decimal(38,12)").cast("string")
    ).otherwise(shortest)
    return F.when(
        plain.contains("."), F.regexp_replace(plain, r"\.?0+$", "")
    ).otherwise(plain)


def sample_id(key: Column | str, depth: Column | str) -> Column:
    """``key_depth`` identifier; a NULL part is left out. ``depth`` must be text."""
    return joined(key, F.lit("_"), depth)


def lacks(c: Column | str, *marks: str) -> Column:
    """True when none of ``marks`` occurs in the text (NULL text gives NULL)."""
    text = _col(c)
    out = ~text.contains(marks[0])
    for mark in marks[1:]:
        out = out & ~text.contains(mark)
    return out


# Marks in a species name that mean "not identified to species". The sets
# differ between products and must not be merged.
ZOOP_MARKS = ("cf.", "/", "grp", "complex")
PHYTO_ABUNDANCE_MARKS = ("cf.", "/", "complex", "type", "group", "cyst")
PHYTO_BIOVOLUME_MARKS = ("cf.", "/", "complex", "type", "cyst")
PHYTO_INDEX_MARKS = PHYTO_BIOVOLUME_MARKS


def identified_species(species: Column | str, marks: tuple[str, ...]) -> Column:
    """Filter predicate: a species was named, is not 'spp.', and carries no mark."""
    s = _col(species)
    return s.isNotNull() & (s != "spp.") & lacks(s, *marks)


def identified_genus(genus: Column | str) -> Column:
    return _col(genus).isNotNull() & lacks(genus, "cf.")


def binomial(genus: Column | str, species: Column | str, whole: bool = False) -> Column:
    """Genus and species as one name; NULL if either part is NULL.

    ``whole`` keeps the full species text, otherwise only its first word counts.
    """
    tail = _col(species) if whole else first_word(species)
    return F.concat(_col(genus), F.lit(" "), tail)
