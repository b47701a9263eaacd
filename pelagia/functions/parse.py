"""Text cells to declared types. Unreadable text becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^\s*[-+]?(\d+(\.\d*)?|\.\d+)([eE][-+]?\d+)?\s*$"
_INTEGER = r"^\s*[-+]?\d+\s*$"
# Values a number column may hold that mean "no number": accepted, stored as NULL.
NOT_A_NUMBER = ("NaN", "INF", "-INF")
_TRUE = ("true", "True", "TRUE", "1")
_FALSE = ("false", "False", "FALSE", "0")
_DAY = r"\d{4}-\d{1,2}-\d{1,2}"
_CLOCK = r"\d{1,2}:\d{1,2}:\d{1,2}"

# Notations tried, in order, for a date declared without a format.
_ANY_DATE = ("M/d/yyyy", "yyyy/M/d", "yyyyMMdd", "d MMM yyyy", "d-MMM-yyyy", "MMM d, yyyy")


def _cast_if(text: Column, shape: str, to: str) -> Column:
    return F.when(text.rlike(shape), text.try_cast(to))


def parse(text: Column, kind: str) -> Column:
    """Typed value of a text cell for a declared kind.

    The shape is checked first and then cast, which keeps zone-less times free of the
    session zone and rejects forms the cast alone would accept (``5d``, a bare year).
    """
    if kind == "string":
        return text
    if kind == "double":
        return _cast_if(text, _NUMBER, "double")
    if kind == "bigint":
        return _cast_if(text, _INTEGER, "bigint")
    if kind == "boolean":
        return F.when(text.isin(*_TRUE), True).when(text.isin(*_FALSE), False)
    if kind == "date":
        return _cast_if(text, rf"^{_DAY}$", "date")
    if kind == "datetime":
        return _cast_if(text, rf"^{_DAY} {_CLOCK}$", "timestamp_ntz")
    if kind == "datetime_t":
        return _cast_if(text, rf"^{_DAY}T{_CLOCK}$", "timestamp_ntz")
    if kind == "datetime_z":
        bare = F.regexp_replace(text, "Z$", "")
        return F.when(text.rlike(rf"^{_DAY} {_CLOCK}Z$"), bare.try_cast("timestamp_ntz"))
    if kind == "date_any":
        iso = F.when(text.rlike(rf"^{_DAY}([ T].*)?$"), F.substring_index(F.substring_index(text, " ", 1), "T", 1).try_cast("date"))
        other = [F.try_to_timestamp(text, F.lit(f)).cast("date") for f in _ANY_DATE]
        return F.coalesce(iso, *other)
    raise ValueError(f"unknown kind {kind}")


def readable(text: Column, kind: str) -> Column:
    """True when a non-NULL cell is acceptable text for its kind."""
    ok = parse(text, kind).isNotNull()
    return ok | text.isin(*NOT_A_NUMBER) if kind == "double" else ok
