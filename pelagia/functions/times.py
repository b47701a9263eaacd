"""Time and place columns shared by the metadata products."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import number_text

SRID = 4326


def stamp_text(c: str) -> Column:
    return F.date_format(F.col(c), "yyyy-MM-dd HH:mm:ss")


def local_parts(c: str) -> list[Column]:
    """The five published columns derived from a local sampling time."""
    t = F.col(c)
    return [
        stamp_text(c).alias("SampleTime_Local"),
        F.year(t).alias("Year_Local"),
        F.month(t).alias("Month_Local"),
        F.dayofmonth(t).alias("Day_Local"),
        F.date_format(t, "HH:mm").alias("Time_Local24hr"),
    ]


def utc_ntz(c: str) -> Column:
    """A stored instant as a zone-less UTC time (the session zone is UTC)."""
    return F.col(c).cast("timestamp_ntz")


def point_wkt(lon: str, lat: str) -> Column:
    """POINT text in SRID 4326; NULL if a coordinate is NULL."""
    return F.concat(
        F.lit("POINT("), number_text(lon), F.lit(" "), number_text(lat), F.lit(")")
    )


_NUM = r"-?\d+(\.\d+)?([eE][-+]?\d+)?"
_XY = rf"\(?\s*{_NUM}\s+{_NUM}\s*\)?"
MULTIPOINT = rf"(?i)^\s*MULTIPOINT\s*(EMPTY|\(\s*{_XY}(\s*,\s*{_XY})*\s*\))\s*$"


def is_multipoint(c: str) -> Column:
    return F.col(c).rlike(MULTIPOINT)
