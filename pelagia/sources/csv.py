"""Declared CSV tables: text scan, missing-value tokens, typed columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.parse import parse
from ..schemas import Table
from .records import largest_file, parsed, records

CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',  # a doubled quote stands for one quote
    "encoding": "UTF-8",
    # A quoted cell may hold line breaks. Spark then reads a file as one split, so larger files
    # are read by :mod:`.records` instead.
    "multiLine": "true",
    # Header names decide which column is which, so a file may order them freely.
    "enforceSchema": "false",
}


# Holds the text of a row with more or fewer cells than the header; NULL for all others.
ODD_ROW = "__row"


@dataclass(frozen=True)
class HeaderReport:
    missing: tuple[str, ...]
    extra: tuple[str, ...]

    @property
    def ok(self) -> bool:
        return not (self.missing or self.extra)


def header_of(spark: SparkSession, path: str, **options: str) -> list[str]:
    """Column names as written in the file; reads only the first line."""
    return spark.read.options(**{**CSV_OPTIONS, **options}).csv(path).columns


def check_header(names: list[str], spec: Table) -> HeaderReport:
    """Compare a header with the declared fields, ignoring case and skipped fields."""
    have = {n.lower() for n in names} - set(spec.skip)
    want = set(spec.columns)
    return HeaderReport(
        tuple(c for c in spec.columns if c not in have), tuple(sorted(have - want))
    )


def _split_bytes(spark: SparkSession) -> int:
    text = spark.conf.get("spark.sql.files.maxPartitionBytes").lower().removesuffix("b")
    unit = {"k": 10, "m": 20, "g": 30}.get(text[-1:], 0)
    return int(text.rstrip("kmg")) << unit


def scan_rows(spark: SparkSession, path: str, spec: Table, in_splits: bool | None = None, **options: str) -> DataFrame:
    """The file as text columns under the declared lower-case names, and its odd rows' text.

    Skipped fields are dropped, missing-value tokens become NULL, declared columns the
    file lacks are NULL, and columns nobody declared are left out. A row with too few or too
    many cells keeps what fits; its whole text stands in ``ODD_ROW``, for
    :func:`pelagia.operators.quality.row_faults`. Empty lines are no rows.

    ``in_splits`` reads a file by as many tasks as it has splits, whatever is quoted in it, and
    gives the same rows; if not set, files that are larger than a split are read so.
    """
    names = header_of(spark, path, **options)
    fields = [*names, ODD_ROW]
    text = T.StructType([T.StructField(n, T.StringType()) for n in fields])
    # Cells are only counted if all columns are parsed.
    counted = {"columnNameOfCorruptRecord": ODD_ROW, "columnPruning": "false"}
    if in_splits is None:
        in_splits = largest_file(spark, path) > _split_bytes(spark)
    if in_splits:
        chosen = {**CSV_OPTIONS, **options}
        raw = parsed(records(spark, path, chosen["quote"]), names, ODD_ROW, chosen)
    else:
        raw = spark.read.options(**{**CSV_OPTIONS, **counted, **options}).schema(text).csv(path)
    by_name = {n.lower(): n for n in names}
    tokens = [t for t in spec.missing if t != ""]

    def cell(name: str):
        if name not in by_name:
            return F.lit(None).cast("string").alias(name)
        value = F.col(f"`{by_name[name]}`")
        # The scan itself turns an empty cell into NULL.
        if tokens:
            value = F.when(~value.isin(*tokens), value)
        return value.alias(name)

    return raw.select(*[cell(c) for c in spec.columns], ODD_ROW)


def scan_text(spark: SparkSession, path: str, spec: Table, in_splits: bool | None = None, **options: str) -> DataFrame:
    """:func:`scan_rows` without the odd rows' text."""
    return scan_rows(spark, path, spec, in_splits, **options).drop(ODD_ROW)


def typed(text: DataFrame, spec: Table) -> DataFrame:
    """Cast a text frame to the declared types; unreadable cells become NULL."""
    return text.select(*[parse(F.col(f.name), f.kind).alias(f.name) for f in spec.fields])


def read_table(spark: SparkSession, path: str, spec: Table, in_splits: bool | None = None, **options: str) -> DataFrame:
    """A declared CSV table as a typed DataFrame."""
    return typed(scan_text(spark, path, spec, in_splits, **options), spec)
