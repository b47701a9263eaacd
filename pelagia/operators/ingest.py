"""Ingest and validation in one scan of the landing.

A landed table is read once. Its rows are stored typed, each with the faults of its own cells in a
column that readers of the table leave out, so it costs them nothing. Counts by rule are taken
while the rows are written. Fault rows, keys and links are then read from the stored columns that
they need; the landing and its text are not touched again.
"""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.parse import parse
from ..schemas import LINKS, Table
from ..sources.csv import header_of, scan_rows
from ..sources.snapshot import write_snapshot
from .quality import cell_rules, header_faults, key_text, keys_of, links_faults, odd_row_rule, shaped, unique_faults

#: The column of a stored table that holds the faults of a row's cells.
FAULTS = "__faults"
RULES = ("required", "type-error", "pattern", "pattern-warning", "range-warning", "extra-cell", "missing-cell")


def checked(text: DataFrame, spec: Table, width: int) -> DataFrame:
    """Rows of a scan as typed columns, and ``FAULTS``: what is wrong with each row, most often nothing."""
    found = F.array_compact(F.array(*[r for f in spec.fields for r in cell_rules(f)], odd_row_rule(width)))
    told = F.transform(found, lambda f: f.withField("key", key_text(spec.key)))
    return text.select(*[parse(F.col(f.name), f.kind).alias(f.name) for f in spec.fields], told.alias(FAULTS))


def _tally() -> list[Column]:
    def of(rule: str) -> Column:
        return F.coalesce(F.sum(F.size(F.filter(FAULTS, lambda f: f["rule"] == rule))), F.lit(0)).alias(rule)

    return [F.count(F.lit(1)).alias("rows"), *[of(r) for r in RULES]]


@dataclass(frozen=True)
class Ingested:
    """``table`` without its faults, ``faults`` of cells, rows, header and keys, and what was
    counted while it was written: its rows, and its faults by rule."""

    table: DataFrame
    faults: DataFrame
    counted: dict[str, int]


def ingest_checked(spark: SparkSession, landing: str, out: str, spec: Table, **options: str) -> Ingested:
    """Store the CSV at ``landing`` typed under ``out`` and validate it with the same scan."""
    names = header_of(spark, landing, **options)
    seen = Observation(f"ingest of {spec.name}")
    rows = checked(scan_rows(spark, landing, spec, **options), spec, len(names))
    stored = write_snapshot(rows.observe(seen, *_tally()), out)
    told = stored.filter(F.size(FAULTS) > 0).select(F.explode(FAULTS).alias("f")).select("f.rule", "f.column", "f.key", "f.value", F.lit(1).alias("n"))
    faults = [shaped(told, spec.name), header_faults(spark, names, spec)]
    faults += [unique_faults(stored.select(*key), spec.name, key, rule) for key, rule in keys_of(spec).items()]
    return Ingested(stored.drop(FAULTS), reduce(DataFrame.unionByName, faults), dict(seen.get))


def ingest_all(spark: SparkSession, landing: str, out: str, specs: Mapping[str, Table], **options: str) -> tuple[dict[str, Ingested], DataFrame]:
    """Ingest ``landing/<table>.csv`` for each table; the faults are those of all tables and of
    the declared links between them. Tables are independent, so their jobs run together."""

    def one(name: str) -> Ingested:
        return ingest_checked(spark, f"{landing}/{name}.csv", f"{out}/{name}", specs[name], **options)

    with ThreadPoolExecutor(max(1, len(specs))) as pool:
        found = dict(zip(specs, pool.map(one, specs)))
    links = [(child, column, parent, key) for child, column, parent, key in LINKS if child in found and parent in found]
    faults = [x.faults for x in found.values()]
    if links:
        faults.append(links_faults({n: x.table for n, x in found.items()}, links))
    return found, reduce(DataFrame.unionByName, faults)
