"""Data-quality rules as distributed checks.

Every rule yields rows of one shape: (table, rule, column, key, value, n), where ``n`` is the
number of faults the row stands for. Cell rules cost one narrow pass and no shuffle; key
rules count on the map side first, so a key repeated without end is one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.parse import parse, readable
from ..functions.text import joined
from ..schemas import LINKS, Field, Table
from ..sources.csv import ODD_ROW, check_header

WARNING_RULES = ("range-warning", "pattern-warning", "volume-warning")
SHOWN = 5
FAULT_COLUMNS = ("table", "rule", "column", "key", "value", "n")


def _fault(rule: str, column: str, value: Column) -> Column:
    return F.struct(
        F.lit(rule).alias("rule"), F.lit(column).alias("column"), value.cast("string").alias("value")
    )


def key_text(key: tuple[str, ...]) -> Column:
    if not key:
        return F.lit(None).cast("string")
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in key]
    return F.concat_ws("|", *parts)


def _whole(pattern: str) -> str:
    return pattern if pattern.endswith("$") else pattern + "$"


def cell_rules(f: Field) -> list[Column]:
    """The rules of one field over its *text* column; each is a fault struct or NULL."""
    text = F.col(f.name).cast("string")
    rules = []
    if f.required:
        rules.append(F.when(text.isNull(), _fault("required", f.name, text)))
    if f.kind != "string":
        wrong = text.isNotNull() & ~readable(text, f.kind)
        rules.append(F.when(wrong, _fault("type-error", f.name, text)))
    if f.pattern:
        rules.append(F.when(~text.rlike(_whole(f.pattern)), _fault("pattern", f.name, text)))
    if f.soft_pattern:
        rules.append(F.when(~text.rlike(_whole(f.soft_pattern)), _fault("pattern-warning", f.name, text)))
    if f.minimum is not None or f.maximum is not None:
        number = parse(text, f.kind)
        outside = F.lit(False)
        if f.minimum is not None:
            outside = outside | (number < f.minimum)
        if f.maximum is not None:
            outside = outside | (number > f.maximum)
        rules.append(F.when(outside, _fault("range-warning", f.name, text)))
    return rules


def cell_faults(text: DataFrame, spec: Table) -> DataFrame:
    """Required, type, pattern and range faults, all rules in one pass over the rows."""
    rules = [r for f in spec.fields for r in cell_rules(f)]
    if not rules:
        return shaped(text.limit(0).select(F.lit("").alias("rule"), F.lit("").alias("column"), F.lit("").alias("key"), F.lit("").alias("value"), F.lit(1).alias("n")), spec.name)
    found = text.select(
        key_text(spec.key).alias("key"), F.explode(F.array_compact(F.array(*rules))).alias("f")
    )
    return shaped(found.select("f.rule", "f.column", "key", "f.value", F.lit(1).alias("n")), spec.name)


def shaped(df: DataFrame, table: str) -> DataFrame:
    return df.select(F.lit(table).alias("table"), "rule", "column", "key", "value", F.col("n").cast("bigint").alias("n"))


def unique_faults(df: DataFrame, table: str, key: tuple[str, ...], rule: str = "primary-key") -> DataFrame:
    """One row per repeated key; ``n`` counts the rows after the first.

    A key with a NULL part is no key; the required rule reports it.
    """
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    repeated = df.filter(whole).groupBy(*key).agg(F.count("*").alias("rows")).filter("rows > 1")
    return shaped(
        repeated.select(
            F.lit(rule).alias("rule"),
            F.lit(",".join(key)).alias("column"),
            key_text(key).alias("key"),
            F.col("rows").cast("string").alias("value"),
            (F.col("rows") - 1).alias("n"),
        ),
        table,
    )


def link_faults(
    child: DataFrame, parent: DataFrame, table: str, column: str, parent_key: str, parent_table: str
) -> DataFrame:
    """One row per child value without a parent; ``n`` counts its rows. NULL passes.

    Child values are counted before the join, so a popular value crosses the network once
    per task and the join sees each value once.
    """
    values = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    keys = parent.select(F.col(parent_key).alias(column)).distinct()
    orphans = values.join(keys, column, "left_anti")
    return shaped(
        orphans.select(
            F.lit("foreign-key").alias("rule"),
            F.lit(column).alias("column"),
            F.col(column).cast("string").alias("key"),
            F.lit(parent_table).alias("value"),
            F.col("rows").alias("n"),
        ),
        table,
    )


def header_faults(spark: SparkSession, names: list[str], spec: Table) -> DataFrame:
    """Missing and extra columns of a header, as fault rows."""
    report = check_header(names, spec)
    rows = [("missing-field", c) for c in report.missing] + [("extra-field", c) for c in report.extra]
    listed = spark.createDataFrame([(r, c, None, c, 1) for r, c in rows], "rule string, column string, key string, value string, n bigint")
    return shaped(listed, spec.name)


def _cells() -> Column:
    """Number of cells of an odd row, separators inside quotes aside."""
    bare = F.regexp_replace(ODD_ROW, r'"(?:[^"]|"")*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","))) + 1


def odd_row_rule(width: int) -> Column:
    """A fault struct for a row of a scan with more or fewer cells than ``width``, or NULL."""
    rule = F.when(_cells() > width, "extra-cell").otherwise("missing-cell")
    fault = F.struct(rule.alias("rule"), F.lit(None).cast("string").alias("column"), _cells().cast("string").alias("value"))
    return F.when(F.col(ODD_ROW).isNotNull(), fault)


def row_faults(rows: DataFrame, spec: Table, width: int) -> DataFrame:
    """Rows of a scan with more or fewer cells than the header's ``width``, one fault each.

    ``value`` is the number of cells found, separators inside quotes aside.
    """
    found = rows.filter(F.col(ODD_ROW).isNotNull()).select(odd_row_rule(width).alias("f"), key_text(spec.key).alias("key"))
    return shaped(found.select("f.rule", "f.column", "key", "f.value", F.lit(1).alias("n")), spec.name)


def volume_faults(raw: DataFrame, table: str) -> DataFrame:
    """Samples with more than one sampled volume: their product rows repeat."""
    volumes = raw.groupBy("sample").agg(
        F.min("sampvol_m3").alias("low"), F.max("sampvol_m3").alias("high")
    )
    return shaped(
        volumes.filter("low < high").select(
            F.lit("volume-warning").alias("rule"),
            F.lit("sampvol_m3").alias("column"),
            F.col("sample").alias("key"),
            joined(F.col("low").cast("string"), F.lit(" to "), F.col("high").cast("string")).alias("value"),
            F.lit(1).alias("n"),
        ),
        table,
    )


def keys_of(spec: Table) -> dict[tuple[str, ...], str]:
    """The columns that must not repeat, and the rule that says so."""
    keyed = {(f.name,): "unique" for f in spec.fields if f.unique and (f.name,) != spec.key}
    return keyed | ({spec.key: "primary-key"} if spec.key else {})


def table_faults(text: DataFrame, spec: Table) -> DataFrame:
    """All single-table rules: cells, primary key, unique columns.

    Keys are compared by typed value, so '1' and '01' of an integer key are the same key.
    """
    faults = [cell_faults(text, spec)]
    for key, rule in keys_of(spec).items():
        values = text.select(*[parse(F.col(k).cast("string"), spec[k].kind).alias(k) for k in key])
        faults.append(unique_faults(values, spec.name, key, rule))
    return reduce(DataFrame.unionByName, faults)


def links_faults(tables: Mapping[str, DataFrame], links: Sequence[tuple[str, str, str, str]]) -> DataFrame:
    """Faults of many links (child table, column, parent table, key) in one shuffle.

    Each table is read once and gives its values under every link that it is a side of. One
    aggregate per (link, value) tells how many child rows there are and whether a parent is;
    partial sums make a popular value one row per task. NULL passes.
    """
    sides: dict[str, list[Column]] = {}
    for n, (child, column, parent, key) in enumerate(links):
        for table, name, rows, there in ((child, column, 1, 0), (parent, key, 0, 1)):
            value = F.col(name).cast("string").alias("value")
            sides.setdefault(table, []).append(F.struct(F.lit(n).alias("link"), value, F.lit(rows).alias("rows"), F.lit(there).alias("there")))
    tagged = [tables[t].select(F.explode(F.array(*entries)).alias("e")).select("e.*").filter("value IS NOT NULL") for t, entries in sides.items()]
    met = reduce(DataFrame.unionByName, tagged).groupBy("link", "value").agg(F.sum("rows").alias("rows"), F.max("there").alias("there"))
    names = F.array(*[F.struct(F.lit(c).alias("child"), F.lit(k).alias("column"), F.lit(p).alias("parent")) for c, k, p, _ in links])
    orphans = met.filter("rows > 0 AND there = 0").select(F.element_at(names, F.col("link") + 1).alias("of"), "value", "rows")
    return orphans.select(
        F.col("of.child").alias("table"),
        F.lit("foreign-key").alias("rule"),
        F.col("of.column").alias("column"),
        F.col("value").alias("key"),
        F.col("of.parent").alias("value"),
        F.col("rows").cast("bigint").alias("n"),
    )


def all_link_faults(tables: Mapping[str, DataFrame]) -> DataFrame | None:
    """Foreign-key faults for every declared link whose two tables are at hand."""
    links = [(child, column, parent, key) for child, column, parent, key in LINKS if child in tables and parent in tables]
    return links_faults(tables, links) if links else None


def message() -> Column:
    """A fault as one line of text."""
    cell = F.coalesce(F.col("value"), F.lit("NULL"))
    return F.concat(F.col("rule"), F.lit(' in "'), F.col("column"), F.lit('": '), cell)


def report(faults: DataFrame, tables: DataFrame, shown: int = SHOWN) -> DataFrame:
    """Per table: valid or not, number of errors and warnings, and the first few messages.

    ``tables`` lists the checked tables in a column ``table``, so clean ones appear too. Only
    ``shown`` faults per table leave each task, whatever the number of faults.
    """
    warning = F.col("rule").isin(*WARNING_RULES)
    counts = faults.groupBy("table").agg(
        F.sum(F.when(~warning, F.col("n"))).alias("errors"),
        F.sum(F.when(warning, F.col("n"))).alias("warnings"),
    )
    order = Window.partitionBy("table").orderBy("rule", "column", F.asc_nulls_last("key"), F.asc_nulls_last("value"))
    first = (
        faults.filter(~warning)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= shown)
        .groupBy("table")
        .agg(F.array_sort(F.collect_list(F.struct("rank", message().alias("m")))).alias("top"))
        .select("table", F.transform("top", lambda t: t["m"]).alias("messages"))
    )
    return (
        tables.select("table")
        .join(counts, "table", "left")
        .join(first, "table", "left")
        .select(
            "table",
            (F.coalesce("errors", F.lit(0)) == 0).alias("valid"),
            F.coalesce("errors", F.lit(0)).cast("bigint").alias("errors"),
            F.coalesce("warnings", F.lit(0)).cast("bigint").alias("warnings"),
            F.coalesce("messages", F.array().cast("array<string>")).alias("messages"),
        )
    )


def invalid_tables(summary: DataFrame) -> int:
    """Number of failing tables."""
    return summary.filter(~F.col("valid")).count()
