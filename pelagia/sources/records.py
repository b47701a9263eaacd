"""CSV records with line breaks in quotes, read from any split of a file.

A split of a text file does not know whether it begins inside a quoted cell. That is settled by
counting quotes, since a doubled quote inside a cell changes nothing in their parity:

1. Lines of a split keep their order; the parity of each split's quotes is one row per split.
2. An exclusive prefix over the splits of a file says whether a split begins inside quotes.
3. A running parity inside the split says the same for each line: a line that begins outside
   quotes begins a record.
4. A line that ends outside quotes, too, is a whole record. The others, few of them, are glued by
   the place where their record began, which may be in an earlier split.

Lines cross the network once, to the place of their split; only lines of broken records do so
again. Everything is built from window functions and aggregates; the tables of splits hold one row
per split. What is glued has a bound in bytes: a quote that is never closed fails the read instead
of gathering the rest of the file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes a record may hold; a quote that is not closed within them is an error.
LONGEST = 64 << 20

_SPLIT = ["__file", "__block"]


def largest_file(spark: SparkSession, path: str) -> int:
    """Size of the largest file under a path; only the listing is read."""
    return spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] or 0


def split_lines(spark: SparkSession, path: str, quote: str = '"') -> DataFrame:
    """Lines with their file, split and number inside it, and the parity of their quotes."""
    text = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))
    return text.select(
        "value",
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        # Numbers grow in reading order, and a split is read in one go.
        F.monotonically_increasing_id().alias("__at"),
        (quotes % 2).cast("int").alias("__odd"),
    )


def records(spark: SparkSession, path: str, quote: str = '"', longest: int = LONGEST) -> DataFrame:
    """record, __first: the records of CSV files as text, ``__first`` true for each file's first.

    Equal to reading each file from its beginning. A record ends at a line feed outside quotes; a
    carriage return before it is dropped, one inside quotes stays. Empty lines are no records.
    """
    lines = split_lines(spark, path, quote)
    before = Window.partitionBy("__file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    parity = lines.groupBy(*_SPLIT).agg(F.sum("__odd").alias("__sum"))
    inside = parity.select(*_SPLIT, (F.coalesce(F.sum("__sum").over(before), F.lit(0)) % 2).alias("__inside"))

    here = Window.partitionBy(*_SPLIT).orderBy("__at")
    so_far = here.rowsBetween(Window.unboundedPreceding, -1)
    met = lines.join(inside, _SPLIT)
    opened = (F.col("__inside") + F.coalesce(F.sum("__odd").over(so_far), F.lit(0))) % 2
    told = met.withColumn("__no", F.row_number().over(here)).withColumn("__open", opened)
    ends_open = (F.col("__open") + F.col("__odd")) % 2 == 1
    told = told.select(
        *_SPLIT, "__no", "value", (F.col("__open") == 0).alias("__begins"), ends_open.alias("__ends_open"), F.length("value").alias("__size")
    )

    # Blank lines between records go; inside quotes they are part of a cell.
    kept = told.filter(~(F.col("__begins") & ~F.col("__ends_open") & (F.btrim("value") == "")))
    whole = kept.filter("__begins AND NOT __ends_open").select(*_SPLIT, F.col("__no").alias("__start"), "value")

    # Lines of broken records: the number of the line that began theirs, in this split or before.
    broken = kept.filter("NOT __begins OR __ends_open")
    running = Window.partitionBy(*_SPLIT).orderBy("__no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = broken.withColumn("__start", F.max(F.when(F.col("__begins"), F.col("__no"))).over(running))
    of_record = Window.partitionBy(*_SPLIT, "__start").orderBy("__no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = own.withColumn("__bytes", F.sum(F.col("__size") + 1).over(of_record))
    # Per split: where its last broken record began, if one did, and how much of it lies here.
    tails = own.groupBy(*_SPLIT).agg(
        F.max("__start").alias("__last"),
        F.max_by("__bytes", "__no").alias("__tail"),
    )
    known = F.when(F.col("__last").isNotNull(), F.struct("__block", F.col("__last").alias("__start")))
    groups = tails.withColumn("__from", F.last(known, ignorenulls=True).over(before))
    run = F.count("__last").over(Window.partitionBy("__file").orderBy("__block"))
    groups = groups.withColumn("__run", run)
    # A split without a beginning belongs to the run of the one before it, so its tail adds up.
    earlier = Window.partitionBy("__file", "__run").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    groups = groups.withColumn("__carried", F.when(F.col("__last").isNull(), F.coalesce(F.sum("__tail").over(earlier), F.lit(0))).otherwise(F.lag("__tail", 1, 0).over(Window.partitionBy("__file").orderBy("__block"))))
    placed = own.join(groups.select(*_SPLIT, "__from", "__carried"), _SPLIT)
    begun = F.when(F.col("__start").isNotNull(), F.struct("__block", "__start")).otherwise(F.col("__from"))
    size = F.col("__bytes") + F.when(F.col("__start").isNull(), F.col("__carried")).otherwise(F.lit(0))
    unclosed = F.raise_error(F.concat(F.lit("a quoted cell is not closed within "), F.lit(str(longest)), F.lit(" bytes in "), F.col("__file")))
    placed = placed.select("__file", begun.alias("__begun"), "__block", "__no", F.when(size > longest, unclosed.cast("string")).otherwise(F.col("value")).alias("value"))
    parts = F.array_sort(F.collect_list(F.struct("__block", "__no", "value")))
    glued = placed.groupBy("__file", "__begun").agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value"))
    glued = glued.select("__file", F.col("__begun.__block").alias("__block"), F.col("__begun.__start").alias("__start"), "value")

    every = whole.unionByName(glued)
    # A file's first record, blank lines aside: the first one of the first split that has any.
    firsts = every.groupBy("__file").agg(F.min(F.struct("__block", "__start")).alias("__head"))
    is_first = F.struct("__block", "__start") == F.col("__head")
    return every.join(firsts, "__file").select(F.rtrim("value", F.lit("\r")).alias("record"), is_first.alias("__first"))


def parsed(found: DataFrame, names: list[str], odd: str, options: dict[str, str]) -> DataFrame:
    """Records as text columns ``names``, and ``odd``: the whole text of a record with more or
    fewer cells. The first record of each file must hold the names, in their order."""
    fields = ", ".join(f"`{n.replace('`', '``')}` string" for n in [*names, odd])
    how = {**{k: v for k, v in options.items() if k not in ("header", "enforceSchema", "columnPruning", "encoding")}, "columnNameOfCorruptRecord": odd, "mode": "PERMISSIVE"}
    # An unclosed quote at the end of a file stays in its record, as in a plain read.
    rows = found.select("__first", F.from_csv("record", fields, how).alias("__row"))
    heading = F.array(*[_cell(n) for n in names]) == F.array(*[F.lit(n) for n in names])
    wrong = F.raise_error(F.lit("the header of a file differs from the first one's")).cast("boolean")
    # The header goes, and is checked as it goes.
    data = F.when(F.col("__first"), F.when(heading, F.lit(False)).otherwise(wrong)).otherwise(F.lit(True))
    return rows.filter(data).select("__row.*")


def _cell(name: str) -> Column:
    """A header cell without a byte order mark."""
    return F.ltrim(F.col("__row")[name], F.lit("﻿"))
