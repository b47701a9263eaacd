"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash. Native.

Texts are equal when they are identical after every blank (space, tab, line breaks, form feed)
is taken out. Of equal texts the row with the most code points in its original text stays, then
the one with the smallest id. Of rows that repeat that id and that text, one stays.

Texts never leave the scan: it is read once, to narrow rows of length, prefix hash and full hash. A
row whose length is its own is done; so is one whose prefix is its own among rows of its length;
only the others are grouped by full hash.

Cases. A NULL text counts as the empty text. A NULL id is smaller than any other id. Rows that
repeat an id and a text are equal texts: each counts in ``group_size``, one is ``kept``. Rows are
told apart by their place in the table, so a row without an id goes like any other. Further
columns never meet those of the operator, as only ``id`` and ``text`` are read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW, Scratch, numbered, table, without

# The characters that do not count, [\x20\x09-\x0D].
BLANKS = (" ", "\t", "\n", "\x0b", "\x0c", "\r")
#: Code points of the normalised text that the prefix hash reads.
PREFIX = 64


def normalised(text: Column) -> Column:
    return reduce(lambda c, b: F.replace(c, F.lit(b), F.lit("")), BLANKS, F.coalesce(text, F.lit("")))


def _grouped(docs: DataFrame, scratch: Scratch, id: str, text: str) -> DataFrame:
    """ROW, doc_id, keep_id, group_size, kept, text_sha256 of numbered rows.

    Counts are summed before each shuffle, and what is joined to rows is stored, so that adaptive
    execution can split a value that owns many of them.
    """
    norm = normalised(F.col(text))
    rows = docs.select(
        ROW,
        F.col(id).alias("doc_id"),
        F.length(F.coalesce(F.col(text), F.lit(""))).alias("chars"),
        F.length(norm).alias("length"),
        F.xxhash64(F.substring(norm, 1, PREFIX)).alias("prefix"),
        F.sha2(norm, 256).alias("text_sha256"),
    )
    rows = scratch.keep(rows, "hashed")
    lengths = scratch.keep(rows.groupBy("length").count().filter("count > 1").select("length"), "lengths")
    open_ = rows.join(lengths, "length")
    prefixes = scratch.keep(open_.groupBy("length", "prefix").count().filter("count > 1").select("length", "prefix"), "prefixes")
    open_ = rows.join(prefixes, ["length", "prefix"])
    best = F.min(F.struct((-F.col("chars")).alias("c"), "doc_id", ROW)).alias("best")
    groups = open_.groupBy("text_sha256").agg(F.count("*").alias("size"), best).filter("size > 1")
    groups = scratch.keep(groups.select("text_sha256", "size", F.col("best.doc_id").alias("best_id"), F.col(f"best.{ROW}").alias("best_row")), "groups")
    alone = F.col("size").isNull()
    return rows.join(groups, "text_sha256", "left").select(
        ROW,
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col(ROW) == F.col("best_row"))).alias("kept"),
        "text_sha256",
    )


def exact_groups(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, keep_id, group_size, kept, text_sha256."""
    # The numbers are stored with the narrow rows, so the documents are read once.
    rows = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text")).withColumn(ROW, F.monotonically_increasing_id())
    return _grouped(rows, Scratch(docs.sparkSession, "exact"), "doc_id", "text").drop(ROW)


def drop_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", stored: bool = False) -> DataFrame:
    """The documents that stay, all their columns: one row of each text."""
    scratch = Scratch(docs.sparkSession, "exact")
    rows = numbered(docs, scratch, stored)
    return without(rows, _grouped(rows, scratch, id, text).filter(~F.col("kept")))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER own AS keep_id, row_number() OVER own AS place
  FROM d WINDOW own AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM g
"""
