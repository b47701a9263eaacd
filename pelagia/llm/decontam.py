"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

1. The word 3-grams of all test items are hashed and counted over the items. One that at most
   ``rare`` items hold is a seed as it is, however many documents hold it.
2. A 3-gram of more items is a seed only together with one of the item's rarest words near it. A
   passage that reaches the threshold leaves a bounded share of the item's words unmatched, so of
   that many rarest words and one more it holds at least one: no passage is lost by it, and a phrase
   of a thousand items meets those of them whose own words stand around it, not all.
3. A bit map sized by the number of seeds says which can matter; one pass over the documents emits
   only those, with their place, and they meet the items' seeds.
4. Seeds on one diagonal of a document and an item are one region. Regions travel to their
   document, and the words around each are aligned with the item's (match 2, mismatch and gap -1).
   The score is the best local alignment over that of an unchanged copy. A region that holds too
   few of the item's words to reach the threshold, each matched, is not aligned.

Cases. NULL and wordless items match nothing; NULL and wordless texts are clean. An item shorter
than three words is one seed as a whole. Repeated items are reported under each id; items with a
NULL id are reported under NULL. Rows that repeat an id are searched each for itself and reported
once with their best score. Very long texts are searched whole; a text may hold many items.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ROW, Scratch, WordHashes, mix, ngram_hashes, numbered, table, without

NGRAM, THRESHOLD = 3, 0.5
#: Items that may share a 3-gram which is a seed by itself.
RARE = 16
#: Bits of a map of seeds: some 32 a seed between these bounds, so a map has 32 MB at most.
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 28
#: Bits of a map that travel together.
SLICE_BITS = 1 << 19
MATCH, OFF = 2, -1
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def local_alignment(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Best Smith-Waterman score and the end (exclusive) of the aligned part of ``text``.

    A row at a time: gaps along the row are a running maximum of score plus distance.
    """
    best, end = 0, 0
    steps = np.arange(len(text)) * -OFF
    above = np.zeros(len(text) + 1, np.int64)
    for word in item:
        row = np.where(text == word, MATCH, OFF) + above[:-1]
        row = np.maximum(np.maximum(row, above[1:] + OFF), 0)
        row = np.maximum.accumulate(row + steps) - steps
        top = int(row.argmax()) if len(row) else 0
        if len(row) and row[top] > best:
            best, end = int(row[top]), top + 1
        above[1:] = row
    return best, end


def paired(gram: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of a 3-gram together with a word near it."""
    with np.errstate(over="ignore"):
        return mix(gram * np.uint64(0x9E3779B97F4A7C15) + mix(word))


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items to (item, item_id, length, words, grams), one row each; wordless ones give none."""
    hashes = WordHashes()
    for b in batches:
        own = [hashes.of(words_of(text)) for text in b["text"].to_pylist()]
        rows = [i for i, w in enumerate(own) if len(w)]
        columns = [b["item"].take(pa.array(rows, pa.int64())), b["item_id"].take(pa.array(rows, pa.int64())), pa.array([len(own[i]) for i in rows], pa.int32())]
        lists = [pa.array([w.view(np.int64) for w in c], pa.list_(pa.int64())) for c in ([own[i] for i in rows], [ngram_hashes(own[i], NGRAM) for i in rows])]
        yield pa.RecordBatch.from_arrays([*columns, *lists], ["item", "item_id", "length", "words", "grams"])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(seed, item, at, length, near) with the words that one of must stand near to a row a word."""
    for b in batches:
        near = b["near"]
        rows = np.repeat(np.arange(b.num_rows), near.value_lengths().to_numpy(zero_copy_only=False))
        words = near.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        grams = b["seed"].to_numpy(zero_copy_only=False).view(np.uint64)[rows]
        at = pa.array(rows)
        yield pa.RecordBatch.from_arrays([pa.array(paired(grams, words).view(np.int64)), *(b[c].take(at) for c in ("item", "at", "length"))], ["seed", "item", "at", "length"])


def _slots(bits: int):
    """Seeds to the slices of the map that hold their bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(bits, bool)
        for b in batches:
            own[(b["seed"].to_numpy(zero_copy_only=False).view(np.uint64) % np.uint64(bits)).astype(np.int64)] = True
        parts = np.packbits(own, bitorder="little").reshape(-1, min(bits, SLICE_BITS) // 8)
        at = np.flatnonzero(parts.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array([parts[i].tobytes() for i in at], pa.binary())], ["slice", "bits"])

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    merged: dict[int, np.ndarray] = {}
    for b in batches:
        for at, bits in zip(b["slice"].to_pylist(), b["bits"].to_pylist()):
            own = np.frombuffer(bits, np.uint8)
            merged[at] = merged[at] | own if at in merged else own
    yield pa.RecordBatch.from_arrays([pa.array(list(merged), pa.int32()), pa.array([m.tobytes() for m in merged.values()], pa.binary())], ["slice", "bits"])


def bit_map(seeds: DataFrame) -> np.ndarray:
    """A map, packed, of the seeds' hashes, merged in tasks. Its length is a power of two."""
    count = seeds.count()
    bits = min(MOST_BITS, max(LEAST_BITS, 1 << (32 * count).bit_length())) if count else 8
    size = min(bits, SLICE_BITS) // 8
    out = np.zeros(bits // 8, np.uint8)
    if count:
        # Few tasks make maps, so that these stay few; the driver gets one whole map at most.
        parts = seeds.select("seed").coalesce(8).mapInArrow(_slots(bits), "slice int, bits binary")
        for r in parts.repartition("slice").mapInArrow(_merge, "slice int, bits binary").collect():
            out[r.slice * size : (r.slice + 1) * size] = np.frombuffer(r.bits, np.uint8)
    return out


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes % np.uint64(8 * len(bits))).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def _hits(alone: np.ndarray, common: np.ndarray, pairs: np.ndarray, shortest: int, reach: int):
    """Documents to (doc_id, place, seed): 3-grams that are seeds alone, and common ones with a word
    within ``reach`` that makes them one; shorter grams too if items have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            rows, places, seeds = [], [], []

            def emit(i: int, at: np.ndarray, found: np.ndarray) -> None:
                rows.append(np.full(len(at), i))
                places.append(at)
                seeds.append(found.view(np.int64))

            for i, text in enumerate(b.column(1).to_pylist()):
                own = hashes.of(words_of(text))
                for n in range(shortest, NGRAM + 1):
                    made = ngram_hashes(own, n) if len(own) >= n else own[:0]
                    at = np.flatnonzero(passes(alone, made))
                    if len(at):
                        emit(i, at, made[at])
                    for p in np.flatnonzero(passes(common, made)):
                        keys = np.unique(paired(made[p], own[max(0, p - reach) : p + reach]))
                        keys = keys[passes(pairs, keys)]
                        emit(i, np.full(len(keys), p), keys)
            none = [np.zeros(0, np.int64)]
            rows, places, seeds = (np.concatenate(x or none) for x in (rows, places, seeds))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), pa.array(places.astype(np.int32)), pa.array(seeds)], ["doc_id", "place", "seed"])

    return run


def _align(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            rows, items, scores, starts, ends = [], [], [], [], []
            for i, (text, regions) in enumerate(zip(b["text"].to_pylist(), b["regions"].to_pylist())):
                own = hashes.of(words_of(text))
                for r in regions:
                    item = np.array(r["words"], np.int64).view(np.uint64)
                    slack = 4 + len(item) // 2
                    low = max(0, r["start"] - slack)
                    part = own[low : max(0, r["start"] + len(item) + slack)]
                    if np.isin(item, part).sum() < threshold * len(item):
                        continue
                    best, end = local_alignment(item, part)
                    if best >= threshold * MATCH * len(item):
                        _, back = local_alignment(item[::-1], part[:end][::-1])
                        rows.append(i)
                        items.append(r["item_id"])
                        scores.append(best / (MATCH * len(item)))
                        starts.append(low + end - back)
                        ends.append(low + end)
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"].take(pa.array(rows, pa.int64())), pa.array(items, b.schema.field("regions").type.value_type.field("item_id").type), pa.array(scores, pa.float64()), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
                ["doc_id", "item_id", "score", "start_word", "end_word"],
            )

    return run


def item_seeds(items: DataFrame, scratch: Scratch, threshold: float, rare: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Seeds of the items as (seed, item, at, length): 3-grams that are seeds alone, those with a word
    near them, and the common 3-grams (seed) the latter are made of."""
    grams = items.select("item", "length", F.posexplode("grams").alias("at", "seed"))
    held = grams.groupBy("seed").agg(F.count_distinct("item").alias("holders"))
    grams = scratch.keep(grams.join(held, "seed"), "grams")
    common = grams.filter(F.col("holders") > rare)
    # The rarest words over all items, as many as a passage may miss and one more.
    words = items.select("item", "length", F.explode("words").alias("word"))
    ranked = words.join(words.groupBy("word").agg(F.count("*").alias("n")), "word").join(common.select("item").distinct(), "item", "left_semi")
    place = F.row_number().over(Window.partitionBy("item").orderBy("n", "word"))
    near = ranked.withColumn("k", place).filter(F.col("k") <= F.floor((1 - threshold) * F.col("length")) + 1)
    near = near.groupBy("item").agg(F.collect_set("word").alias("near"))
    kind = "seed long, item long, at int, length int"
    pairs = common.join(near, "item").select("seed", "item", "at", "length", "near").mapInArrow(_pairs, kind)
    return grams.filter(F.col("holders") <= rare).select("seed", "item", "at", "length"), scratch.keep(pairs, "pairs"), common.select("seed").distinct()


def contaminated(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", threshold: float = THRESHOLD, rare: int = RARE) -> DataFrame:
    """doc_id, item_id, score, start_word, end_word of each item found in a document."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "decontam")
    docs = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    doc_kind, item_kind = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString()
    items = benchmark.select(F.monotonically_increasing_id().alias("item"), F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    items = scratch.keep(items.mapInArrow(_words, f"item long, item_id {item_kind}, length int, words array<long>, grams array<long>"), "items")
    alone, pairs, common = item_seeds(items, scratch, threshold, rare)
    shortest, longest = items.agg(F.coalesce(F.min("length"), F.lit(NGRAM)), F.coalesce(F.max("length"), F.lit(0))).first()
    # What is aligned around a seed lies within twice the item's length and a few words of it.
    looked = _hits(bit_map(alone), bit_map(common), bit_map(pairs), max(1, min(NGRAM, shortest)), 2 * longest + 16)
    hits = scratch.keep(docs.mapInArrow(looked, f"doc_id {doc_kind}, place int, seed long"), "hits")

    # Diagonals that differ by less than half an item overlap in the words that are aligned.
    step = F.greatest(F.lit(4), (F.col("length") / 2).cast("int"))
    start = F.floor((F.col("place") - F.col("at")) / step) * step + (step / 2).cast("int")
    regions = hits.join(alone.unionByName(pairs), "seed").select("doc_id", "item", start.cast("int").alias("start")).distinct()
    regions = regions.join(items.select("item", "item_id", "words"), "item")
    per_doc = regions.groupBy("doc_id").agg(F.collect_list(F.struct("item_id", "start", "words")).alias("regions"))
    asked = docs.join(per_doc.withColumnRenamed("doc_id", "__id"), docs.doc_id.eqNullSafe(F.col("__id"))).select("doc_id", "text", "regions")
    found = asked.mapInArrow(_align(threshold), f"doc_id {doc_kind}, item_id {item_kind}, score double, start_word int, end_word int")
    best = found.groupBy("doc_id", "item_id").agg(F.min(F.struct((-F.col("score")).alias("s"), "start_word", "end_word")).alias("b"))
    return best.select("doc_id", "item_id", (-F.col("b.s")).alias("score"), "b.start_word", "b.end_word")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", stored: bool = False) -> DataFrame:
    """The documents without a test item, all their columns. Rows are told apart by their place,
    so ids may repeat or be NULL."""
    rows = numbered(docs, Scratch(docs.sparkSession, "decontam"), stored)
    return without(rows, contaminated(rows, benchmark, ROW, text).select(F.col("doc_id").alias(ROW)))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
