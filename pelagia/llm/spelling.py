"""Spelling variants: frequent words and the rare words one edit away from them.

1. Count. A document's letter runs are counted in its task; partial counts meet in one shuffle.
2. Place. Two words of up to n letters are one edit apart exactly when common prefix and common
   suffix together reach n - 1. Cut the places 0 .. n - 1 of the edit into parts [a, b): a pair
   whose edit lies in a part has its first a and its last n - b letters in common. Each word
   goes to the tile of each part, as the longer word (n is its length) and as the shorter one
   (n is its length and one), so no pair in reach is missed, and no pair of tiles is compared.
3. Narrow. A tile with more than MOST words is cut into finer parts of its part, by counts over
   all rows, again and again. A part of one place has but one letter free, so the tiles that are
   left are small however the words are spread: no group is unbounded and none is dropped.
4. Tile. A tile's words are rows of a padded matrix of code points, once from the left and once
   from the right. Blocks of rows are compared densely, all pairs at once: the first difference
   from either side gives prefix and suffix. Tiles of one size are stacked into one product.
   A pair that several parts see (an insertion into a run of one letter) counts in the first.
   Only sums leave a tile: how many near words a word has there, and the best of them.
5. Follow. A word's form has ten times its count or more, so chains of forms are short; only
   words that are forms are followed, by joins on unique words.

Cases. NULL text has no words. A NULL id counts as the empty text in the draw. Rows that repeat
an id and a text count again. Words are compared by code points, and sorted so. An empty table
gives no rows; further columns are not read. A word may be of any length: tiles are named by
hashes of prefix and suffix, and a very long word has no more of them than any other.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table

#: Letters of a word (fixed values of the contract), its least length and count.
LETTERS, LEAST, TWICE = "A-Za-zÀ-ÿ", 7, 2
#: One occurrence in so many loses a letter; a form has so many times the count.
DRAW, MORE = 31, 10
#: Parts a word's places are cut into at first; finer parts of a part; words a tile may hold.
PARTS, FINER, MOST = 4, 4, 512
#: Words whose counts a task holds; rows of tiles solved together; letters compared at a time.
HELD, ROWS, CELLS = 200_000, 100_000, 1 << 22


# --- counts -----------------------------------------------------------------------------


def words_of(text: str, id: str, least: int) -> Iterator[tuple[str, int]]:
    """(word, occurrences) of a document, after the letters that the draw takes out."""
    # bytes.lower() knows A-Z alone.
    runs = Counter(re.findall(f"[{LETTERS}]{{{least},}}", text.encode().lower().decode()))
    start = crc32(f"{id}:".encode())
    for word, n in runs.items():
        h = crc32(word.encode(), start)
        if h % DRAW == 0:
            at = h % len(word)
            word = word[:at] + word[at + 1 :]
            if len(word) < least:
                continue
        yield word, n


def _count(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        for b in batches:
            for id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for word, n in words_of(text, id, least):
                    held[word] += n
                if len(held) > HELD:
                    yield out()
                    held.clear()
        yield out()

    return run


def word_counts(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST, twice: int = TWICE) -> DataFrame:
    """word, n of all words with at least ``least`` code points and ``twice`` occurrences."""
    rows = docs.select(F.coalesce(F.col(id).cast("string"), F.lit("")), text).filter(F.col(text).isNotNull())
    return rows.mapInArrow(_count(least), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= twice)


# --- tiles ------------------------------------------------------------------------------


def tile_name(word: Column, size: Column, low: Column, high: Column) -> Column:
    """Names what words of a part share: ``size`` (of the longer word), prefix and suffix."""
    prefix = F.substr(word, F.lit(1), low)
    suffix = F.substr(word, F.char_length(word) - (size - high) + 1, size - high)
    return F.xxhash64(prefix, suffix, size, low, high)


def _parts(low: Column, high: Column, n: int) -> Column:
    """The part [low, high) cut into up to ``n`` parts, as an array of (low, high)."""
    bounds = F.transform(F.sequence(F.lit(0), F.lit(n)), lambda k: low + F.floor((high - low) * k / n).cast("int"))
    parts = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda k: F.struct(bounds[k - 1].alias("low"), bounds[k].alias("high")))
    return F.filter(parts, lambda p: p["low"] < p["high"])


def _placed(words: DataFrame, parts: Column) -> DataFrame:
    """word, n, size, low, high, tile from word, n, size and the parts to place it in."""
    out = words.select("word", "n", "size", F.explode(parts).alias("p")).select("word", "n", "size", "p.low", "p.high")
    return out.withColumn("tile", tile_name(F.col("word"), F.col("size"), F.col("low"), F.col("high")))


def tiles(words: DataFrame, scratch: Scratch, parts: int = PARTS, most: int = MOST) -> DataFrame:
    """Every word in the tiles it may have near words in; no tile that can be cut holds more
    than ``most`` words."""
    length = F.char_length("word")
    either = words.select("word", "n", F.explode(F.array(length, length + 1)).alias("size"))
    open_, done, step = _placed(either, _parts(F.lit(0), F.col("size"), parts)), None, 0
    while True:
        # The counts are aggregated before they are shuffled; large tiles are few.
        large = open_.filter("high - low > 1").groupBy("tile").count().filter(F.col("count") > most).select("tile", F.lit(True).alias("large"))
        large = scratch.keep(large, f"large{step}")
        if large.isEmpty():
            return open_ if done is None else done.unionByName(open_)
        marked = scratch.keep(open_.join(large, "tile", "left"), f"tiles{step}")
        small = marked.filter("large IS NULL").drop("large")
        done = small if done is None else done.unionByName(small)
        finer = marked.filter("large").select("word", "n", "size", "low", "high")
        parts_of = _parts(F.col("low"), F.col("high"), FINER)
        cut = finer.select("word", "n", "size", F.explode(parts_of).alias("p")).select("word", "n", "size", "p.low", "p.high")
        open_ = cut.withColumn("tile", tile_name(F.col("word"), F.col("size"), F.col("low"), F.col("high")))
        step += 1


def code_points(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words as rows of code points from the left and from the right, 0 behind them, and lengths."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    left, right = np.zeros((len(words), width), np.uint32), np.zeros((len(words), width), np.uint32)
    row = np.repeat(np.arange(len(words)), size)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)
    left[row, at] = flat
    right[row, np.repeat(size, size) - 1 - at] = flat
    return left, right, size


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of each row of ``a`` with each row of ``b``, per stack."""
    other = a[:, :, None, :] != b[:, None, :, :]
    first = other.argmax(axis=3)
    return np.where(np.take_along_axis(other, first[..., None], 3)[..., 0], first, a.shape[2])


def near(a: tuple, b: tuple, size: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Dense comparison of block ``a`` with block ``b`` of each tile of a stack.

    A pair counts if its longer word has the tile's ``size``, prefix and suffix together reach
    size - 1, and the first place the edit may stand at lies in the tile's part.
    """
    n, m = a[2][:, :, None], b[2][:, None, :]
    size, low, high = (x[:, None, None] for x in (size, low, high))
    prefix, suffix = _common(a[0], b[0]), _common(a[1], b[1])
    prefix, suffix = np.minimum(prefix, np.minimum(n, m)), np.minimum(suffix, np.minimum(n, m))
    first = np.maximum(size - 1 - suffix, 0)
    same = (n == m) & (prefix == n)
    return (np.maximum(n, m) == size) & (abs(n - m) <= 1) & (prefix + suffix >= size - 1) & ~same & (low <= first) & (first < high)


BEST = "word string, n long, near long, best_n long, best string"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by tile to each word's near words in its tile: how many, and the best."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        held.append(b)
        size += b.num_rows
        if size >= ROWS:
            rows = pa.Table.from_batches(held)
            end = int(_heads(rows)[-1])  # the last tile may go on in the next batch
            yield from _solve(rows.slice(0, end))
            held, size = rows.slice(end).to_batches(), rows.num_rows - end
    if size:
        yield from _solve(pa.Table.from_batches(held))


def _heads(rows: pa.Table) -> np.ndarray:
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for c in ("tile", "size", "low", "high"):
        x = rows[c].to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _solve(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    if rows.num_rows < 2:
        return
    heads = _heads(rows)
    counts = np.diff(np.append(heads, rows.num_rows))
    words, n = rows["word"].combine_chunks(), rows["n"].to_numpy()
    part = np.stack([rows[c].to_numpy() for c in ("size", "low", "high")]).astype(np.int64)
    # Stacks hold tiles of one number of words and of one width.
    width = part[0, heads]
    for k, w in sorted(set(zip(counts[counts > 1].tolist(), width[counts > 1].tolist()))):
        own = heads[(counts == k) & (width == w)]
        block = max(1, min(k, int((CELLS / w) ** 0.5)))  # rows of a block
        stack = max(1, CELLS // (block * block * w))  # tiles of a stack
        for at in range(0, len(own), stack):
            first = own[at : at + stack]
            index = first[:, None] + np.arange(k)
            own_words = words.take(pa.array(index.ravel()))
            text = own_words.to_pylist()
            left, right, size = code_points(text, w)
            left, right, size = left.reshape(len(first), k, w), right.reshape(len(first), k, w), size.reshape(len(first), k)
            weight = n[index]
            # Rank by count, then by code points: the best near word has the least rank.
            both = pa.table({"n": weight.ravel(), "word": own_words})
            order = pc.sort_indices(both, sort_keys=[("n", "descending"), ("word", "ascending")]).to_numpy()
            rank = np.empty(len(text), np.int64)
            rank[order] = np.arange(len(text))
            rank = rank.reshape(len(first), k)
            found, best = np.zeros((len(first), k), np.int64), np.full((len(first), k), len(text), np.int64)
            s, low, high = part[:, first]
            for i in range(0, k, block):
                rows_ = slice(i, i + block)
                a = (left[:, rows_], right[:, rows_], size[:, rows_])
                for j in range(i, k, block):
                    columns = slice(j, j + block)
                    hit = near(a, (left[:, columns], right[:, columns], size[:, columns]), s, low, high)
                    found[:, rows_] += hit.sum(2)
                    best[:, rows_] = np.minimum(best[:, rows_], np.where(hit, rank[:, None, columns], len(text)).min(2))
                    if j > i:  # the same block seen from the other side
                        found[:, columns] += hit.sum(1)
                        best[:, columns] = np.minimum(best[:, columns], np.where(hit, rank[:, rows_, None], len(text)).min(1))
            has = np.flatnonzero(found.ravel())
            if len(has):
                chosen = order[best.ravel()[has]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([text[i] for i in has]), pa.array(weight.ravel()[has]), pa.array(found.ravel()[has]), pa.array(weight.ravel()[chosen]), pa.array([text[i] for i in chosen])],
                    ["word", "n", "near", "best_n", "best"],
                )


def near_words(words: DataFrame, scratch: Scratch, parts: int = PARTS, most: int = MOST) -> DataFrame:
    """word, n_near and its near word of largest n: best, best_n (words that have one)."""
    placed = tiles(words, scratch, parts, most)
    rows = placed.repartition("tile").sortWithinPartitions("tile", "size", "low", "high")
    found = rows.select("word", "n", "size", "low", "high", "tile").mapInArrow(_compare, BEST)
    top = F.min(F.struct((-F.col("best_n")).alias("m"), "best"))
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), top.alias("top")).select("word", "n_near", F.col("top.best").alias("best"), (-F.col("top.m")).alias("best_n"))


# --- forms ------------------------------------------------------------------------------


def _followed(links: DataFrame, scratch: Scratch) -> DataFrame:
    """word, root of the words in ``links`` (word, form), by doubling over words that are forms."""
    forms = links.select(F.col("form").alias("word")).distinct()
    # A form that has a form of its own; both columns of the join are unique.
    step, far = 0, scratch.keep(links.join(forms, "word", "left_semi").select("word", F.col("form").alias("root")), "far0")
    while True:
        onward = far.select(F.col("word").alias("root"), F.col("root").alias("next"))
        more = far.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        step += 1
        more = scratch.keep(more, f"far{step}")
        if more.filter("moved").isEmpty():
            break
        far = more.drop("moved")
    onward = far.select(F.col("word").alias("form"), "root")
    return links.join(onward, "form", "left").select("word", F.coalesce("root", "form").alias("root"))


def spelling_variants(
    docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST, twice: int = TWICE, more: int = MORE, parts: int = PARTS, most: int = MOST
) -> DataFrame:
    """word, form, root, n, n_near, form_n, one row per word."""
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.keep(word_counts(docs, id, text, least, twice), "words")
    met = words.join(near_words(words, scratch, parts, most), "word", "left")
    frequent = F.col("best_n") >= more * F.col("n")
    known = scratch.keep(
        met.select("word", F.when(frequent, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(frequent, F.col("best_n")).alias("form_n")),
        "known",
    )
    roots = _followed(known.filter("form IS NOT NULL").select("word", "form"), scratch)
    return known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))
