"""Hard negatives by a vertical scan of columns, after the BOND search.

Vectors are stored in blocks, a block by dimension: each column lies in one piece, with its
least and largest value. An anchor reads a block's columns in the order of its own magnitudes,
largest first. After some columns every row of the block has a score so far; the columns not read
yet add at least the sum of their least products and at most the sum of their largest. Rows whose
range misses what is wanted leave the candidate bitmap; the others read on, until all columns are
read and the scores are exact.

Two searches use the scan. The first wants an anchor's best rows of its own label: a row leaves
when its most is below the least of as many others. The second wants, per positive, the best rows of
other labels whose score lies in the window from ``margin`` of the positive's score up to it: a
row leaves when its range misses all windows, or when in each window that it may reach enough rows
are sure to stand in it with more than its most.

The anchors are the stated query set, a share of all rows. They are handed to the tasks in slices
of a fixed number, so what is broadcast has a fixed size; every slice meets every block where the
block lies, and blocks are never shuffled. What a task has found so far bounds its next blocks, and
it sends on no more rows than the answer has, so the choice over all tasks is one window over few
rows per anchor.

Cases. Rows with a NULL label, a NULL vector, or a NULL or infinite or not-a-number component take
no part. A shorter vector counts as filled with zeros. Rows that repeat an id are rows each for
itself: each is an anchor if the id says so, and leaves only itself out. A NULL id is no anchor; as
a partner it comes last among ties. Ties go to the smaller id; of equal ids only one
can be first, and which rows they are makes no difference to the answer. An empty table gives no
rows, as does an anchor without rows of its label or of others. Scores that a 64-bit integer
cannot hold raise an error. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, table

#: Fixed values of the contract: anchors, changed labels, the scale of components, and the window.
ANCHORS, CHANGED, SCALE, LOW, FULL = 100, 7, 256, 80, 100
POSITIVES, NEGATIVES = 5, 5
#: Rows of a block, anchors of a slice, columns read between two looks at the bounds.
BLOCK, SLICE, STEP = 8192, 8192, 8
#: Below so many candidates the rest of the columns is read at once.
FEW = 64


# --- blocks -----------------------------------------------------------------------------


def usable(vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """id, label, x: rows that take part, with whole-number components."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.filter(F.col(label).isNotNull() & F.col(vector).isNotNull() & ~odd)
    old = F.col(label).cast("long")
    new = F.when(F.col(id) % CHANGED == 0, (old + 1) % 10).otherwise(old)
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return rows.select(F.col(id).cast("long").alias("id"), new.alias("label"), whole.alias("x"), F.monotonically_increasing_id().alias("row"))


BLOCKS = "ids binary, known binary, labels binary, rows binary, width int, columns binary"


def _blocks(size: int):
    """Rows to one row per block, sorted by label inside it."""

    def build(b: pa.Table) -> pa.RecordBatch:
        x = b["x"].combine_chunks()
        lengths = np.diff(x.offsets.to_numpy())
        width = int(lengths.max(initial=0))
        matrix = np.zeros((width, b.num_rows), np.int64)
        row = np.repeat(np.arange(b.num_rows), lengths)
        matrix[np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths), row] = x.flatten().to_numpy()
        label = b["label"].to_numpy()
        order = np.argsort(label, kind="stable")
        known = b["id"].is_valid().to_numpy()
        ids = b["id"].fill_null(0).to_numpy()
        narrow = np.int32 if abs(matrix).max(initial=0) < 2**31 else np.int64
        parts = [ids[order], known[order], label[order], b["row"].to_numpy()[order]]
        columns = np.ascontiguousarray(matrix[:, order]).astype(narrow)
        return pa.RecordBatch.from_arrays(
            [*(pa.array([p.tobytes()], pa.binary()) for p in parts), pa.array([width], pa.int32()), pa.array([columns.tobytes()], pa.binary())],
            ["ids", "known", "labels", "rows", "width", "columns"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            while b.num_rows:
                held.append(b.slice(0, size - n))
                n += held[-1].num_rows
                b = b.slice(held[-1].num_rows)
                if n == size:
                    yield build(pa.Table.from_batches(held))
                    held, n = [], 0
        if n:
            yield build(pa.Table.from_batches(held))

    return run


@dataclass
class Block:
    ids: np.ndarray
    known: np.ndarray
    labels: np.ndarray
    rows: np.ndarray
    columns: np.ndarray  # dimension by row
    least: np.ndarray  # per dimension
    most: np.ndarray

    @classmethod
    def of(cls, ids: bytes, known: bytes, labels: bytes, rows: bytes, width: int, columns: bytes) -> Block:
        ids = np.frombuffer(ids, np.int64)
        kind = np.int32 if len(columns) == 4 * width * len(ids) else np.int64
        matrix = np.frombuffer(columns, kind).reshape(width, len(ids))
        return cls(ids, np.frombuffer(known, bool), np.frombuffer(labels, np.int64), np.frombuffer(rows, np.int64), matrix, matrix.min(1).astype(np.int64), matrix.max(1).astype(np.int64))


# --- the vertical scan --------------------------------------------------------------------


def scan(block: Block, anchor: np.ndarray, start: np.ndarray, keep) -> tuple[np.ndarray, np.ndarray]:
    """(places, exact scores) of the candidates that stay.

    ``start`` holds the places to look at; ``keep(least, most)`` says which candidates stay, given
    the range of each one's score.
    """
    width = min(len(anchor), len(block.columns))
    anchor = anchor[:width]
    reach = float(np.abs(anchor.astype(float)) @ np.maximum(np.abs(block.least[:width].astype(float)), np.abs(block.most[:width].astype(float))))
    if reach >= 2.0**62:
        raise OverflowError("scores do not fit 64 bits")
    kind = np.int32 if reach < 2**31 - 1 and block.columns.dtype == np.int32 else np.int64
    order = np.argsort(-np.abs(anchor), kind="stable")
    ends = np.stack([anchor * block.least[:width], anchor * block.most[:width]])[:, order]
    # What the columns from the k-th on add at least and at most.
    least, most = (np.append(np.cumsum(e[::-1])[::-1], 0) for e in (ends.min(0), ends.max(0)))
    places, score, k = start, np.zeros(len(start), kind), 0
    weight = anchor.astype(kind)
    while k < width and len(places):
        step = width - k if len(places) <= FEW else STEP
        for d in order[k : k + step]:
            if weight[d]:
                score += weight[d] * block.columns[d][places].astype(kind, copy=False)
        k = min(k + step, width)
        stay = keep(score.astype(np.int64) + least[k], score.astype(np.int64) + most[k])
        if not stay.all():
            places, score = places[stay], score[stay]
    return places, score.astype(np.int64)


class Tops:
    """The first ``n`` rows found so far for each (anchor, positive), over a task's blocks."""

    def __init__(self, n: int):
        self.n = n
        self.held: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def bound(self, key: tuple[int, int], default: int) -> int:
        """The score a row needs to be of use."""
        held = self.held.get(key)
        return default if held is None or len(held[2]) < self.n else max(default, int(held[2][-1]))

    def add(self, key: tuple[int, int], block: Block, places: np.ndarray, scores: np.ndarray) -> None:
        if len(places):
            new = (block.ids[places], block.known[places], scores)
            ids, known, scores = (np.concatenate(x) for x in zip(self.held[key], new)) if key in self.held else new
            first = np.lexsort((ids, ~known, -scores))[: self.n]
            self.held[key] = ids[first], known[first], scores[first]

    def batch(self) -> pa.RecordBatch:
        sizes = [len(v[2]) for v in self.held.values()]
        anchor, positive = (np.repeat(np.array([k[i] for k in self.held], np.int64), sizes) for i in (0, 1))
        ids, known, scores = (np.concatenate(x) for x in zip(*self.held.values()))
        columns = [pa.array(anchor), pa.array(positive.astype(np.int32)), pa.array(ids, mask=~known), pa.array(scores)]
        return pa.RecordBatch.from_arrays(columns, ["anchor", "positive", "id", "score"])


def search_label(block: Block, anchor: np.ndarray, start: np.ndarray, key: tuple[int, int], tops: Tops) -> None:
    """The first rows of ``start`` by score, then id."""
    n, bound = tops.n, tops.bound(key, np.iinfo(np.int64).min)

    def keep(least: np.ndarray, most: np.ndarray) -> np.ndarray:
        floor = bound
        if len(least) > n:
            floor = max(floor, int(np.partition(least, len(least) - n)[len(least) - n]))
        return most >= floor

    tops.add(key, block, *scan(block, anchor, start, keep))


def window_of(score: int, low: int = LOW, full: int = FULL) -> tuple[int, int]:
    """The least and the largest whole number s with low * score <= full * s <= full * score;
    the least is the larger one where there is none."""
    return -(-low * score // full), score


def search_windows(block: Block, anchor: np.ndarray, start: np.ndarray, windows: dict[tuple[int, int], tuple[int, int]], tops: Tops) -> None:
    """Per window the first rows of ``start`` by score, then id."""
    n = tops.n
    open_ = [(tops.bound(key, low), high) for key, (low, high) in windows.items()]

    def keep(least: np.ndarray, most: np.ndarray) -> np.ndarray:
        stay = np.zeros(len(least), bool)
        for low, high in open_:
            may = (most >= low) & (least <= high)
            sure = least[(least >= low) & (most <= high)]
            if len(sure) > n:
                may &= most >= np.partition(sure, len(sure) - n)[len(sure) - n]
            stay |= may
        return stay

    places, scores = scan(block, anchor, start, keep)
    for key, (low, high) in windows.items():
        inside = (scores >= low) & (scores <= high)
        tops.add(key, block, places[inside], scores[inside])


# --- the job ----------------------------------------------------------------------------

HITS = "anchor long, positive int, id long, score long"


def _each_block(search, n: int):
    """Blocks to what ``search(block, tops)`` finds in a task's blocks together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops = Tops(n)
        for b in batches:
            for values in zip(*(b[c].to_pylist() for c in ("ids", "known", "labels", "rows", "width", "columns"))):
                search(Block.of(*values), tops)
        if tops.held:
            yield tops.batch()

    return run


def _positives(anchors, n: int):
    """Each anchor's best rows of its label."""

    def search(block: Block, tops: Tops) -> None:
        for row, label, vector in anchors.value:
            own = np.arange(*np.searchsorted(block.labels, [label, label + 1]))
            own = own[block.rows[own] != row]
            if len(own):
                search_label(block, vector, own, (row, 0), tops)

    return _each_block(search, n)


def _negatives(anchors, n: int):
    """The best rows of other labels, per anchor and window."""

    def search(block: Block, tops: Tops) -> None:
        for row, label, vector, windows in anchors.value:
            begin, end = np.searchsorted(block.labels, [label, label + 1])
            others = np.concatenate([np.arange(begin), np.arange(end, len(block.labels))])
            if len(others):
                search_windows(block, vector, others, windows, tops)

    return _each_block(search, n)


def _first(hits: DataFrame, n: int) -> DataFrame:
    """rank 1 to ``n`` by score, then id with NULL last, per anchor and positive."""
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def hard_negatives(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    anchor: Column | None = None,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    full: int = FULL,
    block: int = BLOCK,
    slice: int = SLICE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` chooses the anchors by the columns ``id`` and ``label``; if not given, ids divisible
    by 100. A negative's score lies between ``low`` / ``full`` of the positive's and the positive's.
    """
    spark = vectors.sparkSession
    scratch, context = Scratch(spark, "negatives"), spark.sparkContext
    rows = scratch.keep(usable(vectors, id, vector, label), "rows")
    blocks = scratch.keep(rows.mapInArrow(_blocks(block), BLOCKS), "blocks")
    asked = scratch.keep(rows.filter((F.col("id") % ANCHORS == 0) if anchor is None else anchor), "anchors")
    scratch.drop("rows")
    near: list[DataFrame] = []
    found: list[DataFrame] = []
    # One slice of anchors at a time is on the driver and in the tasks.
    source = asked.select("row", "label", "x").toLocalIterator()
    while own := [(r.row, r.label, np.array(r.x, np.int64)) for r in islice(source, slice)]:
        sent = context.broadcast(own)
        best = _first(blocks.mapInArrow(_positives(sent, positives), HITS), positives)
        best = scratch.keep(best.select("anchor", (F.col("rank") - 1).alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), f"positives{len(near)}")
        sent.unpersist()
        windows: dict[int, dict] = {}
        for r in best.select("anchor", "positive", "positive_score").collect():
            least, most = window_of(r.positive_score, low, full)
            if least <= most:
                windows.setdefault(r.anchor, {})[r.anchor, r.positive] = least, most
        sent = context.broadcast([(row, own_label, x, windows[row]) for row, own_label, x in own if row in windows])
        hits = _first(blocks.mapInArrow(_negatives(sent, negatives), HITS), negatives)
        found.append(scratch.keep(hits.select("anchor", "positive", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")), f"negatives{len(near)}"))
        near.append(best)
        sent.unpersist()
    if not near:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    pairs, picked = scratch.together(near), scratch.together(found)
    names = asked.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    out = picked.join(pairs, ["anchor", "positive"]).join(names, "anchor")
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(table(spark, sf_dir, "embeddings"))


OP12_SQL = """
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS x
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
    SELECT a.r AS anchor, a.vec_id AS anchor_id, a.label = b.label AS alike, b.vec_id, CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
    FROM v a JOIN v b ON a.r <> b.r
    WHERE a.vec_id % 100 = 0
), p AS (
    SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) AS k
    FROM s WHERE alike QUALIFY k <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor, p.k ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND NOT s.alike AND 80 * p.score <= 100 * s.score AND s.score <= p.score
QUALIFY rank <= 5
"""
