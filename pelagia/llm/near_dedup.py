"""Near duplicates by DartMinHash, banding, and a check of every candidate link.

Sketch. The set (or multiset) of a text's five-word shingles is a set of weighted regions. Darts
fall on each unit of weight at hashed, exponentially spaced ranks; those below a rank that lets
about K (ln K + 2) darts through are thrown, all others never exist. A dart's hash names its
coordinate, and each coordinate keeps its earliest dart. Two texts agree in a coordinate with the
probability of their (weighted) Jaccard similarity. A text with an empty coordinate goes on to
twice the rank.

Join. Texts with equal shingle sets are one representative. R coordinates make a band; in each
bucket every representative is compared with one hub, so copies give one candidate each, not all
pairs. Verified links are contracted to components, and then the pairs of a bucket that still lie
in different components are compared too. So no link between different texts is lost, and pairs
inside a component are never made.

Check. Agreement of the signatures decides far from the threshold; between LOW and HIGH the exact
Jaccard similarity of the shingle sets does.

Cases. NULL and wordless texts have no shingle: each is a class of its own. A text of fewer than
five words is one shingle. Ties: a class is named by its smallest id. Rows that repeat an id and
a text are in one class. NULL ids take part; a class of only such rows has a NULL class_id. No
row, no class. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW, Scratch, WordHashes, mix, ngram_hashes, numbered, table, without

WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS = 25, 5
COORDINATES = BANDS * ROWS
#: Signature agreement that decides alone: some four and a half standard errors off.
LOW, HIGH = 0.62, 0.95
#: Texts of a bucket compared with as many others in one block.
CHUNK = 400
#: Shingles sketched at a time.
BLOCK = 40_000

_SLICE, _NEXT, _SEAT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)


def shingles(text: str | None, hashes: WordHashes, words: int = WORDS) -> np.ndarray:
    return ngram_hashes(hashes.of((text or "").split()), words)


def fingerprint(elements: np.ndarray, times: np.ndarray | None = None) -> int:
    """One number for a set of shingles, or for a multiset."""
    with np.errstate(over="ignore"):
        spread = mix(elements + _SLICE) * (np.uint64(1) if times is None else times.astype(np.uint64))
        return int(spread.sum(dtype=np.uint64).astype(np.int64))


def darts(element: np.ndarray, slot: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slot, rank, dart) of all darts on unit regions ``element`` up to the ``rank`` of each."""
    slots, ranks, ids = [], [], []
    at, seed = np.zeros(len(element)), mix(element + _NEXT)
    while len(element):
        at = at - np.log(((seed >> np.uint64(11)).astype(float) + 1.0) * 2.0**-53)
        keep = at <= rank
        slot, at, rank, seed, element = slot[keep], at[keep], rank[keep], seed[keep], element[keep]
        slots.append(slot)
        ranks.append(at)
        ids.append(mix(seed ^ _SEAT))
        with np.errstate(over="ignore"):
            seed = mix(seed + _NEXT)
    return np.concatenate(slots or [slot]), np.concatenate(ranks or [at]), np.concatenate(ids or [seed])


def signatures(sets: list[np.ndarray], weights: list[np.ndarray] | None = None, k: int = COORDINATES) -> np.ndarray:
    """One row of ``k`` 64-bit darts per set of element hashes; weights are whole numbers, 1 if not given."""
    out = np.zeros((len(sets), k), np.uint64)
    filled = np.zeros((len(sets), k), bool)
    goal = k * (math.log(k) + 2)
    todo = [i for i, s in enumerate(sets) if len(s)]
    while todo:
        elements, owners = [], []
        for i in todo:
            s = sets[i]
            if weights is not None:
                w = weights[i].astype(np.int64)
                nth = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
                with np.errstate(over="ignore"):
                    s = mix(np.repeat(s, w) + nth.astype(np.uint64) * _SLICE)
            elements.append(s)
            owners.append(np.full(len(s), i))
        element, owner = np.concatenate(elements), np.concatenate(owners)
        total = np.bincount(owner, minlength=len(sets))
        slot, rank, dart = darts(element, owner, (goal / np.maximum(1, total))[owner])
        order = np.argsort(-rank, kind="stable")  # the earliest dart is written last
        where = slot[order] * k + ((dart[order] >> np.uint64(32)) % np.uint64(k)).astype(np.int64)
        out.reshape(-1)[where] = dart[order]
        filled.reshape(-1)[where] = True
        todo = [i for i in todo if not filled[i].all()]
        goal *= 2
    return out


def _sketch(words: int, weighted: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            texts, low = batch.column(1).to_pylist(), 0
            while low < len(texts):
                sets, counts, high, size = [], [], low, 0
                while high < len(texts) and size < BLOCK:
                    s, n = np.unique(shingles(texts[high], hashes, words), return_counts=True)
                    sets.append(s)
                    counts.append(n)
                    size += int(n.sum()) if weighted else len(s)
                    high += 1
                made = signatures(sets, counts if weighted else None).astype("<u2")
                prints = [fingerprint(s, n if weighted else None) if len(s) else None for s, n in zip(sets, counts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(prints, pa.int64()), pa.array([m.tobytes() for m in made], pa.binary())],
                    ["doc_id", "print", "signature"],
                )
                low = high

    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        sig = np.frombuffer(b"".join(b["signature"].to_pylist()), "<u2").reshape(-1, BANDS, ROWS).astype(np.uint64)
        key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), sig.shape[:2])
        with np.errstate(over="ignore"):
            for r in range(ROWS):
                key = mix(key * np.uint64(0x100000001B3) + sig[:, :, r])
        prints = np.repeat(b["print"].to_numpy(), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(key.reshape(-1).view(np.int64)), pa.array(prints)], ["key", "print"])


def _agreement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if b.num_rows:
            one, two = (np.frombuffer(b"".join(b[c].to_pylist()), "<u2").reshape(-1, COORDINATES) for c in ("sa", "sb"))
            yield pa.RecordBatch.from_arrays([b["a"], b["b"], pa.array((one == two).mean(1))], ["a", "b", "agreement"])


def _sets(words: int, weighted: bool = False):
    """Sorted 64-bit shingles of the texts whose fingerprint is the one asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for b in batches:
            sets = [np.unique(shingles(t, hashes, words)) for t in b["text"].to_pylist()]
            # Rows that share an id bring each other's texts; only the fingerprint's own stays.
            own = [i for i, (s, p) in enumerate(zip(sets, b["print"].to_pylist())) if weighted or fingerprint(s) == p]
            yield pa.RecordBatch.from_arrays([b["print"].take(pa.array(own, pa.int64())), pa.array([sets[i].tobytes() for i in own], pa.binary())], ["print", "shingles"])

    return run


def _exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sims = []
        for x, y in zip(b["sa"].to_pylist(), b["sb"].to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            sims.append(both / (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([b["a"], b["b"], pa.array(sims, pa.float64())], ["a", "b", "similarity"])


def forest(sets: list[np.ndarray], component: list[int], similarity: float) -> list[tuple[int, int]]:
    """Pairs at least ``similarity`` alike that join the components of these sets, one per join."""
    sizes = np.array([len(x) for x in sets], np.float32)
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), sizes.astype(int))
    both = np.zeros((len(sets), len(sets)), np.float32)
    shared = times[column] > 1  # what only one set holds meets nothing
    narrow = np.cumsum(times > 1) - 1
    column, row = narrow[column[shared]], row[shared]
    order = np.argsort(column, kind="stable")
    column, row = column[order], row[order]
    width = min(8192, int(column[-1]) + 1) if len(column) else 1
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (low, low + width))
        part = np.zeros((len(sets), width), np.float32)
        part[row[a:b], column[a:b] - low] = 1.0
        both += part @ part.T
    names = np.unique(component, return_inverse=True)[1]
    alike = (both >= similarity * (sizes[:, None] + sizes[None, :] - both) - 1e-3) & (names[:, None] < names[None, :])
    root, out = np.arange(names.max() + 1), []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for i, j in zip(*np.nonzero(alike)):
        a, b = find(names[i]), find(names[j])
        if a != b:
            root[a] = b
            out.append((int(i), int(j)))
    return out


def _blocks(similarity: float):
    """Rows sorted by block to the links that join components; a block is held until it is whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(prints: list[int], component: list[int], raw: list[bytes]) -> pa.RecordBatch:
            pairs = forest([np.frombuffer(r, np.uint64) for r in raw], component, similarity) if len(set(component)) > 1 else []
            ends = [[prints[p[k]] for p in pairs] for k in (0, 1)]
            return pa.RecordBatch.from_arrays([pa.array(e, pa.int64()) for e in ends], ["a", "b"])

        at, held = None, ([], [], [])
        for b in batches:
            for row in zip(*(b[c].to_pylist() for c in ("key", "lo", "hi", "print", "component", "shingles"))):
                if row[:3] != at:
                    if at is not None:
                        yield links(*held)
                    at, held = row[:3], ([], [], [])
                for column, value in zip(held, row[3:]):
                    column.append(value)
        if at is not None:
            yield links(*held)

    return run


def _both(edges: DataFrame, values: DataFrame, column: str) -> DataFrame:
    """Edges (a, b) with the value of either end as sa and sb."""
    one = values.select(F.col("print").alias("a"), F.col(column).alias("sa"))
    two = values.select(F.col("print").alias("b"), F.col(column).alias("sb"))
    return edges.join(one, "a").join(two, "b").select("a", "b", "sa", "sb")


def shingle_sets(asked: DataFrame, docs: DataFrame, words: int, weighted: bool) -> DataFrame:
    """(print, shingles) of the representatives asked for: (print, doc_id)."""
    texts = docs.join(asked.withColumnRenamed("doc_id", "__id"), docs.doc_id.eqNullSafe(F.col("__id"))).select("print", "text")
    return texts.mapInArrow(_sets(words, weighted), "print long, shingles binary").dropDuplicates(["print"])


def verified(edges: DataFrame, reps: DataFrame, docs: DataFrame, scratch: Scratch, name: str, words: int, similarity: float, weighted: bool) -> DataFrame:
    """The edges whose ends are at least ``similarity`` alike."""
    seen = scratch.keep(_both(edges, reps, "signature").mapInArrow(_agreement, "a long, b long, agreement double").filter(F.col("agreement") >= LOW), f"{name}_seen")
    open_ = seen.filter(F.col("agreement") < HIGH)
    asked = open_.select(F.explode(F.array("a", "b")).alias("print")).distinct().join(reps.select("print", "doc_id"), "print")
    sets = scratch.keep(shingle_sets(asked, docs, words, weighted), f"{name}_sets")
    close = _both(open_.select("a", "b"), sets, "shingles").mapInArrow(_exact, "a long, b long, similarity double").filter(F.col("similarity") >= similarity)
    links = scratch.keep(seen.filter(F.col("agreement") >= HIGH).select("a", "b").unionByName(close.select("a", "b")), f"{name}_links")
    scratch.drop(f"{name}_seen", f"{name}_sets")
    return links


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(print, component) of all linked nodes: smallest label of the neighbours, then of the label's own label.

    Each round's labels are a written table, so no round is computed twice.
    """
    ends = scratch.keep(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}_ends")
    labels = scratch.keep(ends.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("c")), f"{name}_0")
    n = 0
    while True:
        n += 1
        near = ends.join(labels.select(F.col("a").alias("b"), F.col("c").alias("nc")), "b").groupBy("a").agg(F.min("nc").alias("nc"))
        lower = labels.join(near, "a").select("a", F.col("c").alias("old"), F.least("c", "nc").alias("c"))
        hop = labels.select(F.col("a").alias("c"), F.col("c").alias("cc"))
        step = lower.join(hop, "c").select("a", "old", F.least("c", "cc").alias("c"))
        fresh = scratch.keep(step, f"{name}_{n}")
        scratch.drop(f"{name}_{n - 1}")
        labels = fresh.select("a", "c")
        if fresh.filter("old <> c").isEmpty():
            scratch.drop(f"{name}_ends")
            return labels.select(F.col("a").alias("print"), F.col("c").alias("component"))


def near_classes(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = WORDS, similarity: float = SIMILARITY, weighted: bool = False) -> DataFrame:
    """One row per document: doc_id, class_id (the smallest id of its class), class_size.

    ``weighted`` counts repeated shingles in the signatures; the exact check is on sets.
    """
    scratch = Scratch(docs.sparkSession, "near")
    docs = docs.select(F.col(id).alias("doc_id"), F.col(text).alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    sketch = scratch.keep(docs.mapInArrow(_sketch(words, weighted), f"doc_id {kind}, print long, signature binary"), "sketch")
    reps = sketch.filter("print IS NOT NULL").groupBy("print").agg(F.min("doc_id").alias("doc_id"), F.first("signature").alias("signature"))
    reps = scratch.keep(reps, "reps")
    rows = reps.select("print", "signature").mapInArrow(_bands, "key long, print long")
    hubs = rows.groupBy("key").agg(F.min("print").alias("hub"), F.count("*").alias("n")).filter("n > 1").select("key", "hub")
    shared = scratch.keep(rows.join(hubs, "key"), "shared")

    spokes = shared.filter("print <> hub").select(F.col("print").alias("a"), F.col("hub").alias("b")).distinct()
    links = verified(spokes, reps, docs, scratch, "spokes", words, similarity, weighted)
    labels = components(links, scratch, "first")
    # What a hub did not bring together: buckets with several components, hubs aside, in blocks.
    placed = shared.filter("print <> hub").join(labels, "print", "left").select("key", "print", F.coalesce("component", "print").alias("component"))
    split = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n")).filter("lo < hi")
    apart = scratch.keep(placed.join(split.select("key", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")), "key"), "apart")
    asked = apart.select("print").distinct().join(reps.select("print", "doc_id"), "print")
    sets = scratch.keep(shingle_sets(asked, docs, words, weighted), "sets")
    mine = F.pmod(F.xxhash64("print"), F.col("chunks")).cast("int")
    blocks = apart.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select("key", F.least(mine, "other").alias("lo"), F.greatest(mine, "other").alias("hi"), "print", "component")
    ordered = blocks.join(sets, "print").repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "print")
    more = scratch.keep(ordered.mapInArrow(_blocks(similarity), "a long, b long").distinct(), "more")
    scratch.drop("sets", "apart")
    if not more.isEmpty():
        labels = components(links.unionByName(more), scratch, "second")

    classed = sketch.select("doc_id", "print").join(labels, "print", "left").select("doc_id", F.coalesce("component", "print").alias("class"))
    groups = classed.filter("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).filter("n > 1")
    return classed.join(groups, "class", "left").select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("first")).alias("class_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("class_size"),
    )


def drop_near_copies(docs: DataFrame, id: str = "doc_id", text: str = "text", stored: bool = False) -> DataFrame:
    """The documents that stay, one row of each class, all their columns. Rows are told apart by
    their place, so ids may repeat or be NULL."""
    scratch = Scratch(docs.sparkSession, "near")
    rows = numbered(docs, scratch, stored)
    classes = near_classes(rows, ROW, text)
    return without(rows, classes.filter("doc_id <> class_id").select(F.col("doc_id").alias(ROW)))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents"))
