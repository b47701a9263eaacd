"""Best-fit packing of documents into sequences by a grouping genetic algorithm.

A document is its ids and a closing id 0. Longer ones than a sequence are cut; the first piece
takes what is over, so all others are full. What is left is bin packing. Pieces are dealt into
problems of bounded size. Each problem is evolved on several islands, all the problem's own
tasks; between epochs the best packing of each island moves on to the next island.

Each problem leaves some bins that are not full. Their pieces, from all problems together, are the
pieces of a next level, packed the same way, until a level is one problem; a level that saves no
bin is left as it was.

A packing is a list of bins, and the operators work on bins, not on single pieces. Crossover
takes well-filled bins of one parent into the other, drops the bins there that hold the same
pieces twice, and puts the displaced pieces back by best fit, longest first. Mutation empties the
worst bins and refills the same way.

Cases. A NULL text is empty: its piece is the closing id alone. Rows that repeat an id are packed
each for itself. A NULL id is carried along. An empty table gives no pieces. Problems are
dealt by where a row was read, not by its id, so repeated ids cannot pile up in one.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import reduce
from random import Random

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, mix, table
from .tokens import Encoder

CAPACITY = 2048
#: Pieces of one problem, islands of a problem, packings on an island, and generations an epoch.
#: Evolution ends early only where a packing has as few bins as any can have.
PROBLEM, ISLANDS, POPULATION, EPOCHS, GENERATIONS = 4096, 2, 6, 3, 16
#: Bins filled less than this, and at most one of so many of a problem, are packed again together
#: with those of the other problems.
FILLED, AGAIN = 0.98, 8
#: Texts encoded at a time.
BATCH = 1024


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# --- pieces -----------------------------------------------------------------------------


def pieces(docs: DataFrame, capacity: int = CAPACITY, id: str = "doc_id", text: str = "text", vocab: str | None = None, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, slot, and with ``with_ids`` the ids as bytes.

    ``slot`` spreads rows evenly over problems whatever their ids are.
    """
    vocab = vocab or vocabulary()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task, count = Encoder.of_worker(vocab), TaskContext.get().partitionId(), 0
        for batch in batches:
            for low in range(0, batch.num_rows, BATCH):
                part = batch.slice(low, BATCH)
                owners, rows, ids = [], [], []
                for i, raw in enumerate(encoder.encode([t or "" for t in part.column(1).to_pylist()])):
                    raw += b"\0\0\0\0"
                    total, start = len(raw) // 4, 0
                    while start < total:
                        length = (total - start) % capacity or capacity
                        own = raw[4 * start : 4 * (start + length)]
                        owners.append(i)
                        rows.append((start, length, zlib.crc32(own)))
                        if with_ids:
                            ids.append(own)
                        start += length
                number = np.array(owners)
                nth = number * 0 if not len(number) else np.arange(len(number)) - np.searchsorted(number, number)
                start, length, crc = (np.array(c, np.int64) for c in (zip(*rows) if rows else ((), (), ())))
                slot = mix(np.arange(count, count + len(rows), dtype=np.uint64) + np.uint64(task << 40)).view(np.int64)
                count += len(rows)
                columns = [part.column(0).take(pa.array(owners, pa.int64())), pa.array(nth, pa.int32()), pa.array(start), pa.array(length), pa.array(crc), pa.array(slot)]
                names = ["doc_id", "piece", "start", "length", "ids_crc32", "slot"]
                if with_ids:
                    columns, names = [*columns, pa.array(ids, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = docs.schema[id].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, slot long" + (", ids binary" if with_ids else "")
    return docs.select(id, text).mapInArrow(cut, schema)


# --- the grouping genetic algorithm -------------------------------------------------------


def best_fit(bins: list[list[int]], todo: list[int], size: list[int], capacity: int) -> list[list[int]]:
    """Put pieces into the fullest bin that takes them, a new one if none does."""
    free = sorted((capacity - sum(size[i] for i in b), n) for n, b in enumerate(bins))
    for i in todo:
        at = bisect_left(free, (size[i], -1))
        if at == len(free):
            bins.append([i])
            room, n = capacity - size[i], len(bins) - 1
        else:
            room, n = free.pop(at)
            bins[n].append(i)
            room -= size[i]
        if room:
            insort(free, (room, n))
    return bins


def _rank(bins: list[list[int]], size: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first; of as many, the more uneven ones, as those can still be emptied."""
    return len(bins), -sum((sum(size[i] for i in b) / capacity) ** 2 for b in bins)


def crossover(one: list[list[int]], other: list[list[int]], size: list[int], capacity: int, rng: Random) -> list[list[int]]:
    full = [b for b in other if sum(size[i] for i in b) >= 0.98 * capacity]
    given = rng.sample(full, min(len(full), max(1, len(other) // 8)))
    taken = {i for b in given for i in b}
    child, displaced = [list(b) for b in given], []
    for b in one:
        if taken.isdisjoint(b):
            child.append(list(b))
        else:
            displaced += [i for i in b if i not in taken]
    displaced.sort(key=lambda i: -size[i])
    return best_fit(child, displaced, size, capacity)


def mutate(bins: list[list[int]], size: list[int], capacity: int, rng: Random) -> list[list[int]]:
    order = sorted(range(len(bins)), key=lambda n: sum(size[i] for i in bins[n]))
    worst = set(order[: max(2, len(bins) // 50)]) | set(rng.sample(order, min(len(order), 3)))
    todo = [i for n in worst for i in bins[n]]
    rng.shuffle(todo)
    return best_fit([list(b) for n, b in enumerate(bins) if n not in worst], todo, size, capacity)


def first_packings(size: list[int], capacity: int, rng: Random, n: int) -> list[list[list[int]]]:
    """Best fit over the pieces from long to short, exactly and with more and more disorder; one
    that no packing can beat is the last."""
    out, least = [], -(-sum(size) // capacity)
    for k in range(n):
        noise = 0.05 * k * capacity
        order = sorted(range(len(size)), key=lambda i: -size[i] - noise * rng.random())
        out.append(best_fit([], order, size, capacity))
        if len(out[-1]) <= least:
            break
    return out


def evolve(population: list[list[list[int]]], size: list[int], capacity: int, rng: Random, generations: int) -> list[list[list[int]]]:
    """Steady state: each child takes the place of the worst if it is better. Best first."""
    least = -(-sum(size) // capacity)
    ranked = sorted(((_rank(b, size, capacity), k, b) for k, b in enumerate(population)), key=lambda x: x[:2])
    for g in range(generations):
        if ranked[0][0][0] <= least:  # no packing can have fewer
            break
        one, other = rng.sample(ranked, 2) if len(ranked) > 1 else (ranked[0], ranked[0])
        child = mutate(crossover(one[2], other[2], size, capacity, rng), size, capacity, rng)
        rank = _rank(child, size, capacity)
        if rank < ranked[-1][0]:
            ranked[-1] = (rank, len(population) + g, child)
            ranked.sort(key=lambda x: x[:2])
    return [b for _, _, b in ranked]


def _flat(bins: list[list[int]], n: int) -> np.ndarray:
    out = np.empty(n, np.int32)
    for k, b in enumerate(bins):
        out[b] = k
    return out


def _bins(flat: np.ndarray) -> list[list[int]]:
    order = np.argsort(flat, kind="stable")
    return [b.tolist() for b in np.split(order, np.flatnonzero(np.diff(flat[order])) + 1)]


ISLAND = "problem long, island int, rank int, bins int, packing binary, sizes binary"


def _epoch(capacity: int, generations: int, epoch: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        problem, island = int(key[0]), int(key[1])
        rng = Random(f"{problem} {island} {epoch}")
        if epoch == 0:
            size = rows.sort_values("slot")["length"].tolist()
            population = first_packings(size, capacity, rng, POPULATION)
        else:
            size = np.frombuffer(rows["sizes"].iloc[0], np.int32).tolist()
            rows = rows.sort_values(["bins", "rank"])
            population = [_bins(np.frombuffer(p, np.int32)) for p in rows["packing"]]
        best = evolve(population, size, capacity, rng, generations)[:POPULATION]
        sizes = np.array(size, np.int32).tobytes()
        return pd.DataFrame(
            [(problem, island, k, len(b), _flat(b, len(size)).tobytes(), sizes) for k, b in enumerate(best)],
            columns=["problem", "island", "rank", "bins", "packing", "sizes"],
        )

    return run


def _level(rows: DataFrame, scratch: Scratch, capacity: int, problems: int, level: int) -> DataFrame:
    """The pieces with sequence_id, offset, and ``open``: whether their bin may be packed again."""
    rows = rows.withColumn("problem", F.pmod(F.xxhash64("slot", F.lit(level)), F.lit(problems)))
    islands = F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1)))
    state = rows.select("problem", "slot", "length", islands.alias("island")).groupBy("problem", "island")
    state = scratch.keep(state.applyInPandas(_epoch(capacity, GENERATIONS, 0), ISLAND), f"epoch{level}_0")
    least = rows.groupBy("problem").agg(F.ceil(F.sum("length") / capacity).cast("int").alias("least"))
    for e in range(1, EPOCHS):
        # Problems that are solved rest; the elite of every other island goes on to the next one.
        short = state.groupBy("problem").agg(F.min("bins").alias("bins")).join(least, "problem").filter("bins > least").select("problem")
        left = scratch.keep(state.join(short, "problem", "left_semi"), f"left{level}_{e}")
        if left.isEmpty():
            break
        elite = left.filter("rank = 0").withColumn("island", ((F.col("island") + 1) % ISLANDS).cast("int"))
        grown = left.unionByName(elite).groupBy("problem", "island").applyInPandas(_epoch(capacity, GENERATIONS, e), ISLAND)
        state = scratch.keep(grown.unionByName(state.join(short, "problem", "left_anti")), f"epoch{level}_{e}")
    best = state.filter("rank = 0").groupBy("problem").agg(F.min_by("packing", F.struct("bins", "island")).alias("packing"))

    names = [c for c in rows.columns if c != "problem"]
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def place(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        left = left.sort_values("slot", ignore_index=True)
        flat = np.frombuffer(right["packing"].iloc[0], np.int32)
        order = np.argsort(flat, kind="stable")
        length = left["length"].to_numpy()[order]
        ends = np.cumsum(length)
        first = np.searchsorted(flat[order], flat[order])  # where each piece's sequence begins
        fill = np.bincount(flat, left["length"].to_numpy())
        emptiest = np.argsort(fill, kind="stable")[: max(1, len(fill) // AGAIN)]
        again = np.zeros(len(fill), bool)
        again[emptiest[fill[emptiest] < FILLED * capacity]] = True
        left = left.iloc[order].drop(columns=["problem"])
        left["sequence_id"] = (level << 56) + (int(key[0]) << 24) + flat[order].astype(np.int64)
        left["offset"] = ends - length - (ends - length)[first]
        left["open"] = again[flat[order]]
        return left

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in names) + ", sequence_id long, offset long, open boolean"
    return scratch.keep(rows.groupBy("problem").cogroup(best.groupBy("problem")).applyInPandas(place, schema), f"placed{level}")


def pack(rows: DataFrame, scratch: Scratch, capacity: int = CAPACITY, problem: int = PROBLEM) -> DataFrame:
    """Give pieces (``length``, ``slot``, any more columns) their sequence_id and offset.

    ``rows`` must be a stored table. A problem's size is fixed, so tasks stay as small as they
    are however many documents there are.
    """
    done, before, placed, level = [], None, None, 0
    while True:
        problems = max(1, -(-rows.count() // problem))
        now = _level(rows, scratch, capacity, problems, level)
        if placed is not None and now.select("sequence_id").distinct().count() >= before:
            done.append(placed.filter("open"))  # nothing saved
            break
        if problems == 1:
            done.append(now)
            break
        placed, level = now, level + 1
        done.append(placed.filter("NOT open"))
        before = placed.filter("open").select("sequence_id").distinct().count()
        if not before:
            break
        rows = placed.filter("open").drop("sequence_id", "offset", "open")
    return reduce(DataFrame.unionByName, done).drop("slot", "open")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, id: str = "doc_id", text: str = "text", with_ids: bool = False, problem: int = PROBLEM) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids), one row per piece."""
    scratch = Scratch(docs.sparkSession, "packing")
    stored = scratch.keep(pieces(docs, capacity, id, text, with_ids=with_ids), "pieces")
    return pack(stored, scratch, capacity, problem)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its ids as one byte string, from pieces packed ``with_ids``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids")
    )


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
