"""Repeated byte strings across documents, by a column-wise suffix order of many strings.

1. Cover. Every window of LENGTH bytes is named by its minimizer, the smallest hash among the
   GRAM-byte strings inside it. Consecutive windows with one name are a segment. Equal windows
   have equal names, whatever stands around them.
2. Refine. Segments are sorted by (name, hash of the whole segment, document). Read in that
   order, a segment whose equal stands in a smaller document is covered whole. Of each distinct
   segment all that stand in its smallest document go on, if its name has more than one.
3. Order. The distinct segments of a name are a small collection of strings; what is covered in
   one holds for all its repeats in the document. Its suffix order is
   built column by column: each round puts one more symbol in front of every string and reads the
   collection's Burrows-Wheeler transform once, from front to back, in a stable distribution by
   symbol that yields the next order. Neighbours that share LENGTH bytes are one group; each
   member outside the group's smallest document is covered. Strings that share too little around
   their name to have a window in common are left out before.
4. Cut. Covered windows meet their documents; their union is what is removed.

A name with more than MOST distinct segments (what follows a passage that very many documents
share) is not one collection: its segments are split into single windows, which go through step 2
alone, in sorted order and without being held.

The transform of a round is an array of the task, not a file: collections are cut at BLOCK bytes
between names, so that they fit. Tables between the steps lie in the shared scratch folder.

Cases. NULL text is empty. Texts shorter than LENGTH keep all. Strings never reach from one
document into the next. A NULL id is smaller than any other. Rows with equal ids never cover each
other; each gets a row of its own. A string repeated inside one document only is kept.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, mix, table

LENGTH, GRAM = 50, 20
#: Longest segment in windows; bytes of text hashed at a time, and of a collection ordered at a time.
LONGEST, CHUNK, BLOCK = 64, 1 << 20, 1 << 18
#: Distinct segments of one name that are ordered in one task; larger names are split by window.
MOST = 20_000
_NO_ID = -(2**63)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _running(x: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` over each run of ``width`` values, by doubling."""
    k = 1
    while 2 * k <= width:
        x = pick(x[:-k], x[k:])
        k *= 2
    rest = width - k
    return pick(x[: len(x) - rest], x[rest:]) if rest else x


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on, as numbers."""
    return np.ndarray((max(0, len(data) - 7),), "<u8", data.data, strides=(1,)) if len(data) > 7 else np.zeros(0, np.uint64)


class Prefixes:
    """Hashes of any substring, from sums of symbols times powers of an odd number."""

    def __init__(self):
        self.base, self.inverse = np.uint64(0xD1342543DE82EF95), np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))
        self.up = self.down = np.ones(1, np.uint64)
        self.symbol = mix(np.arange(256, dtype=np.uint64) * _ODD + np.uint64(1))

    def _grow(self, n: int) -> None:
        if n > len(self.up):
            with np.errstate(over="ignore"):
                self.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, self.base)]), dtype=np.uint64)
                self.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, self.inverse)]), dtype=np.uint64)

    def of(self, data: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        self._grow(len(data))
        with np.errstate(over="ignore"):
            total = np.concatenate([[np.uint64(0)], np.cumsum(self.symbol[data] * self.up[: len(data)], dtype=np.uint64)])
            return mix((total[high] - total[low]) * self.down[low] + (high - low).astype(np.uint64))


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """The hash of the GRAM bytes from each place on."""
    w = _words(data)
    with np.errstate(over="ignore"):
        last, middle = w[GRAM - 8 :], w[GRAM // 2 - 4 : len(w) - GRAM + GRAM // 2 + 4]
        return mix(mix(w[: len(last)] * _ODD ^ middle[: len(last)]) + last)


def segments(data: np.ndarray, starts: np.ndarray, prefixes: Prefixes) -> tuple[np.ndarray, ...]:
    """(name, low, windows, hash) of the segments of the texts that begin at ``starts``."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none, none, none, none
    grams = gram_hashes(data)
    name = _running(grams, LENGTH - GRAM + 1, np.minimum)
    owner = np.zeros(len(data), np.int32)
    owner[starts[1:]] = 1
    owner = np.cumsum(owner, dtype=np.int32)
    inside = owner[: len(name)] == owner[LENGTH - 1 :]
    begins = np.flatnonzero(inside & np.concatenate([[True], (name[1:] != name[:-1]) | ~inside[:-1]]))
    breaks = np.flatnonzero(np.concatenate([(name[1:] != name[:-1]) | ~inside[1:], [True]]) & inside) + 1
    long = breaks - begins > LONGEST
    if long.any():  # a short period: cut into pieces counted from where the name began
        cuts = [np.arange(b + LONGEST, e, LONGEST) for b, e in zip(begins[long], breaks[long])]
        begins, breaks = np.sort(np.concatenate([begins, *cuts])), np.sort(np.concatenate([breaks, *cuts]))
    return name[begins].view(np.int64), begins, breaks - begins, prefixes.of(data, begins, breaks + LENGTH - 1)


def _cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents to one row per segment: name, hash, id, row number, start, windows."""
    prefixes = Prefixes()
    for b in batches:
        ids, numbers = b["doc"].to_numpy(), b["row"].to_numpy()
        texts, low = b["text"].cast(pa.binary()).to_pylist(), 0
        while low < len(texts):
            high, size = low, 0
            while high < len(texts) and (high == low or size + len(texts[high]) <= CHUNK):
                size += len(texts[high])
                high += 1
            part = [(i, t) for i, t in enumerate(texts[low:high], low) if len(t) >= LENGTH]
            rows = np.array([i for i, _ in part], np.int64)
            starts = np.cumsum([0] + [len(t) for _, t in part])[:-1]
            name, begin, windows, content = segments(np.frombuffer(b"".join(t for _, t in part), np.uint8), starts, prefixes)
            at = np.searchsorted(starts, begin, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(name), pa.array(content.view(np.int64)), pa.array(ids[rows[at]]), pa.array(numbers[rows[at]]), pa.array((begin - starts[at]).astype(np.int32)), pa.array(windows.astype(np.int16))],
                ["name", "content", "doc", "row", "start", "windows"],
            )
            low = high


FOUND = "name long, doc long, row long, start int, windows short, open boolean, first boolean"


def _refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order (name, content, doc), read once. Covered segments come out with ``open``
    false. Where a name has several contents, the rows of each content's smallest document come
    out with ``open`` true, and the first of them with ``first`` true."""
    last_name = last_content = last_doc = None
    several, waiting = False, []

    def out(b: pa.RecordBatch, rows: np.ndarray, open_: bool, first: np.ndarray) -> pa.RecordBatch:
        part = b.take(pa.array(rows)).select(["name", "doc", "row", "start", "windows"])
        return pa.RecordBatch.from_arrays([*part.columns, pa.array(np.full(len(rows), open_)), pa.array(first[rows])], [*part.schema.names, "open", "first"])

    for b in batches:
        if not b.num_rows:
            continue
        name, content, doc = b["name"].to_numpy(), b["content"].to_numpy(), b["doc"].to_numpy()
        new_name = np.concatenate([[last_name is None or name[0] != last_name], name[1:] != name[:-1]])
        new_content = new_name | np.concatenate([[content[0] != last_content], content[1:] != content[:-1]])
        firsts = np.flatnonzero(new_content)
        of = np.searchsorted(firsts, np.arange(len(name)), "right") - 1
        first_doc = np.where(of >= 0, doc[firsts[np.maximum(of, 0)]] if len(firsts) else 0, last_doc if last_doc is not None else 0)
        least = doc == first_doc
        # Contents per name in this batch; the first name may go on from the batch before.
        group = np.cumsum(new_name)
        kinds = np.bincount(group[firsts], minlength=group[-1] + 1)
        carried = not new_name[0]
        if carried:
            kinds[group[0]] += 2 if several else 1
        if waiting and (not carried or kinds[group[0]] > 1):
            if carried:
                yield from waiting
            waiting = []
        if group[-1] != group[0]:  # the first name ends here
            waiting = []
        yield out(b, np.flatnonzero(~least), False, new_content)
        yield out(b, np.flatnonzero(least & (kinds[group] > 1)), True, new_content)
        if kinds[group[-1]] == 1:  # the last name's only content waits: the next batch may bring another one
            waiting.append(out(b, np.flatnonzero(least & (group == group[-1])), True, new_content))
        several = bool(kinds[group[-1]] > 1)
        last_name, last_content = name[-1], content[-1]
        last_doc = doc[firsts[-1]] if len(firsts) else last_doc


def suffix_order(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places of all suffixes of the strings in lexicographic order, a column at a time.

    ``data`` holds the strings, each followed by a byte that closes it (at ``ends``); closing
    bytes are smaller than all symbols, and in the order of the strings. After round r the order
    has all suffixes of up to r symbols. The symbols in front of them, in that order, are the
    collection's Burrows-Wheeler transform so far; distributing it by symbol, stably, is the
    order of all suffixes that are one symbol longer, with the empty ones before them.
    """
    first = np.zeros(len(data), bool)
    first[starts] = True
    order = ends = ends.astype(np.int32)
    for _ in range(int((ends - starts).max(initial=0))):
        longer = order[~first[order]]
        transform = data[longer - 1]
        order = np.concatenate([ends, longer[np.argsort(transform, kind="stable")] - 1])
    return order


def covered_windows(strings: list[bytes], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, start, windows) of runs of windows that also stand in a string of a smaller document."""
    sizes = np.array([len(s) for s in strings], np.int64)
    data = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    order = suffix_order(data, starts, ends)
    owner = np.repeat(np.arange(len(strings)), sizes + 1)
    windows = order[ends[owner[order]] - order >= LENGTH]
    none = np.zeros(0, np.int64)
    if not len(windows):
        return none, none, none
    w = _words(data)
    same = np.ones(len(windows) - 1, bool)  # common prefix of neighbours in the order reaches LENGTH
    for k in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
        same &= w[windows[:-1] + k] == w[windows[1:] + k]
    heads = np.flatnonzero(np.concatenate([[True], ~same]))
    held = docs[owner[windows]]
    least = np.repeat(np.minimum.reduceat(held, heads), np.diff([*heads, len(windows)]))
    place = np.sort(windows[held > least])
    if not len(place):
        return none, none, none
    # Neighbouring places of one string are at least a string's end apart from those of the next.
    run = np.flatnonzero(np.concatenate([[True], np.diff(place) != 1]))
    string = owner[place[run]]
    return string, place[run] - starts[string], np.diff([*run, len(place)])


def _bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with their open segments to one row per segment with its bytes."""
    for b in batches:
        names, places, starts, out = [], [], [], []
        for place, (text, open_) in enumerate(zip(b["text"].cast(pa.binary()).to_pylist(), b["segments"].to_pylist())):
            for s in open_:
                names.append(s["name"])
                places.append(place)
                starts.append(s["start"])
                out.append(text[s["start"] : s["start"] + s["windows"] + LENGTH - 1])
        own = pa.array(places, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int64()), b["doc"].take(own), b["row"].take(own), pa.array(starts, pa.int32()), pa.array(out, pa.binary())],
            ["name", "doc", "row", "start", "bytes"],
        )


def _single(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments to one row per window, named by the window itself; read by ``_refine`` again."""
    for b in batches:
        rows, starts, names, contents = [], [], [], []
        for i, (start, raw) in enumerate(zip(b["start"].to_pylist(), b["bytes"].to_pylist())):
            for k in range(len(raw) - LENGTH + 1):
                digest = hashlib.blake2b(raw[k : k + LENGTH], digest_size=12).digest()
                rows.append(i)
                starts.append(start + k)
                names.append(int.from_bytes(digest[:8], "little", signed=True))
                contents.append(int.from_bytes(digest[8:], "little", signed=True))
        own = b.take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.int64()), pa.array(contents, pa.int32()), own["doc"], own["row"], pa.array(starts, pa.int32()), pa.array(np.ones(len(rows), np.int16))],
            ["name", "content", "doc", "row", "start", "windows"],
        )


def may_share(strings: list[bytes], names: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Which strings can have a window of another document's string of the same name.

    A window holds the string that names it and LENGTH - GRAM bytes around that, half of them on
    one side. So two strings with a window in common also share the named string with as many
    bytes on its left or on its right; one that shares neither with another document is done.
    Where the named string stands twice, the string is not judged.
    """
    side = (LENGTH - GRAM) // 2
    sizes = np.array([len(s) for s in strings], np.int64)
    found = [np.zeros((4, 0), np.int64)]  # string, side, hash of that side, and 0 for a place of the name alone
    low = 0
    while low < len(strings):  # some strings at a time, so that hashes of all places stay few
        high = max(low + 1, int(np.searchsorted(np.cumsum(sizes[low:]), CHUNK // 2, "right")) + low)
        data = np.frombuffer(b"".join(strings[low:high]), np.uint8)
        starts = np.cumsum(sizes[low:high]) - sizes[low:high]
        owner = np.repeat(np.arange(low, high), sizes[low:high])[: len(data) - GRAM + 1]
        at = np.flatnonzero((gram_hashes(data) == names.view(np.uint64)[owner]) & (np.arange(len(owner)) - starts[owner - low] + GRAM <= sizes[owner]))
        own = owner[at]
        begin = starts[own - low]
        for left in (True, False):
            first = at - side if left else at
            inside = (first >= begin) & (first + GRAM + side <= begin + sizes[own])
            bytes_ = data[first[inside][:, None] + np.arange(GRAM + side)].astype(np.uint64)
            with np.errstate(over="ignore"):
                content = mix((mix(bytes_ + _ODD) * mix(np.arange(1, GRAM + side + 1, dtype=np.uint64) * _ODD)).sum(1, dtype=np.uint64))
            found.append(np.stack([own[inside], np.full(inside.sum(), left), content.view(np.int64), np.ones(inside.sum(), np.int64)]))
        found.append(np.stack([own, np.zeros_like(own), np.zeros_like(own), np.zeros_like(own)]))
        low = high
    who, left, content, judged = np.concatenate(found, 1)
    kept = np.bincount(who[judged == 0], minlength=len(strings)) != 1
    for side_ in (1, 0):
        own, bytes_ = who[(judged == 1) & (left == side_)], content[(judged == 1) & (left == side_)]
        if not len(own):
            continue
        # Equal (name, bytes) of several documents stand together in this order.
        order = np.lexsort((docs[own], bytes_, names[own]))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(names[own][order]) != 0) | (np.diff(bytes_[order]) != 0)
        firsts = np.flatnonzero(new)
        lasts = np.append(firsts[1:], len(order)) - 1
        several = docs[own][order][firsts] != docs[own][order][lasts]
        kept[own[order][several[np.cumsum(new) - 1]]] = True
    return kept


def _collection(t: pa.Table) -> pa.RecordBatch:
    """Segments of whole names to the covered runs of each."""
    coded = t["bytes"].combine_chunks().dictionary_encode()
    code = coded.indices.to_numpy().astype(np.int64)
    name, doc, row, start = (t[c].to_numpy() for c in ("name", "doc", "row", "start"))
    # What one document repeats is one string of the collection, handed to each of its rows.
    order = np.lexsort((code, doc, name))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(name[order]) != 0) | (np.diff(doc[order]) != 0) | (np.diff(code[order]) != 0)
    key = np.empty(len(order), np.int64)
    key[order] = np.cumsum(new) - 1
    firsts = order[new]
    strings = coded.dictionary.take(pa.array(code[firsts])).to_pylist()
    some = np.flatnonzero(may_share(strings, name[firsts], doc[firsts]))
    string, at, n = covered_windows([strings[i] for i in some], doc[firsts[some]])
    string = some[string]
    cuts = np.searchsorted(string, np.arange(len(firsts) + 1))
    sizes = np.diff(cuts)[key]
    own = np.repeat(np.arange(len(key)), sizes)
    run = np.arange(len(own)) + np.repeat(cuts[key] - np.cumsum(sizes) + sizes, sizes)
    none = pa.array(np.zeros(len(own), bool))
    return pa.RecordBatch.from_arrays(
        [pa.array(name[own]), pa.array(doc[own]), pa.array(row[own]), pa.array((start[own] + at[run]).astype(np.int32)), pa.array(n[run].astype(np.int16)), none, none],
        ["name", "doc", "row", "start", "windows", "open", "first"],
    )


def _order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments sorted by name to covered runs of windows; a collection ends between two names."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        # A batch may be large; a collection should not be.
        sizes = np.cumsum(pc.binary_length(b["bytes"]).to_numpy(zero_copy_only=False))
        cuts = [0, *np.searchsorted(sizes, np.arange(BLOCK, sizes[-1] if len(sizes) else 0, BLOCK)).tolist(), b.num_rows]
        for low, high in zip(cuts, cuts[1:]):
            if high > low:
                held.append(b.slice(low, high - low))
                size += int(sizes[high - 1] - (sizes[low - 1] if low else 0))
            if size >= BLOCK:
                t = pa.Table.from_batches(held)
                names = t["name"].to_numpy()
                end = int(np.flatnonzero(np.diff(names))[-1]) + 1 if names[0] != names[-1] else 0
                if end:
                    yield _collection(t.slice(0, end))
                    rest = t.slice(end)
                    held, size = rest.to_batches(), int(pc.sum(pc.binary_length(rest["bytes"])).as_py())
    if held:
        yield _collection(pa.Table.from_batches(held))


def _cut(with_text: bool):
    """Documents with their covered runs to what is removed and what is left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, removed, spans, digests, kept_texts = [], [], [], [], []
            for text, runs in zip(b["text"].cast(pa.binary()).to_pylist(), b["runs"].to_pylist()):
                kept, at, gone, n = [], 0, 0, 0
                for low, high in sorted((r["start"], r["start"] + r["windows"] + LENGTH - 1) for r in runs or ()):
                    if low > at or not n:
                        kept.append(text[at:low])
                        gone += high - low
                        n += 1
                        at = high
                    elif high > at:
                        gone += high - at
                        at = high
                kept.append(text[at:])
                sizes.append(len(text))
                removed.append(gone)
                spans.append(n)
                rest = b"".join(kept)
                digests.append(hashlib.sha256(rest).hexdigest())
                if with_text:
                    kept_texts.append(rest)
            columns = [b["doc_id"], *(pa.array(c, pa.int64()) for c in (sizes, removed, spans)), pa.array(digests, pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                columns, names = [*columns, pa.array(kept_texts, pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", with_text: bool = True, most: int = MOST, stored: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and kept: the bytes that are left.

    Rows are told apart by their number, not their id, and are read three times; ``stored`` says that
    ``docs`` is a table as read from storage, whose rows come in the same order each time. Anything
    else is stored first.
    """
    scratch = Scratch(docs.sparkSession, "suffix")
    docs = docs.select(F.col(id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if not stored:
        docs = scratch.keep(docs, "docs")
    keyed = docs.select("doc_id", F.coalesce("doc_id", F.lit(_NO_ID)).cast("long").alias("doc"), F.monotonically_increasing_id().alias("row"), "text")
    covers = keyed.select("doc", "row", "text").mapInArrow(_cover, "name long, content long, doc long, row long, start int, windows short")
    ordered = covers.repartition("name").sortWithinPartitions("name", "content", "doc")
    found = scratch.keep(ordered.mapInArrow(_refine, FOUND), "found")
    # Segments whose name has several contents get their bytes back and are ordered.
    hot = found.filter("open").groupBy("name").agg(F.count_if("first").alias("n")).filter(F.col("n") > most).select("name", F.lit(True).alias("hot"))
    asked = found.filter("open").groupBy("row").agg(F.collect_list(F.struct("name", "start", "windows")).alias("segments"))
    strings = keyed.select("doc", "row", "text").join(asked, "row").select("doc", "row", "text", "segments")
    strings = strings.mapInArrow(_bytes, "name long, doc long, row long, start int, bytes binary")
    strings = scratch.keep(strings.join(hot, "name", "left"), "strings")
    more = strings.filter("hot IS NULL").repartition("name").sortWithinPartitions("name", "doc").mapInArrow(_order, FOUND)
    split = strings.filter("hot").mapInArrow(_single, "name long, content int, doc long, row long, start int, windows short")
    split = split.repartition("name", "content").sortWithinPartitions("name", "content", "doc").mapInArrow(_refine, FOUND)
    more = scratch.keep(more.unionByName(split.filter(~F.col("open"))), "more")
    scratch.drop("strings")
    runs = found.filter(~F.col("open")).unionByName(more).groupBy("row").agg(F.collect_list(F.struct("start", "windows")).alias("runs"))
    met = keyed.join(runs, "row", "left").select("doc_id", "text", "runs")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return met.mapInArrow(_cut(with_text), schema + (", kept binary" if with_text else ""))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"), with_text=False, stored=True)
