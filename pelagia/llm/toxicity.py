r"""Toxicity: a learned lexicon, matched with misspellings, weighed by the context of each hit.

Learning. Words are counted per label over all labelled training rows, each distinct text once.
A word is a candidate when the documents that hold it outside quotation are toxic for the most
part and beyond chance: the likelihood ratio must exceed what the best of all words counted would
reach by luck. What is quoted is left to the precisions by context. Edited copies of a toxic document make candidates
of all its words, so candidates must explain documents: on a bounded sample of toxic rows (SAMPLE)
the word that covers most of them is taken, its documents leave, and so on. Words that merely
stand beside a toxic one cover nothing that is left.

Matching. The lexicon is a trie. The Levenshtein automaton of the word at hand is intersected
with the trie, and the product is determinised as words ask for it, so a word costs one lookup
per character and most die within a few characters.

Context. A hit counts by its kind: exact, a misspelling seen in training (its own counts),
a disguise (a digit or sign inside the word), or another misspelling; and by whether quotation
marks or reporting words stand in the window around it. Each kind's precision is counted on
training rows, on top of a stated prior. A document's score is the chance that one hit is abuse.

Cases. A NULL or empty text has no hit and gets the base score. Without labels nothing is learned
and every score is the base score. NULL labels are not learned from. Rows that repeat an id are
scored each for itself; a NULL id is scored, and no label joins it. Scores read nothing but the
text. Very long texts are scored whole.
"""

from __future__ import annotations

import math
import re
import sys
import types
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch, split_of, table

THRESHOLD = 0.7
#: Bounds of what the driver holds: terms of the lexicon, and misspellings with their own counts.
MAX_TERMS, MAX_VARIANTS = 2_000, 200_000
#: Candidate words the driver looks at, toxic rows they are tried on, and rows a term must add.
CANDIDATES, SAMPLE, GAIN = 20_000, 3_000, 2
#: Least share of toxic documents among those that hold a term outside quotation.
SHARE = 0.8
MIN_LETTERS = 3
#: Distinct words counted before they are handed on.
DISTINCT = 300_000
#: Nats by which a term must beat the luckiest of all counted words.
MARGIN = 4.6
#: Characters to each side of a hit that are its context.
WINDOW = 60
#: Prior precision of a hit and its weight in documents, by kind and whether it is quoted.
PRIOR = {("exact", False): 0.9, ("exact", True): 0.45, ("disguise", False): 0.85, ("disguise", True): 0.4, ("long", False): 0.75, ("long", True): 0.3, ("short", False): 0.3, ("short", True): 0.1}
PRIOR_WEIGHT = 4.0

WORD = re.compile(r"\w(?:[\w@$*!|]*\w)?")
# Marks of quotation and of reported speech.
QUOTES = re.compile(r"[\"“”„«»‘]|\b(?:quote[ds]?|quoting|said|says|wrote|called|calls|term|word|phrase|slur|meaning)\b")


def edits_for(term: str) -> int:
    """Edits allowed: none in short terms, where every edit is another word."""
    return 0 if len(term) < 5 else 1 if len(term) < 12 else 2


class Lexicon:
    """A trie of terms, and the automaton of misspelled words over it."""

    @classmethod
    def of_worker(cls, terms: list[str]) -> Lexicon:
        """The lexicon of this Python worker: what one task has determinised serves the next."""
        store = vars(sys.modules.setdefault("_pelagia_worker", types.ModuleType("_pelagia_worker")))
        key = tuple(terms)
        if store.get("lexicon", (None,))[0] != key:
            store["lexicon"] = (key, cls(terms))
        return store["lexicon"][1]

    def __init__(self, terms: list[str], states: int = 300_000, words: int = 400_000):
        self.children: list[dict[str, int]] = [{}]
        self.term: list[str | None] = [None]
        self.most = [0]
        for term in terms:
            node = 0
            self.most[0] = max(self.most[0], edits_for(term))
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.term.append(None)
                    self.most.append(0)
                node = self.children[node][c]
                self.most[node] = max(self.most[node], edits_for(term))
            self.term[node] = term
        self.limits = states, words
        self._reset()

    def _reset(self) -> None:
        self.steps: dict[tuple[int, str], int] = {}
        self.states: list[tuple[tuple[int, int], ...]] = []
        self.number: dict[tuple[tuple[int, int], ...], int] = {}
        self.accepts: list[tuple[int, str] | None] = []
        self.start = self._state({0: 0})
        self.words: dict[str, tuple[int, str] | None] = {}

    def _state(self, reached: dict[int, int]) -> int:
        """The state of these (node, edits), with letters of the term left out as further edits."""
        todo = list(reached.items())
        while todo:
            node, edits = todo.pop()
            if edits > reached[node]:
                continue
            for child in self.children[node].values():
                if edits < self.most[child] and edits + 1 < reached.get(child, 99):
                    reached[child] = edits + 1
                    todo.append((child, edits + 1))
        key = tuple(sorted(reached.items()))
        if key not in self.number:
            self.number[key] = len(self.states)
            self.states.append(key)
            ends = [(e, self.term[n]) for n, e in key if self.term[n] is not None and e <= edits_for(self.term[n])]
            self.accepts.append(min(ends) if ends else None)
        return self.number[key]

    def _step(self, state: int, char: str) -> int:
        reached: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.most[node] and edits < reached.get(node, 99):
                reached[node] = edits

        for node, edits in self.states[state]:
            for c, child in self.children[node].items():
                reach(child, edits + (c != char))
            reach(node, edits + 1)
        self.steps[state, char] = out = self._state(reached) if reached else -1
        return out

    def match(self, word: str) -> tuple[int, str] | None:
        """(edits, term) of the nearest term, or None."""
        if word in self.words:
            return self.words[word]
        if len(self.words) > self.limits[1]:
            self.words.clear()
        if len(self.steps) > self.limits[0]:
            self._reset()
        state = self.start
        for c in word:
            nxt = self.steps.get((state, c))
            state = self._step(state, c) if nxt is None else nxt
            if state < 0:
                break
        self.words[word] = found = self.accepts[state] if state >= 0 else None
        return found


def kind_of(word: str, edits: int, term: str) -> str:
    if not edits:
        return "exact"
    if not word.isalpha() and term.isalpha():
        return "disguise"
    return "long" if len(term) >= 7 else "short"


def hits(text: str, lexicon: Lexicon) -> list[tuple[str, str, str, bool]]:
    """(word, term, kind, quoted) of each distinct hit of a text, the unquoted one first."""
    low = text.lower()
    known, match = lexicon.words, lexicon.match
    words = WORD.findall(low)
    found = {w for w in set(words) if (known[w] if w in known else match(w))}
    if not found:
        return []
    best: dict[str, bool] = {}
    for m in WORD.finditer(low):
        w = m.group()
        if w in found and best.get(w, True):
            before, after = low[max(0, m.start() - WINDOW) : m.start()], low[m.end() : m.end() + WINDOW]
            best[w] = bool(QUOTES.search(before) or QUOTES.search(after))
    return [(w, match(w)[1], kind_of(w, *match(w)), quoted) for w, quoted in best.items()]


class Model:
    """What scoring needs: terms, counts of misspellings, precisions by kind, the base rate."""

    def __init__(self, terms: list[str], variants: dict[str, tuple[int, int]], counts: dict[tuple[str, bool], tuple[float, float]], base: float):
        self.terms, self.variants, self.base = terms, variants, base
        self.precision = {}
        for key, prior in PRIOR.items():
            toxic, n = counts.get(key, (0.0, 0.0))
            self.precision[key] = (toxic + prior * PRIOR_WEIGHT) / (n + PRIOR_WEIGHT)

    def score(self, text: str, lexicon: Lexicon) -> float:
        clean = 1.0 - self.base
        for word, _, kind, quoted in hits(text, lexicon):
            p = self.precision[kind, quoted]
            if kind != "exact" and word in self.variants:
                toxic, n = self.variants[word]
                p = (toxic + p * PRIOR_WEIGHT / 2) / (n + PRIOR_WEIGHT / 2)
            clean *= 1.0 - min(0.999, p)
        return 1.0 - clean


def cover(documents: list[list[int]], words: int) -> list[int]:
    """Greedy cover: the word in most documents, then the one in most of those left, and so on."""
    left, picked = [np.array(d, np.int64) for d in documents if d], []
    while left and len(picked) < MAX_TERMS:
        gain = np.bincount(np.concatenate(left), minlength=words)
        best = int(gain.argmax())
        if gain[best] < GAIN:
            break
        picked.append(best)
        left = [d for d in left if best not in d]
    return picked


def unquoted(low: str, words: set[str]) -> set[str]:
    """The words of a lower-case text that stand somewhere without a mark of quotation around."""
    spans = [m.span() for m in QUOTES.finditer(low)]
    if not spans:
        return words
    starts, ends, free = [a for a, _ in spans], [b for _, b in spans], set()
    for m in WORD.finditer(low):
        w = m.group()
        if w not in free:
            a, b = m.span()
            # Marks do not overlap, so the last one before and the first one after are the nearest.
            before, after = bisect_right(ends, a) - 1, bisect_left(starts, b)
            if not (before >= 0 and starts[before] >= a - WINDOW or after < len(ends) and ends[after] <= b + WINDOW):
                free.add(w)
    return free


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to (word, n, toxic, free, free_toxic): documents, and those that hold it unquoted."""

    def out(seen: dict[str, list[int]]) -> pa.RecordBatch:
        columns = zip(*seen.values()) if seen else ((),) * 4
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), *(pa.array(c, pa.int64()) for c in columns)], ["word", "n", "toxic", "free", "free_toxic"])

    seen: dict[str, list[int]] = {}
    for b in batches:
        for text, label in zip(b["text"].to_pylist(), b["toxic"].to_pylist()):
            low = text.lower()
            words = set(WORD.findall(low))
            free = unquoted(low, words)
            for w in words:
                x = seen.setdefault(w, [0, 0, 0, 0])
                x[0] += 1
                x[1] += label
                if w in free:
                    x[2] += 1
                    x[3] += label
            if len(seen) > DISTINCT:
                yield out(seen)
                seen = {}
    yield out(seen)


def learn(labelled: DataFrame) -> Model:
    """A model from rows (text, toxic); counts cover every distinct one."""
    scratch = Scratch(labelled.sparkSession, "toxicity")
    model = _learn(labelled, scratch)
    scratch.drop("rows", "words")
    return model


def _learn(labelled: DataFrame, scratch: Scratch) -> Model:
    rows = labelled.filter("toxic IS NOT NULL").select(F.coalesce("text", F.lit("")).alias("text"), (F.col("toxic") != 0).cast("int").alias("toxic"))
    rows = scratch.keep(rows.dropDuplicates(["text", "toxic"]), "rows")
    total, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    base = toxic / total if total else 0.0
    if not toxic:
        return Model([], {}, {}, 0.0)
    if toxic == total:  # nothing tells the labels apart, and label 1 is all there is
        return Model([], {}, {}, (toxic + 1) / (total + 2))
    counted = rows.mapInArrow(_count, "word string, n long, toxic long, free long, free_toxic long")
    words = scratch.keep(counted.groupBy("word").agg(*(F.sum(c).alias(c) for c in ("n", "toxic", "free", "free_toxic"))), "words")
    # Words of any document that no label can lift above chance leave with the aggregate.
    n, p, q = F.col("free").cast("double"), F.col("free_toxic") / F.col("free"), F.lit(base)
    ratio = n * (p * F.log(p / q) + F.when(p < 1, (1 - p) * F.log((1 - p) / (1 - q))).otherwise(0.0))
    strong = words.filter((F.length("word") >= MIN_LETTERS) & (F.col("free") > 0) & (p >= SHARE) & F.col("word").rlike(r"^\p{L}")).withColumn("ratio", ratio)
    # The luckiest of V words by chance alone reaches about ln V; words met once or twice never do.
    tried = words.filter("n > 2").agg(F.count("*")).first()[0]
    picked = strong.filter(F.col("ratio") > math.log(max(2, tried)) + MARGIN)
    candidates = [r.word for r in picked.orderBy(F.desc("ratio"), "word").limit(CANDIDATES).collect()]
    drawn = F.pmod(F.xxhash64("text", F.lit("draw")), F.lit(1 << 30)) < int(min(1.0, 0.9 * SAMPLE / toxic) * (1 << 30))
    number = {w: i for i, w in enumerate(candidates)}

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sorted({number[w] for w in WORD.findall(t.lower()) if w in number}) for t in b["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32()))], ["found"])

    sample = rows.filter((F.col("toxic") == 1) & drawn).limit(SAMPLE).mapInArrow(held, "found array<int>").collect()
    terms = [candidates[i] for i in cover([r.found for r in sample], len(candidates))]
    if not terms:
        return Model([], {}, {}, base / 2)
    chosen = set(terms)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon.of_worker(terms)
        for b in batches:
            yield b.take(pa.array([i for i, w in enumerate(b["word"].to_pylist()) if w not in chosen and lexicon.match(w)], pa.int64()))

    close = words.filter(F.length("word") >= MIN_LETTERS).mapInArrow(near, words.schema)
    variants = {r.word: (int(r.toxic), int(r.n)) for r in close.orderBy(F.desc("n"), "word").limit(MAX_VARIANTS).collect()}

    def kinds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, seen = Lexicon.of_worker(terms), {}
        for b in batches:
            for text, label in zip(b["text"].to_pylist(), b["toxic"].to_pylist()):
                for kind, quoted in {h[2:] for h in hits(text, lexicon)}:
                    x = seen.setdefault((kind, quoted), [0, 0])
                    x[0] += label
                    x[1] += 1
        rows = [(*k, *v) for k, v in seen.items()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else ((),) * 4, (pa.string(), pa.bool_(), pa.int64(), pa.int64()))], ["kind", "quoted", "toxic", "n"])

    seen = rows.mapInArrow(kinds, "kind string, quoted boolean, toxic long, n long").groupBy("kind", "quoted").agg(F.sum("toxic"), F.sum("n")).collect()
    # Documents without any hit: their share of toxic ones is small, and half the base rate at most.
    return Model(terms, variants, {(r[0], r[1]): (r[2], r[3]) for r in seen}, min(0.3, base / 2))


def with_scores(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score, in one pass without a shuffle."""
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon.of_worker(model.terms)
        for b in batches:
            scores = [model.score(t or "", lexicon) for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.array(scores, float), pa.float64())], [*b.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Labelled rows whose crc32(doc_id) mod 3 is not 1.

    Labels grow with the corpus, so they are merged, not broadcast, at every size.
    """
    mine = labels.select("doc_id", "toxic").filter(split_of("doc_id", 3) != 1).hint("merge")
    return docs.select("doc_id", "text").filter(split_of("doc_id", 3) != 1).join(mine, "doc_id").select("text", "toxic")


def drop_toxic(docs: DataFrame, labels: DataFrame, learn_from: DataFrame | None = None) -> DataFrame:
    """The documents scored below the threshold, with their own columns."""
    model = learn(training_rows(docs if learn_from is None else learn_from, labels))
    return with_scores(docs, model, name="__toxicity").filter(F.col("__toxicity") < THRESHOLD).drop("__toxicity")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(training_rows(docs, table(spark, sf_dir, "labels")))
    return with_scores(docs, model).select(
        "doc_id",
        (split_of("doc_id", 3) == 1).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
