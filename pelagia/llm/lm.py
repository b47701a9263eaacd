"""Language-model scoring: a gated recurrent network with a class-factored softmax.

Tokens are the words of the text (A-Z lower-cased, cut at blanks) and one end. Counts of all
tokens are taken over all training rows. The most frequent words are the network's vocabulary,
in classes of equal size by frequency; end and "any other word" are classes of their own. The
probability of a token is that of its class given the state, times that of the word in its class
given the state; another word's share of "any other" is its smoothed count among those.

The network is trained by truncated backpropagation in numpy on every training row, in ROUNDS
rounds of which each takes the rows of its share of a hash. All tasks of a round start from the same
weights; each trains on all its rows, a block of them at a time, and sends its weights in pieces of
fixed size. Their averages by tokens, also formed in tasks, are what the next round starts from. The
output biases start from the counts over the whole corpus. In scoring, documents of a batch run
side by side, in windows of STEPS tokens; the state goes on from window to window, so the sum is
the log-likelihood of the complete document.

Counts of rare words would not fit on every executor. Each document keeps the rare words it has
as hashes; these meet the counted words in one join on the hash, and only sums come back.

Texts are read into numbers of words once the common words are known, and these are stored: the
rounds of training and the scoring read numbers, two bytes a token, in place of texts.

Words are told apart by 64-bit hashes (62 bits of them free).

Cases. NULL text is empty: its only token is the end. Without training rows every count is 0,
N is 0 and the base score of any text is log10(1 / 1) a token. Rows that repeat an id are scored
each for itself. A NULL id falls in the split of the empty text. Texts are scored whole.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, split_of, table

#: Words of the network, words whose counts go to every task, and classes of words.
VOCABULARY, COMMON, CLASS_SIZE = 4_096, 65_536, 64
#: Rounds of training, streams side by side, the steps of a window, and tokens held by a task.
ROUNDS, STREAMS, STEPS, BLOCK = 4, 512, 24, 1 << 19
#: Windows a task trains in a round at least; a task with few rows goes over them again.
UPDATES = 120
EMBED, HIDDEN, RATE = 16, 24, 0.006
#: Tokens whose class probabilities are worked on together.
PART = 1_024
#: Numbers of the weights that travel together.
PIECE = 8_192
#: Documents side by side in scoring, distinct words counted before they are handed on.
TOGETHER, DISTINCT = 1024, 300_000
END, OTHER = 0, 1
#: How a token of the network is stored.
ID = np.dtype("<u2")
_END = np.zeros(1, np.int64)
_END_KEY = 1 << 61
_KEY_BITS, _KEY_MARK, _hash = (1 << 62) - 1, 1 << 62, xxhash.xxh3_64_intdigest


def word_key(word: bytes) -> int:
    """A positive number of at least 2**62, so that it is never a rank."""
    return (_hash(word) & _KEY_BITS) | _KEY_MARK


def tokens_of(text: str | None) -> list[bytes]:
    # On bytes, lower() changes A-Z only and split() cuts at [\x20\x09-\x0D] only.
    return (text or "").encode().lower().split()


class Codes(dict):
    """word -> rank if common, its key if not; remembered up to a bound."""

    def __init__(self, ranks: dict[int, int], limit: int = 400_000):
        super().__init__()
        self.ranks, self.limit = ranks, limit

    def __missing__(self, word: bytes) -> int:
        key = (_hash(word) & _KEY_BITS) | _KEY_MARK
        self[word] = code = self.ranks.get(key, key)
        return code

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) >= self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """In place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _small(weights: np.ndarray, biases: np.ndarray) -> bool:
    """Whether no state can bring a sum of these so far that its exponential leaves the range of a
    float: a state's numbers are between -1 and 1. Their maximum need not be taken off then."""
    return bool((np.abs(weights).sum(-2) + np.abs(biases)).max(initial=0.0) < 60.0)


def _exponentials(x: np.ndarray, small: bool) -> np.ndarray:
    """Shares before they are divided, in place, and their sums by row."""
    if not small:
        x -= x.max(1, keepdims=True)
    np.exp(x, out=x)
    return x @ np.ones(x.shape[1], x.dtype)


def _softmax(x: np.ndarray, small: bool, n: float) -> np.ndarray:
    """Probabilities over ``n``, in place of what they are made from."""
    x *= (1 / (_exponentials(x, small) * n))[:, None]
    return x


def _with_one(x: np.ndarray) -> np.ndarray:
    """States with a last column of ones, which the biases are multiplied by."""
    out = np.ones((len(x), x.shape[1] + 1), x.dtype)
    out[:, :-1] = x
    return out


def _parts(x: np.ndarray) -> np.ndarray:
    """Columns of the update, reset and new gate as three arrays."""
    return np.ascontiguousarray(x.reshape(-1, 3, HIDDEN).transpose(1, 0, 2))


class Network:
    """Inputs and targets: 0 end, 1 any other word, then the vocabulary by rank."""

    def __init__(self, counts: np.ndarray, ends: int, others: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.words = len(counts)
        self.classes = -(-self.words // CLASS_SIZE)
        init = lambda *shape: (rng.standard_normal(shape) / math.sqrt(shape[0])).astype(np.float32)
        padded = np.full(self.classes * CLASS_SIZE, 0.0)
        padded[: self.words] = counts + 1.0
        padded = padded.reshape(self.classes, CLASS_SIZE)
        with np.errstate(divide="ignore"):
            inside = np.maximum(np.log(padded / np.maximum(1e-9, padded.sum(1, keepdims=True))), -30.0)
        mass = np.concatenate([padded.sum(1), [ends + 1.0, others + 1.0]])
        self.p = {
            "E": init(self.words + 2, EMBED) * 0.5,
            "W": init(EMBED, 3 * HIDDEN),
            "U": init(HIDDEN, 3 * HIDDEN),
            "b": np.zeros(3 * HIDDEN, np.float32),
            "C": np.zeros((HIDDEN, self.classes + 2), np.float32),
            "c": np.log(mass / mass.sum()).astype(np.float32),
            "V": np.zeros((self.classes, HIDDEN, CLASS_SIZE), np.float32),
            "v": inside.astype(np.float32),
        }

    def group(self, target: np.ndarray) -> np.ndarray:
        """The class of each target; end and other follow the word classes."""
        return np.where(target >= 2, (target - 2) // CLASS_SIZE, self.classes + target)

    def step(self, projected: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
        """The next state, from rows of an input's three parts side by side."""
        return self._step(projected.reshape(len(h), 3, HIDDEN).transpose(1, 0, 2), h, _parts(self.p["U"]))

    def _step(self, projected: np.ndarray, h: np.ndarray, across: np.ndarray) -> tuple[np.ndarray, ...]:
        """The same with the three parts one after the other, so that each lies in one piece."""
        g = h @ across
        zr = g[:2]
        zr += projected[:2]
        z, r = _sigmoid(zr)
        n = r * g[2]
        n += projected[2]
        np.tanh(n, out=n)
        out = h - n
        out *= z
        out += n
        return out, z, r, n, g[2]

    def projections(self) -> np.ndarray:
        """What each input adds to the update, reset and new gate."""
        table = self.p["E"] @ _parts(self.p["W"])
        table += self.p["b"].reshape(3, 1, HIDDEN)
        return table

    def small(self) -> tuple[bool, bool]:
        """Whether the sums of classes, and those of words, are small in any state."""
        return _small(self.p["C"], self.p["c"]), _small(self.p["V"], self.p["v"])

    def joint(self) -> np.ndarray:
        """For each class the weights of all classes and those of its words side by side, biases below."""
        p, heads = self.p, self.classes + 2
        out = np.zeros((heads, HIDDEN + 1, heads + CLASS_SIZE), p["C"].dtype)
        out[:, :-1, :heads], out[:, -1, :heads] = p["C"], p["c"]
        out[:-2, :-1, heads:], out[:-2, -1, heads:] = p["V"], p["v"]
        return out

    def by_class(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The order that brings tokens of one class together, and where each class begins."""
        # Numbers of classes are short, so this is a radix sort.
        order = np.argsort(group.astype(np.int16), kind="stable")
        return order, np.concatenate([[0], np.cumsum(np.bincount(group, minlength=self.classes + 2))])

    def log_probability(self, h: np.ndarray, target: np.ndarray, small: tuple[bool, bool] = (False, False)) -> np.ndarray:
        """Natural log of each target's probability given the state before it."""
        return self._log_probability(_with_one(h), target, small, self.joint())

    def _log_probability(self, states: np.ndarray, target: np.ndarray, small: tuple[bool, bool], joint: np.ndarray) -> np.ndarray:
        order, cuts = self.by_class(self.group(target))
        heads, ends = self.classes + 2, np.zeros((joint.shape[2], 2), states.dtype)
        ends[:heads, 0] = ends[heads:, 1] = 1
        states, place, logs = states.take(order, 0), (target[order] - 2) % CLASS_SIZE, np.empty(len(order), states.dtype)
        for k in np.flatnonzero(np.diff(cuts)).tolist():
            words = k < self.classes  # end and other have none
            # A part of a class at a time stays in the processor's cache.
            for low in range(cuts[k], cuts[k + 1], PART):
                own = slice(low, min(low + PART, cuts[k + 1]))
                x = states[own] @ (joint[k] if words else joint[k][:, :heads])
                if not small[0]:
                    x[:, :heads] -= x[:, :heads].max(1, keepdims=True)
                if words and not small[1]:
                    x[:, heads:] -= x[:, heads:].max(1, keepdims=True)
                picked = x[:, k] + x[np.arange(len(x)), heads + place[own]] if words else x[:, k].copy()
                np.exp(x, out=x)
                sums = x @ (ends if words else ends[:heads, :1])
                logs[own] = picked - np.log(sums).sum(1)
        out = np.empty_like(logs)
        out[order] = logs
        return out

    def weights(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.p.values()])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for k, x in self.p.items():
            self.p[k] = flat[at : at + x.size].reshape(x.shape).astype(np.float32)
            at += x.size

    def train(self, flat: np.ndarray, moments: dict, rate: float = RATE, updates: int = 0) -> None:
        """Truncated backpropagation over documents in a row, each begun by an END. They run in
        parallel streams; a stream goes on in the next window with the state it has.

        At least ``updates`` windows are trained, over the same tokens again if need be.
        """
        streams = min(STREAMS, max(1, len(flat) // (16 * STEPS)))
        length = len(flat) // streams
        windows = (length - 1) // STEPS
        if windows < 1 or not self.words:
            return
        grid = flat[: streams * length].reshape(streams, length)
        for done in range(max(windows, updates)):
            at = done % windows * STEPS
            if not at:
                h = np.zeros((streams, HIDDEN), self.p["U"].dtype)
            grads, h = self._window(grid[:, at : at + STEPS].T, grid[:, at + 1 : at + STEPS + 1].T, h)
            moments["t"] = t = moments.get("t", 0) + 1
            norm = math.sqrt(sum(float((g * g).sum()) for g in grads.values()))
            step = rate * math.sqrt(1 - 0.999**t) / (1 - 0.9**t)
            for k, g in grads.items():
                if norm > 5.0:
                    g = g * np.float32(5.0 / norm)
                m, v = moments.setdefault(k, (np.zeros_like(g), np.zeros_like(g)))
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                self.p[k] -= step * m / (np.sqrt(v) + 1e-6)

    def _window(self, x: np.ndarray, y: np.ndarray, h: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
        p, (steps, streams), kind, H = self.p, x.shape, self.p["U"].dtype, HIDDEN
        ids, W, U, table, projected = x.reshape(-1), _parts(p["W"]), _parts(p["U"]), self.projections(), np.empty((3, streams, H), kind)
        goes_on = (x != END)[:, :, None]  # a document starts from nothing
        states, before, parts = np.empty((steps, streams, H), kind), np.empty((steps, streams, H), kind), []
        for t in range(steps):
            np.multiply(h, goes_on[t], out=before[t])
            for part, found in zip(table, projected):
                part.take(x[t], 0, found, "clip")
            h, *gates = self._step(projected, before[t], U)
            states[t] = h
            parts.append(gates)
        top, target = states.reshape(-1, H), y.reshape(-1)
        group, n, small = self.group(target), kind.type(len(target)), self.small()
        grads, dtop = {"C": np.zeros_like(p["C"]), "c": np.zeros_like(p["c"])}, np.empty_like(top)
        # A part of the tokens at a time: their shares of all classes stay in the processor's cache.
        for low in range(0, len(top), PART):
            own = slice(low, low + PART)
            share = top[own] @ p["C"]
            share += p["c"]
            _softmax(share, small[0], n)
            share[np.arange(len(share)), group[own]] -= 1 / n
            grads["C"] += top[own].T @ share
            grads["c"] += np.ones(len(share), kind) @ share
            dtop[own] = share @ p["C"].T
        # Tokens of one class lie together, so a class is a slice.
        order, cuts = self.by_class(group)
        order = order[: cuts[self.classes]]
        sorted_top, place = top[order], (target[order] - 2) % CLASS_SIZE
        back = np.empty_like(sorted_top)
        grads["V"], grads["v"] = np.zeros_like(p["V"]), np.zeros_like(p["v"])
        for k in np.flatnonzero(np.diff(cuts[: self.classes + 1])):
            own = slice(cuts[k], cuts[k + 1])
            inside = sorted_top[own] @ p["V"][k]
            inside += p["v"][k]
            _softmax(inside, small[1], n)
            inside[np.arange(len(inside)), place[own]] -= 1 / n
            grads["V"][k], grads["v"][k] = sorted_top[own].T @ inside, np.ones(len(inside), kind) @ inside
            back[own] = inside @ p["V"][k].T
        dtop[order] += back
        dtop = dtop.reshape(steps, streams, H)
        dproj, dreset = np.empty((3, steps, streams, H), kind), np.empty_like(states)
        carried, back = np.zeros((streams, H), kind), np.ascontiguousarray(U.transpose(0, 2, 1))
        for t in range(steps - 1, -1, -1):
            z, r, cand, gn = parts[t]
            d, (dz, dr, dn) = dtop[t] + carried, dproj[:, t]
            kept = d * z
            np.subtract(d, kept, out=dn)
            # d * z * (1 - z) * (before - cand)
            np.multiply(dn, z, out=dz)
            dz *= before[t] - cand
            dn *= 1 - cand * cand
            np.multiply(dn, r, out=dreset[t])
            np.multiply(dreset[t], gn, out=dr)
            dr *= 1 - r
            kept += dz @ back[0]
            kept += dr @ back[1]
            kept += dreset[t] @ back[2]
            carried = np.multiply(kept, goes_on[t], out=kept)
        past, own = before.reshape(-1, H).T, dproj.reshape(3, -1, H)
        grads["U"] = np.concatenate([past @ own[0], past @ own[1], past @ dreset.reshape(-1, H)], axis=1)
        grads["W"] = np.concatenate(list(p["E"].take(ids, 0).T @ own), axis=1)
        grads["b"] = np.concatenate(list(np.ones(len(ids), kind) @ own))
        # Brought to the size of an embedding first, rows of one input are summed a column at a time.
        inputs = W[0] @ own[0].T
        inputs += W[1] @ own[1].T
        inputs += W[2] @ own[2].T
        grads["E"] = np.stack([np.bincount(ids, c, len(p["E"])) for c in inputs], axis=1).astype(kind)
        return grads, h

    def score(self, documents: list[np.ndarray]) -> np.ndarray:
        """Natural log-likelihood of each document, given as vocabulary ids without the end."""
        out = np.zeros(len(documents))
        U, small, joint = _parts(self.p["U"]), self.small(), self.joint()
        table = self.projections()
        by_length = np.argsort([-len(d) for d in documents], kind="stable")
        # States, targets and documents of the tokens that are scored together, however many steps they take.
        room = STEPS * min(TOGETHER, max(1, len(documents)))
        states = np.ones((room, HIDDEN + 1), np.float32)
        targets, owners, held = np.empty(room, np.int64), np.empty(room, np.int64), 0

        def flush() -> None:
            nonlocal out
            logs = self._log_probability(states[:held], targets[:held], small, joint)
            out += np.bincount(owners[:held], logs, len(documents))

        for low in range(0, len(documents), TOGETHER):
            rows = by_length[low : low + TOGETHER]
            # Inputs are end, words; targets are words, end: one flat array serves both.
            flat = np.concatenate([x for i in rows for x in (_END, documents[i], _END)]).astype(np.int64)
            lengths = np.array([len(documents[i]) + 1 for i in rows])
            starts = np.cumsum(lengths + 1) - lengths - 1
            h = np.zeros((len(rows), HIDDEN), np.float32)
            longest = int(lengths[0])
            # Documents with a token at each place.
            going = (len(rows) - np.cumsum(np.bincount(lengths, minlength=longest + 1))).tolist()
            projected = np.empty((3, len(rows), HIDDEN), np.float32)
            for t in range(longest):
                n = going[t]
                if held + n > room:
                    flush()
                    held = 0
                at = starts[:n] + t
                ids, end = flat.take(at), held + n
                for part, found in zip(table, projected):
                    part.take(ids, 0, found[:n], "clip")
                h = self._step(projected[:, :n], h[:n], U)[0]
                states[held:end, :-1] = h
                at += 1
                flat.take(at, 0, targets[held:end], "clip")
                owners[held:end] = rows[:n]
                held = end
        if held:
            flush()
        return out


# --- Spark --------------------------------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to (key, n), summed over up to DISTINCT words at a time."""

    def out(seen: Counter) -> pa.RecordBatch:
        keys = np.fromiter(map(word_key, seen), np.int64, len(seen))
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.fromiter(seen.values(), np.int64, len(seen)))], ["key", "n"])

    seen, ends = Counter(), 0
    for b in batches:
        for text in b.column(0).to_pylist():
            seen.update(tokens_of(text))
            ends += 1
            if len(seen) > DISTINCT:
                yield out(seen)
                seen = Counter()
    yield out(seen)
    if ends:
        yield pa.RecordBatch.from_arrays([pa.array([_END_KEY]), pa.array([ends])], ["key", "n"])


class Model:
    """Totals, the common words' ranks and counts, and the network."""

    def __init__(self, total: int, distinct: int, ends: int, keys: list[int], counts: np.ndarray):
        self.total, self.distinct, self.ends = total, distinct, ends
        self.ranks = {k: i for i, k in enumerate(keys)}
        self.counts = counts
        self.words = min(VOCABULARY, len(keys))
        inside = int(counts[: self.words].sum())
        self.others, self.other_words = total - ends - inside, max(0, distinct - self.words - (ends > 0))
        self.network = Network(counts[: self.words].astype(float), ends, self.others)

    def ids(self, codes: np.ndarray) -> np.ndarray:
        return np.where(codes < self.words, codes + 2, OTHER).astype(ID)

    @property
    def base_log(self) -> float:
        return math.log10(self.total + self.distinct + 1)

    @property
    def other_log(self) -> float:
        return math.log10(self.others + self.other_words + 1)


def counted(counts: DataFrame) -> Model:
    """A model that has learned nothing but the counted words (key, n)."""
    total, distinct, ends = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.max(F.when(F.col("key") == _END_KEY, F.col("n"))), F.lit(0))).first()
    # A histogram of counts says from where on the COMMON most frequent words lie, so that tasks
    # send these and the rest of one narrow bin, not COMMON words each.
    words, bins = counts.filter(F.col("key") != _END_KEY), F.floor(F.log2("n") * 16)
    held, least = 0, 0
    for bin, n in sorted((tuple(r) for r in words.groupBy(bins).count().collect()), reverse=True):
        held, least = held + n, bin
        if held >= COMMON:
            break
    top = words.filter(bins >= least).orderBy(F.desc("n"), "key").limit(COMMON).collect()
    return Model(total, distinct, ends, [r.key for r in top], np.array([r.n for r in top], np.int64))


def fit(train: DataFrame, counts: DataFrame, id: str = "doc_id", text: str = "text") -> Model:
    """A model from all training rows and their counted words."""
    model = counted(counts)
    learn(model, train, id, text)
    return model


CODED = "row long, doc_id {kind}, round int, n_tokens long, known long, logs double, other double, ids binary, rare array<long>, times array<int>"


def _code(model: Model):
    """(id, text, round) to what learning and scoring need of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, count = Codes(model.ranks), TaskContext.get().partitionId() << 33
        known, log = model.counts > 0, np.log10(model.counts + 1.0)
        for b in batches:
            columns = [], [], [], [], [], [], []
            for text in b.column(1).to_pylist():
                own = codes.of(tokens_of(text))
                common = own[own < len(log)]
                rare, times = np.unique(own[own >= len(log)], return_counts=True)
                outside = log[common[common >= model.words]]
                # ``other``: what common words outside the network add to their share of "any other".
                for c, v in zip(columns, (len(own) + 1, int(known[common].sum()) + (model.ends > 0), float(log[common].sum()) + math.log10(model.ends + 1), float(outside.sum()) - (len(outside) + int(times.sum())) * model.other_log, model.ids(own).tobytes(), rare, times.astype(np.int32))):
                    c.append(v)
            n = b.num_rows
            lists = [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, c)]).astype(np.int32)), pa.array(np.concatenate(c) if c else [], t)) for c, t in ((columns[5], pa.int64()), (columns[6], pa.int32()))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(count, count + n)), b.column(0), b.column(2), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.float64()), pa.array(columns[3], pa.float64()), pa.array(columns[4], pa.binary()), *lists],
                ["row", "doc_id", "round", "n_tokens", "known", "logs", "other", "ids", "rare", "times"],
            )
            count += n

    return run


def coded(docs: DataFrame, model: Model, trained: Column, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Texts as numbers of words; ``round`` is that of a training row, NULL for another row."""
    share = F.pmod(F.xxhash64(F.lit("round"), id, text), F.lit(ROUNDS)).cast("int")
    rows = docs.select(F.col(id), F.col(text), F.when(trained, share).alias("round"))
    return rows.mapInArrow(_code(model), CODED.format(kind=docs.schema[id].dataType.simpleString()))


def _round(model: Model, rate: float):
    """Coded training rows to the weights a task has learned from all of them, in pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net, moments = model.network, {}
        held, size, seen = [], 0, 0

        def block(updates: int) -> None:
            net.train(np.concatenate(held).astype(np.int64), moments, rate, updates)

        for b in batches:
            for raw in b.column(0).to_pylist():
                held += _END, np.frombuffer(raw, ID)
                size += len(held[-1]) + 1
                if size >= BLOCK:
                    block(0)
                    held, seen, size = [], seen + size, 0
        if held:
            block(0 if seen else UPDATES)
            seen += size
        if "t" in moments:
            flat = net.weights()
            pieces = [flat[at : at + PIECE] for at in range(0, len(flat), PIECE)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(pieces)), pa.int32()), pa.array([seen] * len(pieces), pa.int64()), pa.array([x.tobytes() for x in pieces], pa.binary())], ["piece", "tokens", "weights"])

    return run


def _average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of weights to their averages by tokens; a sum per piece is held."""
    sums: dict[int, list] = {}
    for b in batches:
        for piece, tokens, raw in zip(*(b[c].to_pylist() for c in ("piece", "tokens", "weights"))):
            own = sums.setdefault(piece, [0, 0.0])
            own[0] += tokens
            own[1] = own[1] + tokens * np.frombuffer(raw, np.float32).astype(np.float64)
    if sums:
        means = [(total / tokens).astype(np.float32).tobytes() for tokens, total in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([t for t, _ in sums.values()], pa.int64()), pa.array(means, pa.binary())], ["piece", "tokens", "weights"])


def learn(model: Model, train: DataFrame, id: str = "doc_id", text: str = "text") -> int:
    """Train the network on all rows. The number of tokens learned from, repeats aside."""
    scratch = Scratch(train.sparkSession, "lm")
    learned = learn_coded(model, scratch.keep(coded(train, model, F.lit(True), id, text).select("round", "ids"), "train"))
    scratch.drop("train")
    return learned


def learn_coded(model: Model, rows: DataFrame) -> int:
    """The same from stored rows (round, ids): rounds of tasks that start alike and are averaged."""
    schema = "piece int, tokens long, weights binary"
    learned = 0
    for k in range(ROUNDS):
        rate = RATE * (1.0 if k < ROUNDS - 1 else 0.3)
        # The same rows always come in the same order: partitions of a scan, filtered.
        found = rows.filter(F.col("round") == k).select("ids").mapInArrow(_round(model, rate), schema)
        rows_of_pieces = found.repartition("piece").mapInArrow(_average, schema).collect()
        if rows_of_pieces:
            model.network.load(np.concatenate([np.frombuffer(r.weights, np.float32) for r in sorted(rows_of_pieces, key=lambda r: r.piece)]))
            learned += rows_of_pieces[0].tokens
    return learned


SCORED = "row long, doc_id {kind}, n_tokens long, known long, logs double, other double, score double"


def _score(model: Model):
    """Coded rows to their scores by the network."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            scores = model.network.score([np.frombuffer(raw, ID) for raw in b.column(6).to_pylist()]) / math.log(10)
            yield pa.RecordBatch.from_arrays([*b.columns[:6], pa.array(scores)], [*b.schema.names[:6], "score"])

    return run


def score_documents(docs: DataFrame, train: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of each document."""
    return _scored(docs, train, None, id, text)


def score_split(docs: DataFrame, trained: Column, id: str = "doc_id", text: str = "text") -> DataFrame:
    """:func:`score_documents` where the training rows are those of ``docs`` that ``trained`` holds for;
    a text is read into numbers once, for learning and scoring."""
    return _scored(docs, docs.filter(trained), trained, id, text)


def _scored(docs: DataFrame, train: DataFrame, trained: Column | None, id: str, text: str) -> DataFrame:
    scratch = Scratch(docs.sparkSession, "lm")
    counts = train.select(text).mapInArrow(_count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    counts = scratch.keep(counts, "counts")
    model = counted(counts)
    rows = scratch.keep(coded(docs, model, F.lit(False) if trained is None else trained, id, text), "coded")
    if trained is None:
        learn(model, train, id, text)
    else:
        learn_coded(model, rows)
    columns = ["row", "doc_id", "n_tokens", "known", "logs", "other"]
    scored = scratch.keep(rows.select(*columns, "ids").mapInArrow(_score(model), SCORED.format(kind=docs.schema[id].dataType.simpleString())), "scored")
    rare = rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select("row", F.col("w.rare").alias("key"), F.col("w.times").alias("times"))
    # Words never counted add log10(1): the inner join leaves them out.
    sums = rare.join(counts, "key").groupBy("row").agg(F.sum("times").alias("more"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("rare_logs"))
    logs = F.coalesce("rare_logs", F.lit(0.0))
    return scored.join(sums, "row", "left").select(
        "doc_id",
        "n_tokens",
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("logs") + logs - F.col("n_tokens") * model.base_log).alias("base_score"),
        (F.col("score") + F.col("other") + logs).alias("score"),
    )


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = split_of("doc_id", 7) == 2
    return score_split(docs, ~held).withColumn("held_out", held)
