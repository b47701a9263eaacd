"""Language identification by string kernels.

The kernel of two texts is the number of character n-grams (n from 1 to 3) that both contain,
over the geometric mean of how many each contains: the blended spectrum, by presence. Kernel ridge
regression is solved one language against the rest on a Nyström sample of landmark texts.
Texts are cut into windows, so that presence does not saturate in long ones; a document's scores
are the mean over its windows, every window of the whole text counting.

As presence vectors are explicit (n-grams hashed to a fixed width), the kernels of a batch of
windows with all landmarks, times the solved weights, are one product of two matrices.

Bound of learning: PER_LANGUAGE windows of each language, drawn by a hash of (id, window) from all
windows of all training rows; LANDMARKS of these are landmarks.

Cases. NULL or letterless text is ``und`` with score 0, as is everything if nothing was learned.
Rows without a language are not learned from. Ids only draw the sample: a NULL id draws as such.
Ties between languages go to the first in alphabetical order. Repeated rows are equal rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import mix, split_of, table

WINDOW, WIDTH, ORDERS = 800, 8192, 3
PER_LANGUAGE, LANDMARKS, RIDGE = 300, 160, 1e-3
#: Windows in one matrix product.
BLOCK = 256


def has_letter(text: str) -> bool:
    """Whether any character is a letter; powers, fractions and other numbers are none."""
    return any(map(str.isalpha, text))


def presence(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A 0/1 matrix (windows x WIDTH) and the text that each window belongs to."""
    points = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    counts = [max(1, -(-len(p) // WINDOW)) for p in points]
    owner = np.repeat(np.arange(len(texts)), counts)
    out = np.zeros((len(owner), WIDTH), np.float32)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64) if texts else np.zeros(0, np.int64)
    if not texts or not sum(map(len, points)):
        return out, owner
    flat = np.concatenate(points).astype(np.uint64)
    text = np.repeat(np.arange(len(texts)), [len(p) for p in points])
    start = np.concatenate([[0], np.cumsum([len(p) for p in points])[:-1]])
    row = first[text] + (np.arange(len(flat)) - start[text]) // WINDOW
    key = np.zeros(len(flat), np.uint64)
    for n in range(ORDERS):
        m = len(flat) - n
        if m <= 0:
            break
        key = key[:m] * np.uint64(0x110003) + flat[n:] + np.uint64(1)
        whole = text[:m] == text[n:]  # an n-gram does not reach into the next text
        out[row[:m][whole], (mix(key[whole]) >> np.uint64(20)).astype(np.int64) % WIDTH] = 1.0
    return out, owner


class Classifier:
    """Nyström kernel ridge regression; ``weights`` holds landmarks and solution in one matrix."""

    def __init__(self, texts: list[str], langs: list[str]):
        self.langs = sorted(set(langs))
        self.weights = np.zeros((WIDTH, len(self.langs)), np.float32)
        if not texts:
            return
        x, owner = presence(texts)
        y = np.where(np.array(langs)[owner][:, None] == np.array(self.langs)[None, :], 1.0, -1.0)
        x = x / np.sqrt(np.maximum(1, x.sum(1, keepdims=True)))
        # Landmarks in turn from each language, in the order of the sample.
        place = np.zeros(len(owner), np.int64)
        for c in range(len(self.langs)):
            mine = np.flatnonzero(y[:, c] > 0)
            place[mine] = np.arange(len(mine))
        marks = x[np.argsort(place, kind="stable")[: max(LANDMARKS, 4 * len(self.langs))]].astype(np.float64)
        kmm, knm = marks @ marks.T, x @ marks.T
        left = knm.T @ knm + RIDGE * len(x) * kmm + 1e-8 * len(x) * np.eye(len(marks))
        alpha = np.linalg.solve(left, knm.T @ y)
        self.weights = (marks.T @ alpha).astype(np.float32)

    def _blocks(self, texts: list[str]) -> Iterator[tuple[list[int], list[str], list[int]]]:
        """(text, piece, windows of it) of letter texts, up to BLOCK windows at a time. A long text
        is cut between windows; a piece has the letters that its last n-grams reach into."""
        own, pieces, windows = [], [], []
        for i, text in enumerate(texts):
            if not (self.langs and has_letter(text)):
                continue
            low = text.lower()
            for at in range(0, len(low), WINDOW * BLOCK):
                n = min(BLOCK, -(-(len(low) - at) // WINDOW))
                if sum(windows) + n > BLOCK:
                    yield own, pieces, windows
                    own, pieces, windows = [], [], []
                own.append(i)
                pieces.append(low[at : at + WINDOW * BLOCK + ORDERS - 1])
                windows.append(n)
        if own:
            yield own, pieces, windows

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        total, count = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        for own, pieces, windows in self._blocks(texts):
            x, piece = presence(pieces)
            place = np.arange(len(piece)) - np.searchsorted(piece, piece)
            counted = place < np.array(windows)[piece]  # what only the letters behind a cut make is no window
            x, text = x[counted], np.array(own)[piece[counted]]
            np.add.at(total, text, (x @ self.weights) / np.sqrt(np.maximum(1, x.sum(1, keepdims=True))))
            np.add.at(count, text, 1)
        for i in np.flatnonzero(count):
            mean = total[i] / count[i]
            best = int(mean.argmax())
            out[i] = (self.langs[best], float(np.clip((mean[best] + 1) / 2, 0.0, 1.0)))
        return out


def fit(rows: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang") -> Classifier:
    """Learn from (id, text, lang) rows; the driver holds PER_LANGUAGE windows a language at most."""
    r = rows.select(F.col(id).alias("id"), F.col(text).alias("text"), F.col(lang).alias("lang")).filter("lang IS NOT NULL AND text IS NOT NULL AND text != ''")
    windows = F.ceil(F.length("text") / WINDOW).cast("int")
    totals = {x.lang: x.n for x in r.groupBy("lang").agg(F.sum(windows).alias("n")).collect()}
    if not totals:
        return Classifier([], [])
    share = F.create_map(*(F.lit(v) for k, n in totals.items() for v in (k, min(1.0, 3.0 * PER_LANGUAGE / n))))
    draw = lambda w: F.pmod(F.xxhash64("id", w), F.lit(1 << 32))
    drawn = F.filter(F.sequence(F.lit(0), windows - 1), lambda w: draw(w) < share[F.col("lang")] * float(1 << 32))
    picked = r.withColumn("w", F.explode(drawn)).select("lang", draw(F.col("w")).alias("h"), F.col("text").substr(F.col("w") * WINDOW + 1, F.lit(WINDOW)).alias("text"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    sample = picked.withColumn("nth", nth).filter(F.col("nth") <= PER_LANGUAGE).orderBy("lang", "nth").collect()
    return Classifier([s.text for s in sample], [s.lang for s in sample])


def predict(docs: DataFrame, model: Classifier, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = model.predict([t or "" for t in b.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    kind = docs.schema[id].dataType.simpleString()
    return docs.select(id, text).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs.filter(split_of("doc_id", 5) != 0))
    held = (split_of("doc_id", 5) == 0).alias("held_out")
    return predict(docs, model).select("doc_id", held, "lang_pred", "score")
