"""Token counts of whole texts, huge ones in overlapping chunks that are spliced again.

A short text is encoded at once. A longer one is cut every STRIDE characters, wherever that falls,
and each chunk is a row of its own, so one huge document is the work of many tasks:

    chunk i    |------------ STRIDE ------------|-- overlap --|
    chunk i+1                                   |------------ STRIDE ------------|-- overlap --|

Chunk i and the head of chunk i+1 are both encoded over the overlap, with offsets. Where both have
the same boundary between two *words* of the vocabulary's splitting pattern, they are spliced:
the pattern is read from left to right, looks ahead one character at most, and no merge crosses a
word, so two readings that meet at a boundary stay together from there on. The first chunk begins
where the document does; by induction every splice is a boundary of the whole text's own encoding.
What stands before the splice in chunk i+1 is what chunk i counted beyond the cut, so a chunk adds
``own tokens up to the splice - tokens of the next head up to the splice`` and the count of a
document is a plain sum. Boundaries within ``margin`` of a chunk's end prove nothing (a special
string or a run of blanks may go on behind it) and are not used.

Where no boundary is shared (one word longer than the overlap), the overlap widens fourfold up to
``reach``; a document that still fails goes through another round with chunks and overlaps
WIDER times as long, merged from its stored chunks, until it is one chunk at last.

Vocabularies whose boundaries are not proven (another splitting rule, a normaliser, special
strings that take blanks with them, and all ``.model`` files) are never cut; they are encoded whole.

Cases. NULL text is empty: 0 bytes, 0 tokens. Rows are counted each for itself, whatever ids they
repeat; a NULL id stays. Strings of special tokens count as the library's default has it: one
token each. Further columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, table
from .packing import vocabulary
from .tokens import Encoder

#: Characters of a chunk, of the first overlap, and of the widest overlap a chunk carries.
STRIDE, OVERLAP, REACH = 16_384, 128, 1_024
#: How much longer chunks and overlaps get where a document could not be spliced.
WIDER = 16
#: Texts encoded at a time; characters of chunks handed on or encoded at a time.
BATCH, BLOCK = 1024, 1 << 20
LIMIT = 1024


# --- splicing ---------------------------------------------------------------------------


def spliceable(vocab: dict) -> bool:
    """Whether word boundaries of this vocabulary (its JSON) are proven to be local."""
    cut = vocab.get("pre_tokenizer") or {}
    byte_level = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
    added = [t["content"] for t in vocab.get("added_tokens", [])]
    plain = all(not (t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized")) for t in vocab.get("added_tokens", []))
    # Where one special string may overlap another, which of them counts is decided further left.
    plain &= not any(b.startswith(a[k:]) for a in added for b in added for k in range(1, len(a)))
    whole = not vocab.get("normalizer") and not vocab.get("truncation") and not vocab.get("padding") and not vocab.get("post_processor")
    return byte_level and plain and whole


class Tokens:
    """A vocabulary file and how its texts are counted."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        if path.endswith(".model"):
            from sentencepiece import SentencePieceProcessor

            self.model, self.splices = SentencePieceProcessor(model_file=path), False
            return
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)
        self.model, self.splices = None, spliceable(vocab)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = [t["content"] for t in vocab.get("added_tokens", [])]
        #: A special string may begin inside a chunk and end behind it, and the pattern looks ahead.
        self.margin = max(map(len, self.specials), default=0) + 2
        # The encoder by ranks takes special strings for ordinary text.
        self.plain = Encoder.of_worker(path) if self.splices else None

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of whole texts."""
        if self.model is not None:
            return [len(ids) for ids in self.model.encode(texts, num_threads=1)] if texts else []
        special = [self.plain is None or any(s in t for s in self.specials) for t in texts]
        rare = iter(self.tokenizer.encode_batch_fast([t for t, s in zip(texts, special) if s], add_special_tokens=False))
        return [len(next(rare)) if s else self.plain.count(t) for t, s in zip(texts, special)]

    def encode(self, texts: list[str]) -> list:
        return self.tokenizer.encode_batch(texts, add_special_tokens=False)


def boundaries(encoding, low: int, high: int) -> dict[int, int]:
    """Word boundaries at characters ``low`` to ``high``: place -> tokens before it."""
    words, offsets, found = encoding.word_ids, encoding.offsets, {}
    for k in range(len(words) - 1, -1, -1):
        at = offsets[k][0]
        if at < low:
            break
        if at <= high and (k == 0 or words[k] != words[k - 1]):
            found[at] = k
    return found


def splice(own, head, stride: int, end: int, closed: bool) -> int | None:
    """Tokens of a chunk up to the first boundary it shares with the next chunk's head, less the
    head's own tokens up to there; None if they share none at or before ``end``. ``closed`` says
    that the document ends there, a boundary of any reading."""
    left, right = boundaries(own, stride, end), boundaries(head, 0, end - stride)
    if closed:
        left[end], right[end - stride] = len(own), len(head)
    shared = [at for at in right if at + stride in left]
    return left[min(shared) + stride] - right[min(shared)] if shared else None


def chunk_tokens(tokens: Tokens, chunks: list[tuple[str, int]], stride: int, overlap: int) -> list[int | None]:
    """What each chunk (its text, characters of the document behind it) adds; None where the
    overlap it carries is too short."""
    out: list[int | None] = [None] * len(chunks)
    last = [n for n, (text, left) in enumerate(chunks) if len(text) <= stride and not left]
    for n, count in zip(last, tokens.count([chunks[n][0] for n in last])):
        out[n] = count
    todo = sorted(set(range(len(chunks))) - set(last))
    while todo:
        parts = [chunks[n][0][: stride + overlap] for n in todo]
        whole, heads = tokens.encode(parts), tokens.encode([p[stride:] for p in parts])
        again = []
        for n, part, own, head in zip(todo, parts, whole, heads):
            text, left = chunks[n]
            complete = len(part) == len(text)
            closed = complete and not left
            out[n] = splice(own, head, stride, len(part) if closed else len(part) - tokens.margin, closed)
            if out[n] is None and not complete:
                again.append(n)
        todo, overlap = again, overlap * 4
    return out


# --- the job ----------------------------------------------------------------------------

PIECES = "row long, n_bytes long, tokens long, chunk long, text string, behind long"


def _cut(path: str, stride: int, reach: int):
    """Texts to one row with their count, long ones to one row per chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, row = Tokens(path), TaskContext.get().partitionId() << 40

        def out(docs: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()))]
            return pa.RecordBatch.from_arrays([docs, *columns], ["doc_id", "row", "n_bytes", "tokens", "chunk", "text", "behind"])

        for b in batches:
            for low in range(0, b.num_rows, BATCH):
                part = b.slice(low, BATCH)
                texts, sizes = part.column(1).to_pylist(), part.column(2).to_pylist()
                long = [i for i, t in enumerate(texts) if tokens.splices and len(t) > stride]
                short = sorted(set(range(len(texts))) - set(long))
                if short:
                    counts = tokens.count([texts[i] for i in short])
                    yield out(part.column(0).take(pa.array(short)), [(row + i, sizes[i], n, None, None, None) for i, n in zip(short, counts)])
                at: list[int] = []
                rows: list[tuple] = []
                size = 0
                for i in long:
                    text = texts[i]
                    for chunk in range(-(-len(text) // stride)):
                        own = text[chunk * stride : (chunk + 1) * stride + reach]
                        at.append(i)
                        rows.append((row + i, sizes[i], None, chunk, own, len(text) - chunk * stride - len(own)))
                        size += len(own)
                        if size >= BLOCK:
                            yield out(part.column(0).take(pa.array(at)), rows)
                            at, rows, size = [], [], 0
                if rows:
                    yield out(part.column(0).take(pa.array(at)), rows)
                row += len(texts)

    return run


def _add(path: str, stride: int, overlap: int):
    """Chunks to what they add to their document; NULL where they could not be spliced."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = Tokens(path)
        for b in batches:
            texts, behind, added, low = b["text"].to_pylist(), b["behind"].to_pylist(), [], 0
            while low < len(texts):
                high, size = low, 0
                while high < len(texts) and (high == low or size + len(texts[high]) <= BLOCK):
                    size += len(texts[high])
                    high += 1
                added += chunk_tokens(tokens, list(zip(texts[low:high], behind[low:high])), stride, overlap)
                low = high
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["row"], b["n_bytes"], pa.array(added, pa.int64())], ["doc_id", "row", "n_bytes", "tokens"])

    return run


def _merged(chunks: DataFrame, stride: int) -> DataFrame:
    """WIDER chunks of a document to one, with an overlap WIDER times as long.

    The chunk behind the last one of a group lends its text as the overlap.
    """
    group = (F.col("chunk") / WIDER).cast("long")
    lends = (F.col("chunk") % WIDER == 0) & (F.col("chunk") > 0)
    dealt = chunks.withColumn("group", F.explode(F.when(lends, F.array(group, group - 1)).otherwise(F.array(group))))
    parts = dealt.groupBy("row", "group").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_bytes").alias("n_bytes"),
        F.array_sort(F.collect_list(F.struct("chunk", "text", "behind"))).alias("parts"),
    )
    last = F.element_at("parts", -1)
    # Every chunk gives its own characters; the last one of a document also what stands behind.
    lent = last["chunk"] == (F.col("group") + 1) * WIDER
    over = F.when(lent, F.greatest(F.char_length(last["text"]) - stride, F.lit(0))).otherwise(F.lit(0))
    text = F.concat(
        F.array_join(F.transform(F.slice("parts", 1, F.size("parts") - 1), lambda p: F.substring(p["text"], 1, stride)), ""),
        F.when(lent, F.substring(last["text"], 1, stride)).otherwise(last["text"]),
    )
    return parts.select("doc_id", "row", "n_bytes", F.lit(None).cast("long").alias("tokens"), F.col("group").alias("chunk"), text.alias("text"), (last["behind"] + over).alias("behind"))


def count_tokens(
    docs: DataFrame, id: str = "doc_id", text: str = "text", vocab: str | None = None, limit: int = LIMIT, stride: int = STRIDE, overlap: int = OVERLAP, reach: int = REACH
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens), one row per row of ``docs``."""
    if not 0 < overlap <= reach or reach * WIDER > stride:
        raise ValueError("overlap <= reach <= stride / 16 is needed")
    vocab, scratch = vocab or vocabulary(), Scratch(docs.sparkSession, "tokens")
    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    pieces = scratch.keep(rows.mapInArrow(_cut(vocab, stride, reach), f"doc_id {kind}, {PIECES}"), "pieces")
    done = pieces.filter("chunk IS NULL").select("doc_id", "n_bytes", F.col("tokens").alias("n_tokens"))
    chunks, step = pieces.filter("chunk IS NOT NULL"), 0
    while True:
        added = chunks.select("doc_id", "row", "n_bytes", "text", "behind").mapInArrow(_add(vocab, stride, overlap), f"doc_id {kind}, row long, n_bytes long, tokens long")
        each = added.groupBy("row").agg(
            F.first("doc_id").alias("doc_id"), F.first("n_bytes").alias("n_bytes"), F.sum("tokens").alias("n_tokens"), F.bool_or(F.col("tokens").isNull()).alias("failed")
        )
        each = scratch.keep(each, f"counted{step}")
        done = done.unionByName(each.filter("NOT failed").select("doc_id", "n_bytes", "n_tokens"))
        failed = each.filter("failed").select("row")
        if failed.isEmpty():
            break
        chunks = scratch.keep(_merged(chunks.join(failed, "row", "left_semi"), stride), f"chunks{step}")
        stride, overlap, reach, step = stride * WIDER, reach * 4, reach * WIDER, step + 1
    return done.withColumn("over_limit", F.col("n_tokens") > limit)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
