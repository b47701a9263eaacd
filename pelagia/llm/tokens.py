"""Byte-level BPE ids of whole texts, as the tokenizers library gives them.

A byte-level BPE vocabulary whose merges stand in the order of their ids can be applied by ranks
alone: of all neighbours in a word, the pair with the least id is merged first. That is what
tiktoken does, several times faster and without a memo, so ordinary texts go to it with the
ranks read from the same JSON file. Texts go to the tokenizers library whole where the two are not
proven alike or safe: where a character is of a class (letter, number, blank) that the short
pattern below does not know, where a run of blanks is very long, and for any other vocabulary.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types

import numpy as np

# The characters whose classes are the same in every version of the libraries, and the
# pattern by which the vocabulary's pre-tokenizer cuts a text.
_KNOWN = "\t-\r -~A-Za-zÀ-ÖØ-öø-ɏ¡-©«-±´¶-¸»¿×÷‐-‧"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Blanks in a row that still go by ranks; the pattern's lookahead goes back over such a run.
BLANKS = 1_000
_ODD = re.compile(rf"[^{_KNOWN}]|\s{{{BLANKS}}}")


def byte_of_sign() -> dict[str, int]:
    """The sign that stands for each byte in a byte-level vocabulary: printable ones for
    themselves, the others in order from code point 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


def ranks_of(vocab: dict) -> dict[bytes, int] | None:
    """bytes -> id of a vocabulary (its JSON) that ranks alone describe, else None."""
    model, cut = vocab["model"], vocab.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex", True):
        return None
    if vocab.get("normalizer") or vocab.get("post_processor") or model.get("dropout") or model.get("ignore_merges"):
        return None
    ids, signs = model["vocab"], byte_of_sign()
    special = {t["content"] for t in vocab.get("added_tokens", [])}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if any(ids.get(a + b) != 256 + n for n, (a, b) in enumerate(merges)):
        return None
    words = {w: n for w, n in ids.items() if w not in special}
    if len(words) != 256 + len(merges) or any(c not in signs for w in words for c in w):
        return None
    return {bytes(signs[c] for c in w): n for w, n in words.items()}


class Encoder:
    """Texts to little-endian unsigned 32-bit ids; special strings are ordinary text."""

    @classmethod
    def of_worker(cls, path: str) -> Encoder:
        """The encoder of this Python worker, which serves one task after the other. Functions
        travel by value, so what outlives a task hangs on a module of its own."""
        store = sys.modules.setdefault("_pelagia_worker", types.ModuleType("_pelagia_worker"))
        kept = vars(store).setdefault("encoders", {})
        if path not in kept:
            kept[path] = cls(path)
        return kept[path]

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            ranks = ranks_of(json.load(f))
        self.by_rank = None
        if ranks is not None:
            import tiktoken

            self.by_rank = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def ids(self, text: str) -> np.ndarray:
        if self.by_rank is None or _ODD.search(text):
            return self._whole(text)
        return np.array(self.by_rank.encode_ordinary(text), "<u4")

    def count(self, text: str) -> int:
        if self.by_rank is None or _ODD.search(text):
            return len(self._whole(text))
        return len(self.by_rank.encode_ordinary(text))

    def encode(self, texts: list[str]) -> list[bytes]:
        return [self.ids(t).tobytes() for t in texts]
