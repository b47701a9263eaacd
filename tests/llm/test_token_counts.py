"""Spliced counts against the library's own count of whole texts."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pelagia.llm.token_counts import Tokens, chunk_tokens, count_tokens, op13_token_counts, spliceable
from pelagia.llm.packing import vocabulary
from public_tokenizers import path
from tokenizers import Tokenizer

WHOLE = Tokenizer.from_file(vocabulary())
TOKENS = Tokens(vocabulary())


def whole(text):
    return len(WHOLE.encode(text or "", add_special_tokens=False).ids)


def spliced(text, stride, reach, overlap):
    """The sum over chunks, or None if one of them fails at its widest overlap."""
    chunks = []
    for k in range(0, len(text), stride):
        own = text[k : k + stride + reach]
        chunks.append((own, len(text) - k - len(own)))
    added = chunk_tokens(TOKENS, chunks, stride, overlap)
    return None if None in added else sum(added)


ODD = ["<|endoftext|>", "<|endof", "text|>", " ", "  ", "\n\n", "\t", "it's", "'ll", "don", "é", "日本語", "😀", "a", "word", "12", "...", "é", " ", "x" * 40, "=" * 30, "‍", "<|"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(ODD), max_size=120), st.integers(20, 70), st.integers(1, 60))
def test_splices_are_boundaries_of_the_whole_text(parts, stride, overlap):
    text = "".join(parts)
    got = spliced(text, stride, 60, overlap)
    assert got is None or got == whole(text)


def test_ordinary_text_needs_no_second_round(prose):
    text = prose(3000, 5)
    assert spliced(text, 512, 32, 8) is None or spliced(text, 512, 32, 8) == whole(text)
    assert spliced(text, 512, 256, 64) == whole(text)
    assert spliced("z" * 5000, 512, 256, 64) is None


def test_counts_match_the_library_in_every_round(make, prose):
    rng = random.Random(3)
    rows = [(k, prose(5 + 40 * k, k)) for k in range(40)]
    rows += [(100, None), (101, ""), (102, "x" * 20_000), (103, " " * 9000 + "end"), (104, "<|endoftext|>" * 900), (105, "a<|endoftext|> b"), (None, "no id"), (7, prose(900, 1)), (7, prose(900, 1))]
    rows += [(200 + k, "".join(rng.choice(ODD) for _ in range(1500))) for k in range(6)]
    rows += [(300, "日本語" * 3000), (301, prose(400, 2) + "y" * 3000 + prose(400, 3)), (302, "0" * 70_000)]
    got = count_tokens(make(rows), limit=500, stride=256, overlap=4, reach=16).collect()
    want = [(i, len((t or "").encode()), whole(t), whole(t) > 500) for i, t in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert count_tokens(make([])).count() == 0
    assert got[0].__fields__ == ["doc_id", "n_bytes", "n_tokens", "over_limit"]


def test_vocabularies_without_proof_are_not_cut(make, prose):
    vocab = json.load(open(path("byte_bpe_50k.json"), encoding="utf-8"))
    assert spliceable(vocab)
    assert not spliceable(json.load(open(path("word_bpe_49k.json"), encoding="utf-8")))
    assert not spliceable(vocab | {"normalizer": {"type": "NFC"}})
    assert not spliceable(vocab | {"added_tokens": [{"content": "<a<"}, {"content": "<b>"}]})
    rows = [(1, prose(300, 1)), (2, None), (3, "A  B\n<|endoftext|>")]
    words = Tokenizer.from_file(path("word_bpe_49k.json"))
    got = {r.doc_id: r.n_tokens for r in count_tokens(make(rows), vocab=path("word_bpe_49k.json"), stride=256, overlap=4, reach=16).collect()}
    assert got == {i: len(words.encode(t or "", add_special_tokens=False).ids) for i, t in rows}
    from sentencepiece import SentencePieceProcessor

    pieces = SentencePieceProcessor(model_file=path("piece_bpe_32k.model"))
    got = {r.doc_id: r.n_tokens for r in count_tokens(make(rows), vocab=path("piece_bpe_32k.model"), stride=256, overlap=4, reach=16).collect()}
    assert got == {i: len(pieces.encode(t or "")) for i, t in rows}


def test_overlaps_that_do_not_fit_are_refused(make):
    with pytest.raises(ValueError):
        count_tokens(make([]), stride=100, overlap=10, reach=20)


def test_query_over_the_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, op13_token_counts(spark, sf_dir).collect()))
    assert got == sorted((r.doc_id, len((r.text or "").encode()), whole(r.text), whole(r.text) > 1024) for r in docs)
