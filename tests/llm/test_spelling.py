"""Spelling variants against brute force over all pairs of words."""

import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pelagia.llm.common import Scratch
from pelagia.llm.spelling import code_points, near, op11_spelling_variants, spelling_variants, tiles


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def brute(rows, least=7, twice=2, more=10):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = crc32(f"{'' if i is None else i}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            n[word] += 1
    words = sorted(w for w, c in n.items() if len(w) >= least and c >= twice)
    links = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w in words:
        best = min(links[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= more * n[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(links[w]), n[form[w]] if form[w] else None))
    return out


def answer(df):
    return sorted(((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()), key=lambda r: r[0])


def corpus(seed, documents=60):
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abeéÿ") for _ in range(rng.randint(6, 12))) for _ in range(30)]
    stems += ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "abababab", "babababa", "Straßen", "Éclairs", "éclairs", "x×÷yzabc"]
    rows = []
    for k in range(documents):
        words = []
        for _ in range(40):
            w = rng.choice(stems[: rng.randint(1, len(stems))])
            if rng.random() < 0.3:
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice("abé") + w[at:], w[:at] + rng.choice("abé") + w[at + 1 :]])
            words.append(w.upper() if rng.random() < 0.1 else w)
        rows.append((k, rng.choice([" ", ", ", "1", "_"]).join(words)))
    return rows


@pytest.mark.parametrize("parts, most", [(4, 512), (1, 3), (2, 1), (9, 512)])
def test_variants_match_brute_force(make, parts, most):
    rows = corpus(parts) + [(None, "nothing nothing without"), (None, "without"), (70, None), (71, ""), (5, "repeated repeated"), (5, "repeated repeated")]
    rows += [(80, "y" * 3000 + " " + "y" * 3001), (81, "y" * 3000 + " " + "y" * 3001)]
    assert answer(spelling_variants(make(rows), parts=parts, most=most)) == brute(rows)
    assert spelling_variants(make([])).count() == 0


def test_chains_of_forms_are_followed_to_the_last(make):
    words = ["chaining", "chainixg", "chaixixg", "chxixixg", "cxxixixg"]
    rows = [(1000 + k, " ".join([w] * 3 * 12 ** (4 - k))) for k, w in enumerate(words)]
    got = answer(spelling_variants(make(rows)))
    assert got == brute(rows)
    assert [r[2] for r in got if r[0] == words[4]] == [words[0]]


def test_a_crowd_of_like_words_is_cut_into_small_tiles(spark, make):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [f"common{a}{b}{c}tail" for a in letters for b in letters[:12] for c in letters[:6]]
    table = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    placed = tiles(table, Scratch(spark, "test"), parts=1, most=64)
    assert placed.filter("high - low > 1").groupBy("tile").count().agg({"count": "max"}).first()[0] <= 64
    rows = [(k, " ".join(words) + " commonabatail" * 30) for k in range(2)]
    assert answer(spelling_variants(make(rows), parts=1, most=64)) == brute(rows)


def test_blocks_find_each_pair_in_one_part():
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(5, 9))) for _ in range(160)})
    size = max(map(len, words))
    left, right, length = code_points(words, size + 1)
    block = tuple(x[None] for x in (left, right, length))
    total = np.zeros((len(words), len(words)), int)
    for s in range(5, size + 1):
        for low, high in ((0, 2), (2, 3), (3, s)):
            total += near(block, block, *(np.array([v]) for v in (s, low, high)))[0]
    assert total.tolist() == [[int(one_edit(a, b)) for b in words] for a in words]


def test_query_over_the_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    got = answer(op11_spelling_variants(spark, sf_dir))
    want = {r[0]: r for r in brute_fast([(r.doc_id, r.text) for r in docs])}
    assert {r[0]: r for r in got} == want


def brute_fast(rows):
    """Brute force through all deletions of each word, for tables with many words."""
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = crc32(f"{i}:{word}".encode())
            n[word[: h % len(word)] + word[h % len(word) + 1 :] if h % 31 == 0 else word] += 1
    words = sorted(w for w, c in n.items() if len(w) >= 7 and c >= 2)
    holes: dict = {}
    for w in words:
        for k in range(len(w)):
            holes.setdefault(w[:k] + w[k + 1 :], set()).add(w)
    links: dict = {w: set(holes.get(w, ())) for w in words}
    for hole, own in holes.items():
        for w in own:
            links[w] |= {x for x in own if x != w and one_edit(w, x)} | ({hole} if hole in links else set())
    form = {}
    for w in words:
        best = min(links[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        yield w, form[w], root, n[w], len(links[w]), n[form[w]] if form[w] else None
