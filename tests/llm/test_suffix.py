import hashlib
import random

import numpy as np
import pytest
from pelagia.llm.suffix import Prefixes, covered_windows, may_share, remove_repeats, segments, suffix_order


def brute(rows):
    order = sorted(range(len(rows)), key=lambda k: -(2**70) if rows[k][0] is None else rows[k][0])
    seen: dict[bytes, object] = {}
    rank = lambda k: -(2**70) if rows[k][0] is None else rows[k][0]
    for k in order:
        raw = (rows[k][1] or "").encode()
        for p in range(len(raw) - 49):
            seen.setdefault(raw[p : p + 50], rank(k))
    out = []
    for k, (i, text) in enumerate(rows):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 49):
            if seen[raw[p : p + 50]] < rank(k):
                gone[p : p + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        spans = sum(1 for p in range(len(gone)) if gone[p] and (p == 0 or not gone[p - 1]))
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(out, key=repr)


def test_suffix_order_is_lexicographic():
    rng = random.Random(4)
    strings = [bytes(rng.choice(b"ab\0\xff") for _ in range(rng.randint(1, 30))) for _ in range(40)]
    data = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    ends = np.cumsum([len(s) + 1 for s in strings]) - 1
    starts = ends - [len(s) for s in strings]
    want = sorted(((s[p:], k, starts[k] + p) for k, s in enumerate(strings) for p in range(len(s) + 1)), key=lambda x: (x[0], x[1]))
    assert suffix_order(data, starts, ends).tolist() == [int(w[2]) for w in want]


def test_covered_windows_of_a_collection():
    a = bytes(range(80))
    s, at, n = covered_windows([a, b"x" + a[10:70], a[20:]], np.array([3, 1, 2]))
    assert sorted(zip(s.tolist(), at.tolist(), n.tolist())) == [(0, 10, 21), (2, 0, 1)]


def test_strings_that_share_a_window_are_never_left_out():
    rng = random.Random(6)
    for _ in range(60):
        texts = []
        passage = bytes(rng.choice(b"abcdef ") for _ in range(rng.choice([50, 51, 64, 90])))
        for k in range(rng.randint(2, 6)):
            around = [bytes(rng.choice(b"abcdef ") for _ in range(rng.randint(0, 60))) for _ in range(2)]
            texts.append(around[0] + (passage if rng.random() < 0.7 else b"") + around[1])
        data = np.frombuffer(b"".join(texts), np.uint8)
        starts = np.cumsum([0] + [len(t) for t in texts])[:-1]
        name, begin, windows, _ = segments(data, starts, Prefixes())
        doc = np.searchsorted(starts, begin, "right") - 1
        strings = [data[b : b + w + 49].tobytes() for b, w in zip(begin, windows)]
        kept = may_share(strings, name, doc)
        for a in range(len(strings)):
            own = {strings[a][k : k + 50] for k in range(len(strings[a]) - 49)}
            if any(name[b] == name[a] and doc[b] != doc[a] and any(strings[b][k : k + 50] in own for k in range(len(strings[b]) - 49)) for b in range(len(strings))):
                assert kept[a]


@pytest.mark.parametrize("most", [20_000, 1])
def test_removal_matches_brute_force(make, prose, most):
    passage = prose(25, 1)
    rows = [(k, prose(60, 100 + k) + " " + passage[k % 7 :] + prose(20, 300 + k)) for k in range(14)]
    rows += [(30, rows[2][1]), (31, rows[2][1][:90]), (32, "=" * 400), (33, "x" + "=" * 300 + "y"), (34, "ab" * 200), (29, "ab" * 150), (35, None), (36, ""), (37, "é" * 60), (38, "a" + "é" * 60), (39, "short")]
    rows += [(None, passage), (5, rows[5][1]), (5, rows[6][1] + " more"), (40, prose(6000, 7)), (41, "new " + prose(6000, 7)[3000:20_000])]
    rng = random.Random(8)
    for k in range(12):
        w = rows[k][1].split()
        w[rng.randrange(len(w))] = "edited"
        rows.append((60 + k, " ".join(w)))
    got = [tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in remove_repeats(make(rows), most=most).collect()]
    assert sorted(got, key=repr) == brute(rows)
    assert remove_repeats(make([])).count() == 0


@pytest.mark.parametrize("most", [20_000, 1])
def test_repeats_inside_the_smallest_document_are_covered(make, prose, most):
    paragraph = prose(30, 5)
    rows = [(1, "-" * 80), (2, "-" * 400), (3, "=" * 70 + "\n" + "=" * 700), (4, "=" * 300)]
    rows += [(10, paragraph[20:110]), (11, " ".join([paragraph, prose(9, 1), paragraph, prose(9, 2), paragraph])), (12, "_" * 90), (12, "a" + "_" * 200), (12, "b" + "_" * 200), (11, paragraph)]
    got = [tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in remove_repeats(make(rows), most=most).collect()]
    assert sorted(got, key=repr) == brute(rows)
    assert {r[2] for r in got if r[0] == 2} == {400}


@pytest.mark.parametrize("id", [5, None])
def test_rows_that_share_an_id_keep_their_own_cuts(spark, make, prose, id):
    """Texts whose 15-bit hashes agree, under one id or none, beside a smaller document that one repeats."""
    from pyspark.sql import functions as F

    shared = prose(80, 1)[:300]
    many = [(k, prose(40, 50_000 + k)[:207]) for k in range(3000)]
    marked = make([(0, shared), *many]).select("doc_id", "text", F.pmod(F.xxhash64("text"), F.lit(1 << 15)).alias("m")).collect()
    by_mark: dict = {}
    for r in marked:
        by_mark.setdefault(r.m, set()).add(r.text)
    clashing = [sorted(v) for v in by_mark.values() if len(v) > 1]
    assert clashing
    one, two = clashing[0][:2]
    rows = [(None if id is None else 1, one + shared), (id, one), (id, two), (id, shared), (id, two), (9, shared), (9, one)]
    got = [tuple(bytes(v) if isinstance(v, bytearray) else v for v in r) for r in remove_repeats(make(rows)).collect()]
    assert sorted(got, key=repr) == brute(rows)


def test_segments_of_one_name_are_told_apart_by_64_bits(make):
    rng = np.random.default_rng(3)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz", np.uint8)
    pool = letters[rng.integers(0, 26, 2_000_000)]
    name, begin, _, _ = segments(pool, np.zeros(1, np.int64), Prefixes())
    seed = pool[begin[name.view(np.uint64).argmin()] :][:50]  # holds the string with the smallest hash
    texts = letters[rng.integers(0, 26, (400_000, 50))]
    for at in range(31):  # where in the window the string stands
        texts[0, 15:35] = seed[at : at + 20]
        if segments(texts[0], np.zeros(1, np.int64), Prefixes())[0].view(np.uint64)[0] == name.view(np.uint64).min():
            break
    texts[:, 15:35] = texts[0, 15:35]
    names, _, _, content = segments(texts.reshape(-1), np.arange(len(texts)) * 50, Prefixes())
    own = np.flatnonzero(names.view(np.uint64) == name.view(np.uint64).min())
    upper = content[own] >> np.uint64(32)
    order = np.argsort(upper, kind="stable")
    pairs = np.flatnonzero(upper[order][1:] == upper[order][:-1])
    assert len(own) > 300_000 and len(pairs)
    rows = [(2 * k + i, texts[own[order[p + i]]].tobytes().decode()) for k, p in enumerate(pairs) for i in (0, 1)]
    assert len({t for _, t in rows}) == len(rows)
    assert {r.n_removed for r in remove_repeats(make(rows), with_text=False).collect()} == {0}
