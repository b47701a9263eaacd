import random
from collections import defaultdict

import numpy as np
import pytest
from pelagia.llm import near_dedup
from pelagia.llm.decontam import contaminated, drop_contaminated, local_alignment
from pelagia.llm.near_dedup import drop_near_copies, forest, near_classes, signatures


def shingle_set(text):
    w = (text or "").split()
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def brute_classes(rows):
    ids = sorted(i for i, _ in rows)
    sets, parent = {i: shingle_set(t) for i, t in rows}, {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and both / len(sets[a] | sets[b]) >= 0.8:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in ids}


def edited(text, k, seed):
    r, w = random.Random(seed), text.split()
    for _ in range(k):
        w[r.randrange(len(w))] = f"edit{r.randrange(10**6)}"
    return " ".join(w)


@pytest.mark.parametrize("chunk", [400, 4])
def test_classes_match_brute_force(make, prose, monkeypatch, chunk):
    monkeypatch.setattr(near_dedup, "CHUNK", chunk)
    base = prose(150, 1)
    rows = [(k, prose(40 + k, 100 + k)) for k in range(25)]
    rows += [(100 + k, edited(base, 1 + k % 6, k)) for k in range(45)]  # pairs on either side of the threshold
    rows += [(200, base), (201, base), (202, base + " "), (300, None), (301, ""), (302, "one two"), (303, "one two"), (304, "one"), (305, prose(9000, 5)), (306, edited(prose(9000, 5), 3, 9))]
    got = {r.doc_id: (r.class_id, r.class_size) for r in near_classes(make(rows)).collect()}
    want = brute_classes(rows)
    sizes = defaultdict(int)
    for c in want.values():
        sizes[c] += 1
    assert got == {i: (c, sizes[c]) for i, c in want.items()}


def test_near_copies_leave_one_and_odd_rows_are_defined(make, prose):
    text = prose(80, 4)
    docs = make([(5, text), (3, edited(text, 1, 1)), (3, prose(70, 9)), (None, text), (9, None), (9, None), (8, prose(60, 2))])
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    # Rows are told apart by their place: of the class one row stays, ids and their lack aside.
    left = [(r.doc_id, r.text) for r in kept.collect()]
    assert sum(t in (text, edited(text, 1, 1)) for _, t in left) == 1
    assert sorted((i for i, t in left if t not in (text, edited(text, 1, 1))), key=repr) == sorted([3, 9, 9, 8], key=repr)
    assert near_classes(make([])).count() == 0 and drop_near_copies(make([])).count() == 0


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 2**63, 300, dtype=np.int64).astype(np.uint64)
    one, two = signatures([x, x[60:]], k=2000)
    assert abs((one == two).mean() - 0.8) < 0.04
    weights = [np.full(300, 2), np.concatenate([np.full(150, 2), np.full(150, 1)])]
    one, two = signatures([x, x], weights, k=2000)
    assert abs((one == two).mean() - 450 / 600) < 0.04
    assert (signatures([x[:1]], k=64) != 0).all()


def test_forest_joins_components_once():
    a = np.arange(100, dtype=np.uint64)
    sets = [a, a[:95], a[5:], np.arange(500, 600, dtype=np.uint64)]
    pairs = forest(sets, [1, 2, 3, 4], 0.8)
    assert len(pairs) == 2 and all(3 not in p for p in pairs)
    assert forest(sets, [1, 1, 1, 4], 0.8) == []


def test_alignment_is_smith_waterman():
    def brute(a, b):
        h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                h[i][j] = max(0, h[i - 1][j - 1] + (2 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
        return max(max(r) for r in h)

    rng = np.random.default_rng(1)
    for _ in range(60):
        a, b = rng.integers(0, 5, rng.integers(1, 14)), rng.integers(0, 5, rng.integers(0, 20))
        assert local_alignment(a, b)[0] == brute(a.tolist(), b.tolist())


def test_leaks_are_found_and_clean_documents_left(spark, make, prose):
    items = [(k, prose(20 + k, 1000 + k)) for k in range(12)] + [(50, None), (51, ""), (52, "Two words"), (0, prose(20, 1000)), (None, prose(30, 77))]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, score string")
    rng, rows, want = random.Random(2), [], set()
    for k in range(12):
        item = items[k][1].split()
        for form in range(4):
            body = list(item)
            if form == 1:
                body[rng.randrange(len(body))] = "changed"
            elif form == 2:
                del body[len(body) // 2]
                body.insert(3, "more")
            elif form == 3:
                body = " ".join(body).upper().replace(" ", ", ").split(" ")
            doc = 10 * k + form
            rows.append((doc, prose(60, 5000 + doc) + " " + " ".join(body) + " " + prose(90, 6000 + doc)))
            want.add((doc, k))
    rows += [(1000 + k, prose(150, 9000 + k)) for k in range(40)] + [(2000, None), (2001, ""), (None, prose(10, 3)), (0, rows[0][1]), (3000, prose(15_000, 8) + " " + items[3][1])]
    want |= {(3000, 3)}
    docs = make(rows)
    found = contaminated(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want and len(found) == len(want)
    assert all(r.score >= 0.5 and r.end_word > r.start_word for r in found)
    kept = drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - {d for d, _ in want}
    assert contaminated(make([]), benchmark).count() == 0 and contaminated(docs, benchmark.limit(0)).count() == 0


def test_filters_name_rows_not_ids(spark, make, prose):
    shared, own, leak = prose(80, 40), prose(80, 41), prose(30, 42)
    docs = make([(1, shared), (2, shared + " more"), (2, own), (None, own + " x"), (4, prose(50, 43))])
    left = [r.text for r in drop_near_copies(docs).collect()]
    assert len(left) == 3 and prose(50, 43) in left and sum(t.startswith(shared) for t in left) == 1
    benchmark = spark.createDataFrame([(1, leak)], "item_id long, text string")
    docs = make([(1, leak + " a b c"), (1, own), (None, own), (None, "x y " + leak), (3, None)])
    assert sorted((r.text or "" for r in drop_contaminated(docs, benchmark).collect())) == sorted([own, own, ""])


def test_edited_copies_are_found_beside_one_verbatim_copy(spark, make, prose):
    item = prose(15, 4242).split()
    edited_item = list(item)
    for k in (3, 7, 11):  # 4 of 13 3-grams stay, and stand in many more documents than the others
        edited_item[k] = f"edit{k}"
    rows = [(k, prose(30, 100 + k) + " " + " ".join(edited_item) + " " + prose(30, 700 + k)) for k in range(1, 40)]
    rows += [(0, prose(30, 1) + " " + " ".join(item)), (900, prose(60, 2)), (901, " ".join(item[:3]) + " " + prose(60, 3))]
    benchmark = spark.createDataFrame([(7, " ".join(item))], "item_id long, text string")
    found = {r.doc_id: r.score for r in contaminated(make(rows), benchmark).collect()}
    assert set(found) == set(range(40)) and found[0] == 1.0 and all(abs(found[k] - 0.7) < 1e-9 for k in range(1, 40))


def test_phrase_of_many_items_joins_only_items_whose_words_are_near(spark, make, prose):
    phrase = "which of the following is"
    own = lambda k: " ".join(f"w{k}x{j}" for j in range(7))
    items = [(k, f"{phrase} {own(k)}") for k in range(200)] + [(2000, phrase), (2001, phrase + " true")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    rows = [(k, f"{prose(30, k)} {items[k][1]} {prose(30, 90 + k)}") for k in range(20)]
    rows += [(100 + k, f"{prose(30, k)} {phrase} {prose(40, 70 + k)}") for k in range(20)]
    # Beside the phrase, only words that stand alone: no other 3-gram is left.
    rows += [(400 + k, f"{prose(9, k)} {phrase} " + " between ".join(own(k).split()[:5])) for k in range(5)]
    docs = make(rows)
    fields = ("doc_id", "item_id", "score", "start_word", "end_word")
    took = sorted(map(tuple, contaminated(docs, benchmark).select(*fields).collect()))
    every = sorted(map(tuple, contaminated(docs, benchmark, rare=10**6).select(*fields).collect()))
    assert took == every
    assert {(d, i) for d, i, *_ in took if i < 1000} == {(k, k) for k in range(20)} | {(400 + k, k) for k in range(5)}
    assert {d for d, i, *_ in took if i == 2000} == {d for d, _ in rows}


def test_common_seeds_find_what_every_seed_finds(spark, make, prose):
    rng = random.Random(9)
    stock = [prose(4, 300 + k) for k in range(6)]
    items = [(k, " ".join(rng.sample(stock, 3)) + " " + prose(rng.randint(1, 10), 800 + k)) for k in range(60)]
    rows = []
    for k in range(60):
        body = items[k % 60][1].split()
        for _ in range(rng.randint(0, 8)):
            at = rng.randrange(len(body))
            body[at : at + rng.randint(0, 2)] = ["odd"] * rng.randint(0, 2)
            body = body or ["odd"]
        rows.append((k, f"{prose(20, k)} {' '.join(body)} {prose(20, 40 + k)} {rng.choice(stock)}"))
    docs, benchmark = make(rows), spark.createDataFrame(items, "item_id long, text string")
    fields = ("doc_id", "item_id", "score", "start_word", "end_word")
    results = [sorted(map(tuple, contaminated(docs, benchmark, rare=n).select(*fields).collect())) for n in (0, 2, 10**6)]
    assert results[0] == results[1] == results[2] and len(results[0]) > 50
