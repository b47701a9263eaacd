"""Hard negatives against all scores, and the scan against plain products."""

import math
import random

import numpy as np
import pytest
from pelagia.llm.negatives import OP12_SQL, Block, Tops, _blocks, hard_negatives, op12_hard_negatives, scan, search_label, search_windows, usable, window_of
from workload.check import compare, connect

SCHEMA = "vec_id long, embedding array<float>, label int, row string, score string, x string, id string, rank string"


def make_vectors(spark, rows):
    return spark.createDataFrame([(*r, "r", "s", "x", "i", "k") for r in rows], SCHEMA)


def brute(rows, anchors=100, positives=5, negatives=5):
    last = lambda i: (i is None, i)
    use = []
    for i, x, label in rows:
        if label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        use.append((i, [math.floor(256 * float(np.float32(v))) for v in x], (label + 1) % 10 if i is not None and i % 7 == 0 else label))
    out = []
    for k, (i, x, label) in enumerate(use):
        if i is None or i % anchors:
            continue
        scores = [(-sum(a * b for a, b in zip(x, y)), last(j), other) for m, (j, y, other) in enumerate(use) if m != k]
        for p, j, _ in sorted(s for s in scores if s[2] == label)[:positives]:
            inside = sorted((s, j) for s, j, other in scores if other != label and 80 * -p <= 100 * -s <= 100 * -p)
            out += [(i, j[1], r, m[1], -p, -s) for r, (s, m) in enumerate(inside[:negatives], 1)]
    return sorted(out, key=repr)


def answer(df):
    return sorted(((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect()), key=repr)


def cloud(seed, n, width, spread=1.0):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(4, width))
    x = centre[rng.integers(0, 4, n)] + spread * rng.normal(size=(n, width))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [(k, x[k].astype(np.float32).tolist(), int(rng.integers(0, 5))) for k in range(n)]


@pytest.mark.parametrize("block, slice", [(8192, 8192), (37, 2)])
def test_negatives_match_brute_force(spark, block, slice):
    rows = cloud(1, 420, 24, 0.5)
    rows += [(500, rows[3][1], 2), (500, rows[3][1], 2), (600, rows[4][1], None), (None, rows[0][1], rows[0][2]), (None, rows[5][1], (rows[0][2] + 1) % 5), (None, rows[5][1], (rows[0][2] + 1) % 5)]
    rows += [(700, [0.0] * 24, 1), (701, None, 1), (702, [float("nan")] * 24, 1), (703, [float("inf")] + [0.0] * 23, 1), (704, [None] * 24, 1), (800, rows[7][1][:10], 3), (801, [], 3), (900, [], 3)]
    rows += [(1000 + k, rows[200][1], 3 if k % 2 else 4) for k in range(60)]  # ties of many rows
    got = answer(hard_negatives(make_vectors(spark, rows), block=block, slice=slice))
    assert got == brute(rows)
    assert len(got) > 100


def test_few_rows_and_none(spark):
    assert answer(hard_negatives(make_vectors(spark, []))) == []
    assert answer(hard_negatives(make_vectors(spark, [(1, [1.0], 1), (2, [1.0], 2)]))) == []
    few = [(100, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, [0.9, 0.5], 2)]
    assert answer(hard_negatives(make_vectors(spark, few))) == brute(few) != []
    alone = [(100, [1.0], 1), (200, [-1.0], 1), (3, [1.0], 2)]  # a negative score has no window
    assert answer(hard_negatives(make_vectors(spark, alone))) == brute(alone) == []


def test_windows_hold_the_whole_numbers_of_the_rule():
    for score in range(-40, 400):
        low, high = window_of(score)
        assert [s for s in range(-60, 420) if low <= s <= high] == [s for s in range(-60, 420) if 80 * score <= 100 * s <= 100 * score]


def one_block(rows):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64()), pa.array([[math.floor(256 * v) for v in r[1]] for r in rows], pa.list_(pa.int64())), pa.array(range(len(rows)), pa.int64())],
        ["id", "label", "x", "row"],
    )
    (out,) = _blocks(10_000)(iter([batch]))
    return Block.of(*(out[c].to_pylist()[0] for c in ("ids", "known", "labels", "rows", "width", "columns")))


def test_scan_reads_columns_by_magnitude_and_drops_candidates_early():
    rows = cloud(3, 2000, 32, 0.2)
    block = one_block(rows)
    anchor = block.columns[:, 17].astype(np.int64)
    exact = anchor @ block.columns.astype(np.int64)
    seen = []

    def keep(least, most):
        seen.append(len(least))
        assert (least <= most).all()
        return most >= np.sort(least)[-5]

    places, scores = scan(block, anchor, np.arange(2000), keep)
    assert (scores == exact[places]).all() and set(np.argsort(-exact)[:5]) <= set(places)
    assert seen[0] == 2000 and seen[-1] < 600  # the anchor's own cluster is a quarter of all
    tops = Tops(5)
    search_label(block, anchor, np.arange(2000), (0, 0), tops)
    assert tops.held[0, 0][2].tolist() == np.sort(exact)[::-1][:5].tolist()
    top = int(np.sort(exact)[-40])
    search_windows(block, anchor, np.arange(2000), {(0, 1): window_of(top)}, tops)
    assert tops.held[0, 1][2].tolist() == [s for s in np.sort(exact)[::-1] if s <= top][:5]


def test_scores_beyond_64_bits_are_refused():
    block = one_block([(k, [2.0**30] * 8, 1) for k in range(3)])
    with pytest.raises(OverflowError):
        scan(block, np.full(8, 2**38), np.arange(3), lambda a, b: a == a)


def test_query_matches_sql(spark, sf_dir):
    assert compare(spark, connect(sf_dir), sf_dir, op12_hard_negatives, OP12_SQL).startswith("ok")
    rng = random.Random(2)
    rows = [(rng.choice([k, 7 * k, None]), [rng.choice([0.5, -0.25, 1.0]) for _ in range(6)], rng.choice([1, 2, 9])) for k in range(300)]
    assert usable(make_vectors(spark, rows)).count() == 300
    assert answer(hard_negatives(make_vectors(spark, rows))) == brute(rows)
