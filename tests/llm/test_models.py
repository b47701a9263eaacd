import math
import zlib
from collections import Counter

import numpy as np
from pelagia.llm import langid, lm, toxicity
from pelagia.llm.toxicity import Lexicon, edits_for


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(new[-1] + 1, row[j] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_is_levenshtein_within_bounds():
    rng = np.random.default_rng(2)
    terms = ["idiot", "trash", "pathetic", "worthless", "scum", "ab", "idiots", "incorrigible"]
    words = {w for t in terms for w in (t, t[1:], t + "s", "x" + t, t.replace("i", "1", 1), t[:3] + "zz" + t[3:], t[::-1])}
    words |= {"".join(rng.choice(list("idotrash1"), rng.integers(1, 9))) for _ in range(400)} | {"", "é"}
    for states in (100_000, 3):
        lexicon = Lexicon(terms, states=states)
        for w in words:
            near = [(levenshtein(w, t), t) for t in terms if levenshtein(w, t) <= edits_for(t)]
            assert lexicon.match(w) == (min(near) if near else None), w


def test_toxicity_learns_matches_and_leaves_clean(spark, make, prose):
    rows = []
    for k in range(300):
        text = prose(60, k)
        if k % 6 == 0:
            text = text.replace(" ", " zorgwitz ", 2) if k % 12 else text + " Blatnokker!"
        rows.append((k, text))
    labels = spark.createDataFrame([(k, None if k == 5 else int(k % 6 == 0), "x") for k in range(300)] + [(None, 1, "x")], "doc_id long, toxic int, score string")
    more = [(1000, prose(50, 1) + " zorgw1tz"), (1001, prose(50, 2) + " zorgwits"), (1002, None), (1003, ""), (1004, prose(50, 3)), (None, "zorgwitz"), (1005, 'they said the word "zorgwitz" is a term'), (1006, prose(20_000, 5) + " zorgwitz")]
    docs = make(rows + more)
    model = toxicity.learn(toxicity.training_rows(docs, labels))
    assert set(model.terms) == {"zorgwitz", "blatnokker"}
    got = {r.doc_id: r.score2 for r in toxicity.with_scores(docs, model, name="score2").collect()}
    assert all((got[k] >= 0.7) == (k % 6 == 0) for k in range(300))
    assert got[1000] >= 0.7 and got[1001] >= 0.7 and got[1006] >= 0.7 and got[None] >= 0.7
    assert max(got[1002], got[1003], got[1004]) < 0.3 and got[1005] < got[None]
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and 1004 in {r.doc_id for r in kept.collect()} and 1000 not in {r.doc_id for r in kept.collect()}
    nothing = toxicity.learn(toxicity.training_rows(docs, labels.limit(0)))
    assert toxicity.with_scores(docs, nothing, name="s").filter("s >= 0.7").count() == 0
    assert toxicity.drop_toxic(make([]), labels).count() == 0


def test_language_held_out_and_cases(spark, make):
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = langid.fit(table.filter(langid.split_of("doc_id", 5) != 0))
    both = langid.predict(table, model).join(table.select("doc_id", "lang"), "doc_id").filter(langid.split_of("doc_id", 5) == 0)
    assert both.filter("lang = lang_pred").count() >= 0.95 * both.count()
    odd = make([(1, None), (2, ""), (3, "12 34 --"), (None, "the and of the is in that"), (4, "x"), (4, "x")])
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(odd, model).collect()}
    assert [got[k] for k in (1, 2, 3)] == [("und", 0.0)] * 3
    assert got[None][0] == "en" and 0 <= got[4][1] <= 1
    assert langid.predict(make([]), model).count() == 0
    unlearned = langid.fit(make([(1, "abc")]))
    assert {r.lang_pred for r in langid.predict(odd, unlearned).collect()} == {"und"}


def test_kernel_is_presence_over_geometric_mean():
    x, owner = langid.presence(["abcabc", "abd", "", "q" * 2000])
    assert owner.tolist() == [0, 1, 2, 3, 3, 3]
    assert x[0].sum() == 3 + 3 + 3 and x[0] @ x[1] == 3 and x[2].sum() == 0


def test_long_texts_are_read_in_blocks_of_windows(monkeypatch):
    rng = np.random.default_rng(4)
    letters = list("abcdefghij klmno")
    texts = ["".join(rng.choice(letters, n)) for n in (10, 799, 800, 801, 5000, 16_003)] + ["²½ 12", "İ" * 3000]
    model = langid.Classifier([t[:800] for t in texts[2:6]] + ["zzz zz zzzz"] * 2, ["a", "b", "a", "b", "c", "c"])
    whole = model.predict(texts)
    monkeypatch.setattr(langid, "BLOCK", 3)
    assert all(a[0] == b[0] and abs(a[1] - b[1]) < 1e-6 for a, b in zip(whole, model.predict(texts)))
    assert whole[6] == ("und", 0.0)
    for i in (0, 3, 5):  # brute force: the kernel of each window with the weights, averaged
        x, _ = langid.presence([texts[i]])
        mean = ((x @ model.weights) / np.sqrt(np.maximum(1, x.sum(1, keepdims=True)))).mean(0)
        assert whole[i][0] == model.langs[mean.argmax()] and abs(whole[i][1] - np.clip((mean.max() + 1) / 2, 0, 1)) < 1e-6


def test_nothing_but_toxic_labels_gives_high_scores(spark, make):
    rows = spark.createDataFrame([(f"word{k} vile", 1) for k in range(50)], "text string, toxic int")
    got = toxicity.with_scores(make([(1, "vile"), (2, None)]), toxicity.learn(rows), name="s").collect()
    assert all(r.s > 0.9 for r in got)


def test_network_gradients_and_normalisation():
    rng = np.random.default_rng(0)
    net = lm.Network(np.arange(70, 0, -1).astype(float), 30, 20)
    for k in ("C", "V", "U"):
        net.p[k] = rng.standard_normal(net.p[k].shape) * 0.2
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, y = rng.integers(0, 72, (5, 3)), rng.integers(0, 72, (5, 3))
    start = rng.standard_normal((3, lm.HIDDEN)) * 0.1

    def loss():
        h, total = start, 0.0
        table = net.p["E"] @ net.p["W"] + net.p["b"]
        for t in range(5):
            h = net.step(table[x[t]], h * (x[t] != 0)[:, None])[0]
            total -= net.log_probability(h, y[t]).sum()
        return total / y.size

    grads, _ = net._window(x, y, start)
    for k in net.p:
        flat, g = net.p[k].reshape(-1), grads[k].reshape(-1)
        for i in rng.choice(len(flat), 6):
            old = flat[i]
            flat[i] = old + 1e-5
            up = loss()
            flat[i] = old - 1e-5
            down = loss()
            flat[i] = old
            assert abs((up - down) / 2e-5 - g[i]) < 1e-5 + 1e-3 * abs(g[i]), k
    h = rng.standard_normal((1, lm.HIDDEN))
    assert abs(np.exp(net.log_probability(np.repeat(h, 72, 0), np.arange(72))).sum() - 1) < 1e-6


def test_state_goes_on_across_windows_and_neighbours_do_not_matter():
    net = lm.Network(np.arange(70, 0, -1).astype(float), 30, 20)
    rng = np.random.default_rng(1)
    for k in ("C", "V"):
        net.p[k] = (rng.standard_normal(net.p[k].shape) * 0.2).astype(np.float32)
    docs = [rng.integers(1, 72, n) for n in (0, 1, 200, 24, 25, 77)]
    together = net.score(docs)
    assert np.allclose(together, [net.score([d])[0] for d in docs], rtol=1e-4)
    h, total = np.zeros((1, lm.HIDDEN), np.float32), 0.0
    table = net.p["E"] @ net.p["W"] + net.p["b"]
    for a, b in zip([0, *docs[2]], [*docs[2], 0]):
        h = net.step(table[[a]], h)[0]
        total += net.log_probability(h, np.array([b]))[0]
    assert abs(total - together[2]) < 1e-2


def test_scores_and_counts_match_brute_force(make, prose, monkeypatch):
    monkeypatch.setattr(lm, "COMMON", 60)
    monkeypatch.setattr(lm, "VOCABULARY", 30)
    monkeypatch.setattr(lm, "UPDATES", 20)
    rows = [(k, prose(5 + k, k)) for k in range(60)] + [(100, None), (101, ""), (102, "ÄB ab\x0bAB\u00a0x"), (None, "la la"), (7, "la su"), (7, "la su"), (103, prose(5000, 3) + " unheard")]
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2
    tokens = lambda t: [*(t or "").encode().lower().split(), None]
    counts = Counter(w for i, t in rows if not held(i) for w in tokens(t))
    total, distinct = sum(counts.values()), len(counts)
    want = sorted((i, len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), total, round(sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens(t)), 6)) for i, t in rows if i is not None)
    docs = make(rows)
    out = lm.score_documents(docs, docs.filter(lm.split_of("doc_id", 7) != 2)).collect()
    got = sorted((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out if r.doc_id is not None)
    assert got == want and len(out) == len(rows)
    assert all(math.isfinite(r.score) and r.score < 0 for r in out)
    empty = lm.score_documents(docs, docs.limit(0)).collect()
    assert {r.base_score for r in empty} == {0.0} and {r.n_known for r in empty} == {0}
    assert lm.score_documents(make([]), make([])).count() == 0


def test_network_learns_from_every_training_row(make, prose, monkeypatch):
    monkeypatch.setattr(lm, "UPDATES", 20)
    monkeypatch.setattr(lm, "BLOCK", 3000)
    rare = ["kopf wald turm berg fluss", "turm fluss kopf berg wald"]  # a language of few rows, in one order of words
    rows = [(k, prose(40, k)) for k in range(400)] + [(5000 + k, " ".join(rare[k % 2] for _ in range(12))) for k in range(30)] + [(9000, None), (None, "la")]
    docs = make(rows)
    train = docs.filter(lm.split_of("doc_id", 7) != 2)
    counts = train.select("text").mapInArrow(lm._count, "key long, n long").groupBy("key").agg({"n": "sum"}).withColumnRenamed("sum(n)", "n")
    model = lm.fit(train, counts)
    before = model.network.weights()
    assert lm.learn(model, train) == model.total == sum(len(lm.tokens_of(r.text)) + 1 for r in train.collect())
    assert not np.array_equal(before, model.network.weights())
    out = lm.score_documents(docs, train).withColumn("held", lm.split_of("doc_id", 7) == 2).filter("held AND doc_id >= 5000 AND doc_id < 9000").collect()
    assert out and all(r.score > r.base_score for r in out)


def test_averaged_rounds_weigh_tasks_by_their_tokens():
    import pyarrow as pa

    one, two = np.arange(4, dtype=np.float32), np.ones(4, np.float32)
    rows = [(0, 1, one), (1, 1, two), (0, 3, two)]
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows]), pa.array([r[2].tobytes() for r in rows])], ["piece", "tokens", "weights"])
    (out,) = lm._average(iter([batch]))
    got = {p: np.frombuffer(w, np.float32).tolist() for p, w in zip(out["piece"].to_pylist(), out["weights"].to_pylist())}
    assert got == {0: ((one + 3 * two) / 4).tolist(), 1: two.tolist()} and out["tokens"].to_pylist() == [4, 1]


def test_quoted_terms_and_copied_clean_documents_stay_in_the_lexicon(spark, make, prose):
    rows = [(k, prose(60, k) + " zorgwitz " + prose(60, 5000 + k), 1) for k in range(100)]
    rows += [(1000 + k, prose(60, 1000 + k) + ' they called it "zorgwitz" then', 0) for k in range(60)]
    rows += [(2000 + k, prose(60, 2000 + k) + " blatnokker", 1) for k in range(60)]
    rows += [(3000 + k, prose(60, 3000) + " blatnokker", 0) for k in range(40)]
    rows += [(4000 + k, prose(80, 4000 + k), 0) for k in range(300)]
    model = toxicity.learn(spark.createDataFrame([(t, y) for _, t, y in rows], "text string, toxic int"))
    assert set(model.terms) == {"zorgwitz", "blatnokker"}
    got = {r.doc_id: r.s for r in toxicity.with_scores(make([(i, t) for i, t, _ in rows]), model, name="s").collect()}
    assert all(got[i] >= 0.7 for i, _, y in rows if y)
    assert all(got[i] < 0.7 for i, _, _ in rows if 1000 <= i < 2000 or i >= 4000)


def test_small_weights_need_no_maximum_and_large_ones_keep_it():
    rng = np.random.default_rng(3)
    net = lm.Network(np.arange(130, 0, -1).astype(float), 30, 20)
    for k in ("C", "V"):
        net.p[k] = (rng.standard_normal(net.p[k].shape) * 0.3).astype(np.float32)
    h, target = np.tanh(rng.standard_normal((3000, lm.HIDDEN))).astype(np.float32), rng.integers(0, 132, 3000)
    assert net.small() == (True, True)
    assert np.allclose(net.log_probability(h, target), net.log_probability(h, target, net.small()), atol=1e-4)
    for k in ("C", "V"):
        net.p[k] = net.p[k] * np.float32(200)
    assert net.small() == (False, False)
    assert np.isfinite(net.log_probability(h, target, net.small())).all()


def test_texts_are_read_into_numbers_once_for_learning_and_scoring(make, prose, monkeypatch):
    monkeypatch.setattr(lm, "COMMON", 60)
    monkeypatch.setattr(lm, "VOCABULARY", 30)
    monkeypatch.setattr(lm, "UPDATES", 5)
    coded, coder = [], lm.coded
    monkeypatch.setattr(lm, "coded", lambda *a, **k: coded.append(a) or coder(*a, **k))
    docs = make([(k, prose(5 + k, k)) for k in range(60)] + [(100, None), (None, "la la"), (7, "la su"), (7, "la su")])
    trained = lm.split_of("doc_id", 7) != 2
    split = lm.score_split(docs, trained)
    assert len(coded) == 1
    columns = ("n_tokens", "n_known", "train_tokens", "base_score")
    rows = lambda df: sorted((str(r.doc_id), *(r[c] for c in columns)) for r in df.collect())
    assert rows(split) == rows(lm.score_documents(docs, docs.filter(trained)))


def test_documents_that_outlast_others_are_scored_in_full_windows(monkeypatch):
    net, rng = lm.Network(np.arange(70, 0, -1).astype(float), 30, 20), np.random.default_rng(2)
    sizes, inner = [], net._log_probability
    monkeypatch.setattr(net, "_log_probability", lambda states, *a: sizes.append(len(states)) or inner(states, *a))
    docs = [rng.integers(0, 72, n).astype(lm.ID) for n in (2000, *(10 for _ in range(63)))]
    scores = net.score(docs)
    # One document of 64 is left after 11 steps: its windows of STEPS tokens used to be worked on one by one.
    assert sum(sizes) == sum(len(d) + 1 for d in docs) and len(sizes) == 2
    assert np.allclose(scores[:2], [net.score([d])[0] for d in docs[:2]], rtol=1e-4)
