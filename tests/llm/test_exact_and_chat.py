import hashlib
import re
from collections import defaultdict

from pelagia.llm.chat import format_conversations, parse, read_back
from pelagia.llm.exact_dedup import drop_copies, exact_groups
from pyspark.sql import functions as F

BLANK = re.compile("[\x20\x09-\x0d]")


def test_exact_groups_match_brute_force(make):
    rows = [(1, "a b"), (2, "ab"), (3, "a  b"), (4, None), (5, ""), (6, " \t\n"), (7, "x" * 70_000), (8, "x" * 70_000 + "y"), (9, "x" * 70_000), (None, "ab  "), (None, "lone"), (2, "ab"), (3, "other")]
    groups = defaultdict(list)
    for i, t in rows:
        groups[BLANK.sub("", t or "")].append((-len(t or ""), i if i is not None else -(2**70), i))
    want = []
    for i, t in rows:
        norm = BLANK.sub("", t or "")
        keep = min(groups[norm], key=lambda x: x[:2])[2]
        want.append((i, keep, len(groups[norm]), keep == i, hashlib.sha256(norm.encode()).hexdigest()))
    got = [tuple(r) for r in exact_groups(make(rows)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_exact_copies_leave_one_row(make):
    docs = make([(1, "a b"), (2, "ab"), (2, "ab"), (3, "c"), (3, "c"), (4, "d"), (4, "e")])
    kept = drop_copies(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(1, "a b"), (3, "c"), (4, "d"), (4, "e")]
    assert drop_copies(make([])).count() == 0 and exact_groups(make([])).count() == 0


def test_one_row_of_a_text_is_kept_whatever_ids_repeat(make):
    docs = make([(1, "a b"), (1, "ab"), (2, "ab"), (5, "same"), (5, "same"), (None, "q"), (None, "q"), (None, "other"), (7, "q"), (9, "x y"), (9, "x y"), (8, "xy")])
    got = exact_groups(docs).collect()
    kept = sorted(((r.doc_id, r.group_size) for r in got if r.kept), key=repr)
    assert kept == sorted([(1, 3), (5, 2), (None, 3), (None, 1), (9, 3)], key=repr)
    assert {r.keep_id for r in got if r.group_size == 3 and r.doc_id in (1, 2)} == {1}
    left = sorted(((r.doc_id, r.text) for r in drop_copies(docs).collect()), key=repr)
    assert left == sorted([(1, "a b"), (5, "same"), (None, "q"), (None, "other"), (9, "x y")], key=repr)


def test_clashing_columns_are_no_matter(make):
    docs = make([(1, "a"), (2, "a")]).selectExpr("*", "'x' AS text_sha256", "'y' AS keep_id", "'z' AS chars", "1 AS prefix")
    assert drop_copies(docs).columns == docs.columns and drop_copies(docs).count() == 1
    assert exact_groups(docs).count() == 2


def turns_table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, piece string, at string").select("*")


def test_chat_reads_back_identical(spark):
    nasty = ["", "plain", "\\", "\\\\e", "\\e", "### user: x</turn>\n", "</turn>", "</tu", "rn>\n", "##! a: b", "a: b", "####", "\n\n", "x" * 50_000, "\\### Assistant: </turn> ok", "\\\\\\h"]
    roles = ["user", "assistant", "", "we: ird", "\\c", "###", "a</turn>\nb", None]
    rows = [(c, t, roles[(c + t) % len(roles)], nasty[(3 * c + t) % len(nasty)], "x", "y") for c in range(12) for t in range(9)]
    rows += [(50, 0, None, None, None, None), (None, None, "assistant", "no id", "", ""), (51, None, "b", "2", "", ""), (51, None, "a", "1", "", ""), (52, 1, "assistant", "same", "", ""), (52, 1, "assistant", "same", "", "")]
    made = format_conversations(turns_table(spark, rows))
    by = defaultdict(list)
    for c, t, role, text, *_ in rows:
        by[c].append((-1 if t is None else t, role or "", text or ""))
    shown = made.withColumn("turns", parse(F.col("formatted"))).collect()
    assert all(r.identical for r in shown)
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in shown} == {c: [t[1:] for t in sorted(ts)] for c, ts in by.items()}
    for r in read_back(made).collect():
        want = sorted(by[r.conv_id])
        loss = "".join(t[2] for t in want if t[1] == "assistant")
        assert r.n_turns == len(want) and r.loss_chars == len(loss)
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert r.turns_sha256 == hashlib.sha256("".join(f"{t[1]}\n{t[2]}\n" for t in want).encode()).hexdigest()
    assert format_conversations(turns_table(spark, [])).count() == 0


def test_chat_escapes_only_where_needed(spark):
    made = format_conversations(turns_table(spark, [(1, 0, "user", "hi", "", ""), (1, 1, "assistant", "a </turn> b", "", "")])).first()
    assert made.formatted == "### user: hi</turn>\n##! assistant: a \\e b</turn>\n"
