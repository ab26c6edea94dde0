import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from perfscore.llm import quality_rules as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    windows = list(zip(w, w[1:], w[2:]))
    often = Counter(windows)
    covered = {i + k for i, g in enumerate(windows) if often[g] > 1 for k in range(3)}
    lines = [s for s in text.split("\n") if WORD.search(s)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def counts(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = {r.doc_id: r for r in q.clean_lines(df).collect()}
    return [rows[i] for i in range(len(texts))]


def test_base_counts_equal_brute_force_on_documents(documents):
    for r in q.clean_lines(documents).collect():
        assert tuple(r[c] for c in q.BASE) == brute(r.text)
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t\x0b#é漢", max_size=60), min_size=1, max_size=30))
def test_base_counts_equal_brute_force_on_any_text(spark, texts):
    for t, r in zip(texts, counts(spark, texts)):
        assert tuple(r[c] for c in q.BASE) == brute(t)


def test_hash_clashes_are_settled_by_the_words(spark, monkeypatch):
    monkeypatch.setattr(q, "POS_BITS", 62)  # two bits of hash are left: nearly all windows clash
    texts = ["a b c d e f g h i j a b c k l m", "a a a a b b b", "x y z x y z"]
    for t, r in zip(texts, counts(spark, texts)):
        assert tuple(r[c] for c in q.BASE) == brute(t)


PROSE = "This is a plain sentence of quite ordinary words that goes on. "


@pytest.mark.parametrize("line,fails", [
    (PROSE, False), ("", False), ("   ", False), ("no mark at the end of this line", True),
    ("Home | About us. | Contact | Help | Jobs", True), ("All rights reserved.", True),
    ("STOP! BUY NOW! GREAT DEALS! ONLY TODAY!", True), ("a$$$ b### c%%% d&&& e*** f.", True),
    (PROSE * 10 + "we mention cookie once.", False), ("He said “no.”", False)])
def test_line_rules(spark, line, fails):
    df = spark.createDataFrame([(line,)], "line string")
    assert df.select(q.line_fails(df.line, q.LineRules()).alias("f")).first().f is fails


def test_failing_lines_go_and_lossy_documents_are_rejected(spark):
    words = " ".join(f"word{i}" for i in range(60)) + "."
    few, many = "menu | home | top", " | ".join(f"nav{i}" for i in range(80))
    a, b = counts(spark, [f"{words}\n{few}\n\n{words[::-1]}.", f"{words}\n{many}"])
    assert a.kept and few not in a.clean_text and a.n_failed_lines == 1 and a.clean_text.count("\n") == 2
    assert not b.kept and not b.base_failed and b.lost_chars > 0.5 * b.word_chars


def test_odd_documents(odd, none):
    rows = q.clean_lines(odd).collect()
    assert len(rows) == odd.count() and not any(r.kept for r in rows if not (r.text or "").strip())
    kept = q.keep_clean(odd)
    assert kept.columns == odd.columns and kept.dtypes == odd.dtypes
    assert all(r.kept == "x" and r.n_words == "x" for r in kept.collect())
    assert q.keep_clean(none).count() == 0 == q.clean_lines(none).count()
