import pytest

from perfscore.llm import line_dedup as d


def run(spark, docs, **kw):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return {(r.doc_id, r.text): r for r in d.drop_recurring_lines(df, d.TemplateTree(**kw)).collect()}


def dropped(rows, doc):
    return next(list(r.dropped) for (k, _), r in rows.items() if k == doc)


def test_variable_fields_are_generalised(spark):
    rows = run(spark, [(1, "Order 17 was sent to Paris by plane today.\nThis is unlike."),
                       (2, "Order 23 was sent to Paris by plane today.\nQuite another one here."),
                       (3, "Dear customer please send Anna the final bill soon."),
                       (4, "Dear customer please send Bert the final bill soon."),
                       (5, "Dear customer please note this is unlike all others.")])
    assert dropped(rows, 1) == [] and dropped(rows, 2) == [0]  # digits
    assert dropped(rows, 3) == [] and dropped(rows, 4) == [0]  # a word that differs
    assert dropped(rows, 5) == []
    assert rows[2, "Order 23 was sent to Paris by plane today.\nQuite another one here."].clean_text == "Quite another one here."


FRAMES = {1: "You can always contact {} about further details", 2: "Shipped with great care from {} to {}"}


@pytest.mark.parametrize("fields", [1, 2])
@pytest.mark.parametrize("values", [2, 20, 2000])
def test_templates_hold_however_often_values_recur(spark, fields, values):
    names = [f"name{'abcdefghij'[k % 10]}{'abcdefghij'[k // 10 % 10]}{'abcdefghij'[k // 100 % 10]}{'xy'[k // 1000]}" for k in range(values)]
    pairs = [(a, b) for a in names for b in names][:: max(1, values ** 2 // 3000)] if fields == 2 else [(a, "") for a in names]
    if values == 2 and fields == 2:
        pairs = pairs[:3]  # Paris to Anna, Paris to Bob, Rome to Anna
    rows = run(spark, [(k, FRAMES[fields].format(*pair)) for k, pair in enumerate(pairs)])
    assert [k for (k, _), r in sorted(rows.items()) if not r.dropped] == [0]


def test_two_templates_of_one_leaf_are_told_apart(spark):
    rows = run(spark, [(k, f"All you can {a} with {b} on this page") for k, (a, b) in enumerate(
        [("read", "Anna"), ("read", "Bob"), ("read", "Cleo"), ("write", "Anna"), ("write", "Dora")])])
    assert sorted(k for (k, _), r in rows.items() if not r.dropped) in ([0], [0, 3])


def test_rows_of_numbers_are_told_apart(spark):
    rows = run(spark, [(1, "Revenue 2019 4.5 3.2 8.1\n12 7 9\nTotal sales 2019 77"),
                       (2, "Revenue 2020 9.9 1.0 7.7\n8 1 3\nTotal sales 2020 78"),
                       (3, "12 7 9\nRevenue 2020 9.9 1.0 7.7")])
    assert dropped(rows, 1) == dropped(rows, 2) == [] and dropped(rows, 3) == [0, 1]  # equal rows recur


def test_bylines_of_a_date_and_a_name(spark):
    rows = run(spark, [(1, "Published on 12 May by Anna"), (2, "Published on 12 May by Bert"), (3, "Published on 9 May by Cleo")])
    assert dropped(rows, 1) == [] and dropped(rows, 2) == dropped(rows, 3) == [0]


def test_prose_of_the_same_beginning_stays(spark):
    tails = ["we went down to the river early", "my sister sold her small red car", "nobody could say what had happened",
             "they came back without their old dog", "a storm broke over the empty fields"]
    rows = run(spark, [(k, f"In the end {t}.\nI do not {t.split()[0]}") for k, t in enumerate(tails)])
    assert all(not r.dropped for r in rows.values())


def test_lines_of_other_lengths_or_leads_are_other_templates(spark):
    rows = run(spark, [(1, "a b c d e f"), (2, "a b c d e f g"), (3, "z b c d e f"), (4, "a b c q r s")])
    assert all(not r.dropped for r in rows.values())


def test_copies_count_as_one_text_and_keep_their_lines(spark):
    text = "Same line in each copy.\nAnother same line."
    rows = run(spark, [(5, text), (6, text), (7, "Same line in each copy.\nMore.")])
    assert dropped(rows, 5) == dropped(rows, 6) == [] and dropped(rows, 7) == [0]


def test_a_template_needs_min_texts(spark):
    docs = [(i, f"Shared line here.\nown {'x' * i} line.") for i in range(1, 4)]
    assert dropped(run(spark, docs, min_texts=3), 3) == [0]
    assert dropped(run(spark, docs, min_texts=4), 3) == []


def test_every_recurring_template_is_left_in_one_text(documents, spark):
    left = d.without_recurring_lines(documents)
    lines = [(r.text, s) for r in left.collect() for s in set(r.text.split("\n")) if s.strip()]
    by_line = {}
    for text, s in lines:
        by_line.setdefault(s, set()).add(text)
    whole = {r.text for r in documents.collect()}
    homes = [s for s, texts in by_line.items() if len(texts) > 1]
    # a line left in two texts would be one that these share by the cleaning alone: there is none
    assert not homes and len(whole) >= left.count() - (documents.count() - len(whole))


def test_lines_are_read_without_functions_of_single_tokens(spark, documents):
    plan = d._keyed(documents, d.TemplateTree())._jdf.queryExecution().optimizedPlan().toString()
    text_hash = next(line for line in plan.split("\n") if "AS text_key" in line)
    assert "lambda" not in plan  # a lambda runs interpreted, token by token
    assert plan.index("Generate posexplode") < plan.index(text_hash)  # below: a text is hashed once, not once a line


def test_odd_white_space_and_wildcards(spark):
    rows = run(spark, [(1, "Order\t17 was\x0bsent to\x0cParis by plane today.\r\n\t \r\n  <*> 12  a1b\tc"),
                       (2, "  Order 23\twas sent  to Paris by plane today. \n12 <*>\ta1b c"),
                       (3, "<*> 12 a1b c\r\nOrder\u00a0 17 was sent to Paris by plane today.")])
    assert dropped(rows, 1) == [] and dropped(rows, 2) == [0] and dropped(rows, 3) == [0]


def test_odd_documents(odd, none):
    rows = d.drop_recurring_lines(odd).collect()
    assert len(rows) == odd.count()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    line = by[9][0].text
    assert [list(r.dropped) for r in by[7]] == [[], []]  # copies of the null doc_id's text, the first of all
    assert list(by[6][0].dropped) == [0] and by[6][0].clean_text == "other words here."
    assert all(not r.dropped for r in by[None]) and by[1][0].clean_text is None and by[2][0].clean_text == ""
    assert by[9][0].clean_text == "" and by[10][0].clean_text == "" and line.startswith("The quick")
    kept = d.without_recurring_lines(odd)
    assert kept.dtypes == odd.dtypes and 9 not in {r.doc_id for r in kept.collect()}
    assert d.without_recurring_lines(none).count() == 0
