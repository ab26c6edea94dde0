"""Edge rows of every column expression (FIXTURES §4)."""

import datetime as dt

from pyspark.sql import functions as F

from perfscore.functions import labels as lb
from perfscore.functions.scoring import (band_half_open, band_right_closed, score_label, score_v5,
                                         text_points)
from perfscore.functions.video import (as_of_literal, best_thumbnail, counter, days_live, is_short,
                                       performance_score, views_per_sub)


def col(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_is_short_edges(spark):
    cases = {"PT59S": True, "PT60S": False, "PT0M30S": True, "PT1M": False, "PT1H": False,
             "P0D": False, "": False, "PT45S": True, "PT1M30S": False, "PT1H2M": False,
             "PT75S": False, None: False, "junk": False}
    df = spark.createDataFrame([(k,) for k in cases], "d string")
    got = dict(zip([r[0] for r in df.collect()], col(df, is_short("d"))))
    assert got == cases


def test_days_live_and_performance(spark):
    as_of = "2001-08-02 00:00:00"
    rows = [(dt.datetime(2001, 8, 2), 100, 0), (dt.datetime(2001, 9, 1), 100, 10),
            (dt.datetime(2001, 7, 31, 1), 100, 10), (dt.datetime(2001, 7, 30), 100, 10)]
    df = spark.createDataFrame(rows, "p timestamp_ntz, v bigint, s bigint")
    days = col(df, days_live("p", as_of_literal(as_of)))
    assert days == [1, 1, 1, 3]  # today, future, 23 h, exactly 3 days
    perf = col(df, performance_score("v", "p", "s", as_of_literal(as_of)))
    assert perf == [100.0, 10.0, 10.0, 100 / 3 / 10]  # subscriber 0 -> divisor 1
    assert col(df, views_per_sub("v", "s")) == [100.0, 10.0, 10.0, 10.0]


def test_best_thumbnail_and_counter(spark):
    df = spark.createDataFrame(
        [({"maxres": {"url": ""}, "high": {"url": "h"}, "medium": {"url": "m"}}, "12"),
         ({"maxres": None, "high": None, "medium": {"url": "m"}}, None),
         ({"maxres": {"url": "x"}, "high": {"url": "h"}, "medium": None}, "n/a")],
        "t struct<maxres:struct<url:string>,high:struct<url:string>,medium:struct<url:string>>, c string")
    assert col(df, best_thumbnail("t")) == ["h", "m", "x"]
    assert col(df, counter("c")) == [12, 0, 0]


def test_text_points_edges(spark):
    df = spark.createDataFrame([(True, n) for n in (0, 20, 21, 50, 51)] + [(False, 80), (None, 80)],
                               "p boolean, n int")
    assert col(df, text_points("p", "n")) == [7.0, 7.0, 8.5, 8.5, 10.0, 0.0, 0.0]


def test_score_parts_sum_and_bounds(spark):
    rows = [(True, 60, 1, "Neutre", "Froid"), (False, 0, 0, "Aucun", "Chaud"),
            (True, 10, 2, "Sourire", "Neutre"), (True, 30, 3, "Intense", "Froid")]
    df = spark.createDataFrame(rows, "texte_present boolean, text_length int, nb_personnes int, "
                                     "expression string, couleur_dominante string")
    assert col(df, score_v5()) == [20.0, 0.0, 13.0, 11.5]


def test_bands_both_conventions(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (14.5,), (20.0,)], "s double")
    assert col(df, band_half_open("s")) == ["0-5", "5-10", "10-15", None]
    assert col(df, band_right_closed("s")) == [None, "0-5", "10-15", "15-20"]
    assert col(df, score_label("s")) == ["Poor", "Below average", "Good", "Excellent"]


def _faces(*faces):
    return [dict(joy=j, sorrow=s, anger=a, surprise=u, confidence=0.9) for j, s, a, u in faces]


FACE_T = "array<struct<joy:int,sorrow:int,anger:int,surprise:int,confidence:double>>"


def test_expression_ties_by_profile(spark):
    df = spark.createDataFrame([(_faces((4, 0, 0, 4)),), (_faces((0, 4, 0, 4)),), (_faces((1, 1, 1, 3)),),
                                ([],), (_faces((0, 0, 5, 0)),)], f"faces {FACE_T}")
    assert col(df, lb.expression_label(profile="label")) == ["Sourire", "Intense", "Neutre", "Aucun", "Intense"]
    assert col(df, lb.expression_label(profile="serve")) == ["Sourire", "Surprise", "Neutre", "Aucun", "Intense"]


COLOR_T = "array<struct<red:double,green:double,blue:double>>"


def test_color_edges(spark):
    def c(r, g, b, n=1):
        return [dict(red=r, green=g, blue=b)] + [dict(red=0.0, green=0.0, blue=0.0)] * (n - 1)
    df = spark.createDataFrame([(c(150.0, 10.0, 10.0),), (c(200.0, 200.0, 10.0),), (c(151.0, 10.0, 10.0),),
                                (c(10.0, 10.0, 151.0),), (c(10.0, 151.0, 10.0),), ([],)], f"colors {COLOR_T}")
    assert col(df, lb.color_label()) == ["Neutre", "Neutre", "Chaud", "Froid", "Froid", "Neutre"]


def test_contrast_edges(spark):
    rows = [([dict(red=0.0, green=0.0, blue=0.0)] * n,) for n in (3, 4, 8, 9, 0)]
    df = spark.createDataFrame(rows, f"colors {COLOR_T}")
    assert col(df, lb.contrast_label(profile="label")) == ["Faible", "Moyen", "Moyen", "Élevé", "Moyen"]
    assert col(df, lb.contrast_label(profile="serve")) == ["Faible", "Moyen", "Moyen", "Élevé", "Faible"]


def test_background_profiles(spark):
    def labels(*names):
        return [dict(description=n) for n in names]
    many = [f"obj{i}" for i in range(11)]
    rows = [(labels("Plain wood", *many),), (labels(*many),), (labels("Bokeh", "a"),),
            (labels(*[f"o{i}" for i in range(8)]),), (labels("a"),), (labels("Blue Sky", *many),)]
    df = spark.createDataFrame(rows, "labels array<struct<description:string>>")
    assert col(df, lb.background_label(profile="label")) == ["Uni", "Chargé", "Flou", "Chargé", "Uni", "Uni"]
    assert col(df, lb.background_label(profile="serve")) == ["Chargé", "Chargé", "Uni", "Chargé", "Uni", "Uni"]


def test_text_and_faces(spark):
    texts_t = "array<struct<description:string,confidence:double>>"
    long = "x" * 150
    df = spark.createDataFrame([([dict(description=long, confidence=0.5), dict(description="w", confidence=0.4)],
                                 _faces((0, 0, 0, 0)) * 4),
                                ([dict(description="only", confidence=0.5)], []),
                                ([], _faces((0, 0, 0, 0)))], f"texts {texts_t}, faces {FACE_T}")
    assert col(df, lb.text_present()) == [True, False, False]
    assert col(df, F.length(lb.text_content())) == [100, 4, 0]
    assert col(df, lb.person_bucket()) == [3, 0, 1]
    assert col(df, lb.text_confidence()) == [0.5, 0.0, 0.0]
    assert col(df, lb.face_confidence()) == [0.9, 0.0, 0.9]


def test_documented_points_table(spark):
    """Every row of the published v5 points table, dimension by dimension."""
    from perfscore.functions.scoring import color_points, expression_points, person_points
    texts = spark.createDataFrame([(True, 51), (True, 50), (True, 21), (True, 20), (True, 0), (False, 80)],
                                  "p boolean, n bigint")
    assert col(texts, text_points("p", "n")) == [10.0, 8.5, 8.5, 7.0, 7.0, 0.0]
    persons = spark.createDataFrame([(n,) for n in (0, 1, 2, 3)], "n int")
    assert col(persons, person_points("n")) == [0.0, 4.0, 2.0, 0.0]
    exprs = spark.createDataFrame([(e,) for e in ("Neutre", "Sourire", "Surprise", "Intense", "Aucun")], "e string")
    assert col(exprs, expression_points("e")) == [3.0, 2.5, 0.0, 0.0, 0.0]
    colors = spark.createDataFrame([(c,) for c in ("Froid", "Neutre", "Chaud")], "c string")
    assert col(colors, color_points("c")) == [3.0, 1.5, 0.0]


def _rule(present, tl, nb, ex, co):
    text = (10.0 if tl > 50 else 8.5 if tl > 20 else 7.0) if present else 0.0
    person = {1: 4.0, 2: 2.0}.get(nb, 0.0)
    expr = {"Neutre": 3.0, "Sourire": 2.5}.get(ex, 0.0)
    color = {"Froid": 3.0, "Neutre": 1.5}.get(co, 0.0)
    return text + person + expr + color


def test_score_property_random_rows(spark):
    from hypothesis import given, settings, strategies as st_
    row = st_.tuples(st_.one_of(st_.none(), st_.booleans()), st_.integers(0, 200), st_.integers(0, 3),
                     st_.sampled_from(["Neutre", "Sourire", "Surprise", "Intense", "Aucun"]),
                     st_.sampled_from(["Froid", "Neutre", "Chaud"]))

    @settings(max_examples=5, deadline=None)
    @given(st_.lists(row, min_size=1, max_size=200))
    def check(rows):
        df = spark.createDataFrame(rows, "texte_present boolean, text_length bigint, nb_personnes int, "
                                         "expression string, couleur_dominante string")
        got = col(df, score_v5())
        want = [_rule(bool(p), tl, nb, ex, co) for p, tl, nb, ex, co in rows]
        assert got == want
        assert all(0.0 <= s <= 20.0 for s in got)

    check()
