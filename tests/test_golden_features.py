"""Golden micro tables: feature weights (PL1-PL4, PL12), ranking ties, SURVEY Q3."""

import json

from pyspark.sql import functions as F

from lumenrec.operators import features as ft
from lumenrec.operators.ranking import top3_json
from lumenrec.plans import features as pf
from tests.conftest import rows
from tests.helpers import tables

BEH = [
    # sid, cla_id, level, subject, type, teacher, center, time, day
    ("s1", "k1", "启航班", "数学", "1", "T1", "L0", "a", "2018-08-10"),
    ("s1", "k2", "勤学班", "数学", "3", "T2", "L0", "b", "2018-08-11"),
    ("s1", "k3", "普通", "物理", "8", "T2", "L1", "a", "2018-08-12"),
    ("s1", "-", "启航班", "数学", "1", "T9", "L9", "z", "2018-08-12"),     # invalid class id
    ("", "k1", "启航班", "数学", "3", "T1", "L0", "c", "2018-08-10"),       # invalid sid
    ("s2", "k1", "启航班", "数学", "1", "T1", "L0", "a", "2018-08-20"),     # outside the range
]


def test_event_features(spark):
    t = tables(spark, behavior=BEH)
    got = rows(pf.event_features(t, "2018-08-10", "2018-08-12", "2018-09-05"), "sid", "feature_name", "value", "dt")
    assert got == sorted([
        ("s1", "math_lev_1", 1.0, "2018-09-05"), ("s1", "math_lev_2", 1.0, "2018-09-05"),
        ("s1", "math", 2.0, "2018-09-05"), ("s1", "math_tp_1", 1.0, "2018-09-05"),
        ("s1", "math_tp_3", 1.0, "2018-09-05"), ("s1", "phy0", 1.0, "2018-09-05"),
        ("s1", "phy", 1.0, "2018-09-05"), ("s1", "phy_tp_0", 1.0, "2018-09-05")])


def test_range_equals_merge_of_days(spark):
    """AG4 metamorphic: one range aggregation = MergeData over the single days."""
    t = tables(spark, behavior=BEH)
    whole = pf.event_features(t, "2018-08-10", "2018-08-12", "x")
    days = [pf.event_features(t, d, d, "x") for d in ("2018-08-10", "2018-08-11", "2018-08-12")]
    merged = ft.merge(ft.merge(days[0], days[1]), days[2], "x")
    assert rows(whole) == rows(merged.select(*whole.columns))


def test_order_features_weights(spark):
    orders = [("s1", "d1", 2, 3000.0, "启航", "数学", None, "2018-08-02", "2018-08-02"),
              ("s1", "d1", 3, 5000.0, "启航", "数学", None, "2018-08-03", "2018-08-03"),
              ("s1", "d1", None, 100.0, "x", "英语", None, "2018-08-03", "2018-08-03"),   # null status = 0 (Q2)
              ("s1", "d1", 1, 50.0, "x", "英语", None, "2016-08-01", "2018-08-03")]       # created too early
    t = tables(spark, order=orders)
    got = {(r.feature_name): r.value for r in pf.order_features(t, "2018-08-01", "2018-08-05", "x", "2016-09-01").collect()}
    assert got == {"math_lev_1": 7.0 - 2.0, "math": 4.0, "mathprice": 1500.0 + 5.0,
                   "eng0": 3.0, "eng": 2.0, "engprice": 100.0}


def test_top3_json_ties_and_padding(spark):
    w = spark.createDataFrame([("s1", "b", 2.0), ("s1", "a", 2.0), ("s1", "c", 5.0), ("s1", "d", 1.0),
                               ("s2", "x", 1.0)], "sid string, feature_name string, value double")
    got = {r.sid: json.loads(r.value) for r in top3_json(w, "teacher_favor", "d").collect()}
    assert got == {"s1": {"1": "c", "2": "a", "3": "b"}, "s2": {"1": "x", "2": "", "3": ""}}


def test_class_time_favor_bracketed_and_literal(spark):
    t = tables(spark, behavior=BEH)
    fixed = {r.sid: json.loads(r.value) for r in pf.favor_list(t, "class_time_favor", "2018-08-10", "2018-08-12", "d").collect()}
    # preference lists do not check the class id, so the "-" class row counts too
    assert fixed == {"s1": {"1": "a", "2": "b", "3": "z"}}
    # the literal "... and type='1' or type='3'": type-3 rows skip every other filter
    # and count once per day of the range (3 days here)
    lit = pf.favor_counts(t, "cla_classtime_ids", "2018-08-10", "2018-08-12",
                          F.col("cla_class_type") == "1", F.col("cla_class_type") == "3")
    got = rows(lit, "sid", "feature_name", "value")
    assert got == sorted([("s1", "a", 1.0), ("s1", "b", 3.0), ("", "c", 3.0), ("s1", "z", 1.0)])


def test_order_recall_text_rows(spark):
    orders = [("s1", "d1", 2, 12.5, "启航", "数学", "2018-08-17", "2018-08-17", "2018-08-17"),
              ("s2", "d1", 0, 7.5, "启航", "数学", "2018-08-17", "2018-08-17", "2018-08-17"),
              ("s1", "d2", 0, None, "启航", "数学", "2018-08-17", "2018-08-17", "2018-08-17")]
    t = tables(spark, order=orders)
    got = rows(pf.order_recall_rows(t, "2018-08-17", "2018-08-17"), "distinctid", "feature_name", "value", "dt")
    assert got == sorted([("d1", "math_lev_1", "7.0", "2018-08-17"), ("d1", "price", "12.5", "2018-08-17"),
                          ("d1", "math_lev_1", "3.0", "2018-08-17"), ("d1", "price", "7.5", "2018-08-17"),
                          ("d2", "math_lev_1", "3.0", "2018-08-17"), ("d2", "price", "0.0", "2018-08-17")])
    sums = {(r.distinctid, r.feature_name): (r.value, r.n_rejected)
            for r in pf.order_recall(t, "2018-08-17", "2018-08-17").collect()}
    # summed by distinctid, not by student; a null price counts as 0 (Q2)
    assert sums == {("d1", "math_lev_1"): (10.0, 0), ("d1", "price"): (20.0, 0),
                    ("d2", "math_lev_1"): (3.0, 0), ("d2", "price"): (0.0, 0)}


def test_text_that_is_no_number_is_counted(spark):
    r = spark.createDataFrame([("d1", "price", "3.5"), ("d1", "price", "free"), ("d1", "price", None)],
                              "distinctid string, feature_name string, value string")
    assert [(x.value, x.n_rejected) for x in ft.sum_text_values(r).collect()] == [(3.5, 1)]
