"""Golden micro tables: token lists (WN2) and the rule match (JN5-JN7, NS1, NS2)."""

import json

import pytest

from lumenrec.plans import rules as pr
from lumenrec.schemas import TOKENS
from tests.conftest import rows
from tests.helpers import tables


def test_student_tokens_recent_distinct_ties_and_padding(spark):
    t = tables(
        spark,
        student=[("s1", "u1", "c1", "g1"), ("s2", "u2", "c1", "g1"), ("s3", "u3", "-", "g1"),
                 ("s4", "u4", "c1", "-")],
        user=[("u1",), ("u2",), ("u3",), ("u4",)],
        regist=[("s1", "k1", "2018-01-05", 1, 0), ("s1", "k2", "2018-01-05", 2, 0),  # equal dates
                ("s1", "k3", "2018-01-04", 1, 0), ("s1", "k1b", "2018-01-01", 1, 0),  # repeat of k1's token
                ("s1", "k4", "2018-01-03", 1, 0),
                ("s1", "k5", "2018-01-09", 1, 1),   # deleted
                ("s1", "k6", "2018-01-09", 0, 0),   # not paid
                ("s1", "k7", "2015-01-01", 1, 0),   # before pay_after
                ("s2", "k1", "2018-02-01", 1, 0),   # one token only
                ("s3", "k1", "2018-02-01", 1, 0),   # city '-' passes the weak check
                ("s4", "k1", "2018-02-01", 1, 0)],  # grade '-' fails
        klass=[("k1", "c1", "g1", "1", "数学", "启航", "1", "2017"),
               ("k1b", "c1", "g1", "1", "初中数学", "启航", "1", "2017"),
               ("k2", "c1", "g1", "2", "英语", "启航", "1", "2017"),
               ("k3", "c1", "g1", "3", "生物", "启航", "1", "2017"),   # 生物 -> 其他
               ("k4", "c1", "g1", "4", "化学", "启航", "1", "2017"),
               ("k5", "c1", "g1", "5", "物理", "启航", "1", "2017"),
               ("k6", "c1", "g1", "5", "语文", "启航", "1", "2017"),
               ("k7", "c1", "g1", "5", "综合", "启航", "1", "2017")],
    )
    got = {r.sid: (r.city_id, r.left_rule) for r in pr.student_tokens(t, "2016-09-01", "2018-09-05").collect()}
    # s1: k1 and k2 tie on 2018-01-05 -> token order; k1b repeats 数学_1 (skipped)
    assert got["s1"] == ("c1", ["数学_1", "英语_2", "其他_3"])
    assert got["s2"] == ("c1", ["数学_1", "", ""])
    assert got["s3"] == ("-", ["数学_1", "", ""])
    assert "s4" not in got


def _rule_inputs(spark):
    tokens = spark.createDataFrame([
        ("s1", "c1", "g1", ["数学_1", "英语_2", ""], "d"),
        ("s2", "c1", "g1", ["数学_1", "英语_2", "物理_3"], "d"),
        ("s3", "c1", "g2", ["数学_1", "", ""], "d"),
        ("s4", "c1", "g1", ["数学_1", "英语_2", "物理_3"], "d"),
    ], TOKENS)
    rule_rows = [
        ("c1", "g1", ["数学_1", "英语_2"], json.dumps({"L0": ["101", "102"], "live-class-service-center": ["103"]})),
        ("c1", "g1", [], json.dumps({"L1": ["201"]})),                 # empty left: matches everyone
        ("c1", "g1", [""], json.dumps({"L0": ["301"]})),               # '' matches padded lists only
        ("c1", "g1", ["化学_1"], json.dumps({"L0": ["401"]})),
        ("c1", "g1", ["数学_1", "数学_1"], json.dumps({"L0": ["501", ""]})),  # repeated token; '' class dropped
        ("c1", "g1", None, json.dumps({"L0": ["601"]})),               # null left: no match
        ("c1", "g1", ["数学_1"], "{}"),                                # empty recall: filtered
        ("c2", "g1", ["数学_1"], json.dumps({"L0": ["701"]})),         # other city
    ]
    rules = spark.createDataFrame(rule_rows, "city_id string, grade_id string, left array<string>, recall string")
    location = spark.createDataFrame([("s1", "c1", "L0,L1"), ("s2", "c1", "L1,"), ("s3", "c1", None),
                                      ("s4", "c2", "L0")], "sid string, city_id string, depart_4 string")
    return tokens, rules, location


def test_rule_match_golden(spark):
    tokens, rules, location = _rule_inputs(spark)
    got = rows(pr.rule_match(tokens, rules, location))
    assert got == sorted([
        ("s1", "c1", c) for c in ["101", "102", "103", "201", "301", "501"]
    ] + [("s2", "c1", "103"), ("s2", "c1", "201")])
    # s3: no rule of its grade; s4: its location row is of another city (joined on sid and city)


def test_rule_match_city_filter(spark):
    tokens, rules, location = _rule_inputs(spark)
    assert rows(pr.rule_match(tokens, rules, location, city="c2")) == []
    assert len(rows(pr.rule_match(tokens, rules, location, city="c1"))) == 8


def test_bad_recall_json_fails_or_skips(spark):
    tokens, _, location = _rule_inputs(spark)
    bad = spark.createDataFrame([("c1", "g1", ["数学_1"], "{not json"), ("c1", "g1", [], '{"L1":["9"]}')],
                                "city_id string, grade_id string, left array<string>, recall string")
    with pytest.raises(Exception, match="bad recall JSON"):
        pr.rule_match(tokens, bad, location).collect()
    got = rows(pr.rule_match(tokens, bad, location, bad_json="skip"))
    assert got == [("s1", "c1", "9"), ("s2", "c1", "9")]


def test_duplicate_recall_keys_keep_every_entry(spark):
    """Q12: a location listed twice in the recall JSON contributes both lists."""
    tokens, _, location = _rule_inputs(spark)
    dup = spark.createDataFrame([("c1", "g1", ["数学_1"], '{"L1":["801"],"L1":["802"]}')],
                                "city_id string, grade_id string, left array<string>, recall string")
    got = rows(pr.rule_match(tokens, dup, location))
    assert got == [("s1", "c1", "801"), ("s1", "c1", "802"), ("s2", "c1", "801"), ("s2", "c1", "802")]
