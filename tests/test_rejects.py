"""Reject channel (Q9, Q11, Q20): counts taken in the pass that computes the result, limits before anything is replaced."""

import pytest
from pyspark.sql import functions as F

from lumenrec.operators.rejects import Rejects, TooManyRejects
from lumenrec.plans import recommend as prec
from lumenrec.plans import rules as pr
from lumenrec.schemas import TOKENS
from lumenrec.sinks import replace_slice
from tests.conftest import rows
from tests.helpers import tables

RULE = "city_id string, grade_id string, left array<string>, recall string"


def _inputs(spark):
    tokens = spark.createDataFrame([("s1", "c1", "g1", ["a", "b", ""], "d")], TOKENS)
    rules = spark.createDataFrame([("c1", "g1", ["a"], '{"L0":["1"]}'), ("c1", "g1", ["a"], "{not json"), ("c1", "g1", None, '{"L0":["2"]}'),
                                   ("c1", "g1", None, "[1"), ("c1", "g1", [], '{"L0":["3"]}'), ("c1", "g1", ["b"], "{}")], RULE)
    location = spark.createDataFrame([("s1", "c1", "L0"), ("s2", "c1", None), ("s3", "c1", None)], "sid string, city_id string, depart_4 string")
    return tokens, rules, location


def test_rejected_rows_are_counted_while_the_result_is_computed(spark):
    tokens, rules, location = _inputs(spark)
    rejects = Rejects()
    got = rows(pr.rule_match(tokens, rules, location, rejects=rejects))
    assert got == [("s1", "c1", "1"), ("s1", "c1", "3")]
    # the rule with an empty recall is no rule (PF10), so five are counted
    assert sorted(rejects.counts()) == [("location", "null_depart_4", 3, 2), ("rule", "bad_json", 5, 2), ("rule", "null_left", 5, 2)]
    assert sorted(tuple(r) for r in rejects.table(spark).collect()) == sorted(rejects.counts())


def test_missing_times_of_registrations(spark):
    klass = [(k, "c1", "g1", "1", s, "x", "1", "2017") for k, s in (("A", "数学"), ("B", "英语"))]
    t = tables(spark, klass=klass, curriculum=[(k, "2001-05-01", "09:00", "10:00", "c1") for k in "AB"],
               register=[("s1", "R1", "2", "x", "2017", "1", "0", "c1", "2001-05-01\u00012001-05-02", "09:30", "09:40\u00039:50"),
                         ("s1", "R2", "2", "y", "2017", "1", "0", "c1", "2001-05-03", "09:30", "09:40"),
                         ("s1", "R3", "2", "z", "2017", "1", "0", "c1", "", "", "")])
    recs = spark.createDataFrame([("s1", "c1", "A"), ("s2", "c1", "B")], "sid string, city_id string, cla_id string")
    rejects = Rejects()
    assert rows(prec.conflict_free(t, recs, "2001-01-01", rejects=rejects)) == [("s2", "c1", "B")]
    assert rejects.counts() == [("register", "missing_time", 3, 1)]


def test_limit_keeps_the_old_slice(spark, tmp_path):
    tokens, rules, location = _inputs(spark)
    path = str(tmp_path / "recs")
    old = spark.createDataFrame([("old", "c1", "0")], "sid string, city_id string, cla_id string")
    replace_slice(old, path, dt="d")
    for limits, fails in (({"bad_json": 0.1}, True), ({"null_depart_4": 0.5, "bad_json": 0.9}, True), ({"bad_json": 0.4, "null_left": 0.4}, False)):
        rejects = Rejects(limits)
        new = pr.rule_match(tokens, rules, location, rejects=rejects)
        if fails:
            with pytest.raises(TooManyRejects, match="limit"):
                replace_slice(new, path, rejects.check, dt="d")
            assert [r.sid for r in spark.read.parquet(path).collect()] == ["old"]
        else:
            replace_slice(new, path, rejects.check, dt="d")
            assert sorted(r.cla_id for r in spark.read.parquet(path).collect()) == ["1", "3"]


def test_sources_that_no_row_needs_are_counted_too(spark):
    """An empty side of a join lets adaptive execution skip the other one; its counts must not hang."""
    tokens, rules, location = _inputs(spark)
    for tk, loc in ((tokens.limit(0), location), (tokens, location.limit(0)), (tokens.limit(0), location.limit(0))):
        rejects = Rejects({"bad_json": 1.0})
        assert rows(pr.rule_match(tk, rules, loc, rejects=rejects)) == []
        rejects.check()
        assert all(n <= total for _, _, total, n in rejects.counts())


def test_watching_changes_no_row_and_adds_no_scan(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    rejects = Rejects()
    out = rejects.watch(df, "t", odd=F.col("id") % 2 == 1, never=F.lit(None).cast("boolean"))
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert rows(out) == rows(df) and rejects.counts() == [("t", "odd", 100, 50), ("t", "never", 100, 0)]
