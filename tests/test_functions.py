"""Truth tables of the scalar functions (SC1-SC8, PF5, PF6, PF12, NS3, NS6)."""

from pyspark.sql import functions as F

from lumenrec import functions as fn


def one_col(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {typ}")
    return [r[0] for r in df.select(expr(F.col("x"))).collect()]


def test_level_tag(spark):
    vals = ["启航班", "勤思A", "勤学", "敏学", "博学", "创新", "兴趣", "普通", None, "",
            "启航博学", "勤学启航", "启航\n班", "启航\r"]
    assert one_col(spark, vals, fn.level_tag) == [
        "_lev_1", "_lev_2", "_lev_2", "_lev_3", "_lev_4", "_lev_5", "_lev_6", "0", "0", "0",
        "_lev_1", "_lev_1", "0", "0"]


def test_subject_code_and_rule_name(spark):
    vals = ["语文", "初二数学", "英语", "物理", "化学", "综合", "生物", None, "数学语文", "数\n学"]
    assert one_col(spark, vals, fn.subject_code) == [
        "chn", "math", "eng", "phy", "chem", "comp", "other", "other", "chn", "other"]
    assert one_col(spark, vals, fn.subject_rule_name) == [
        "语文", "数学", "英语", "物理", "化学", "综合", "其他", "其他", "语文", "其他"]


def test_class_type_tag(spark):
    assert one_col(spark, ["1", "2", "3", "0", "8", None, ""], fn.class_type_tag) == [
        "_tp_1", "_tp_2", "_tp_3", "_tp_0", "_tp_0", "_tp_0", "_tp_0"]


def test_status_weight(spark):
    # Q1: refund weighs -2 (the code, not the comment); Q2: null counts as status 0
    assert one_col(spark, [0, 1, 2, 3, 4, 9, None], fn.status_weight, "int") == [
        3.0, 5.0, 7.0, -2.0, 1.0, 1.0, 3.0]


def test_price_weight(spark):
    df = spark.createDataFrame(
        [(0, 500.0), (0, 2000.0), (1, 999.99), (1, 1000.0), (2, 3000.0), (3, 5000.0), (3, 10.0),
         (7, 5000.0), (None, 2000.0), (3, None), (None, None)], "s int, p double")
    got = [r[0] for r in df.select(fn.price_weight("s", "p")).collect()]
    assert got == [500.0, 200.0, 999.99, 200.0, 1500.0, 5.0, 0.01, 0.0, 200.0, 0.0, 0.0]


def test_intervals_overlap_closed(spark):
    df = spark.createDataFrame(
        [("08:00", "10:00", "10:00", "11:00"),   # touching end: overlap (closed)
         ("08:00", "10:00", "10:01", "11:00"),   # disjoint
         ("10:00", "11:00", "08:00", "10:00"),   # touching start
         ("08:00", "12:00", "09:00", "10:00"),   # containment
         ("09:00", "09:30", "08:00", "08:59")],
        "fs string, fe string, rs string, re string")
    got = [r[0] for r in df.select(fn.intervals_overlap("fs", "fe", "rs", "re")).collect()]
    assert got == [True, False, True, True, False]


def test_millis_to_date(spark):
    vals = ["0", "86399999", "86400000", "1535760000000", "abc", None]
    assert one_col(spark, vals, fn.millis_to_date) == [
        "1970-01-01", "1970-01-01", "1970-01-02", "2018-09-01", None, None]


def test_is_valid_and_weak_city(spark):
    vals = ["a", "", "-", None, " "]
    assert one_col(spark, vals, fn.is_valid) == [True, False, False, False, True]
    assert one_col(spark, vals, fn.is_valid_city_weak) == [True, False, True, False, True]


def test_first_not_blank(spark):
    df = spark.createDataFrame([(["a", ""],), ([""],), ([],), (None,)], "a array<string>")
    assert [r[0] for r in df.select(fn.first_not_blank("a")).collect()] == [True, False, False, False]


def test_java_split_and_pad(spark):
    df = spark.createDataFrame([("a\u0001b\u0001",), ("a\u0001\u0001b",), ("",), (None,), ("\u0001\u0001",)], "x string")
    got = [r[0] for r in df.select(fn.java_split("x", "\u0001")).collect()]
    assert got == [["a", "b"], ["a", "", "b"], [""], None, []]
    df2 = spark.createDataFrame([(["x"],), (["a", "b", "c", "d"],), ([],)], "a array<string>")
    assert [r[0] for r in df2.select(fn.pad("a")).collect()] == [["x", "", ""], ["a", "b", "c"], ["", "", ""]]


def test_date_between(spark):
    days = ["2018-08-30", "2018-08-31", "2018-09-01", None]
    df = spark.createDataFrame([(d,) for d in days], "x string").selectExpr("CAST(x AS DATE) AS x")
    got = [r[0] for r in df.select(fn.date_between("x", "2018-08-31", "2018-09-01")).collect()]
    assert got == [False, True, True, None]
    assert df.filter(fn.date_between("x", end="2018-08-30")).count() == 1


def test_group_key_nulls(spark):
    df = spark.createDataFrame([("1", None, "数学")], "a string, b string, c string")
    assert df.select(fn.group_key("a", "b", "c")).first()[0] == "1_null_数学"


def test_day_range(spark):
    got = spark.range(1).select(F.explode(fn.day_range("2018-08-30", "2018-09-02")).alias("d")) \
        .select(F.col("d").cast("string")).collect()
    assert [r[0] for r in got] == ["2018-08-30", "2018-08-31", "2018-09-01", "2018-09-02"]


def test_millis_to_date_negative_and_zone(spark):
    assert one_col(spark, ["-1", "-86400000"], fn.millis_to_date) == ["1969-12-31", "1969-12-31"]
    assert one_col(spark, ["1535760000000"], lambda c: fn.millis_to_date(c, "Asia/Shanghai")) == ["2018-09-01"]
    assert one_col(spark, ["1535817600000"], lambda c: fn.millis_to_date(c, "America/New_York")) == ["2018-09-01"]
