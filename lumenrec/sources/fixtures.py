"""Binding of the driver's TPC-H-style tables to the recommender's inputs.

FIXTURES.md §2 defines each view in SQL; this module builds the same views
with the DataFrame API so Catalyst prunes columns and pushes filters into the
parquet scans.  The raw tables are ``<sf_dir>/<name>.parquet``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lumenrec.sources.tables import Tables

# ---- fixed values of the binding (FIXTURES.md §2) -----------------------------
GRADES = ["BUILDING", "FURNITURE", "MACHINERY", "HOUSEHOLD", "AUTOMOBILE"]
SUBJECT_BY_TYPE = [("MEDIUM", "数学"), ("STANDARD", "语文"), ("LARGE", "英语"),
                   ("PROMO", "物理"), ("SMALL", "化学")]
SUBJECT_OTHER = "生物"
LEVEL_BY_WORD = [("widget", "启航班"), ("plate", "勤思班"), ("ring", "敏学班"),
                 ("rod", "博学班"), ("bolt", "创新班"), ("gizmo", "兴趣班")]
LEVEL_OTHER = "-"
LIVE_LOCATION = "live-class-service-center"
# Parameters the fixture queries use.
AS_OF = "2001-01-01"             # "today": sessions strictly after it are future
PAY_AFTER = "1996-09-01"          # registration history starts after this pay date
CREATED_AFTER = "1996-09-01"      # order creation date lower bound
EVENT_BEGIN, EVENT_END = "2024-01-10", "2024-01-20"
ORDER_BEGIN, ORDER_END = "1995-01-01", "2001-08-01"
# Packed-array delimiters of the registration table.
CUT_EVERY = 13                    # classes whose packed registrations lack their last start time
SPOILED_RULE, SPOILED_STUDENT = 3, 11      # what the reject counts' inputs spoil: terms, every so many students
DATE_SEP, START_SEP, END_SEP = "\u0001", "\u0002", "\u0003"
# -------------------------------------------------------------------------------


def _case(c: Column, pairs, default) -> Column:
    expr = None
    for k, v in pairs:
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr.otherwise(F.lit(default))


def _day(c: str) -> Column:
    return F.col(c).cast("date")


def _class_city(key: Column) -> Column:
    # 400 classes and 300 students a city, however many cities the data holds
    return F.floor(key / F.lit(400.0)).cast("string")


def _student_city(key: Column) -> Column:
    return F.floor(key / F.lit(300.0)).cast("string")


class _Raw:
    """Driver tables, each read (and its files listed) once per binding."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")
        self._dfs: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        if name not in self._dfs:
            self._dfs[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._dfs[name]


def fx_class(raw: _Raw) -> DataFrame:
    p = raw("part")
    key = F.col("p_partkey")
    grade_idx = F.floor(key / F.lit(5.0)).cast("bigint") % 5
    return p.select(
        key.cast("string").alias("cla_id"),
        _class_city(key).alias("city_id"),
        _case(grade_idx, list(enumerate(GRADES)), GRADES[-1]).alias("cla_grade_id"),
        (F.col("p_size") % 6).cast("string").alias("cla_term_id"),
        _case(F.col("p_type"), SUBJECT_BY_TYPE, SUBJECT_OTHER).alias("cla_subject_names"),
        _case(F.split_part(F.col("p_name"), F.lit(" "), F.lit(2)), LEVEL_BY_WORD, LEVEL_OTHER)
        .alias("cla_level_name"),
        (key % 4).cast("string").alias("cla_class_type"),
        (F.lit(2016) + F.col("p_size") % 3).cast("string").alias("cla_year"),
        F.when(key % 4 == 1, F.lit(LIVE_LOCATION))
        .otherwise(F.concat(F.lit("L"), (key % 3).cast("string"))).alias("loc"),
        F.col("p_brand").alias("cla_teacher_ids"),
        (F.col("p_size") % 6 + 1).cast("bigint").alias("cla_subject_ids"),
        F.concat(F.lit("C"), (F.col("p_size") % 6).cast("string")).alias("cla_classtime_names"),
        F.concat((F.lit(2016) + F.col("p_size") % 3).cast("string"), F.lit("/"),
                 (F.col("p_size") % 6).cast("string")).alias("cla_classdate_name"),
        (F.col("p_retailprice") / 1000).alias("fin_score"),
    )


def fx_student(raw: _Raw) -> DataFrame:
    return raw("customer").select(
        F.col("c_custkey").cast("string").alias("stu_id"),
        F.col("c_custkey").cast("string").alias("stu_uid"),
        _student_city(F.col("c_custkey")).alias("city_id"),
        F.col("c_mktsegment").alias("stu_grade_id"),
    )


def fx_user(raw: _Raw) -> DataFrame:
    return raw("customer").filter(F.col("c_acctbal") > 0) \
        .select(F.col("c_custkey").cast("string").alias("id"))


def _line_orders(raw: _Raw, line_cols, order_cols) -> DataFrame:
    li = raw("lineitem").select("l_orderkey", *line_cols)
    o = raw("orders").select("o_orderkey", *order_cols)
    return li.join(o, li.l_orderkey == o.o_orderkey)


def fx_regist(raw: _Raw) -> DataFrame:
    lo = _line_orders(raw, ["l_partkey", "l_returnflag"], ["o_custkey", "o_orderdate", "o_orderstatus"])
    return lo.select(
        F.col("o_custkey").cast("string").alias("reg_student_id"),
        F.col("l_partkey").cast("string").alias("reg_class_id"),
        _day("o_orderdate").alias("reg_pay_date"),
        _case(F.col("o_orderstatus"), [("F", 1), ("O", 2)], 0).cast("int").alias("reg_ispay"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).cast("int").alias("reg_isdeleted"),
    )


def fx_order(raw: _Raw, klass: DataFrame) -> DataFrame:
    lo = _line_orders(raw, ["l_partkey", "l_returnflag", "l_extendedprice"],
                      ["o_custkey", "o_orderdate", "o_orderstatus"])
    k = klass.select("cla_id", "cla_level_name", "cla_subject_names")
    j = lo.join(k, k.cla_id == F.col("l_partkey").cast("string"))
    status = (F.when(F.col("l_returnflag") == "R", 3).when(F.col("o_orderstatus") == "F", 2)
              .when(F.col("o_orderstatus") == "O", 1).otherwise(0))
    return j.select(
        F.col("o_custkey").cast("string").alias("sid"),
        F.concat(F.lit("d"), F.col("o_custkey").cast("string")).alias("distinctid"),
        status.cast("int").alias("orderstatus"),
        (F.col("l_extendedprice") * 0.02).alias("classprice"),
        F.col("cla_level_name").alias("classlevelname"),
        F.col("cla_subject_names").alias("subjectname"),
        _day("o_orderdate").alias("startdate"),
        _day("o_orderdate").alias("finacreatedate"),
        _day("o_orderdate").alias("dt"),
    )


def fx_behavior(raw: _Raw, klass: DataFrame) -> DataFrame:
    e = raw("events").select("user_id", "event_type", "ts", "props")
    k = klass.select("cla_id", "cla_level_name", "cla_subject_names", "cla_class_type",
                     "cla_teacher_ids", "loc")
    j = e.join(k, k.cla_id == F.regexp_extract("props", "([0-9]+)", 1))
    return j.select(
        F.col("user_id").cast("string").alias("sid"), "cla_id", "cla_level_name",
        "cla_subject_names", "cla_class_type", "cla_teacher_ids",
        F.col("loc").alias("cla_servicecenter_id"),
        F.col("event_type").alias("cla_classtime_ids"),
        _day("ts").alias("day"),
    )


def fx_curriculum(raw: _Raw) -> DataFrame:
    li = raw("lineitem").select("l_partkey", "l_shipdate", "l_linenumber")
    ln = F.col("l_linenumber")
    return li.select(
        F.col("l_partkey").cast("string").alias("cuc_class_id"),
        F.col("l_shipdate").cast("date").alias("cuc_class_date"),
        F.concat(F.lpad((ln + 8).cast("string"), 2, "0"), F.lit(":00")).alias("cuc_start_time"),
        F.concat(F.lpad((ln + 10).cast("string"), 2, "0"), F.lit(":00")).alias("cuc_end_time"),
        _class_city(F.col("l_partkey")).alias("city_id"),
    )


def fx_location(raw: _Raw) -> DataFrame:
    k = F.col("c_custkey")
    return raw("customer").select(
        k.cast("string").alias("sid"),
        _student_city(k).alias("city_id"),
        F.concat(F.lit("L"), (k % 3).cast("string"), F.lit(",L"), (k % 2).cast("string")).alias("depart_4"),
    )


def fx_rule_long(klass: DataFrame) -> DataFrame:
    subj = F.when(F.col("cla_subject_names") == SUBJECT_OTHER, F.lit("其他")) \
        .otherwise(F.col("cla_subject_names"))
    return klass.select(
        "city_id", F.col("cla_grade_id").alias("grade_id"),
        F.concat(subj, F.lit("_"), F.col("cla_term_id")).alias("left_token"), "loc", "cla_id",
    )


def fx_rule(klass: DataFrame) -> DataFrame:
    """Rules in the stored JSON form: one row per (city, grade, token)."""
    per_loc = fx_rule_long(klass).groupBy("city_id", "grade_id", "left_token", "loc") \
        .agg(F.array_sort(F.collect_list("cla_id")).alias("ids"))
    per_rule = per_loc.groupBy("city_id", "grade_id", "left_token").agg(
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(F.struct("loc", "ids"))))).alias("recall"))
    return per_rule.select("city_id", "grade_id", F.array("left_token").alias("left"), "recall")


def fx_registered(raw: _Raw) -> DataFrame:
    lo = _line_orders(raw, ["l_partkey", "l_linestatus", "l_returnflag"], ["o_custkey"])
    return lo.filter((F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "N")).select(
        F.col("o_custkey").cast("string").alias("sid"),
        F.col("l_partkey").cast("string").alias("cla_id"),
    ).distinct()


def fx_score(klass: DataFrame) -> DataFrame:
    return klass.select(
        "cla_id", "city_id", F.col("cla_class_type").cast("bigint").alias("cla_class_type"),
        "cla_subject_names", (F.col("cla_term_id").cast("bigint") + 1).alias("cla_subject_ids"),
        "cla_term_id", "cla_grade_id", "cla_level_name",
        F.concat(F.lit("T"), F.col("cla_term_id")).alias("cla_classtime_names"),
        F.concat(F.col("cla_year"), F.lit("-"), F.col("cla_term_id")).alias("cla_classdate_name"),
        "fin_score",
    )


def fx_session(curriculum: DataFrame, as_of: str = AS_OF) -> DataFrame:
    return curriculum.filter(F.col("cuc_class_date") > F.lit(as_of).cast("date")) \
        .groupBy(F.col("cuc_class_id").alias("cla_id"), F.col("cuc_class_date").alias("d")) \
        .agg(F.min("cuc_start_time").alias("st"), F.min("cuc_end_time").alias("et"))


def fx_register(raw: _Raw, klass: DataFrame, curriculum: DataFrame) -> DataFrame:
    """Packed registrations: one row per registered (sid, class) with its future sessions.

    Of every ``CUT_EVERY``-th class with several sessions the last start is missing.
    """
    _n_starts = F.size("s") - F.when((F.col("cla_id").cast("long") % CUT_EVERY == 0) & (F.size("s") > 1), 1).otherwise(0)
    packed = fx_session(curriculum).groupBy("cla_id").agg(
        F.array_sort(F.collect_list(F.struct("d", "st", "et"))).alias("s"))
    packed = packed.select(
        "cla_id",
        F.array_join(F.transform("s", lambda x: x["d"].cast("string")), DATE_SEP).alias("class_dates"),
        F.array_join(F.transform(F.slice("s", F.lit(1), _n_starts), lambda x: x["st"]), START_SEP).alias("start_times"),
        F.array_join(F.transform("s", lambda x: x["et"]), END_SEP).alias("end_times"),
    )
    k = klass.select("cla_id", "cla_term_id", "cla_subject_names", F.col("cla_year").alias("year"))
    # city of the registration row = the student's city, so a per-city run checks
    # all of a student's registrations
    stu = fx_student(raw).select(F.col("stu_id").alias("sid"), "city_id")
    # every registration is a row; a class without future sessions packs empty texts
    return fx_registered(raw).join(packed, "cla_id", "left").join(k, "cla_id").join(stu, "sid").select(
        "sid", "cla_id", "cla_term_id", "cla_subject_names", "year",
        F.lit("1").alias("reg_ispay"), F.lit("0").alias("reg_isdeleted"), "city_id",
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("class_dates", "start_times", "end_times")],
    )


def spoiled_rules(rules: DataFrame) -> DataFrame:
    """Rules of which those for term 3 have cut-off JSON and those for term 4 a null ``left``."""
    term = F.element_at(F.split(F.get("left", F.lit(0)), "_"), -1).cast("int")
    return rules.select("city_id", "grade_id", F.when(term != SPOILED_RULE + 1, F.col("left")).alias("left"),
                        F.when(term == SPOILED_RULE, F.lit('{"L0": [')).otherwise(F.col("recall")).alias("recall"))


def spoiled_locations(location: DataFrame) -> DataFrame:
    """Locations of which every eleventh student has a null list."""
    return location.withColumn("depart_4", F.when(F.col("sid").cast("long") % SPOILED_STUDENT != 0, F.col("depart_4")))


def bind_fixtures(spark: SparkSession, sf_dir: str) -> Tables:
    """All logical inputs bound to the driver tables in ``sf_dir``."""
    raw = _Raw(spark, sf_dir)
    memo: dict[str, DataFrame] = {}

    def once(key, build):
        # one DataFrame per view: shared inputs are one plan object (smaller plans,
        # faster analysis, identical subtrees for exchange reuse)
        def get():
            if key not in memo:
                memo[key] = build()
            return memo[key]
        return get

    klass_full = once("klass_full", lambda: fx_class(raw))
    curriculum = once("curriculum", lambda: fx_curriculum(raw))
    loaders = {
        "behavior": once("behavior", lambda: fx_behavior(raw, klass_full())),
        "order": once("order", lambda: fx_order(raw, klass_full())),
        "regist": once("regist", lambda: fx_regist(raw)),
        "user": once("user", lambda: fx_user(raw)),
        "student": once("student", lambda: fx_student(raw)),
        "klass": klass_full,
        "curriculum": curriculum,
        "rule": once("rule", lambda: fx_rule(klass_full())),
        "location": once("location", lambda: fx_location(raw)),
        "register": once("register", lambda: fx_register(raw, klass_full(), curriculum())),
        "score": once("score", lambda: fx_score(klass_full())),
    }
    return Tables(spark, loaders)
