"""Student token lists and the rule match (PL5, PL6).

Long form throughout: a recommendation is a row ``(sid, city_id, cla_id)``;
lists are only built at the edges (``as_lists``) because a list per student is
a whole group in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lumenrec.functions import is_valid, is_valid_city_weak, java_split, not_empty_json, token
from lumenrec.operators.joins import MAX_TOKENS, set_key, subset_keys
from lumenrec.operators.ranking import as_padded_list, recent_distinct
from lumenrec.operators.rejects import Rejects
from lumenrec.sources.tables import Tables

# ---- fixed values of the token job ------------------------------------------------
PAID_STATES = [1, 2]
TOKEN_TERMS = ["1", "2", "3", "4", "5"]
TOKEN_SUBJECTS = ["语文", "数学", "英语", "物理", "化学", "综合", "生物"]
CLASS_YEAR_AFTER = "2016"
LIVE_KEY = "live-class-service-center"
# ------------------------------------------------------------------------------------


def paid_registrations(t: Tables, pay_after: str, rows: DataFrame | None = None) -> DataFrame:
    """Paid, not deleted registrations ``(sid, cla_id, reg_pay_date)`` after a pay date (SRC4), of
    the whole table or of ``rows`` of it."""
    return (t.regist if rows is None else rows).filter(F.col("reg_ispay").isin(*PAID_STATES) & (F.col("reg_isdeleted") == 0)
                           & (F.col("reg_pay_date") > F.lit(pay_after).cast("date"))
                           & is_valid("reg_student_id") & is_valid("reg_class_id")) \
        .select(F.col("reg_student_id").alias("sid"), F.col("reg_class_id").alias("cla_id"), "reg_pay_date")


def live_students(t: Tables, city: str | None = None) -> DataFrame:
    """Rows ``(sid, city_id, grade_id)`` of live students (JN1) with a valid city and grade (JN4).

    A student is live if any of its rows names a live user; the students are read once.
    """
    users = t.user.select(F.col("id").alias("_uid")).distinct()
    flagged = t.student.join(users, t.student.stu_uid == users["_uid"], "left")
    live = F.max(F.col("_uid").isNotNull()).over(Window.partitionBy("stu_id"))
    rows = flagged.select(F.col("stu_id").alias("sid"), "city_id", F.col("stu_grade_id").alias("grade_id"), live.alias("_live"))
    keep = F.col("_live") & is_valid_city_weak("city_id") & is_valid("grade_id")
    if city is not None:
        keep = keep & (F.col("city_id") == city)
    return rows.filter(keep).drop("_live")


def token_classes(t: Tables, year_after: str = CLASS_YEAR_AFTER) -> DataFrame:
    """Classes eligible for tokens (PF9, PF10): year after, terms 1-5, seven subjects."""
    return t.klass.filter((F.col("cla_year") > F.lit(year_after)) & is_valid("cla_id")
                          & F.col("cla_term_id").isin(*TOKEN_TERMS)
                          & F.col("cla_subject_names").isin(*TOKEN_SUBJECTS)) \
        .select("cla_id", "cla_term_id", "cla_subject_names")


def student_tokens_long(t: Tables, pay_after: str) -> DataFrame:
    """WN2 in long form: ``(sid, rank, token)`` for the 3 most recent distinct tokens of all students
    with registrations.  Registrations are summed up within a task before they are shuffled."""
    rc = paid_registrations(t, pay_after).join(token_classes(t), "cla_id") \
        .select("sid", token("cla_subject_names", "cla_term_id").alias("token"), "reg_pay_date")
    return recent_distinct(rc, "sid", "token", "reg_pay_date")


def student_tokens(t: Tables, pay_after: str, dt: str, city: str | None = None) -> DataFrame:
    """PL5 ``CalRuleFunc``: ``(sid, city_id, grade_id, left_rule[3], dt)``.

    ``city`` filters the students early (the original filtered after computing
    every city).
    """
    return token_lists(student_tokens_long(t, pay_after), live_students(t, city), dt)


def token_lists(ranked: DataFrame, students: DataFrame, dt: str) -> DataFrame:
    """Ranked tokens ``(sid, rank, token)`` as the padded lists of the given students."""
    lists = as_padded_list(ranked, "sid", "token").withColumnRenamed("list", "left_rule")
    return lists.join(students, "sid").select("sid", "city_id", "grade_id", "left_rule", F.lit(dt).alias("dt"))


# ---- PL6 rule match -----------------------------------------------------------------

_RECALL = T.MapType(T.StringType(), T.ArrayType(T.StringType()))


def rules_with_id(rules: DataFrame, city: str | None = None) -> DataFrame:
    """Rules with a non-empty recall (PF10) and a content id."""
    r = rules.filter(not_empty_json("recall"))
    if city is not None:
        r = r.filter(F.col("city_id") == city)
    return r.withColumn("rule_id", F.xxhash64("city_id", "grade_id", "left", "recall"))


def recall_entries(rules: DataFrame, bad_json: str = "fail", rejects: Rejects | None = None) -> DataFrame:
    """NS1: recall JSON -> rows ``(rule_id, city_id, grade_id, left, loc, cla_id)``.

    Unparseable JSON fails the job like the original (``bad_json='fail'``), or
    is skipped (``'skip'``).  With ``rejects`` it is skipped and counted, as are
    rules with a null ``left``, which match nothing (SURVEY Q11, Q20).
    """
    r = rules.select("rule_id", "city_id", "grade_id", "left", "recall", F.from_json("recall", _RECALL).alias("m"))
    if rejects is not None:
        r = rejects.watch(r, "rule", bad_json=F.col("m").isNull(), null_left=F.col("left").isNull())
    elif bad_json == "fail":
        r = r.withColumn("m", F.when(F.col("m").isNull(),
                                     F.raise_error(F.concat(F.lit("bad recall JSON: "), F.col("recall"))))
                         .otherwise(F.col("m")))
    return r.select("rule_id", "city_id", "grade_id", "left", F.explode("m").alias("loc", "ids")) \
        .select("rule_id", "city_id", "grade_id", "left", "loc", F.explode("ids").alias("cla_id"))


def listed_locations(c: str) -> Column:
    """NS2: the listed locations plus the live key; a null list gives the live key only."""
    parts = F.coalesce(java_split(c, ","), F.array().cast("array<string>"))
    return F.array_distinct(F.array_append(parts, F.lit(LIVE_KEY)))


def student_locations(location: DataFrame, city: str | None = None) -> DataFrame:
    """NS2: one row per (sid, city, loc)."""
    loc = location if city is None else location.filter(F.col("city_id") == city)
    return loc.select("sid", "city_id", F.explode(listed_locations("depart_4")).alias("loc"))


def rule_match(tokens: DataFrame, rules: DataFrame, location: DataFrame, city: str | None = None,
               bad_json: str = "fail", rejects: Rejects | None = None) -> DataFrame:
    """PL6: distinct recommendations ``(sid, city_id, cla_id)`` (JN5-JN7, NS1-NS2, AG6).

    A rule matches a student of its city and grade when every token of its
    ``left`` is in the student's padded token list (so ``''`` in ``left``
    matches students with fewer than three tokens).  A matched rule offers the
    classes listed under each of the student's locations and the live key.

    ``rejects`` counts bad JSON, null ``left`` and null location lists in the same pass.

    Both sides meet once: a student's row per subset of its tokens and location,
    a rule's row per location and class, on ``(city, grade, subset, location)``.
    The output is students times the classes their rules offer at their
    locations: linear in the students as long as a rule's class list is bounded.
    """
    tk = tokens if city is None else tokens.filter(F.col("city_id") == city)
    offers = recall_entries(rules_with_id(rules, city), bad_json, rejects).filter(F.col("cla_id") != "")
    loc = location if city is None else location.filter(F.col("city_id") == city)
    if rejects is not None:
        loc = rejects.watch(loc, "location", null_depart_4=F.col("depart_4").isNull())
    asked = tk.select("sid", "city_id", "grade_id", "left_rule") \
        .join(loc.select("sid", "city_id", listed_locations("depart_4").alias("_locs")), ["sid", "city_id"]) \
        .select("sid", "city_id", "grade_id", F.explode(subset_keys("left_rule")).alias("_subset"), "_locs") \
        .select("sid", "city_id", "grade_id", "_subset", F.explode("_locs").alias("loc"))
    wanted = offers.select("city_id", "grade_id", set_key("left").alias("_subset"), "loc", "cla_id") \
        .filter(F.size("_subset") <= MAX_TOKENS)
    return asked.join(wanted, ["city_id", "grade_id", "_subset", "loc"]).select("sid", "city_id", "cla_id").distinct()


def as_lists(recs: DataFrame, item: str = "cla_id", name: str = "rec_class_list") -> DataFrame:
    """AG6 (over distinct recommendations) and AG7 (repeated rows stay repeated items): the list
    form of the stored tables, one sorted list per (sid, city), for readers that ask for it."""
    return recs.groupBy("sid", "city_id").agg(F.array_sort(F.collect_list(item)).alias(name))
