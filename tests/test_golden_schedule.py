"""Golden micro tables: the conflict filter (JN8-JN11, NS3, NS5, SURVEY Q7-Q9)."""

import datetime as dt

from lumenrec.operators import schedule as sc
from lumenrec.operators.rejects import Rejects
from lumenrec.plans import recommend as prec
from tests.conftest import rows
from tests.helpers import tables

D = dt.date.fromisoformat
S1, S2, S3 = "\u0001", "\u0002", "\u0003"


def _inputs(spark):
    klass = [
        ("A", "c1", "g1", "1", "数学", "x", "1", "2017"),   # same term-subject-year as R1
        ("B", "c1", "g1", "2", "数学", "x", "1", "2017"),   # overlaps only R2's second session
        ("C", "c1", "g1", "3", "英语", "x", "1", "2018"),   # touches R2's first session (closed)
        ("D", "c1", "g1", "1", "物理", "x", "1", "2017"),   # overlaps R1
        ("E", "c1", "g1", "4", "化学", "x", "1", "2017"),   # past sessions only
        ("F", "c1", "g1", "4", "语文", "x", "1", "2017"),   # free
    ]
    curriculum = [
        ("A", D("2001-05-01"), "09:00", "10:00", "c1"),
        ("B", D("2001-03-01"), "08:00", "09:30", "c1"),
        ("C", D("2001-03-01"), "11:00", "12:00", "c1"),
        ("D", D("2001-02-01"), "09:30", "10:30", "c1"),
        ("E", D("2000-12-01"), "09:00", "10:00", "c1"),
        ("F", D("2001-03-01"), "12:00", "13:00", "c1"),
        ("F", D("2001-03-01"), "06:00", "09:00", "c1"),     # F's first session of the date is 06:00
    ]
    register = [
        ("s1", "R1", "1", "数学", "2017", "1", "0", "c1", "2001-02-01", "09:00", "10:00"),
        # R2: two sessions on one date, trailing delimiters (Q9); first occurrence wins (Q7)
        ("s1", "R2", "5", "化学", "2018", "1", "0", "c1",
         f"2001-03-01{S1}2001-03-01{S1}", f"10:00{S2}08:00{S2}", f"11:00{S3}09:00{S3}"),
        ("s1", "R3", "1", "数学", "2017", "1", "1", "c1", "2001-03-01", "00:00", "23:59"),  # deleted
    ]
    t = tables(spark, klass=klass, curriculum=curriculum, register=register)
    recs = spark.createDataFrame([("s1", "c1", c) for c in "ABCDEF"], "sid string, city_id string, cla_id string")
    return t, recs


def test_conflict_free_literal_first_session(spark):
    t, recs = _inputs(spark)
    got = rows(prec.conflict_free(t, recs, "2001-01-01"))
    # F conflicts with nothing: its first session of 2001-03-01 is 06:00-09:00, R2's first is 10:00-11:00
    assert got == [("s1", "c1", "B"), ("s1", "c1", "F")]


def test_conflict_free_all_sessions(spark):
    t, recs = _inputs(spark)
    # every session counts: B meets R2's 08:00-09:00 and F's 06:00-09:00 meets it too
    assert rows(prec.conflict_free(t, recs, "2001-01-01", all_sessions=True)) == []


def test_registered_sessions_unpack(spark):
    t, _ = _inputs(spark)
    got = rows(sc.registered_sessions(t.register.filter("reg_isdeleted = '0'")), "cla_id", "d", "st", "et", "ok")
    assert got == [("R1", "2001-02-01", "09:00", "10:00", True), ("R2", "2001-03-01", "10:00", "11:00", True)]


def test_missing_time_is_error_row(spark):
    t = tables(spark, register=[("s1", "R", "1", "x", "2017", "1", "0", "c1",
                                 f"2001-03-01{S1}2001-03-02", "10:00", "11:00")])
    got = rows(sc.registered_sessions(t.register), "d", "st", "ok")
    assert got == [("2001-03-01", "10:00", True), ("2001-03-02", None, False)]


def test_curriculum_arrays_sorted(spark):
    t, _ = _inputs(spark)
    got = {r.cuc_id: (r.date_arr, r.starttime_arr) for r in prec.curriculum_table(t, "2001-01-01").collect()}
    assert got["F"] == (["2001-03-01", "2001-03-01"], ["06:00", "12:00"])
    assert "E" not in got


def test_null_keys_compare_equal_in_same_subject_exclusion(spark):
    recs = spark.createDataFrame([("s1", "c1", "A", None, "数学", "2017"), ("s1", "c1", "B", "1", "数学", "2017")],
                                 "sid string, city_id string, cla_id string, cla_term_id string, cla_subject_names string, year string")
    regs = spark.createDataFrame([("s1", "c1", None, "数学", "2017")],
                                 "sid string, city_id string, cla_term_id string, cla_subject_names string, year string")
    assert rows(sc.same_subject_exclusion(recs, regs), "cla_id") == [("B",)]


def test_a_class_registered_twice_books_the_first_session_of_each_row(spark):
    """Q7 holds row by row: each registration's first session of a date counts."""
    t = tables(spark, klass=[("A", "c1", "g1", "1", "数学", "x", "1", "2017"), ("B", "c1", "g1", "1", "英语", "x", "1", "2017"),
                             ("C", "c1", "g1", "1", "物理", "x", "1", "2017")],
               curriculum=[("A", D("2001-03-01"), "08:00", "08:30", "c1"), ("B", D("2001-03-01"), "10:00", "10:30", "c1"),
                           ("C", D("2001-03-01"), "12:00", "12:30", "c1")],
               register=[("s1", "R", "9", "x", "2017", "1", "0", "c1", f"2001-03-01{S1}2001-03-01", f"08:00{S2}12:00", f"08:10{S3}12:10"),
                         ("s1", "R", "9", "x", "2017", "1", "0", "c1", "2001-03-01", "10:00", "10:10")])
    recs = spark.createDataFrame([("s1", "c1", c) for c in "ABC"], "sid string, city_id string, cla_id string")
    assert rows(prec.conflict_free(t, recs, "2001-01-01")) == [("s1", "c1", "C")]
    got = rows(sc.registered_sessions(t.register), "d", "st", "et")
    assert got == [("2001-03-01", "08:00", "08:10"), ("2001-03-01", "10:00", "10:10")]


def test_booked_entries_know_the_largest_end_so_far(spark):
    t = tables(spark, register=[("s1", f"R{i}", "1", "x", "2017", "1", "0", "c1", d, st, et) for i, (d, st, et) in enumerate(
        [("2001-03-01", "08:00", "12:00"), ("2001-03-01", "09:00", "09:30"), ("2001-03-01", "09:00", "09:40"), ("2001-03-02", "07:00", "07:10"),
         ("", "", "")])])
    one = sc.student_register(t.register).first()
    assert [tuple(b) for b in one.booked] == [("2001-03-01", "08:00", "12:00"), ("2001-03-01", "09:00", "12:00"), ("2001-03-02", "07:00", "07:10")]
    assert [tuple(o) for o in one.owned] == [("1", "x", "2017")]
    alone = sc.student_register(t.register.filter("cla_id = 'R4'")).first()
    assert alone.booked == [] and len(alone.owned) == 1


def test_packed_texts_are_split_once_a_row_and_the_summary_moves_once(spark):
    """Q9, Q7: a registration's texts are not split again for each of its dates, and one exchange by
    student serves both exclusions."""
    t = tables(spark, register=[("s1", "R", "9", "x", "2017", "1", "0", "c1", f"2001-03-01{S1}2001-03-02", f"08:00{S2}12:00", f"08:10{S3}12:10")])
    for every in (False, True):
        watched = Rejects().watch(sc.with_lists(t.register), "register", missing_time=sc.missing_time(every))
        for regs in (t.register, watched):
            summary = sc.student_register(regs, every)._jdf.queryExecution()
            assert summary.optimizedPlan().toString().count("split(") == 3
            assert summary.sparkPlan().toString().count("Window") == 0
            assert summary.executedPlan().toString().count("Exchange") == 1


def test_missing_texts_and_repeated_dates_of_registrations(spark):
    """A registration without a text has no sessions and lacks no time; a date that an earlier
    position holds is no session unless all are asked for."""
    def reg(cla_id, dates, starts, ends):
        return ("s1", cla_id, cla_id, "x", "2017", "1", "0", "c1", dates, starts, ends)

    a, b = "2001-03-01", "2001-03-02"
    t = tables(spark, register=[reg("no starts", a, None, "10:00"), reg("no dates", None, "09:00", "10:00"),
                                reg("again", f"{a}{S1}{b}{S1}{a}", f"09:00{S2}09:10", f"10:00{S3}10:10{S3}10:20"),
                                reg("short", f"{a}{S1}{S1}{b}", f"11:00{S2}11:10{S2}11:20", "12:00"), reg("gap", f"{a}{S1}{S1}", "13:00", "14:00")])
    missing = {every: sorted(r.cla_id for r in sc.with_lists(t.register).filter(sc.missing_time(every)).collect()) for every in (False, True)}
    assert missing == {False: ["short"], True: ["again", "short"]}
    one = sc.student_register(t.register).first()
    assert [tuple(x) for x in one.booked] == [(a, "09:00", "10:00"), (a, "11:00", "12:00"), (a, "13:00", "14:00"), (b, "09:10", "10:10")]
    assert sorted(o.term for o in one.owned) == ["again", "gap", "no dates", "no starts", "short"]
    left_out = sc.rejected_sessions(t.register).first()
    assert (left_out.n_sessions, left_out.n_rejected) == (5, 1)
