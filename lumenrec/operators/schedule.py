"""Timetables and the two exclusion rules (PL7, NS3, NS5, JN9-JN11).

Sessions are kept long, one row ``(class, city, date, start, end)``.  The
same-subject rule is a null-safe anti join; the overlap test
(``conflict_flags``) checks each recommended session against a bounded
per-date summary of the registered sessions, so no recommendation x
registration pair is formed.  ``time_conflicts`` is the plain pairwise form
(equi-join on ``(sid, city, date)`` plus the overlap residual), kept as the
reference the tests compare with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumenrec.functions import intervals_overlap, java_split

# ---- fixed values: delimiters of the packed registration arrays ---------------------
DATE_SEP = "\u0001"
START_SEP = "\u0002"
END_SEP = "\u0003"
# ---------------------------------------------------------------------------------------


def future_sessions(curriculum: DataFrame, as_of: str, city: str | None = None) -> DataFrame:
    """SRC8 + PF14: sessions strictly after ``as_of``: ``(cla_id, city_id, d, st, et)``.

    ``d`` is the ``yyyy-MM-dd`` text of the session date.
    """
    c = curriculum.filter(F.col("cuc_class_date") > F.lit(as_of).cast("date"))
    if city is not None:
        c = c.filter(F.col("city_id") == city)
    return c.select(F.col("cuc_class_id").alias("cla_id"), "city_id",
                    F.col("cuc_class_date").cast("string").alias("d"),
                    F.col("cuc_start_time").alias("st"), F.col("cuc_end_time").alias("et"))


def curriculum_arrays(sessions: DataFrame, dt: str) -> DataFrame:
    """PL7 ``transform_curriculum`` stored form: per class three parallel arrays
    ordered by (date, start, end) (AG5)."""
    s = F.array_sort(F.collect_list(F.struct("d", "st", "et")))
    return sessions.groupBy(F.col("cla_id").alias("cuc_id"), "city_id").agg(s.alias("_s")).select(
        "cuc_id", "city_id",
        F.col("_s.d").alias("date_arr"), F.col("_s.st").alias("starttime_arr"),
        F.col("_s.et").alias("endtime_arr"), F.lit(dt).alias("dt"))


def first_session_per_date(sessions: DataFrame) -> DataFrame:
    """NS5 on the recommendation side: a date's first session in (date, start, end)
    order is the one the original compares (SURVEY Q7)."""
    first = F.min(F.struct("st", "et"))
    return sessions.groupBy("cla_id", "city_id", "d").agg(first.alias("_f")) \
        .select("cla_id", "city_id", "d", F.col("_f.st").alias("st"), F.col("_f.et").alias("et"))


def with_lists(register: DataFrame) -> DataFrame:
    """Packed registrations with their texts split, once a row: ``_dates``, ``_starts``, ``_ends``.

    A row without one of the texts has no dates.
    """
    if "_dates" in register.columns:
        return register
    texts = F.col("class_dates").isNotNull() & F.col("start_times").isNotNull() & F.col("end_times").isNotNull()
    return register.withColumns({"_dates": F.when(texts, java_split("class_dates", DATE_SEP)),
                                 "_starts": java_split("start_times", START_SEP), "_ends": java_split("end_times", END_SEP)})


def _unpacked(register: DataFrame, columns: list, all_sessions: bool = False) -> DataFrame:
    """The positions of packed registrations, ``columns`` of the row with ``(pos, d, st, et, counts)``;
    a row without any gives one with nulls.

    ``counts`` tells the sessions: by default only the first position of each date of a
    registration counts (NS5, SURVEY Q7).  An empty text splits to [''], which is no session;
    times beyond the dates belong to none.
    """
    ex = with_lists(register).select(*columns, "_dates", "_starts", "_ends", F.posexplode_outer("_dates").alias("pos", "d"))
    counts = F.col("d") != ""
    if not all_sessions:
        counts = counts & (F.array_position("_dates", F.col("d")) == F.col("pos") + 1)
    return ex.withColumns({"st": F.get("_starts", "pos"), "et": F.get("_ends", "pos"), "counts": F.coalesce(counts, F.lit(False))}) \
        .drop("_dates", "_starts", "_ends")


def registered_sessions(register: DataFrame, all_sessions: bool = False) -> DataFrame:
    """Registered sessions ``(sid, city_id, cla_id, d, st, et, ok)``, unpacked within each row.

    ``ok`` is false when a date has no start or end at its position -- the
    original fails there (Q9); such rows are kept for counting, never joined.
    """
    ex = _unpacked(register, ["sid", "city_id", "cla_id"], all_sessions).filter("counts")
    return ex.select("sid", "city_id", "cla_id", "d", "st", "et", (F.col("st").isNotNull() & F.col("et").isNotNull()).alias("ok"))


def same_subject_exclusion(recs: DataFrame, regs: DataFrame) -> DataFrame:
    """JN10: drop recommendations whose (term, subject, year) equals one of the
    student's registrations; nulls compare equal (SURVEY Q8)."""
    r, g = recs.alias("r"), regs.alias("g")
    cond = ((F.col("r.sid") == F.col("g.sid")) & (F.col("r.city_id") == F.col("g.city_id"))
            & F.col("r.cla_term_id").eqNullSafe(F.col("g.cla_term_id"))
            & F.col("r.cla_subject_names").eqNullSafe(F.col("g.cla_subject_names"))
            & F.col("r.year").eqNullSafe(F.col("g.year")))
    return r.join(g, cond, "left_anti")


def time_conflicts(rec_sessions: DataFrame, reg_sessions: DataFrame) -> DataFrame:
    """JN11: recommendations ``(sid, city_id, cla_id)`` with a session that overlaps
    a registered session of the same student on the same date (closed intervals)."""
    r = rec_sessions.alias("r")
    f = reg_sessions.filter("ok").alias("f")
    cond = ((F.col("r.sid") == F.col("f.sid")) & (F.col("r.city_id") == F.col("f.city_id"))
            & (F.col("r.d") == F.col("f.d"))
            & intervals_overlap(F.col("f.st"), F.col("f.et"), F.col("r.st"), F.col("r.et")))
    return r.join(f, cond, "left_semi").select("sid", "city_id", "cla_id").distinct()


def conflict_flags(rec_sessions: DataFrame, reg_sessions: DataFrame) -> DataFrame:
    """JN11 without pairs: per recommended session ``(sid, city_id, cla_id, d, st, et)``
    a flag ``conflict`` -- does it overlap (closed, ``TimeCover``) a registered
    session of the same student on the same date?

    A registered F overlaps R iff ``F.st <= R.et and F.et >= R.st``.  For a fixed
    start the second test only needs the largest end, so the registered side
    is reduced to one ``(start, max end)`` entry per distinct start time of the
    student's date -- bounded by the clock's resolution (1,440 for ``HH:MM``),
    however many rows the data holds -- and every recommended session checks that short array
    with ``exists``.  The join is many-to-one on ``(sid, city_id, d)``; a hot
    key is split by AQE.  Exact for any intervals, inverted ones included;
    rows with a missing time never match (SURVEY Q9).
    """
    f = reg_sessions.filter(F.col("ok") & F.col("st").isNotNull() & F.col("et").isNotNull())
    per_start = f.groupBy("sid", "city_id", "d", "st").agg(F.max("et").alias("mx"))
    per_day = per_start.groupBy("sid", "city_id", "d") \
        .agg(F.collect_list(F.struct("st", "mx")).alias("_reg"))
    j = rec_sessions.join(per_day, ["sid", "city_id", "d"], "left")
    hit = F.exists("_reg", lambda e: (e["st"] <= F.col("et")) & (e["mx"] >= F.col("st")))
    return j.select("sid", "city_id", "cla_id", "d", "st", "et",
                    F.coalesce(hit, F.lit(False)).alias("conflict"))


def conflict_free_recs(rec_sessions: DataFrame, reg_sessions: DataFrame) -> DataFrame:
    """Recommendations ``(sid, city_id, cla_id)`` none of whose sessions conflict.

    Every recommendation must appear in ``rec_sessions`` with at least one
    session (JN9 guarantees it); a session with a missing time has no conflict.
    """
    flags = conflict_flags(rec_sessions, reg_sessions)
    return flags.groupBy("sid", "city_id", "cla_id").agg(F.max("conflict").alias("_c")) \
        .filter(~F.col("_c")).select("sid", "city_id", "cla_id")


def _largest_ends(booked: Column) -> Column:
    """Entries ``(d, st, mx)`` in order, ``mx`` still each one's own end, as one ``(d, st, mx)`` per
    date and start, ``mx`` the largest end of the date so far.

    A date's entries are put together before they join those of the dates before it, so the work
    is that of the dates and of the entries of a date, not the square of a student's entries.
    """
    entry = "struct<d:string,st:string,mx:string>"
    none = F.array().cast(f"array<{entry}>")

    def closed(acc):
        return F.concat(acc["day"], F.array(acc["last"]))

    def state(days, day, last):
        return F.struct(days.alias("days"), day.alias("day"), last.alias("last"))

    def add(acc, x):
        last = acc["last"]
        later = F.struct(x["d"].alias("d"), x["st"].alias("st"), F.greatest(last["mx"], x["mx"]).alias("mx"))
        return F.when(last["d"] != x["d"], state(F.concat(acc["days"], F.array(closed(acc))), none, x)) \
            .when(last["st"] != x["st"], state(acc["days"], closed(acc), later)) \
            .when(last["st"] == x["st"], state(acc["days"], acc["day"], later)) \
            .otherwise(state(acc["days"], acc["day"], x))           # the first one
    start = state(F.array().cast(f"array<array<{entry}>>"), none, F.lit(None).cast(entry))
    return F.when(F.size(booked) > 0, F.aggregate(booked, start, add, lambda acc: F.flatten(F.concat(acc["days"], F.array(closed(acc)))))) \
        .otherwise(none)


def student_register(regs: DataFrame, all_sessions: bool = False) -> DataFrame:
    """What both exclusions need of a student, one row per (sid, city_id), from one pass over the
    registrations: ``owned``, the distinct (term, subject, year), and ``booked``, one
    (d, st, mx) per date and start, in that order, ``mx`` the largest end of the date so far.

    Both are sets, bounded by the values of terms, subjects and years and by the calendar's
    sessions, however many registrations repeat them; they are put together within a task
    before they are shuffled, once.  Rows with a missing time book nothing (SURVEY Q9).
    """
    own = F.struct(F.col("cla_term_id").alias("term"), F.col("cla_subject_names").alias("subject"), F.col("year").alias("year"))
    ex = _unpacked(regs, ["sid", "city_id", own.alias("own")], all_sessions)
    first = F.when(F.coalesce(F.col("pos"), F.lit(0)) == 0, F.col("own"))        # once per registration
    timed = F.col("counts") & F.col("st").isNotNull() & F.col("et").isNotNull()
    sets = ex.groupBy("sid", "city_id").agg(F.collect_set(first).alias("owned"),
                                            F.sort_array(F.collect_set(F.when(timed, F.struct("d", "st", F.col("et").alias("mx"))))).alias("booked"))
    once = F.size(F.array_distinct("booked.d")) == F.size("booked")             # no date twice
    return sets.withColumn("booked", F.when(once, F.col("booked")).otherwise(_largest_ends(F.col("booked"))))


def overlaps_booked(booked, d, st, et) -> Column:
    """Whether a session meets one of ``booked`` (as :func:`student_register` orders it): closed
    intervals of the same date, found by binary search.

    Of the entries of the date that start by ``et`` the last one knows their
    largest end; the session meets one of them if that is not before ``st``.
    """
    booked, d, st, et = (F.col(c) if isinstance(c, str) else c for c in (booked, d, st, et))

    def halve(acc, _):
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        e = F.get(booked, mid)
        by_then = (e["d"] < d) | ((e["d"] == d) & (e["st"] <= et))
        return F.when(acc["lo"] >= acc["hi"], acc) \
            .when(by_then, F.struct((mid + 1).alias("lo"), acc["hi"].alias("hi"))) \
            .otherwise(F.struct(acc["lo"].alias("lo"), mid.alias("hi")))

    n = F.size(booked)
    steps = F.sequence(F.lit(1), F.ceil(F.log2(n + 1)).cast("int"))
    lo = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), n.alias("hi")), halve, lambda acc: acc["lo"])
    last = F.get(booked, lo - 1)
    return F.when(n > 0, F.coalesce((last["d"] == d) & (last["mx"] >= st), F.lit(False))).otherwise(F.lit(False))


def missing_time(all_sessions: bool = False) -> Column:
    """Whether a packed registration (as :func:`with_lists` gives it) has a session without a start
    or an end (SURVEY Q9): a date beyond the times that no position before repeats."""
    def dates(some):
        found = F.array_remove(some, "")
        return F.size(found if all_sessions else F.array_distinct(found))

    n = F.least(F.size("_starts"), F.size("_ends"))
    return (F.size("_dates") > n) & (dates(F.col("_dates")) > dates(F.slice("_dates", F.lit(1), n)))


def rejected_sessions(regs: DataFrame, all_sessions: bool = False) -> DataFrame:
    """Sessions of the packed registrations that were left out for a missing start or end
    (SURVEY Q9), counted per city: ``(city_id, n_sessions, n_rejected)``."""
    s = registered_sessions(regs, all_sessions)
    return s.groupBy("city_id").agg(F.count(F.lit(1)).alias("n_sessions"), F.count_if(~F.col("ok")).alias("n_rejected"))


def tagged_union(recs: DataFrame, regs: DataFrame, tag: str = "-1") -> DataFrame:
    """ST2/ST3: recommendations and registrations in one positional union, the
    recommendations tagged ``reg_ispay = tag`` (the original's sentinel)."""
    cols = ["sid", "cla_id", "cla_term_id", "cla_subject_names", "year", "reg_ispay"]
    a = recs.select("sid", "cla_id", "cla_term_id", "cla_subject_names", "year",
                    F.lit(tag).alias("reg_ispay"))
    b = regs.select(*cols)
    return a.union(b)
