"""Conflict-free recommendations (PL7, PL8)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenrec.functions import is_valid
from lumenrec.operators import schedule as sc
from lumenrec.operators.rejects import Rejects
from lumenrec.sources.tables import Tables


def current_classes(t: Tables, city: str | None = None) -> DataFrame:
    """SRC12 with the valid-id filter: ``(cla_id, city_id, cla_term_id, cla_subject_names, year)``."""
    k = t.klass.filter(is_valid("cla_id"))
    if city is not None:
        k = k.filter(F.col("city_id") == city)
    return k.select("cla_id", "city_id", "cla_term_id", "cla_subject_names", F.col("cla_year").alias("year"))


def live_registrations(t: Tables, city: str | None = None) -> DataFrame:
    """SRC13: not-deleted packed registrations (of the city)."""
    g = t.register.filter(F.col("reg_isdeleted") == "0")
    if city is not None:
        g = g.filter(F.col("city_id") == city)
    return g


def class_sessions(t: Tables, as_of: str, city: str | None = None, all_sessions: bool = False) -> DataFrame:
    """JN8, JN9 on the class side: current classes with a future session, one row each with its
    attributes and its sessions ``(d, st, et)`` as an array (a class's own few dates)."""
    sessions = sc.future_sessions(t.curriculum, as_of, city)
    if not all_sessions:
        sessions = sc.first_session_per_date(sessions)
    per_class = sessions.groupBy("cla_id", "city_id").agg(F.collect_list(F.struct("d", "st", "et")).alias("sessions"))
    return current_classes(t, city).join(per_class, ["cla_id", "city_id"])


def conflict_free(t: Tables, recs: DataFrame, as_of: str, city: str | None = None,
                  all_sessions: bool = False, rejects: Rejects | None = None) -> DataFrame:
    """PL8: recommendations that (a) are current classes (JN8), (b) have a future
    session (JN9), (c) repeat no registered term-subject-year (JN10) and
    (d) overlap no registered session on the same date (JN11).

    Returns the set ``(sid, city_id, cla_id)``.  The recommendations move twice:
    to their class, then to their student, where one row per student holds what
    both exclusions need (``schedule.student_register``); no pair of a
    recommendation and a registration is formed.  ``rejects`` counts the
    registrations with a session that lacks a time, in the same pass.
    """
    r = recs if city is None else recs.filter(F.col("city_id") == city)
    offers = r.select("sid", "city_id", "cla_id").join(class_sessions(t, as_of, city, all_sessions), ["cla_id", "city_id"])
    regs = live_registrations(t, city)
    if rejects is not None:
        regs = rejects.watch(sc.with_lists(regs), "register", missing_time=sc.missing_time(all_sessions))
    owned = sc.student_register(regs, all_sessions)
    j = offers.join(owned, ["sid", "city_id"], "left")
    same = F.exists("owned", lambda o: o["term"].eqNullSafe(F.col("cla_term_id"))
                    & o["subject"].eqNullSafe(F.col("cla_subject_names")) & o["year"].eqNullSafe(F.col("year")))
    clash = F.exists("sessions", lambda s: sc.overlaps_booked("booked", s["d"], s["st"], s["et"]))
    free = ~F.coalesce(same, F.lit(False)) & ~F.coalesce(clash, F.lit(False))
    return j.filter(free).select("sid", "city_id", "cla_id")


def curriculum_table(t: Tables, as_of: str, city: str | None = None) -> DataFrame:
    """PL7 stored curriculum: future sessions per class as parallel arrays."""
    return sc.curriculum_arrays(sc.future_sessions(t.curriculum, as_of, city), as_of)
