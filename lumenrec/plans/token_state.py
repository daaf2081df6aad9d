"""Mergeable token state (WN2, PL5): the most recent distinct tokens, kept from day to day.

The state of a student is at most three rows ``(sid, token, latest)``.  A new
registration can only make a token more recent, so the three most recent tokens
of the state and the new registrations together are those of the whole history:
a token outside the state is older than all three of it, unless it is among the
new ones.  A deletion can bring an older token back, so students with a deleted
registration are computed again from their whole history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenrec.functions import token
from lumenrec.operators.ranking import latest_items, top_recent
from lumenrec.plans import rules as pr
from lumenrec.sources.tables import Tables

STATE = "sid string, token string, latest date"


def _tokens(t: Tables, regs: DataFrame) -> DataFrame:
    return regs.join(pr.token_classes(t), "cla_id") \
        .select("sid", token("cla_subject_names", "cla_term_id").alias("token"), F.col("reg_pay_date").alias("latest"))


def _kept(rows: DataFrame) -> DataFrame:
    latest = latest_items(rows, "sid", "token", "latest")
    return top_recent(latest, "sid", "token", "latest").select("sid", "token", "latest")


def token_state(t: Tables, pay_after: str) -> DataFrame:
    """The state from all registrations."""
    return _kept(_tokens(t, pr.paid_registrations(t, pay_after)))


def advance(t: Tables, state: DataFrame, inserted: DataFrame, deleted: DataFrame, pay_after: str) -> DataFrame:
    """The state after a day's changes.

    ``inserted`` and ``deleted`` have the columns of the registration table; of ``deleted``
    (also registrations that are no longer paid) only the students count.  ``t.regist`` is the
    table after the changes; it is read for the students with a deletion alone.
    ``pay_after`` and the class table must be those of the state; else build it anew.
    """
    again = deleted.select(F.col("reg_student_id").alias("sid")).distinct()
    new = _tokens(t, pr.paid_registrations(t, pay_after, inserted))
    merged = state.unionByName(new).join(again, "sid", "left_anti")
    anew = _tokens(t, pr.paid_registrations(t, pay_after).join(again, "sid", "left_semi"))
    return _kept(merged.unionByName(anew))


def state_lists(t: Tables, state: DataFrame, dt: str, city: str | None = None) -> DataFrame:
    """PL5's lists ``(sid, city_id, grade_id, left_rule[3], dt)`` of live students from the state."""
    ranked = top_recent(state, "sid", "token", "latest").drop("latest")
    return pr.token_lists(ranked, pr.live_students(t, city), dt)
