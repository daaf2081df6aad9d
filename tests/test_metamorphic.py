"""Metamorphic checks on the sf0.001 driver tables."""

import os

import pytest
from pyspark.sql import functions as F

from lumenrec.operators import schedule as sc
from lumenrec.plans import recommend as prec
from lumenrec.plans import rules as pr
from lumenrec.sources import fixtures as fx

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def flow(spark):
    t = fx.bind_fixtures(spark, SF)
    tokens = pr.student_tokens(t, fx.PAY_AFTER, fx.AS_OF)
    recs = pr.rule_match(tokens, t.rule, t.location)
    free = prec.conflict_free(t, recs, fx.AS_OF)
    return t, tokens, recs, free


def test_token_lists_have_three_slots(flow):
    _, tokens, _, _ = flow
    assert tokens.filter(F.size("left_rule") != 3).count() == 0


def test_recommended_and_excluded_are_disjoint(flow):
    t, _, recs, free = flow
    regs = prec.live_registrations(t)
    attrs = recs.join(prec.current_classes(t), ["cla_id", "city_id"])
    same = attrs.join(sc.same_subject_exclusion(attrs, regs), ["sid", "city_id", "cla_id"], "left_anti")
    sessions = sc.first_session_per_date(sc.future_sessions(t.curriculum, fx.AS_OF))
    clash = sc.time_conflicts(attrs.select("sid", "city_id", "cla_id").join(sessions, ["cla_id", "city_id"]),
                              sc.registered_sessions(regs))
    keys = ["sid", "city_id", "cla_id"]
    assert free.join(same.select(*keys), keys, "left_semi").count() == 0
    assert free.join(clash, keys, "left_semi").count() == 0
    # and everything kept comes from the rule match
    assert free.join(recs, keys, "left_anti").count() == 0


def test_all_sessions_is_stricter(flow):
    t, _, recs, free = flow
    strict = prec.conflict_free(t, recs, fx.AS_OF, all_sessions=True)
    assert strict.join(free, ["sid", "city_id", "cla_id"], "left_anti").count() == 0
