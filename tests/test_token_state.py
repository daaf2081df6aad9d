"""Token state (WN2, PL5): merged day by day, equal to the full computation."""

import datetime as dt
import random

from lumenrec import schemas
from lumenrec.plans import rules as pr
from lumenrec.plans import token_state as ts
from tests.conftest import rows
from tests.helpers import tables

AFTER = "2018-01-01"
SUBJECTS = ["数学", "英语", "物理", "化学", "语文", "生物"]


def _fixed(spark):
    return dict(
        student=[(f"s{i}", f"u{i}", "c1", "g1") for i in range(12)], user=[(f"u{i}",) for i in range(11)],
        klass=[(f"k{i}", "c1", "g1", str(1 + i % 5), SUBJECTS[i % 6], "x", "1", "2017") for i in range(14)])


def _regs(spark, some):
    return spark.createDataFrame([(s, k, dt.date.fromisoformat(d), p, x) for s, k, d, p, x in some], schemas.REGIST)


def test_thirty_days_of_inserts_and_deletions(spark, tmp_path):
    """Inserts of the day or late, deletions of any age, rows that never count; the state is written each day."""
    rnd = random.Random(17)
    fixed = _fixed(spark)
    table, state = [], None
    for day in range(30):
        today = dt.date(2018, 3, 1) + dt.timedelta(day)
        new = [(f"s{rnd.randrange(12)}", f"k{rnd.randrange(14)}", str(today - dt.timedelta(rnd.choice((0, 0, 0, 3, 40)))),
                rnd.choice((1, 1, 2, 0)), 0) for _ in range(rnd.randrange(7))]
        gone = [table.pop(rnd.randrange(len(table))) for _ in range(rnd.randrange(3)) if table]
        table += new
        t = tables(spark, regist=table, **fixed)
        if state is None:
            out = ts.token_state(t, AFTER)
        else:
            out = ts.advance(t, state, _regs(spark, new), _regs(spark, gone), AFTER)
        path = str(tmp_path / f"day{day}")
        out.coalesce(2).write.parquet(path)
        state = spark.read.parquet(path)
        if day % 3 == 2 or day == 29:
            assert rows(state) == rows(ts.token_state(t, AFTER)), day
            assert rows(ts.state_lists(t, state, "d")) == rows(pr.student_tokens(t, AFTER, "d")), day


def test_deletion_brings_an_older_token_back(spark):
    fixed = _fixed(spark)
    table = [("s1", f"k{i}", f"2018-02-0{i + 1}", 1, 0) for i in range(5)]
    state = ts.token_state(tables(spark, regist=table, **fixed), AFTER)
    after = tables(spark, regist=table[:4], **fixed)
    got = ts.advance(after, state, _regs(spark, []), _regs(spark, table[4:]), AFTER)
    assert [r.token for r in got.orderBy("latest").collect()] == ["英语_2", "物理_3", "化学_4"]
    unchanged = ts.advance(after, state, _regs(spark, []), _regs(spark, []), AFTER)
    assert rows(unchanged) == rows(state)


def test_empty_state_and_student_without_rest(spark):
    fixed = _fixed(spark)
    none = tables(spark, regist=[], **fixed)
    state = ts.token_state(none, AFTER)
    assert rows(state) == []
    one = [("s1", "k1", "2018-02-01", 1, 0)]
    got = ts.advance(tables(spark, regist=one, **fixed), state, _regs(spark, one), _regs(spark, []), AFTER)
    assert [(r.sid, r.token) for r in got.collect()] == [("s1", "英语_2")]
    assert rows(ts.advance(none, got, _regs(spark, []), _regs(spark, one), AFTER)) == []
