"""Random equivalence against plain-Python loops that follow the original jobs."""

import random

from pyspark.sql import functions as F

from lumenrec import schemas
from lumenrec.operators import schedule as sc
from lumenrec.operators.ranking import recent_distinct
from tests.conftest import rows


def test_recent_distinct_equals_walk(spark):
    rnd = random.Random(7)
    data = [(f"s{rnd.randrange(30)}", f"t{rnd.randrange(8)}", f"2018-01-{rnd.randrange(1, 29):02d}")
            for _ in range(600)]
    df = spark.createDataFrame(data, "sid string, token string, day string")
    got = {}
    for r in recent_distinct(df, "sid", "token", "day").collect():
        got.setdefault(r.sid, []).append((r["rank"], r.token))
    got = {k: [t for _, t in sorted(v)] for k, v in got.items()}
    # the original's walk: newest first (ties by token), skip repeats, stop at three
    want = {}
    for sid in {d[0] for d in data}:
        walk = sorted((d for d in data if d[0] == sid), key=lambda d: (d[2], [-ord(c) for c in d[1]]), reverse=True)
        out = []
        for _, tok, _ in walk:
            if tok not in out and len(out) < 3:
                out.append(tok)
        want[sid] = out
    assert got == want


def _minute(m):
    return f"{m // 60:02d}:{m % 60:02d}"


def test_conflict_check_equals_nested_loop(spark):
    rnd = random.Random(11)
    dates = ["2001-03-01", "2001-03-02", "2001-03-03"]
    recs, regs = [], []
    for i in range(400):
        s = rnd.randrange(420, 1200)
        recs.append((f"s{rnd.randrange(12)}", "c1", f"k{i % 60}", rnd.choice(dates), _minute(s), _minute(s + rnd.randrange(0, 180))))
    for i in range(200):
        s = rnd.randrange(420, 1200)
        # a few inverted intervals (start after end): the closed-overlap test still applies
        e = s + rnd.randrange(0, 180) if i % 10 else s - rnd.randrange(1, 60)
        regs.append((f"s{rnd.randrange(12)}", "c1", f"r{i}", rnd.choice(dates), _minute(s), _minute(e), True))
    r = spark.createDataFrame(recs, "sid string, city_id string, cla_id string, d string, st string, et string")
    f = spark.createDataFrame(regs, "sid string, city_id string, cla_id string, d string, st string, et string, ok boolean")
    got = rows(sc.conflict_flags(r, f).filter("conflict"), "sid", "cla_id", "d", "st", "et")
    want = sorted({(a[0], a[2], a[3], a[4], a[5]) for a in recs for b in regs
                   if a[0] == b[0] and a[3] == b[3] and not (a[4] > b[5] or b[4] > a[5])})
    assert got == want
    # and the pairwise semi-join gives the same set
    pair = rows(sc.time_conflicts(r, f), "sid", "city_id", "cla_id")
    assert pair == sorted({(a[0], a[1], a[2]) for a in recs for b in regs
                           if a[0] == b[0] and a[3] == b[3] and not (a[4] > b[5] or b[4] > a[5])})


def test_binary_search_of_booked_times_equals_pairs(spark):
    """Inverted intervals, equal starts, several dates; registrations without sessions."""
    rnd = random.Random(12)

    def time():
        return f"{rnd.randrange(24):02d}:{rnd.choice('0135')}0"

    regs, recs = [], []
    for i in range(400):
        n = rnd.randrange(4)
        days = [f"2001-03-0{rnd.randrange(1, 6)}" for _ in range(n)]
        regs.append((f"s{i % 9}", f"r{i}", "1", "x", "2017", "1", "0", "c", "\u0001".join(days),
                     "\u0002".join(time() for _ in days), "\u0003".join(time() for _ in days)))
    for i in range(600):
        recs.append((f"s{i % 10}", "c", f"k{i}", f"2001-03-0{rnd.randrange(1, 6)}", time(), time()))
    reg = spark.createDataFrame(regs, schemas.REGISTER)
    rec = spark.createDataFrame(recs, "sid string, city_id string, cla_id string, d string, st string, et string")
    for every in (False, True):
        want = sorted(tuple(r) for r in sc.time_conflicts(rec, sc.registered_sessions(reg, every)).collect())
        j = rec.join(sc.student_register(reg, every), ["sid", "city_id"], "left")
        got = j.filter(F.coalesce(sc.overlaps_booked("booked", "d", "st", "et"), F.lit(False))).select("sid", "city_id", "cla_id")
        assert sorted(tuple(r) for r in got.collect()) == want


def test_one_student_with_ten_thousand_registrations(spark):
    """Three sessions each on three years of days: one bounded row, found by binary search."""
    import datetime
    import time as clock
    day = datetime.date(2001, 1, 2)
    regs = spark.range(10_000).select(
        F.lit("s").alias("sid"), F.concat(F.lit("r"), "id").alias("cla_id"), F.lit("1").alias("cla_term_id"), F.lit("x").alias("cla_subject_names"),
        F.lit("2017").alias("year"), F.lit("1").alias("reg_ispay"), F.lit("0").alias("reg_isdeleted"), F.lit("c").alias("city_id"),
        F.array_join(F.transform(F.sequence(F.lit(0), F.lit(2)), lambda k: F.date_add(F.lit(day), (F.col("id") * 3 + k).cast("int") % 1000)
                                 .cast("string")), "\u0001").alias("class_dates"),
        F.lit("09:00\u000209:30\u000210:00").alias("start_times"), F.lit("09:20\u000310:10\u000310:30").alias("end_times"))
    recs = spark.range(20_000).select(F.lit("s").alias("sid"), F.lit("c").alias("city_id"), F.concat(F.lit("k"), "id").alias("cla_id"),
                                      F.date_add(F.lit(day), F.col("id").cast("int") % 1200).cast("string").alias("d"),
                                      F.when(F.col("id") % 2 == 0, "09:10").otherwise("10:40").alias("st"),
                                      F.when(F.col("id") % 2 == 0, "09:15").otherwise("10:50").alias("et"))
    t0 = clock.perf_counter()
    j = recs.join(sc.student_register(regs), ["sid", "city_id"])
    got = j.filter(sc.overlaps_booked("booked", "d", "st", "et")).count()
    took = clock.perf_counter() - t0
    assert got == sc.time_conflicts(recs, sc.registered_sessions(regs)).count() > 0
    assert took < 60


def test_rule_match_equals_loops(spark):
    """Random lists, rules with up to four tokens, repeated and empty ones, locations in several rows."""
    import json

    from lumenrec.plans import rules as pr

    rnd = random.Random(31)
    tok = ["a", "b", "c", "d", "e", ""]
    tokens = [(f"s{i}", f"c{i % 3}", f"g{i % 2}", rnd.sample(tok[:5], k) + [""] * (3 - k), "d") for i in range(60) for k in [rnd.randrange(4)]]
    places = ["L0", "L1", "L2", pr.LIVE_KEY]
    rules = [(f"c{rnd.randrange(3)}", f"g{rnd.randrange(2)}", rnd.choice([None, [], [rnd.choice(tok) for _ in range(rnd.randrange(1, 5))]]),
              json.dumps({p: [str(rnd.randrange(30)) for _ in range(rnd.randrange(3))] + rnd.choice([[], [""]]) for p in rnd.sample(places, rnd.randrange(1, 4))}))
             for _ in range(80)]
    where = [(f"s{rnd.randrange(70)}", f"c{rnd.randrange(3)}", rnd.choice([None, "L0", "L1,L2", "L2,", "nowhere"])) for _ in range(150)]
    want = set()
    for sid, city, grade, have, _ in tokens:
        mine = {p for s, c, d in where if (s, c) == (sid, city) for p in [*(d or "").rstrip(",").split(","), pr.LIVE_KEY]}
        for c, g, left, recall in rules:
            if (c, g) == (city, grade) and left is not None and set(left) <= set(have):
                want |= {(sid, city, k) for p, ks in json.loads(recall).items() if p in mine for k in ks if k}
    got = pr.rule_match(spark.createDataFrame(tokens, schemas.TOKENS),
                        spark.createDataFrame(rules, "city_id string, grade_id string, left array<string>, recall string"),
                        spark.createDataFrame(where, "sid string, city_id string, depart_4 string"))
    assert rows(got) == sorted(want) and len(want) > 100
