"""Property tests: the Column functions agree with a plain-Python statement of
the original rules on generated inputs (keywords, line breaks, nulls)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lumenrec import functions as fn
from lumenrec.functions.text import LEVEL_TAGS, SUBJECT_CODES
from lumenrec.functions.weights import PRICE_DIVISORS, STATUS_WEIGHTS

PIECES = [kw for kw, _ in LEVEL_TAGS] + [kw for kw, _ in SUBJECT_CODES] + ["班", "a", " ", "\n", "\r", "\u2028", "初三"]
texts = st.one_of(st.none(), st.lists(st.sampled_from(PIECES), max_size=5).map("".join))
LINE_BREAKS = "\n\r\u0085\u2028\u2029"


def first_hit(text, pairs, default):
    """``text matches .*kw.*`` for the first keyword; '.' never crosses a line break."""
    if text is None or any(c in text for c in LINE_BREAKS):
        return default
    for kw, out in pairs:
        if kw in text:
            return out
    return default


def status_weight(s):
    return dict(STATUS_WEIGHTS).get(0 if s is None else s, 1.0)


def price_weight(s, p):
    s, p = (0 if s is None else s), (0.0 if p is None else p)
    if s == 3:
        return p / 1000.0
    div = dict(PRICE_DIVISORS).get(s)
    if div is None:
        return 0.0
    return p if p < 1000 else p / div


SETTINGS = settings(max_examples=40, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(texts, min_size=1, max_size=30))
def test_keyword_functions(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x string")
    got = df.select(fn.level_tag("x"), fn.subject_code("x"), fn.subject_rule_name("x")).collect()
    for v, (lev, sub, rule) in zip(values, got):
        assert lev == first_hit(v, LEVEL_TAGS, "0")
        assert sub == first_hit(v, SUBJECT_CODES, "other")
        assert rule == first_hit(v, [(k, k) for k, _ in SUBJECT_CODES], "其他")


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-1, 5)),
                          st.one_of(st.none(), st.floats(0, 1e6, allow_nan=False))), min_size=1, max_size=30))
def test_weights(spark, pairs):
    df = spark.createDataFrame(pairs, "s int, p double")
    got = df.select(fn.status_weight("s"), fn.price_weight("s", "p")).collect()
    for (s, p), (w, pw) in zip(pairs, got):
        assert w == status_weight(s)
        assert abs(pw - price_weight(s, p)) <= 1e-9 * max(1.0, abs(pw))


times = st.integers(0, 24 * 60 - 1).map(lambda m: f"{m // 60:02d}:{m % 60:02d}")


@SETTINGS
@given(st.lists(st.tuples(times, times, times, times), min_size=1, max_size=30))
def test_overlap_is_time_cover(spark, quads):
    df = spark.createDataFrame(quads, "fs string, fe string, rs string, re string")
    got = [r[0] for r in df.select(fn.intervals_overlap("fs", "fe", "rs", "re")).collect()]
    assert got == [not (rs > fe or fs > re) for fs, fe, rs, re in quads]
