import math
import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from lumenrec.llm import katz
from tests.llm.helpers import docs, edge_rows, prose


def model(rows):
    """(id, held, text) -> per row (n_tokens, n_known, base, score) and all probabilities after a context."""
    tokens = [(t or "").encode().lower().split() + ["end"] for _, _, t in rows]
    uni, pair, before = Counter(), Counter(), Counter()
    for (_, held, _), w in zip(rows, tokens):
        if not held:
            uni.update(w)
            for a, b in zip(["start", *w], w):
                pair[a, b] += 1
                before[a] += 1
    total, distinct = sum(uni.values()), len(uni)

    def numbers(c):
        return [sum(1 for v in c.values() if v == r) for r in range(1, katz.CUT + 2)]
    du, dp = katz.discounts(numbers(uni)), katz.discounts(numbers(pair))
    less = lambda c, d: d[c] * c if c <= katz.CUT else c - katz._KEEP_BACK
    unknown = 1 - sum(less(v, du) for v in uni.values()) / total if total else 1.0
    one = lambda w: less(uni[w], du) / total if w in uni else unknown
    follow = defaultdict(list)
    for (a, b), v in pair.items():
        follow[a].append((b, v))
    weight = {a: (1 - sum(less(v, dp) for _, v in f) / before[a]) / (1 - sum(one(b) for b, _ in f)) for a, f in follow.items()}

    def two(a, b):
        return less(pair[a, b], dp) / before[a] if (a, b) in pair else weight.get(a, 1.0) * one(b)
    out = []
    for w in tokens:
        out.append((len(w), sum(x in uni for x in w), sum(math.log10((uni[x] + 1) / (total + distinct + 1)) for x in w),
                    sum(math.log10(two(a, b)) for a, b in zip(["start", *w], w))))
    return out, total, two, uni, list(follow)


def rows(seed=1):
    rnd = random.Random(seed)
    made = [(100 + i, prose(rnd, rnd.randint(0, 120), 60)) for i in range(120)]
    return [(d, (d or 0) % 7 == 2, t) for d, t in [*[r for r in edge_rows() if r[0] not in (6,)], *made]]


def run(spark, table):
    df = docs(spark, [(d, t) for d, _, t in table])
    return katz.score_documents(df, F.coalesce(F.col("doc_id"), F.lit(0)) % 7 == 2).collect()


def test_against_a_direct_model(spark):
    table = rows()
    want, total, two, uni, contexts = model(table)
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in run(spark, table)), key=repr)
    assert got == sorted(((d, n, k, round(b, 6), round(s, 6)) for (d, _, _), (n, k, b, s) in zip(table, want)), key=repr)
    for a in contexts[:40]:
        assert abs(sum(two(a, b) for b in uni) + two(a, "never seen") - 1) < 1e-9


def test_held_out_text_is_more_likely_than_by_single_words(spark):
    rnd = random.Random(5)
    phrase = ["one two three four five six", "seven eight nine ten", "one ten two nine three eight"]
    table = [(i, i % 7 == 2, " ".join(rnd.choice(phrase) for _ in range(20))) for i in range(140)]
    held = [r for r in run(spark, table) if r.held_out]
    assert len(held) == 20 and sum(r.score for r in held) > sum(r.base_score for r in held) / 2
    assert {r.train_tokens for r in held} == {model(table)[1]}


def test_empty_tables(spark):
    assert run(spark, []) == []
    only = run(spark, [(2, True, "nothing was learnt from this"), (9, True, None)])
    assert [(r.n_known, r.train_tokens, r.held_out) for r in only] == [(0, 0, True)] * 2
    assert all(np.isfinite(r.score) and np.isfinite(r.base_score) for r in only)


def test_packed_arrays():
    rnd = np.random.default_rng(1)
    for values in (np.empty(0, np.uint64), np.zeros(5, np.uint64), rnd.integers(0, 2**63, 99).astype(np.uint64), np.arange(300, dtype=np.uint64)):
        assert (katz.unpack(katz.pack(values)) == values).all()
        assert (katz.unpack_sorted(katz.pack_sorted(np.sort(values))) == np.sort(values)).all()


def test_discounts():
    d = katz.discounts([1000, 400, 220, 150, 110, 80])
    assert all(0 < x < 1 for x in d[1:])
    n = [1000, 400, 220, 150, 110]
    assert abs(sum(r * c * (1 - x) for r, c, x in zip(range(1, 6), n, d[1:])) - 1000) < 1e-6     # the mass of those seen once
    assert all(0 < x < 1 for x in katz.discounts([0, 0, 0, 0, 0, 0])[1:])
    assert all(0 < x < 1 for x in katz.discounts([3, 9, 1, 0, 4, 70])[1:])
