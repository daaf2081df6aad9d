import math
import random
import re
from collections import Counter, defaultdict

from lumenrec.llm import pii
from tests.llm.helpers import docs, edge_rows, prose


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def brute(t):
    t, out = t or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, "phone", m.end()))
    return sorted(out)


def found(spark, rows, column="base", **options):
    got = pii.find_personal_data(docs(spark, rows), **options).collect()
    return {r.doc_id: [(s.start, s.ord, s.kind, s.end) for s in r[column]] for r in got}


def test_formats_against_brute_force(spark):
    rnd = random.Random(4)
    bits = ["a@b.co", "x.y+z%1@m-1.example.com", "@", "a@b", "a@b.c_d@e.f", "..@x.y.", "1.2.3.4", "255.255.255.255", "256.1.1.1",
            "0001.0002.3.4", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111112", "1234",
            "79927398713000000018", "+1 (555) 123-4567", "+1 2", "+123456789", "+1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6", "😀", "é", "\n",
            " ", ".", "-", "+", "12", "(", "中"]
    rows = [(i, "".join(rnd.choice(bits) + rnd.choice(["", "", " "]) for _ in range(rnd.randint(0, 25)))) for i in range(400)]
    got = found(spark, rows)
    assert {d: brute(t) for d, t in rows} == got


def test_edges(spark):
    rows = [r for r in edge_rows() if r[0] not in (None, 1)] + [(90, "a" * 100_000), (91, "1" * 100_000), (92, "1 " * 30_000),
                                                               (93, "7.8.9.1 " * 5000), (94, "a@b.cc\n" * 3000)]
    got = found(spark, rows)
    assert {d: brute(t) for d, t in rows} == got


def test_nulls_repeats_and_empty_table(spark):
    mail = "write to a.b@c.org now"
    out = pii.find_personal_data(docs(spark, [(None, mail), (1, mail), (1, mail), (1, "none"), (2, None)]))
    assert sorted((str(r.doc_id), r.n_email, len(r.spans)) for r in out.collect()) == [
        ("1", 0, 0), ("1", 1, 1), ("1", 1, 1), ("2", 0, 0), ("None", 1, 1)]
    assert pii.find_personal_data(docs(spark, [])).count() == 0


def test_contexts_reveal_unseen_identifiers(spark):
    rnd = random.Random(9)
    rows = [(i, f"{prose(rnd, 30)} mailto: user{i}@host.example.com {prose(rnd, 20)}") for i in range(30)]
    rows += [(100 + i, f"{prose(rnd, 30)} mailto: user{i}(at)host-{i} {prose(rnd, 20)}") for i in range(8)]
    rows += [(200 + i, f"{prose(rnd, 30)} the 1{i}23456th of them {prose(rnd, 9)}") for i in range(40)]
    texts = dict(rows)
    got = found(spark, rows, "spans", min_score=0.75)
    for i in range(8):
        spans = [texts[100 + i][a:e] for a, _, kind, e in got[100 + i] if kind == "context"]
        assert spans == [f"user{i}(at)host-{i}"]
    # an ordinary word in front of numbers is no pattern
    assert not any(kind == "context" for i in range(40) for _, _, kind, _ in got[200 + i])


def test_discovered_identifiers_make_patterns(spark):
    rnd = random.Random(12)
    fill = lambda n: " ".join(f"w{'abcdefgh'[rnd.randrange(8)]}{'ijklmnop'[rnd.randrange(8)]}" for _ in range(n))
    rows = [(i, f"{fill(9)} mailto: user{i}@host.example.com") for i in range(100)]
    rows += [(200 + i, f"{fill(9)} mailto: first{i}(at)host") for i in range(8)]
    rows += [(300 + i, f"{fill(9)} handle: first{i % 8}(at)host") for i in range(40)]
    rows += [(400 + i, f"{fill(9)} handle: second{i}(at)host") for i in range(2)]          # beside no seed anywhere
    rows += [(500 + i, f"{fill(9)} ordinary user{i}@host.example.com") for i in range(6)]
    rows += [(510 + i, f"{fill(9)} ordinary word") for i in range(30)]
    rows += [(600, f"{fill(9)} ordinary first0(at)host")]                                  # beside an ordinary word
    rows += [(700, f"{fill(9)} handle: plain")]
    texts = dict(rows)
    got = found(spark, rows, "spans")
    context = {i: [texts[i][a:e] for a, _, kind, e in spans if kind == "context"] for i, spans in got.items()}
    want = {i: [] for i in texts}
    want |= {i: [texts[i].split(" ")[-1]] for i in texts if 200 <= i < 500}
    assert context == want


def brute_context(rows, support=5, confidence=0.5, least=0.9, rounds=3):
    """The bootstrap by loops and dictionaries over (key, text): the contextual spans of each key."""
    low = lambda w: re.sub("[A-Z]", lambda m: m[0].lower(), w)
    uses, cands, known = Counter(), [], set()
    seeds = {k: [(a, e) for a, _, _, e in brute(t)] for k, t in rows}
    for k, t in rows:
        words = [(m.start(), m.end(), m[0]) for m in re.finditer(r"[^\x20\x09-\x0D]+", t or "")]
        uses.update(low(w) for _, _, w in words)
        uses.update(low(a[2]) + " " + low(b[2]) for a, b in zip(words, words[1:]))
        is_cand = [bool(re.search("[0-9@]", w)) for _, _, w in words]
        for i, (a, e, w) in enumerate(words):
            if not is_cand[i] or len(w) < 6:
                continue
            slots = []
            if i and not is_cand[i - 1]:
                slots.append(("L", low(words[i - 1][2])))
                if i > 1 and not is_cand[i - 2]:
                    slots.append(("L", low(words[i - 2][2]) + " " + slots[0][1]))
            if i + 1 < len(words) and not is_cand[i + 1]:
                slots.append(("R", low(words[i + 1][2])))
                if i + 2 < len(words) and not is_cand[i + 2]:
                    slots.append(("R", low(words[i + 1][2]) + " " + low(words[i + 2][2])))
            cands.append((k, a, e, w, slots))
            if any(a < e2 and a2 < e for a2, e2 in seeds[k]):
                known.add(w)
    edges = Counter((s, w) for _, _, _, w, slots in cands for s in slots)
    score, good = {w: 1.0 for w in known}, {}
    for _ in range(rounds):
        mass, sup = Counter(), Counter()
        for (slot, w), n in edges.items():
            if w in score:
                mass[slot] += n * score[w]
                sup[slot] += score[w] >= least
        good = {p: mass[p] / uses[p[1]] for p in mass if sup[p] >= support and mass[p] / uses[p[1]] >= confidence}
        doubt = defaultdict(float)
        for p, w in edges:
            if p in good and w not in known:
                doubt[w] += math.log(1 - min(good[p], 0.999) + 1e-9)
        score = {w: 1.0 for w in known} | {w: 1 - math.exp(d) for w, d in doubt.items()}
    out = defaultdict(set)
    for k, a, e, w, slots in cands:
        if w not in known and score.get(w, 0) >= least and any(s in good for s in slots) and not any(a < e2 and a2 < e for a2, e2 in seeds[k]):
            out[k].add((a, e))
    return {k: sorted(v) for k, v in out.items()}


def test_bootstrap_against_brute_force(spark):
    """Random prose with one- and two-word slots, identifiers shared between slots, candidates side by side."""
    rnd = random.Random(21)
    plain = [f"w{chr(97 + i)}" for i in range(20)]
    slots = ["call me at", "my id is", "account no", "tel", "user name"]
    rows = []
    for i in range(400):
        words = [rnd.choice(plain) for _ in range(rnd.randrange(3, 25))]
        for _ in range(rnd.randrange(3)):
            ident = rnd.choice([f"+49 30 {rnd.randrange(10**7, 10**8)}", f"u{rnd.randrange(40)}@host.example.com", f"id-{rnd.randrange(60):05d}",
                                f"X{rnd.randrange(30)}(at)x", f"{rnd.randrange(100, 999)}",
                                *[f"v{rnd.randrange(400)}@mail.example.org"] * 5])
            at = rnd.randrange(len(words))
            words[at:at] = [*rnd.choice(slots).split(" "), ident, *rnd.choice(["", "please write", "bye"]).split()]
        rows.append((i, " ".join(words) + rnd.choice(["", "\n", " \t"])))
    got = {k: sorted((a, e) for a, _, kind, e in spans if kind == "context") for k, spans in found(spark, rows, "spans").items()}
    want = brute_context(rows)
    assert {k: v for k, v in got.items() if v} == want and sum(map(len, want.values())) > 20


def test_two_words_before_a_slot_reveal_what_one_word_does_not(spark):
    rnd = random.Random(2)
    fill = lambda n: " ".join(f"w{'abcdefgh'[rnd.randrange(8)]}" for _ in range(n))
    rows = [(i, f"{fill(5)} write to user{i}@host.example.com {fill(4)}") for i in range(30)]
    rows += [(100 + i, f"{fill(5)} to {fill(5)}") for i in range(200)]                    # one word says nothing
    rows += [(400 + i, f"{fill(5)} write to staff-{i}00 {fill(3)}") for i in range(3)]
    texts = dict(rows)
    got = found(spark, rows, "spans")
    context = {i: [texts[i][a:e] for a, _, kind, e in spans if kind == "context"] for i, spans in got.items()}
    assert {i: c for i, c in context.items() if c} == {400 + i: [f"staff-{i}00"] for i in range(3)}


def test_spans_of_one_text_are_compared_in_blocks(spark):
    """Forty thousand e-mails in one text: rows made by the join grow with the spans, not with their square."""
    text = " ".join(f"user{i}@host.example.com" for i in range(40_000))
    spans = pii.formatted(spark.createDataFrame([(1, text)], "key int, text string"), ["key"]).filter("kind = 'email'")
    spans = spark.createDataFrame(spans.select("key", "start", "end").collect(), "key int, start int, end int")
    assert spans.count() == 40_000
    assert pii.touching(spans, spans).distinct().count() == 40_000
    pairs = pii._in_blocks(spans, "start", "end").join(pii._in_blocks(spans, "start", "end").selectExpr("key", "block", "start s"), ["key", "block"]).count()
    assert pairs < 40_000 * 60


def test_long_words_take_linear_time(spark):
    rows = [(1, "a" * 300_000 + " b"), (2, "x " + "é" * 300_000 + " 123456 " + "y" * 200_000), (3, "-" * 100_000 + "1")]
    got = found(spark, rows, "base")
    assert {k: [kind for _, _, kind, _ in v] for k, v in got.items()} == {1: [], 2: [], 3: []}


def test_plan_is_native(spark):
    plan = pii.find_personal_data(docs(spark, [(1, "a@b.cc")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
