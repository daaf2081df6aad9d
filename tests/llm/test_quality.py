import math
import random
import re
from collections import Counter

import numpy as np

from lumenrec.llm import quality
from lumenrec.llm.common import Scratch
from tests.llm.helpers import docs, edge_rows, prose, records

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {j for i in range(len(w) - 7) if windows[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered),
            len(w) < 20 or 100 * len(covered) > 30 * len(w))


def rows():
    rnd = random.Random(2)
    out = edge_rows()
    passage = prose(rnd, 25)
    out += [(20, passage + " " + prose(rnd, 40) + " " + passage), (21, "to be " * 40), (22, " ".join("abcdefgh" * 2)),
            (23, "a b c d e f g h a b c d e f g h a b c d e f g h"), (24, "#$% & | < > *" + passage)]
    return out + [(100 + i, prose(rnd, 80 + i), "de" if i % 3 else None, f"s{i % 2}" if i % 5 else None) for i in range(60)]


def test_statistics_against_brute_force(spark):
    got = quality.quality_rules(docs(spark, rows()))
    want = sorted(((r[0], *brute(r[1])) for r in rows()), key=repr)
    assert records(got, "doc_id", *STATS) == want


def test_very_long_repetition(spark):
    text = " ".join(["one two three four five six seven eight nine"] * 3000)
    r = quality.quality_rules(docs(spark, [(1, text)])).first()
    assert (r.n_words, r.n_repeat_words, r.kept) == (27_000, 27_000, False)


def test_outliers_go_and_clean_texts_stay(spark):
    rnd = random.Random(7)
    clean = [(i, prose(rnd, rnd.randint(25, 600)), ("en", "de")[i % 2], f"s{i % 3}") for i in range(400)]
    odd = [(1000 + i, " ".join(w + "***" for w in prose(rnd, 120).split()), "en", "s0") for i in range(12)]
    odd += [(1100 + i, prose(rnd, 120).upper().replace(" ", "!! "), "de", "s1") for i in range(12)]
    kept = {r.doc_id: r.kept for r in quality.quality_rules(docs(spark, clean + odd)).collect()}
    assert all(kept[i] for i, *_ in clean)
    assert not any(kept[i] for i, *_ in odd)


def test_distance_is_that_of_the_estimate(spark):
    """One concentration step from given medians: numpy gives the same distances."""
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=(500, 6)) @ np.diag([0.1, 0.4, 0.2, 0.6, 0.1, 0.5]) + 2
    x[:20] += 9
    df = spark.createDataFrame([("g", *map(float, r)) for r in x], "g string, " + ", ".join(f"x{i} double" for i in range(6)))
    got = quality.mcd_distance(df, Scratch(spark, "test"), steps=3, prior=0.0)
    floor = np.array(list(quality.FEATURES.values()))
    med = np.median(x, axis=0)
    mad = np.median(abs(x - med), axis=0)
    d2 = (((x - med) / np.maximum(1.4826 * mad, floor)) ** 2).sum(axis=1)
    share = 0.75
    cut = quality.chi2_quantile(share, 6)
    factor = share / quality.chi2_cdf(cut, 8)
    for _ in range(3):
        near = x[np.argsort(d2)[: int(share * len(x)) + 3]]
        cov = factor * np.cov(near.T, bias=True) + np.diag(floor**2)
        diff = x - near.mean(axis=0)
        d2 = np.einsum("ij,jk,ik->i", diff, np.linalg.inv(cov), diff)
    mine = {tuple(round(v, 9) for v in r[1:7]): r["d2"] for r in got.collect()}
    ratio = [mine[tuple(round(float(v), 9) for v in r)] / d for r, d in zip(x, d2)]
    assert all(0.9 < q < 1.1 for q in ratio)


def test_chi_square():
    assert math.isclose(quality.chi2_cdf(quality.chi2_quantile(0.975, 6), 6), 0.975, rel_tol=1e-9)
    assert math.isclose(quality.chi2_quantile(0.95, 6), 12.5916, rel_tol=1e-4)


def test_empty_table_and_kept_rows(spark):
    assert quality.quality_rules(docs(spark, [])).count() == 0
    source = docs(spark, rows())
    out = quality.keep_good(source)
    verdict = records(quality.quality_rules(source).filter("kept"), "doc_id")
    assert out.columns == source.columns and records(out, "doc_id") == verdict
    assert quality.keep_good(docs(spark, [])).count() == 0
