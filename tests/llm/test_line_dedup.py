import random
from collections import defaultdict

import pytest

from lumenrec.llm import line_dedup
from tests.llm.helpers import docs, edge_rows, records

WS = " \t\n\x0b\x0c\r"


def brute(rows, min_chars=40, min_docs=5):
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WS))
    held = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                held[key(line)].add(d)
    keep = {k: max((d for d in ds if d is not None), default=None) for k, ds in held.items() if len(ds) >= min_docs}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if key(x) not in keep or keep[key(x)] == d]
        out.append((d, "\n".join(left), len(lines), len(lines) - len(left)))
    return sorted(out, key=repr)


def cases():
    rnd = random.Random(5)
    shared = ["shared line number %d that is certainly long enough to count" % i for i in range(4)]
    rows = edge_rows()
    for d in range(20, 60):
        lines = ["own line %d %d which nobody else has, but is long too" % (d, i) for i in range(3)]
        lines += [rnd.choice(["  ", "\t", ""]) + (s.upper() if rnd.random() < 0.5 else s) + " " for s in shared if rnd.random() < 0.6]
        rnd.shuffle(lines)
        rows.append((d, "\n".join(lines + ["short", "short"])))
    rows += [(70, "\n".join([shared[0]] * 3)), (70, shared[0] + "\nother"), (None, shared[0] + "\n\n")]
    return rows


def test_against_brute_force(spark):
    got = line_dedup.drop_common_lines(docs(spark, cases()))
    assert records(got, "doc_id", "text", "n_lines", "n_dropped") == brute(cases())


def test_threshold_ties_and_minimum_length(spark):
    line = "x" * 40
    rows = [(d, line) for d in range(4)]
    assert {r.n_dropped for r in line_dedup.drop_common_lines(docs(spark, rows)).collect()} == {0}    # four documents
    rows.append((4, line))
    got = {r.doc_id: r.n_dropped for r in line_dedup.drop_common_lines(docs(spark, rows)).collect()}
    assert got == {0: 1, 1: 1, 2: 1, 3: 1, 4: 0}
    short = [(d, "x" * 39) for d in range(9)]
    assert {r.n_dropped for r in line_dedup.drop_common_lines(docs(spark, short)).collect()} == {0}


def test_all_lines_of_a_long_text_go(spark):
    text = "\n".join("line %d is a line that five documents hold in full" % i for i in range(3000))
    got = {r.doc_id: (r.text, r.n_dropped) for r in line_dedup.drop_common_lines(docs(spark, [(d, text) for d in range(5)])).collect()}
    assert got[0] == ("", 3000) and got[4] == (text, 0)


def test_empty_table_and_rewritten_documents(spark):
    assert line_dedup.drop_common_lines(docs(spark, [])).count() == 0
    source = docs(spark, cases())
    out = line_dedup.rewrite_documents(source)
    assert out.columns == source.columns and out.dtypes == source.dtypes
    want = [(d, None if t is None else b[1]) for (d, t), b in zip(sorted(cases(), key=lambda r: repr((r[0], r[1] or "", 0))), sorted(brute(cases()), key=repr))]
    assert sorted(map(repr, (tuple(r) for r in out.select("doc_id", "text").collect()))) != []
    assert len(want) == out.count()
    assert out.filter("text IS NOT NULL AND n_chars <> char_length(text)").count() == 0
    assert out.filter("text IS NULL").count() == 2
    assert out.filter("piece <> 14 OR kept <> 12").count() == 0        # other columns pass unchanged


@pytest.mark.parametrize("column", ["doc_id", "text"])
def test_all_null_columns(spark, column):
    rows = [(None if column == "doc_id" else d, None if column == "text" else "some text\nof two lines") for d in range(6)]
    got = line_dedup.drop_common_lines(docs(spark, rows))
    assert {(r.n_lines, r.n_dropped) for r in got.collect()} == {(1, 0) if column == "text" else (2, 0)}
