"""Small document tables with the cases every operator must take."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use themselves
CLASHING = ["id", "tk", "key", "h", "pos", "lines", "rest", "spans", "base", "node", "regs", "n_words", "kept", "words",
            "piece", "length", "sequence_id", "ids", "chunk", "held", "score", "kind", "text_", "g", "d2", "view"]


def docs(spark, rows, clash=True):
    """rows: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(r[0], r[1], *(r[2:] if len(r) > 2 else ("en", "s")), len(r[1]) if r[1] is not None else None) for r in rows]
    df = spark.createDataFrame(full, SCHEMA)
    return df.withColumns({c: F.lit(i) for i, c in enumerate(CLASHING)}) if clash else df


def prose(rnd, n, vocabulary=400):
    """n made-up words with lines and full stops."""
    words = ["".join(chr(97 + (v * k) % 26) for k in (1, 3, 7, 11)[: 2 + v % 3]) + str(v)[:0] for v in range(1, vocabulary)]
    out = []
    for i in range(n):
        out.append(rnd.choice(words) + (".\n" if i % 23 == 22 else "." if i % 11 == 10 else ""))
    return " ".join(out)


def edge_rows(seed=1):
    """Nulls, empty and very long texts, ties, repeated rows, odd characters."""
    rnd = random.Random(seed)
    same = prose(rnd, 60)
    return [(1, same), (1, same), (2, same), (3, None), (4, ""), (None, same), (None, None), (5, " \t\n\x0b\x0c\r "),
            (6, prose(rnd, 30_000, 3000)), (7, "word"), (8, "a b c d"), (9, "é ü 😀 中文  x \x1c y"), (10, "A" * 5000),
            (11, "x\n" * 300), (12, prose(rnd, 90)), (13, prose(rnd, 90))]


def records(df, *columns):
    """Rows of the columns as a list that sorts with nulls."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
