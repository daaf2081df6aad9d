"""Quality rules: text statistics, and robust multivariate outliers per language and source.

Everything is DataFrame or SQL functions.  The statistics come from arrays inside a row (no row
per word, no shuffle of texts); the estimates come from sums per group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD_CLASS, Scratch, row_key, without, words_of

# statistic -> smallest standard deviation taken for it: groups of clean text have near-constant
# statistics, and a distance in units of less than this would reject ordinary variation
FEATURES = {"x0": 0.15, "x1": 0.2, "x2": 0.3, "x3": 0.3, "x4": 0.2, "x5": 0.25}
_X = list(FEATURES)
_P = len(_X)
_BINS = 1024.0        # bins per unit of a statistic when medians are taken
_D_BINS = 64.0        # bins per factor e of a squared distance
_PACK = 20_000        # groups up to which the estimates (about 250 bytes a group) are broadcast


# ---------------------------------------------------------------- statistics of a text

def _pairwise(a: Column, shift: int) -> Column:
    """Hash of each element and the one ``shift`` places on."""
    m = F.greatest(F.size(a) - shift, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), m), F.slice(a, F.lit(shift + 1), m),
                      lambda x, y: F.xxhash64(x, y))


def _neighbours(a: Column, f) -> Column:
    m = F.greatest(F.size(a) - 1, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), m), F.slice(a, F.lit(2), m), f)


def _count_chars(text: Column, but: str) -> Column:
    """Code points that the negated class ``but`` does not match."""
    return F.char_length(F.regexp_replace(text, but, "")).cast("long")


def text_statistics(docs: DataFrame, keep: list[Column], text_col: str) -> DataFrame:
    """The columns ``keep`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    n_punct, n_upper of each row's text (null: no words).

    The 8-word windows are hashed by doubling (1, 2, 4, 8 words); only texts with a repeated
    window sort theirs, in O(n log n) inside the row.
    """
    names = [f"k{i}" for i in range(len(keep))]
    t = docs.select(*[c.alias(n) for c, n in zip(keep, names)],
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    t = t.select(*names, "text", words_of(F.col("text")).alias("words"),
                 F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD_CLASS)).alias("lines"))
    t = t.select(*names,
                 F.size("words").cast("long").alias("n_words"),
                 F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
                 _count_chars(F.col("text"), r"[^#*$%&|<>]+").alias("n_symbols"),
                 (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
                 _count_chars(F.col("text"), r"[^!-/:-@\[-`{-~]+").alias("n_punct"),
                 _count_chars(F.col("text"), r"[^A-Z]+").alias("n_upper"),
                 F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    plain = [*names, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_punct", "n_upper"]
    for shift in (1, 2, 4):
        t = t.select(*plain, _pairwise(F.col("h"), shift).alias("h"))
    t = t.select(*plain, "h", (F.size(F.array_distinct("h")) < F.size("h")).alias("again"))
    t = t.select(*plain, F.when(F.col("again"), F.sort_array(
        F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("s"))
    t = t.select(*plain, "s", _neighbours(F.col("s"), lambda a, b: a["h"] == b["h"]).alias("e"))
    no = F.array(F.lit(False))
    t = t.select(*plain, "s", F.zip_with(F.concat(no, "e"), F.concat("e", no), lambda a, b: a | b).alias("f"))
    t = t.select(*plain, F.sort_array(F.filter(
        F.zip_with("s", "f", lambda s, f: F.when(f, s["i"])), lambda i: i.isNotNull())).alias("p"))
    t = t.select(*plain, "p", _neighbours(F.col("p"), lambda a, b: F.least(F.lit(8), b - a)).alias("g"))
    covered = F.when(F.col("p").isNull(), F.lit(0)).otherwise(
        F.lit(8) + F.aggregate("g", F.lit(0), lambda a, b: a + b))
    return t.select(*plain, covered.cast("long").alias("n_repeat_words"))


def _transformed() -> list[Column]:
    chars, words = F.greatest(F.col("word_chars"), F.lit(1)), F.greatest(F.col("n_words"), F.lit(1))
    return [F.log1p(F.col("word_chars") / words).alias("x0"),
            F.log1p(50 * F.col("n_symbols") / chars).alias("x1"),
            F.log1p(10 * F.col("n_dup_lines") / words).alias("x2"),
            F.log1p(10 * F.col("n_repeat_words") / words).alias("x3"),
            F.log1p(10 * F.col("n_punct") / chars).alias("x4"),
            F.log1p(10 * F.col("n_upper") / chars).alias("x5")]


# ---------------------------------------------------------------- minimum covariance determinant

def chi2_cdf(x: float, p: int) -> float:
    """Chi-square distribution function for an even number of degrees of freedom."""
    term, total = 1.0, 1.0
    for i in range(1, p // 2):
        term *= x / 2 / i
        total += term
    return 1 - math.exp(-x / 2) * total


def chi2_quantile(q: float, p: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, p) < q else (lo, mid)
    return lo


def _bin_quantile(counts: DataFrame, keys: list[str], q: float) -> DataFrame:
    """Per key the first bin at which the running count reaches ``q`` of the total.

    ``counts`` has one row per key and bin; bins are bounded by the statistics' range, so a
    window holds that many rows and not the group's.
    """
    run = Window.partitionBy(*keys).orderBy("bin")
    every = Window.partitionBy(*keys)
    return (counts.select(*keys, "bin", F.sum("n").over(run).alias("run"), F.sum("n").over(every).alias("all"))
            .filter(F.col("run") >= q * F.col("all"))
            .groupBy(*keys).agg(F.min("bin").alias("bin")))


def _by_group(rows: DataFrame, params: DataFrame) -> DataFrame:
    """Rows with their group's estimates; broadcast only a counted, small number of groups."""
    if params.count() <= _PACK:
        params = F.broadcast(params)
    return rows.join(params, "g")


def _medians(rows: DataFrame, values: dict[str, Column], scratch: Scratch, name: str) -> DataFrame:
    """(g, <name>_<statistic>...) medians to within a bin."""
    stack = F.explode(F.array(*[F.struct(F.lit(x).alias("x"), F.floor(v * _BINS).alias("bin"))
                                for x, v in values.items()])).alias("s")
    counts = rows.select("g", stack).groupBy("g", "s.x", "s.bin").agg(F.count(F.lit(1)).alias("n"))
    med = _bin_quantile(counts, ["g", "x"], 0.5)
    return scratch.write(med.groupBy("g").agg(*[
        F.max(F.when(F.col("x") == x, (F.col("bin") + 0.5) / _BINS)).alias(f"{name}_{x}") for x in values]), name)


def _distance(rows: DataFrame) -> DataFrame:
    """Adds d2, the squared Mahalanobis distance by the group's Cholesky factor l_i_k."""
    ys = []
    for i, x in enumerate(_X):
        rest = sum((F.col(f"l_{i}_{k}") * F.col(f"y{k}") for k in range(i)), F.lit(0.0))
        rows = rows.withColumn(f"y{i}", (F.col(x) - F.col(f"m_{i}") - rest) / F.col(f"l_{i}_{i}"))
        ys.append(F.col(f"y{i}") * F.col(f"y{i}"))
    return rows.withColumn("d2", sum(ys[1:], ys[0]))


def _nearest(rows: DataFrame, share: float) -> DataFrame:
    """The rows of each group in the lowest distance bins that hold ``share`` of it."""
    binned = rows.withColumn("bin", F.floor(F.log(F.col("d2") + 1e-6) * _D_BINS))
    counts = binned.groupBy("g", "bin").agg(F.count(F.lit(1)).alias("n"))
    limit = _bin_quantile(counts, ["g"], share).withColumnRenamed("bin", "limit")
    return _by_group(binned, limit).filter(F.col("bin") <= F.col("limit"))


def _estimate(subset: DataFrame, factor: float, prior: float) -> DataFrame:
    """Mean and Cholesky factor per group from the sums over its subset.

    Small groups lean on the sums over all groups with the weight of ``prior`` rows; the floors
    of FEATURES are added to the diagonal.
    """
    pairs = [(i, k) for i in range(_P) for k in range(i + 1)]
    sums = [F.count(F.lit(1)).alias("n")]
    sums += [F.sum(x).alias(f"s_{i}") for i, x in enumerate(_X)]
    sums += [F.sum(F.col(_X[i]) * F.col(_X[k])).alias(f"q_{i}_{k}") for i, k in pairs]
    per = subset.groupBy("g").agg(*sums)
    names = [c for c in per.columns if c != "g"]
    whole = per.agg(*[F.sum(c).alias(c) for c in names]).first()   # one row of 28 numbers
    n_all = float(whole["n"] or 0) or 1.0
    w = {c: float(whole[c] or 0.0) / n_all for c in names}
    n = F.col("n") + F.lit(prior)
    per = per.select("g", *[((F.col(f"s_{i}") + prior * w[f"s_{i}"]) / n).alias(f"m_{i}") for i in range(_P)],
                     *[((F.col(f"q_{i}_{k}") + prior * w[f"q_{i}_{k}"]) / n).alias(f"q_{i}_{k}") for i, k in pairs])
    per = per.select("g", *[f"m_{i}" for i in range(_P)], *[
        (factor * (F.greatest(F.col(f"q_{i}_{k}") - F.col(f"m_{i}") * F.col(f"m_{k}"), F.lit(0.0)) if i == k
                   else F.col(f"q_{i}_{k}") - F.col(f"m_{i}") * F.col(f"m_{k}"))
         + (FEATURES[_X[i]] ** 2 if i == k else 0.0)).alias(f"c_{i}_{k}") for i, k in pairs])
    for k in range(_P):
        own = F.col(f"c_{k}_{k}") - sum((F.col(f"l_{k}_{j}") * F.col(f"l_{k}_{j}") for j in range(k)), F.lit(0.0))
        per = per.withColumn(f"l_{k}_{k}", F.sqrt(F.greatest(own, F.lit(FEATURES[_X[k]] ** 2 / 4))))
        for i in range(k + 1, _P):
            rest = sum((F.col(f"l_{i}_{j}") * F.col(f"l_{k}_{j}") for j in range(k)), F.lit(0.0))
            per = per.withColumn(f"l_{i}_{k}", (F.col(f"c_{i}_{k}") - rest) / F.col(f"l_{k}_{k}"))
    return per.select("g", *[f"m_{i}" for i in range(_P)], *[f"l_{i}_{k}" for i, k in pairs])


def mcd_distance(rows: DataFrame, scratch: Scratch, share: float = 0.75, steps: int = 3,
                 prior: float = 100.0) -> DataFrame:
    """Rows (g, x0..) with d2, by minimum-covariance-determinant estimates per group ``g``.

    Starts at medians and median absolute deviations, then takes concentration steps: estimate
    from the ``share`` of rows nearest to the last estimate.  The consistency factor is that of
    a normal distribution cut at ``share``.  ``rows`` must be a written table (it is read
    several times).
    """
    cut = chi2_quantile(share, _P)
    factor = share / chi2_cdf(cut, _P + 2)
    med = _medians(rows, {x: F.col(x) for x in _X}, scratch, "m")
    mad = _medians(_by_group(rows, med), {x: F.abs(F.col(x) - F.col(f"m_{x}")) for x in _X}, scratch, "a")
    start = _by_group(_by_group(rows, med), mad)
    d2 = sum((F.pow((F.col(x) - F.col(f"m_{x}")) / F.greatest(1.4826 * F.col(f"a_{x}"), F.lit(floor)), 2)
              for x, floor in FEATURES.items()), F.lit(0.0))
    at = start.select("g", *_X, d2.alias("d2"))
    for step in range(steps):
        params = scratch.write(_estimate(_nearest(at, share), factor, prior), f"step{step}")
        at = _distance(_by_group(rows, params))
    return at


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  source_col: str = "source", tail: float = 1e-6, carry: tuple[str, ...] = ()) -> DataFrame:
    """Statistics and verdict for each row.

    Returns ``id_col``, the ``carry`` columns, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, distance (squared Mahalanobis), kept.  base_failed: fewer than
    20 words, or over 30 % of them in 8-word windows found twice.  kept is false for those, and
    for rows whose transformed statistics lie beyond the chi-square quantile ``1 - tail`` of their
    language and source's robust estimate.

    Null text has no words and fails the base rule; null languages or sources are groups of
    their own; repeated rows are judged alike; an empty table gives an empty result; columns
    other than those named are ignored.  A group without a row that passes the base rules has
    no estimate and none of its rows needs one.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    keep = [F.col(id_col), *[F.col(c) for c in carry],
            F.concat_ws("\x01", F.coalesce(F.col(lang_col).cast("string"), F.lit("\x02")),
                        F.coalesce(F.col(source_col).cast("string"), F.lit("\x02")))]
    stats = text_statistics(docs, keep, text_col)
    g = f"k{len(keep) - 1}"
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    named = [F.col(f"k{i}").alias(f"k{i}") for i in range(len(keep) - 1)]
    rows = scratch.write(stats.select(*named, F.col(g).alias("g"), "n_words", "word_chars", "n_symbols",
                                      "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                                      *_transformed()), "stats")
    passed = rows.filter(~F.col("base_failed"))
    judged = mcd_distance(passed, scratch)
    failing = rows.filter("base_failed").withColumn("d2", F.lit(None).cast("double"))
    cut = chi2_quantile(1 - tail, _P)
    out = judged.select(*failing.columns).unionByName(failing)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate([id_col, *carry])],
                      "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                      F.col("d2").alias("distance"),
                      (~F.col("base_failed") & F.coalesce(F.col("d2") <= cut, F.lit(True))).alias("kept"))


def keep_good(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
              source_col: str = "source", tail: float = 1e-6) -> DataFrame:
    """The rows of ``docs`` that :func:`quality_rules` keeps, with all their columns."""
    key = row_key(id_col, text_col, lang_col, source_col)
    judged = quality_rules(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
                                       F.col(source_col).alias("source"), key.alias("key")),
                           "id", "text", "lang", "source", tail, carry=("key",))
    gone = judged.filter(~F.col("kept")).select(F.col("id").alias("g_id"), F.col("key").alias("g_key")).distinct()
    return without(docs, Scratch(docs.sparkSession, "quality").write(gone, "rejected"), id_col, key)
