"""Secret scans: fixed formats, and credential values that would take long to guess."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import in_tasks, parts, texts
from .common import Scratch
from .words import WORDS

KINDS = ("assign", "access", "hex")
GUESS = "guess"


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_BASE_WORDS = ("password", "passwd", "secret", "token", "api_?key")
_ASSIGN = re.compile("(" + "|".join(map(_either_case, _BASE_WORDS)) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]{32,}")
# contexts whose value the guess cost is computed for
_CONTEXT_WORDS = ("password", "passwd", "passphrase", "pwd", "secret", "token", "api[_-]?key", "access[_-]?key",
                  "private[_-]?key", "credential", "credentials", "auth", "bearer")
_CONTEXT = re.compile("(?<![A-Za-z])(?:[A-Za-z0-9]+[_-])?(?:" + "|".join(map(_either_case, _CONTEXT_WORDS))
                      + r""")["']?\x20{0,4}[:=]\x20{0,4}["']?([!-~]{6,})""")
_HINTS = ("passw", "passphrase", "pwd", "secret", "token", "key", "credential", "auth", "bearer")

# ---- fixed values: common words of guessed passwords, the commonest first --------------------
COMMON_WORDS = """password 123456 12345678 qwerty abc123 letmein admin welcome monkey dragon master login iloveyou
sunshine princess football baseball shadow michael superman batman trustno1 hello freedom whatever secret
starwars charlie jordan hunter access flower passw0rd summer winter spring autumn love cookie cheese pepper
ginger soccer hockey killer george computer internet service server system default example sample test demo
user guest root public private changeme please enter insert value your here none null true false string
token key api pass word name email data base home work school family friend mother father baby angel
purple orange yellow green black white silver golden tiger eagle mustang ranger thomas robert daniel andrew
joshua matthew jessica ashley amanda nicole samsung google apple windows linux the and for you are with""".split()
_RANK = {w: i + 1 for i, w in reversed(list(enumerate(WORDS)))}
_RANK |= {w: min(i + 1, _RANK.get(w, i + 1)) for i, w in reversed(list(enumerate(COMMON_WORDS)))}
_LONGEST = max(24, *map(len, _RANK))
_LEET = str.maketrans("04@31!$57", "oaaeiisst")
_ROWS = ("1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
_DATE = re.compile(r"(?:19|20)\d\d(?:([-/._ ]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01]))?"
                   r"|(?:0?[1-9]|[12]\d|3[01])([-/._ ])(?:0?[1-9]|[12]\d|3[01])\2(?:\d{4}|\d\d)")


def _keyboard() -> dict[str, tuple[int, int]]:
    return {c: (y, x) for y, row in enumerate(_ROWS) for x, c in enumerate(row)}


_KEYS = _keyboard()
_SEGMENT = 1.0           # bits for one more segment
_SEPARATORS = "/-_.:,=+@#&"      # single characters between words, the commonest first
_PERIODS = (1, 2, 3, 4)
_WALK, _TURN = math.log2(94), 1.5


def _step(a: str, b: str) -> tuple | None:
    """Direction from one key to a neighbouring one, or in the alphabet; None if neither."""
    d = ord(b) - ord(a)
    if abs(d) == 1 and a.isalnum() and b.isalnum():
        return ("abc", d)
    p, q = _KEYS.get(a), _KEYS.get(b)
    if p and q:
        dy, dx = q[0] - p[0], q[1] - p[1]
        if abs(dy) <= 1 and abs(dx) <= 1 and (dy or dx):
            return ("key", dy, dx)
    return None


def _char_bits(value: str) -> float:
    """Bits of one brute-forced character: by the kinds of character the value holds."""
    if not value.strip("0123456789"):
        return math.log2(10)
    if not value.strip("0123456789abcdef") or not value.strip("0123456789ABCDEF"):
        return 4.0
    n = 0
    n += 26 if any("a" <= c <= "z" for c in value) else 0
    n += 26 if any("A" <= c <= "Z" for c in value) else 0
    n += 10 if any(c.isdigit() for c in value) else 0
    n += 20 if any(not c.isalnum() for c in value) else 0
    return math.log2(max(n, 10))


Ranks = Mapping[str, int]


def _short_segments(value: str, ranks: Ranks = _RANK) -> list[list[tuple[int, float, str]]]:
    """For each end position the (start, bits, kind) of the words, dates and separators that end there."""
    n = len(value)
    ends: list[list[tuple[int, float, str]]] = [[] for _ in range(n + 1)]
    low = value.lower()
    plain = low.translate(_LEET) if len(low) == n else low
    for i in range(n):
        for j in range(i + 3, min(n, i + _LONGEST) + 1):
            for form, extra in ((low, 0.0), (plain, 2.0)):
                rank = ranks.get(form[i:j])
                if rank and not (extra and plain[i:j] == low[i:j]):
                    case = 0.0 if value[i:j] == low[i:j] else 1.0 if value[i + 1:j] == low[i + 1:j] else 2.0
                    ends[j].append((i, math.log2(rank + 1) + extra + case, "word"))
        if value[i].isdigit():
            for j in range(i + 4, min(n, i + 10) + 1):
                if _DATE.fullmatch(value, i, j):
                    # a day of about 60 years, in a few ways of writing it; a bare year
                    year = j - i == 4 and value[i:i + 2] in ("19", "20")
                    ends[j].append((i, math.log2(60 * (1 if year else 365 * 4)), "date"))
        elif value[i] in _SEPARATORS:
            ends[i + 1].append((i, math.log2(_SEPARATORS.index(value[i]) + 2), "separator"))
    return ends


def _segments(value: str, bits: float) -> list[list[tuple[int, float, str]]]:
    """All segments, spelled out: :func:`_short_segments`, and the repeats and keyboard walks from
    every start to every end.  Their number grows with the square of a run; :func:`guess_bits`
    takes the least of them without listing them."""
    n, low = len(value), value.lower()
    ends = _short_segments(value)
    for i in range(n):
        for period in _PERIODS:
            j = i + period
            while j < n and value[j] == value[j - period]:
                j += 1
                if j - i >= max(3, 2 * period):
                    ends[j].append((i, period * bits + math.log2((j - i) / period), "repeat"))
        j, turns, last = i + 1, 0, None
        while j < n and (step := _step(low[j - 1], low[j])):
            turns += step != last
            last = step
            j += 1
            if j - i >= 3:
                ends[j].append((i, _WALK + _TURN * turns + math.log2(j - i), "walk"))
    return ends


class _Starts:
    """Least ``key + log2(end - start)`` over the starts of a run, for growing ends.

    A start goes for good once another one is the better for all further ends: a later one with
    no greater key, or an earlier one that has caught up (the logarithms only come closer).
    """

    def __init__(self):
        self.first, self.open = 0, []

    def restart(self, first: int) -> None:
        self.first, self.open = first, []

    def least(self, new: int, key: Callable[[int], float], end: int) -> float:
        """With ``new`` as one more start, if the run holds it."""
        if new >= self.first:
            k = key(new)
            while self.open and self.open[-1][0] >= k:
                self.open.pop()
            self.open.append((k, new))
        least, kept = float("inf"), []
        for k, start in self.open:
            if (cost := k + math.log2(end - start)) < least:
                least = cost
                kept.append((k, start))
        self.open = kept
        return least


def guess_bits(value: str, ranks: Ranks = _RANK) -> float:
    """Binary logarithm of the guesses for ``value`` by its cheapest segmentation.

    Dynamic programming over end positions; brute-forced characters run on in one segment, any
    other segment (word, date, separator, repeat, keyboard walk) and each new brute-force span
    cost one more choice.  Repeats and walks may start and end anywhere in their runs; of a run
    only the starts that can still be the cheapest are kept, a few, so time and memory grow in
    proportion to the length.
    """
    if not value:
        return 0.0
    bits, low, n = _char_bits(value), value.lower(), len(value)
    ends = _short_segments(value, ranks)
    inf = float("inf")
    best = [0.0] + [inf] * n          # cheapest up to here
    brute = [inf] * (n + 1)           # the same, ending in a brute-force span
    repeats = [(p, max(3, 2 * p), p * bits - math.log2(p), _Starts()) for p in _PERIODS]
    walks, turns, last = _Starts(), [0] * n, None      # turns: changes of direction so far
    for j in range(1, n + 1):
        k = j - 1
        brute[j] = min(brute[k], best[k] + _SEGMENT) + bits
        least = min((best[i] + cost for i, cost, _ in ends[j]), default=inf)
        for period, shortest, cost, starts in repeats:
            if k >= period and value[k] != value[k - period]:
                starts.restart(k - period + 1)
            least = min(least, starts.least(j - shortest, best.__getitem__, j) + cost)
        if k:
            step = _step(low[k - 1], low[k])
            turns[k] = turns[k - 1] + (step != last)
            last = step
            if step is None:
                walks.restart(k)
            walk = walks.least(j - 3, lambda i: best[i] - _TURN * turns[i + 1], j)
            least = min(least, walk + _WALK + _TURN * (1 + turns[k]))
        best[j] = min(brute[j], least + _SEGMENT)
    return best[-1]


# a reference: an address with a scheme, or a path of names with dots, arrows, calls or brackets
_URL = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://[^\s@?#]+")
_PATH = re.compile(r"""[A-Za-z_$][\w$-]*(?:(?:\.|::|->|/)[A-Za-z_$][\w$-]*|\[["']?[\w$-]+["']?\]|\(["'][\w$-]+["']\)|\(\))+""")
_BETWEEN = re.compile(r"""[./\[\]"'():>]+|->""")


def _worded(part: str, ranks: Ranks) -> bool:
    """Whether a name is one or two letters, or words, up to three digits each, and separators alone."""
    if len(part) <= 2 and part.isalpha():
        return True
    whole = [True] + [False] * len(part)
    for j, some in enumerate(_short_segments(part, ranks)):
        whole[j] = whole[j] or any(whole[i] for i, _, kind in some if kind in ("word", "separator"))
        if j and not whole[j]:
            whole[j] = any(whole[i] and part[i:j].isdigit() for i in range(max(0, j - 3), j))
    return whole[-1]


def value_bits(value: str, ranks: Ranks = _RANK) -> float:
    """:func:`guess_bits` of a credential value.  A reference (an address, or a path of names such as
    a setting's) all of whose parts are made of words names no secret as a whole: it counts as its
    most costly part, whatever its case."""
    if _URL.fullmatch(value) or _PATH.fullmatch(value):
        names = [p for p in _BETWEEN.split(value.partition("://")[2] or value) if p]
        if len(names) > 1 and all(_worded(p, ranks) for p in names):
            return max(guess_bits(p.lower(), ranks) for p in names)
    return guess_bits(value, ranks)


def find_spans(text: str, min_bits: float, ranks: Ranks = _RANK) -> list[tuple[int, int, str, float | None]]:
    """(start, end, kind, bits) in order of start, kind, end; bits for contextual values alone."""
    out: list[tuple[int, int, int, float | None]] = []
    if ":" in text or "=" in text:
        low = text.lower()
        if any(h in low for h in _HINTS):
            out += [(m.start(), 0, m.end(), None) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
            for m in _CONTEXT.finditer(text):
                value = m[1].rstrip("\"'`,;.)]}>")
                if value != m[1] and _PATH.fullmatch(m[1].rstrip("`,;.")):
                    value = m[1].rstrip("`,;.")          # the brackets are the reference's own
                if len(value) >= 6 and (bits := value_bits(value, ranks)) >= min_bits:
                    out.append((m.start(1), 3, m.start(1) + len(value), round(bits, 3)))
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), None) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(m.start(), 2, m.end(), None) for m in _HEX.finditer(text)]
    names = (*KINDS, GUESS)
    return [(a, e, names[k], bits) for a, k, e, bits in sorted(out, key=lambda s: s[:3])]


# ---- words of the corpus ------------------------------------------------------------------------

WORDS_EACH, WORDS_ALL, WORD_DOCS = 30_000, 100_000, 5
_LETTERS = re.compile(r"[^\W\d_]+")


def _word_counts(rows: DataFrame) -> DataFrame:
    """(lang, word, n): documents that hold each word, of rows (lang, text); summed up over six
    megabytes of text before the shuffle."""
    def count(batches):
        for part in parts(batches, chars=6_000_000):
            seen: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(part.column("lang").to_pylist(), texts(part)):
                low = text.lower()
                if any(h in low for h in _HINTS):
                    low = _CONTEXT.sub(" ", text).lower()
                seen[lang].update({w for w in _LETTERS.findall(low) if 3 <= len(w) <= 20})
            columns = [[lang for lang, c in seen.items() for _ in c], [w for c in seen.values() for w in c], [n for c in seen.values() for n in c.values()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.int64()))], ["lang", "word", "n"])

    return in_tasks(rows, count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def corpus_words(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", each: int = WORDS_EACH,
                 most: int = WORDS_ALL, min_docs: int = WORD_DOCS) -> DataFrame:
    """The commonest words per language by the documents that hold them: (word, rank).

    Words are three to twenty letters, lower-cased, outside credential values (so a secret that is
    copied often is no word); every document counts.  A word's rank in a language is one more than
    the words in more documents; its rank here is its best.  Of a language the counts are kept
    that, with all above them, at most ``each`` words reach, and of those the ``most`` best ranks in
    all, so the table can be sent to every task.
    """
    rows = docs.select(F.coalesce(F.col(lang_col), F.lit("")).alias("lang"), F.col(text_col).alias("text"))
    counts = _word_counts(rows).filter(F.col("n") >= min_docs)
    counts = Scratch(docs.sparkSession, "secret-words").write(counts, "counts")
    # a row for each language and count: few, whatever the words
    levels = counts.groupBy("lang", "n").agg(F.count(F.lit(1)).alias("words"))
    above = Window.partitionBy("lang").orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    levels = levels.withColumn("upto", F.sum("words").over(above)).filter(F.col("upto") <= each)
    ranked = counts.join(levels, ["lang", "n"]).select("word", (F.col("upto") - F.col("words") + 1).alias("rank"))
    return ranked.groupBy("word").agg(F.min("rank").alias("rank")).orderBy("rank", "word").limit(most)


def _ranks(docs: DataFrame, text_col: str, lang_col: str | None):
    """Broadcast ranks of the fixed and the corpus's words (a bounded table)."""
    found = {r["word"]: r["rank"] for r in corpus_words(docs, text_col, lang_col).collect()} if lang_col else {}
    # a word guessed from a language's list costs a choice of the list as well
    ranks = dict(_RANK)
    for w, r in found.items():
        ranks[w] = min(2 * r, ranks.get(w, 2 * r))
    return docs.sparkSession.sparkContext.broadcast(ranks)


_SPAN = "array<struct<start:int,end:int,kind:string,bits:double>>"


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_bits: float = 40.0, lang_col: str | None = None) -> DataFrame:
    """Per row: ``id_col`` and spans, an array of (start, end, kind, bits) in order.

    Kinds: assign, access and hex are the fixed formats (whole match); guess is a value in a
    credential context whose cheapest segmentation takes at least ``2 ** min_bits`` guesses.
    Offsets are code points, end exclusive.

    Null or empty text has no spans.  Rows are judged one by one, so repeated rows and null ids
    need no rule; an empty table gives an empty result; other columns are ignored.  With
    ``lang_col`` (null: a language of its own) words are, besides the fixed list's, the commonest of
    ``docs`` per language (:func:`corpus_words`).  Word counts are all that is shuffled; each
    task then reads its own rows in slices of about two million bytes.
    """
    ranks = _ranks(docs, text_col, lang_col)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("spans", T._parse_datatype_string(_SPAN))])
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("bits", pa.float64())]))

    def scan(batches):
        for part in parts(batches):
            found = [[dict(zip(("start", "end", "kind", "bits"), s)) for s in find_spans(t, min_bits, ranks.value)]
                     for t in texts(part)]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(found, kind)], ["id", "spans"])

    return in_tasks(rows, scan, schema).withColumnRenamed("id", id_col)


def redact(text: str, spans: list[tuple], marker: str) -> str:
    """The text with each run of overlapping spans replaced by ``marker``."""
    out, at, end = [], 0, -1
    for a, e in sorted((s[0], s[1]) for s in spans):
        if a >= end:
            out += [text[at:a], marker]
        end = max(end, e)
        at = end
    return "".join(out) + text[at:]


def redact_secrets(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars",
                   marker: str = "[SECRET]", min_bits: float = 40.0, lang_col: str | None = None) -> DataFrame:
    """The rows with secrets replaced by ``marker`` in the text; every other column unchanged,
    but for ``chars_col`` (if there is one), the new count of code points.

    ``lang_col`` as for :func:`scan_secrets`.  Null text stays null.  Column names may repeat or clash with this function's own: rows pass
    as whole batches and columns are taken by their place.
    """
    at = docs.columns.index(text_col)
    chars = docs.columns.index(chars_col) if chars_col in docs.columns else None
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    ranks = _ranks(plain, f"c{at}", f"c{docs.columns.index(lang_col)}" if lang_col else None)

    def rewrite(batches):
        for part in parts(batches, f"c{at}"):
            columns = list(part.columns)
            new = [None if t is None else redact(t, find_spans(t, min_bits, ranks.value), marker)
                   for t in part.column(at).to_pylist()]
            columns[at] = pa.array(new, part.schema.field(at).type)
            if chars is not None:
                kept = part.column(chars).to_pylist()
                columns[chars] = pa.array([n if t is None else len(t) for t, n in zip(new, kept)],
                                          part.schema.field(chars).type)
            yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    return in_tasks(plain, rewrite, plain.schema).toDF(*docs.columns)
