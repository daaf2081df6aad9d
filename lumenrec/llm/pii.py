"""Personal data: fixed formats, and identifiers found by bootstrapped contextual extraction.

Everything is DataFrame or SQL functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_CLASS, WS, WS_CLASS, Scratch, ascii_lower

KINDS = ("email", "ip", "card", "phone")
CONTEXT = "context"

# A match starts at the first character of its run or where the last match ended; a later start
# in the same run fails whenever the first does.  Possessive loops keep the search linear.
_LOCAL, _DOMAIN = "[A-Za-z0-9._%+-]", "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@{_DOMAIN}++(?:\.{_DOMAIN}++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# what a text must hold for a pattern to match at all
_NEEDS = {"email": "@", "phone": "+"}
_OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
# words that may be identifiers: a digit or an at sign, six or more characters
_CANDIDATE = rf"(?<!{WORD_CLASS})[^\x20\x09-\x0D0-9@]*+[0-9@]{WORD_CLASS}*+"
_SPAN_BLOCK = 512          # code points: spans meet block by block, not text by text
_BROADCAST_ROWS = 500_000  # patterns up to which a counted table is broadcast


def _spans(text: Column, pattern: str) -> tuple[Column, Column]:
    """The pieces between the matches, and the matches (both arrays of strings)."""
    return F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


_BLOCK = 128


def _block_starts(widths: str) -> Column:
    """Sum of all widths before each block of 128.

    Running sums in two levels: an array grows by copying, so one level alone would take
    quadratic time on a text with very many matches.
    """
    blocks = F.sequence(F.lit(0), F.floor((F.size(widths) - 1) / _BLOCK).cast("int"))
    total = F.transform(blocks, lambda i: F.aggregate(
        F.slice(F.col(widths), i * _BLOCK + 1, F.lit(_BLOCK)), F.lit(0), lambda a, w: a + w))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))
    return F.aggregate(total, empty, lambda a, w: F.struct(
        (a["at"] + w).alias("at"), F.concat(a["all"], F.array(a["at"])).alias("all")))["all"]


def _running(widths: str, starts: str) -> Column:
    """Running sums of ``widths``, block by block."""
    def block(start, i):
        return F.aggregate(
            F.slice(F.col(widths), i * _BLOCK + 1, F.lit(_BLOCK)),
            F.struct(start.alias("at"), F.array().cast("array<int>").alias("all")),
            lambda a, w: F.struct((a["at"] + w).alias("at"), F.concat(a["all"], F.array(a["at"] + w)).alias("all")))["all"]
    return F.flatten(F.transform(F.col(starts), block))


def located(text_rows: DataFrame, keep: list[str], pattern: str, needs: Column, context: bool = False) -> DataFrame:
    """One row per match: the columns ``keep``, start, end (code points), match.

    ``context`` adds the pieces before and after the match.
    """
    pieces, matches = _spans(F.col("text"), pattern)
    t = text_rows.filter(needs).select(*keep, pieces.alias("pieces"), matches.alias("matches"))
    widths = F.zip_with("pieces", "matches", lambda p, m: F.char_length(p) + F.coalesce(F.char_length(m), F.lit(0)))
    t = t.select(*keep, "pieces", "matches", F.slice(widths, F.lit(1), F.size("matches")).alias("w"))
    t = t.select(*keep, "pieces", "matches", "w", _block_starts("w").alias("starts"))
    t = t.select(*keep, "pieces", "matches", _running("w", "starts").alias("ends"))
    extra = []
    if context:
        extra = [F.slice("pieces", F.lit(1), F.size("matches")).alias("before"),
                 F.slice("pieces", F.lit(2), F.size("matches")).alias("after")]
    zipped = t.select(*keep, F.arrays_zip("matches", "ends", *extra).alias("z"))
    # explode() would have the whole array computed again in a filter pushed below it
    rows = zipped.select(*keep, F.explode_outer("z").alias("z")).filter(F.col("z").isNotNull())
    cols = [(F.col("z.ends") - F.char_length("z.matches")).alias("start"), F.col("z.ends").alias("end"),
            F.col("z.matches").alias("match")]
    if context:
        cols += [F.col("z.before").alias("before"), F.col("z.after").alias("after")]
    return rows.select(*keep, *cols)


def _luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn test."""
    reverse = F.split(F.reverse(digits), "")
    # doubled digits, with the digits of the result added up
    value = F.transform(reverse, lambda d, i: F.when(
        i % 2 == 0, F.try_to_number(d, F.lit("9"))).otherwise(
        F.try_to_number(F.translate(d, "0123456789", "0246813579"), F.lit("9"))).cast("int"))
    return F.aggregate(value, F.lit(0), lambda a, b: a + F.coalesce(b, F.lit(0))) % 10 == 0


def _valid(kind: str) -> Column:
    m = F.col("match")
    if kind == "ip":
        return m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "card":
        return F.char_length(digits).between(12, 19) & _luhn(digits)
    if kind == "phone":
        return F.char_length(digits).between(9, 15)
    return F.lit(True)


def formatted(text_rows: DataFrame, keep: list[str]) -> DataFrame:
    """Rows (keep, kind, start, end, match) of the four fixed formats."""
    out = None
    for kind in KINDS:
        needs = F.col("text").contains(_NEEDS[kind]) if kind in _NEEDS else F.col("text").rlike("[0-9]")
        found = located(text_rows, keep, PATTERNS[kind], needs).filter(_valid(kind))
        found = found.select(*keep, F.lit(kind).alias("kind"), "start", "end", "match")
        out = found if out is None else out.unionByName(found)
    return out


def _context_rows(text_rows: DataFrame, keep: list[str]) -> DataFrame:
    """Candidate words with ``slots``: the lower-cased word and the two words on either side, as
    (side, words), where there are any between it and the next candidate or the edge of the text."""
    found = located(text_rows, keep, _CANDIDATE, F.col("text").rlike("[0-9@]"), context=True)
    near = F.split(F.reverse(F.rtrim(F.col("before"), F.lit(WS))), WS_CLASS + "+", 3)
    near = F.transform(F.slice(near, 1, 2), lambda w: F.reverse(w))
    after = F.slice(F.split(F.ltrim(F.col("after"), F.lit(WS)), WS_CLASS + "+", 3), 1, 2)
    found = found.select(*keep, "start", "end", "match", near.alias("l"), after.alias("r"))

    def slots(side: str, words: str, two: list[Column]) -> list[Column]:
        one = F.get(words, F.lit(0))
        return [F.struct(F.lit(side).alias("side"), F.nullif(one, F.lit("")).alias("word")),
                F.struct(F.lit(side).alias("side"), F.when((F.size(words) > 1) & (F.get(words, F.lit(1)) != ""),
                                                           F.concat_ws(" ", *two)).alias("word"))]

    def at(words: str, i: int) -> Column:
        return F.get(words, F.lit(i))

    every = F.array(*slots("L", "l", [at("l", 1), at("l", 0)]), *slots("R", "r", [at("r", 0), at("r", 1)]))
    every = F.transform(every, lambda s: F.struct(s["side"].alias("side"), ascii_lower(s["word"]).alias("word")))
    return found.select(*keep, "start", "end", "match", F.filter(every, lambda s: s["word"].isNotNull()).alias("slots"))


def _uses(text_rows: DataFrame, patterns: DataFrame) -> DataFrame:
    """How often the words of the patterns, one or two in a row, occur in all texts: (word, uses).

    Only uses of these words leave a task; they are summed up within it.
    """
    wanted = patterns.select("word").distinct()
    words = F.filter(F.split(ascii_lower(F.col("text")), WS_CLASS + "+"), lambda w: w != "")
    t = text_rows.select(words.alias("w"))
    pairs = F.zip_with(F.slice("w", F.lit(1), F.greatest(F.size("w") - 1, F.lit(0))), F.slice("w", F.lit(2), F.greatest(F.size("w") - 1, F.lit(0))),
                       lambda x, y: F.concat_ws(" ", x, y))
    if wanted.count() <= _BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    return t.select(F.explode(F.concat("w", pairs)).alias("word")).join(wanted, "word", "left_semi") \
        .groupBy("word").agg(F.count(F.lit(1)).alias("uses"))


def _in_blocks(spans: DataFrame, start: str, end: str) -> DataFrame:
    """The spans, once for each block of code points that they touch."""
    blocks = F.sequence(F.floor(F.col(start) / _SPAN_BLOCK), F.floor((F.col(end) - 1) / _SPAN_BLOCK))
    return spans.withColumn("block", F.explode(blocks))


def touching(spans: DataFrame, others: DataFrame) -> DataFrame:
    """The rows of ``spans`` (key, start, end, ...) that overlap a row of ``others`` (key, start, end);
    a row may come more than once.  Only spans of one block of a text are compared."""
    other = _in_blocks(others.select("key", F.col("start").alias("s"), F.col("end").alias("e")), "s", "e")
    return _in_blocks(spans, "start", "end").join(other, ["key", "block"]) \
        .filter((F.col("start") < F.col("e")) & (F.col("s") < F.col("end"))).select(*spans.columns)


def bootstrap(text_rows: DataFrame, seeds: DataFrame, scratch: Scratch, rounds: int = 3, min_support: int = 5,
              min_confidence: float = 0.5, min_score: float = 0.9) -> DataFrame:
    """Identifiers that the contexts of known ones reveal: rows (key, start, end).

    A pattern is the word, or the two words, before or after a slot.  Edges join patterns and
    instances (distinct candidate words of six or more characters).  Each round scores

    * a pattern by the instances' scores summed over its uses, divided by all uses of its words
      in the corpus (every filler of the slot counts, ordinary words too), if ``min_support``
      distinct known instances support it;
    * an instance by noisy-or over its patterns of at least ``min_confidence``.

    Seeds keep the score 1.  Instances that reach ``min_score`` are discovered; they support
    patterns of the next round, whether or not a seed does.  A discovered word is reported where
    a pattern of the last round stands beside it.  Tables: one edge row per distinct (pattern,
    instance), so the graph grows with the candidates and not with the text; uses are counted
    for supported patterns alone, in one pass over the texts for each round that has new ones.
    """
    cand = scratch.write(_context_rows(text_rows, ["key"]).filter(F.char_length("match") >= 6), "candidates")
    # a candidate word that overlaps a seed span is that seed's instance
    known = touching(cand.select("key", "start", "end", "match"), seeds).select("match").distinct().withColumn("seed", F.lit(1.0))
    known = scratch.write(known, "known")
    edges = (cand.select("match", F.explode("slots").alias("p")).select("match", "p.side", "p.word")
             .groupBy("side", "word", "match").agg(F.count(F.lit(1)).alias("n")))
    edges = scratch.write(edges, "all-edges")
    # a pattern with fewer distinct instances, known or not, can never be supported
    possible = (edges.groupBy("side", "word").agg(F.count(F.lit(1)).alias("instances"))
                .filter(F.col("instances") >= min_support).select("side", "word"))
    edges = scratch.write(edges.join(possible, ["side", "word"], "left_semi"), "edges")
    seeded = known.select("match", F.col("seed").alias("score"))
    scores, counted, confident = seeded, None, None
    for i in range(rounds):
        supported = (edges.join(scores, "match").groupBy("side", "word")
                     .agg(F.sum(F.col("n") * F.col("score")).alias("mass"), F.count_if(F.col("score") >= min_score).alias("support"))
                     .filter(F.col("support") >= min_support))
        supported = scratch.write(supported, f"supported{i}")
        new = supported if counted is None else supported.join(counted, "word", "left_anti")
        if counted is None or not new.isEmpty():
            more = scratch.write(_uses(text_rows, new), f"uses{i}")
            counted = more if counted is None else counted.unionByName(more)
        confident = supported.join(counted, "word").select("side", "word", (F.col("mass") / F.col("uses")).alias("conf"))
        confident = scratch.write(confident.filter(F.col("conf") >= min_confidence), f"confident{i}")
        doubt = F.sum(F.log(F.lit(1.0) - F.least(F.col("conf"), F.lit(0.999)) + F.lit(1e-9)))
        found = (edges.join(confident, ["side", "word"]).groupBy("match").agg(doubt.alias("d"))
                 .join(known, "match", "left_anti").select("match", (1 - F.exp("d")).alias("score")))
        scores = scratch.write(seeded.unionByName(found), f"scores{i}")
    if not rounds:
        return cand.select("key", "start", "end").limit(0)
    new = scores.filter(F.col("score") >= min_score).join(known, "match", "left_anti").select("match")
    return (cand.join(new, "match").select("key", "start", "end", F.explode("slots").alias("p"))
            .select("key", "start", "end", "p.side", "p.word").join(confident, ["side", "word"], "left_semi")
            .select("key", "start", "end").distinct())


def _is(kind: str):
    return lambda span: span["kind"] == kind


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: ``id_col``, n_email, n_ip, n_card, n_phone, base (the spans of the fixed formats)
    and spans (those and the contextual ones), arrays of (start, ord, kind, end) in order.

    Offsets are code points, end exclusive.  Null or empty text has no spans.  Rows with the
    same id and text are one text and get the same spans; null ids are kept.  An empty table
    gives an empty result; other columns are ignored.  ``options`` go to :func:`bootstrap`.

    Texts are read in place; only spans, candidates and word counts are shuffled.  The spans
    of a text are gathered in one row, whose size the text bounds.
    """
    scratch = Scratch(docs.sparkSession, "pii")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"))
    key = F.struct(F.col("id").alias("id"), F.xxhash64("text").alias("tk")).alias("key")
    rows = rows.select("id", "text", key)
    texts = rows.select("key", "text")
    seeds = scratch.write(formatted(texts, ["key"]).distinct(), "seeds")
    more = bootstrap(texts, seeds, scratch, **options)
    # a contextual span that touches a fixed one adds nothing
    more = more.join(touching(more, seeds).distinct(), ["key", "start", "end"], "left_anti")
    order = F.create_map(*[x for i, k in enumerate((*KINDS, CONTEXT)) for x in (F.lit(k), F.lit(i))])
    spans = (seeds.select("key", "kind", "start", "end")
             .unionByName(more.withColumn("kind", F.lit(CONTEXT)).select("key", "kind", "start", "end"))
             .groupBy("key").agg(F.sort_array(F.collect_list(F.struct(
                 "start", order[F.col("kind")].alias("ord"), "kind", "end"))).alias("spans"))
             .select(F.col("key.id").alias("s_id"), F.col("key.tk").alias("s_tk"), "spans"))
    ids = rows.select("id", F.col("key.tk").alias("tk"))
    out = ids.join(spans, F.col("id").eqNullSafe(F.col("s_id")) & (F.col("tk") == F.col("s_tk")), "left")
    none = F.array().cast("array<struct<start:int,ord:int,kind:string,end:int>>")
    out = out.select(F.col("id"), F.coalesce("spans", none).alias("spans"))
    out = out.select("id", F.filter("spans", lambda s: s["kind"] != CONTEXT).alias("base"), "spans")
    count = [F.size(F.filter("base", _is(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return out.select(F.col("id").alias(id_col), *count, "base", "spans")
