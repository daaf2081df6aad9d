"""Katz backoff scoring with Good-Turing discounts, at the size of the corpus.

Texts become chunks: the sorted word hashes of some megabytes of text, and each word's place in
them.  Everything that crosses the network is a chunk's sorted distinct keys for one part of
the hash space, so a word or pair costs one entry per chunk however often it occurs, and no key
is hot.  Written tables, by chunk or by part of the hash space: chunks, counts, scores without
backoff weights; the weights are joined to the last.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import in_tasks, parts
from .common import Scratch
from .shingles import mix, word_hashes, words

CUT = 5                       # counts above it keep all but _KEEP_BACK of their mass
_KEEP_BACK = 0.01
_CHUNK = 6_000_000            # bytes of text in a chunk
_PER_PART = 1_000_000         # words of the corpus for each part of the hash space: a part's keys fit a task at any size
_END = np.uint64(xxhash.xxh3_64_intdigest(b" end"))        # no word holds a space
_START = np.uint64(xxhash.xxh3_64_intdigest(b" start"))
_u64 = np.uint64


# ---------------------------------------------------------------- packed arrays

def pack(values: np.ndarray) -> bytes:
    """Unsigned numbers as byte planes, without the empty high ones."""
    planes = np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8).T
    n = 8
    while n and not planes[n - 1].any():
        n -= 1
    return bytes([n]) + np.int64(len(values)).tobytes() + planes[:n].tobytes()


def unpack(data: bytes) -> np.ndarray:
    n, count = data[0], int(np.frombuffer(data, np.int64, 1, 1)[0])
    out = np.zeros((count, 8), np.uint8)
    if n:
        out[:, :n] = np.frombuffer(data, np.uint8, n * count, 9).reshape(n, count).T
    return out.reshape(-1).view("<u8").astype(np.uint64, copy=False)


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=_u64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def _cuts(keys: np.ndarray, n_parts: int) -> np.ndarray:
    """Where each part of the hash space begins in sorted keys."""
    width = (1 << 64) // n_parts + 1
    edges = np.array([min(p * width, (1 << 64) - 1) for p in range(1, n_parts)], np.uint64)
    return np.concatenate(([0], np.searchsorted(keys, edges), [len(keys)]))


# ---------------------------------------------------------------- chunks

class Chunk:
    """Token arrays of a chunk: documents' words and one end each, as places in a vocabulary."""

    def __init__(self, vocab: np.ndarray, place: np.ndarray, lengths: np.ndarray, held: np.ndarray):
        self.vocab, self.held, self.lengths = vocab, held, lengths
        self.n_tokens = lengths + 1
        n = int(self.n_tokens.sum())
        last = np.cumsum(self.n_tokens) - 1
        is_end = np.zeros(n, bool)
        is_end[last] = True
        self.token = np.empty(n, np.int64)
        self.token[is_end] = np.searchsorted(vocab, _END)
        self.token[~is_end] = place
        self.context = np.empty(n, np.int64)        # the place before; the start is one beyond the vocabulary
        self.context[1:] = self.token[:-1]
        self.context[last - lengths] = len(vocab)
        self.doc = np.repeat(np.arange(len(lengths)), self.n_tokens)
        keys = np.append(vocab, _START)
        pair = mix(keys[self.context] * _u64(0x9E3779B97F4A7C15) ^ mix(vocab[self.token]))
        self.pairs, self.first, self.which = np.unique(pair, return_index=True, return_inverse=True)
        self.train = ~held[self.doc]

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Training counts of the vocabulary and of the distinct pairs."""
        return (np.bincount(self.token[self.train], minlength=len(self.vocab)),
                np.bincount(self.which[self.train], minlength=len(self.pairs)))


def _chunk_rows(docs: DataFrame) -> DataFrame:
    """(chunk, ids, held, lengths, vocab, place) of rows (id, held, text)."""
    id_type = docs.schema["id"].dataType
    schema = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("ids", T.ArrayType(id_type)),
                           T.StructField("held", T.BinaryType()), T.StructField("lengths", T.BinaryType()),
                           T.StructField("vocab", T.BinaryType()), T.StructField("place", T.BinaryType())])

    def run(batches):
        from pyspark import TaskContext
        name = TaskContext.get().partitionId() << 32
        for part in parts(batches, "text", _CHUNK):
            lists = [words(t) for t in part.column("text").to_pylist()]
            vocab, place = np.unique(word_hashes(lists), return_inverse=True)
            at = np.searchsorted(vocab, _END)
            if at == len(vocab) or vocab[at] != _END:       # the end is in every chunk
                vocab = np.insert(vocab, at, _END)
                place = place + (place >= at)
            held = np.array(part.column("held").to_pylist(), bool)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.ListArray.from_arrays(pa.array([0, part.num_rows], pa.int32()), part.column("id")),
                 pa.array([np.packbits(held).tobytes()], pa.binary()),
                 pa.array([pack(np.fromiter(map(len, lists), np.uint64, len(lists)))], pa.binary()),
                 pa.array([pack_sorted(vocab)], pa.binary()), pa.array([pack(place.astype(np.uint64))], pa.binary())],
                schema.names)
            name += 1

    return in_tasks(docs, run, schema)


def _chunk(row: dict) -> Chunk:
    lengths = unpack(row["lengths"]).astype(np.int64)
    held = np.unpackbits(np.frombuffer(row["held"], np.uint8), count=len(lengths)).astype(bool)
    return Chunk(unpack_sorted(row["vocab"]), unpack(row["place"]).astype(np.int64), lengths, held)


# ---------------------------------------------------------------- counts

def _requests(chunks: DataFrame, n_parts: int) -> DataFrame:
    """(part, chunk, order, keys, counts): each chunk's keys in each part, with its training counts."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                c = _chunk(row)
                out = []
                for order, (keys, n) in enumerate(zip((c.vocab, c.pairs), c.counts()), 1):
                    cut = _cuts(keys, n_parts)
                    out += [(p, row["chunk"], order, pack_sorted(keys[a:b]), pack(n[a:b]))
                            for p, (a, b) in enumerate(zip(cut, cut[1:])) if b > a]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()))],
                    ["part", "chunk", "order", "keys", "counts"])
    return in_tasks(chunks, run, "part int, chunk long, order int, keys binary, counts binary")


def _merged(table: pa.Table) -> pa.Table:
    """Of one part: a row per chunk with the corpus counts of its keys and which it owns (the first
    chunk that has a key owns it); one row with the statistics of the counts."""
    chunk, own = table.column("chunk").to_pylist(), table.column("keys").to_pylist()
    keys = [unpack_sorted(k) for k in own]
    counts = [unpack(c) for c in table.column("counts").to_pylist()]
    distinct, first, which = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
    total = np.bincount(which, np.concatenate(counts).astype(np.float64), len(distinct)).astype(np.int64)
    owner = np.zeros(len(which), bool)
    owner[first] = True
    stats = np.concatenate((np.bincount(total[total <= CUT + 1], minlength=CUT + 2)[1:],
                            [(total > 0).sum(), total.sum()]))
    edge = np.cumsum([0] + [len(k) for k in keys])
    part, order = table.column("part")[0].as_py(), table.column("order")[0].as_py()
    rows = [{"part": part, "order": order, "chunk": c, "counts": pack(total[which[a:b]]),
             "owns": np.packbits(owner[a:b]).tobytes(), "stats": None} for c, a, b in zip(chunk, edge, edge[1:])]
    rows.append({"part": part, "order": order, "chunk": None, "counts": None, "owns": None, "stats": stats.tolist()})
    return pa.Table.from_pylist(rows, _COUNTS)


_COUNTS = pa.schema([("part", pa.int32()), ("order", pa.int32()), ("chunk", pa.int64()), ("counts", pa.binary()),
                     ("owns", pa.binary()), ("stats", pa.list_(pa.int64()))])


def discounts(n: list[int]) -> np.ndarray:
    """Discount of the counts 0..CUT from the numbers of keys seen 1..CUT+1 times.

    Good-Turing as Katz scales it, so that all mass taken off is that of the keys seen once.
    Where the numbers give no factor between 0 and 1 (small corpora), absolute discounting by
    n1 / (n1 + 2 n2) takes its place.
    """
    d = np.zeros(CUT + 1)
    n1, top = n[0], (CUT + 1) * n[CUT]
    plain = min(max(n1 / (n1 + 2 * n[1]) if n1 else 0.5, 0.1), 0.9)
    for r in range(1, CUT + 1):
        value = -1.0
        if n[r - 1] and n1 > top:
            value = ((r + 1) * n[r] / n[r - 1] / r - top / n1) / (1 - top / n1)
        d[r] = value if 0 < value < 1 else (r - plain) / r
    return d


def discounted(count: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Counts less what their discount takes; counts above CUT give _KEEP_BACK, so that every
    context leaves something to the words it was not seen with."""
    low = np.minimum(count, CUT).astype(np.int64)
    return np.where(count <= CUT, d[low] * count, count - _KEEP_BACK)


# ---------------------------------------------------------------- scores

def _aligned(replies: list[dict], order: int, column: str) -> list[bytes]:
    return [r[column] for r in sorted((r for r in replies if r["order"] == order), key=lambda r: r["part"])]


def _owned(replies: list[dict]) -> np.ndarray:
    flags = []
    for r in sorted((r for r in replies if r["order"] == 2), key=lambda r: r["part"]):
        n = int(np.frombuffer(r["counts"], np.int64, 1, 1)[0])
        flags.append(np.unpackbits(np.frombuffer(r["owns"], np.uint8), count=n).astype(bool))
    return np.concatenate(flags)


class Model:
    """The corpus-wide numbers: totals, discounts, the unknown word's probability."""

    def __init__(self, words_stats: list[int], pairs_stats: list[int], starts: int):
        *n, self.distinct, self.total = words_stats
        self.word_d = discounts(n)
        self.pair_d = discounts(pairs_stats[:CUT + 1])
        self.starts = starts

    def words(self, count: np.ndarray) -> np.ndarray:
        """Probability of words seen ``count`` times.

        The unknown word has what the discounts leave, _KEEP_BACK for each frequent word among it.
        """
        return np.where(count > 0, discounted(count, self.word_d) / max(self.total, 1), self.unknown)

    unknown = 1.0


def _score_chunk(row: dict, replies: list[dict], m: Model, n_parts: int) -> list[dict]:
    """Scores without backoff weights, and this chunk's share of the sums behind the weights."""
    c = _chunk(row)
    count = np.concatenate([unpack(b) for b in _aligned(replies, 1, "counts")]).astype(np.int64)
    pair = np.concatenate([unpack(b) for b in _aligned(replies, 2, "counts")]).astype(np.int64)
    docs = len(c.lengths)
    own = count[c.token]
    uni = m.words(count)
    before = np.append(count, m.starts)             # how often a place was followed by anything
    seen = pair[c.which]
    follows = before[c.context]
    with np.errstate(divide="ignore"):
        direct = np.log10(discounted(seen, m.pair_d) / np.maximum(follows, 1))
    token = np.where(seen > 0, direct, np.log10(uni[c.token]))
    base = np.log10((own + 1) / (m.total + m.distinct + 1))
    backed = (seen == 0) & (follows > 0)            # a context that was never seen weighs 1
    mine = _owned(replies) & (pair > 0)
    context, word = c.context[c.first[mine]], c.token[c.first[mine]]
    size = len(c.vocab) + 1
    given = np.bincount(context, discounted(pair[mine], m.pair_d), size)
    share = np.bincount(context, uni[word], size)
    wanted = np.zeros(size, bool)
    wanted[c.context[backed]] = True
    key = np.append(c.vocab, _START)
    some = np.flatnonzero(wanted | (given > 0))
    some = some[np.argsort(key[some])]
    rank = np.zeros(size, np.int64)
    asked = some[wanted[some]]
    rank[asked] = np.arange(len(asked))
    out = [{"chunk": row["chunk"], "part": None, "ids": row["ids"], "held": row["held"],
            "n_tokens": pack(c.n_tokens), "n_known": pack(np.bincount(c.doc, own > 0, docs)),
            "base": np.bincount(c.doc, base, docs).tobytes(), "score": np.bincount(c.doc, token, docs).tobytes(),
            "at_doc": pack(c.doc[backed]), "at_weight": pack(rank[c.context[backed]])}]
    keys = key[some]
    cut = _cuts(keys, n_parts)
    for p, (a, b) in enumerate(zip(cut, cut[1:])):
        if b > a:
            s = some[a:b]
            out.append({"chunk": row["chunk"], "part": p, "keys": pack_sorted(keys[a:b]), "follows": pack(before[s]),
                        "given": given[s].tobytes(), "share": share[s].tobytes(),
                        "wanted": np.packbits(wanted[s]).tobytes()})
    return out


def _weights(table: pa.Table) -> pa.Table:
    """Backoff weights of one part: what a context's seen words leave, over what the words it was
    not seen with have by themselves; one row per chunk with the weights it asked for."""
    rows = sorted(table.select(["part", "chunk", "keys", "follows", "given", "share", "wanted"]).to_pylist(),
                  key=lambda r: r["chunk"])
    keys = [unpack_sorted(r["keys"]) for r in rows]
    distinct, which = np.unique(np.concatenate(keys), return_inverse=True)

    def total(name):
        return np.bincount(which, np.concatenate([np.frombuffer(r[name], np.float64) for r in rows]), len(distinct))

    follows = np.zeros(len(distinct), np.int64)
    follows[which] = np.concatenate([unpack(r["follows"]) for r in rows]).astype(np.int64)
    weight = np.log10((1 - total("given") / np.maximum(follows, 1)) / (1 - total("share")))
    out, at = [], 0
    for r, k in zip(rows, keys):
        asked = np.unpackbits(np.frombuffer(r["wanted"], np.uint8), count=len(k)).astype(bool)
        out.append({"chunk": r["chunk"], "part": r["part"], "weights": weight[which[at:at + len(k)][asked]].tobytes()})
        at += len(k)
    return pa.Table.from_pylist(out, pa.schema([("chunk", pa.int64()), ("part", pa.int32()), ("weights", pa.binary())]))


def score_documents(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col``, held_out, n_tokens, n_known, train_tokens, base_score, score.

    ``held_out`` is a boolean column expression over ``docs``; the model learns from the other
    rows.  Tokens are words between ASCII white space, A-Z lower-cased, and one end.  score is
    the log10 probability of the tokens under a bigram Katz model: a seen pair has its
    discounted share; any other the context's backoff weight times the word's own probability;
    a context never followed by anything has weight 1; unknown words share one probability,
    what the discounts of single words leave.  The weights are exactly such that the
    probabilities of all words after a context add up to 1.  base_score is the add-one unigram
    score.  Words and pairs are known by 64-bit hashes.

    Null or empty text is one end token; a null ``held_out`` counts as training.  Repeated rows
    are learnt and scored each; null ids are kept; an empty table gives an empty result; other
    columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "katz")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held"),
                       F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType
    chunks = scratch.write(_chunk_rows(rows), "chunks")
    n_words = rows.select(F.sum(F.coalesce(F.char_length("text"), F.lit(0)) / 6), F.count_if(~F.col("held"))).first()
    starts = int(n_words[1] or 0)
    n_parts = int(max(64, (n_words[0] or 0) // _PER_PART))

    counted = _requests(chunks, n_parts).groupBy("part", "order").applyInArrow(
        _merged, "part int, order int, chunk long, counts binary, owns binary, stats array<long>")
    counts = scratch.write(counted, "counts")
    stats = {r["order"]: r for r in counts.filter("stats is not null").groupBy("order").agg(
        *[F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(CUT + 3)]).collect()}    # two rows
    if not stats:
        stats = {1: {f"s{i}": 0 for i in range(CUT + 3)}, 2: {f"s{i}": 0 for i in range(CUT + 3)}}
    m = Model(*[[int(stats[o][f"s{i}"]) for i in range(CUT + 3)] for o in (1, 2)], starts)
    m.unknown = _unknown(m, [int(stats[1][f"s{i}"]) for i in range(CUT + 3)])

    part_fields = ("keys", "follows", "given", "share", "wanted")
    doc_fields = ("held", "n_tokens", "n_known", "base", "score", "at_doc", "at_weight")
    scored_type = T.StructType([T.StructField("chunk", T.LongType()), T.StructField("part", T.IntegerType()),
                                T.StructField("ids", T.ArrayType(id_type)),
                                *[T.StructField(f, T.BinaryType()) for f in (*doc_fields, *part_fields)]])

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        replies = right.to_pylist()
        out = [x for row in left.to_pylist() for x in _score_chunk(row, replies, m, n_parts)]
        kinds = [pa.int64(), pa.int32(), left.schema.field("ids").type] + [pa.binary()] * (len(scored_type) - 3)
        return pa.Table.from_pylist([{n: x.get(n) for n in scored_type.names} for x in out],
                                    pa.schema(list(zip(scored_type.names, kinds))))

    replies = counts.filter("chunk is not null").select("chunk", "part", "order", "counts", "owns")
    scored = scratch.write(chunks.groupBy("chunk").cogroup(replies.groupBy("chunk")).applyInArrow(score, scored_type),
                           "scored")
    weights = scored.filter("part is not null").select("chunk", "part", *part_fields).groupBy("part").applyInArrow(
        _weights, "chunk long, part int, weights binary")
    out_type = T.StructType([T.StructField("id", id_type), T.StructField("held_out", T.BooleanType()),
                             T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
                             T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())])

    def close(left: pa.Table, right: pa.Table) -> pa.Table:
        asked = sorted(right.to_pylist(), key=lambda r: r["part"])
        weight = np.concatenate([np.zeros(0), *(np.frombuffer(r["weights"], np.float64) for r in asked)])
        row = left.to_pylist()[0]
        n = unpack(row["n_tokens"]).astype(np.int64)
        docs_at, at = unpack(row["at_doc"]).astype(np.int64), unpack(row["at_weight"]).astype(np.int64)
        total = np.frombuffer(row["score"], np.float64) + np.bincount(docs_at, weight[at], len(n))
        held = np.unpackbits(np.frombuffer(row["held"], np.uint8), count=len(n)).astype(bool)
        return pa.Table.from_arrays(
            [left.column("ids").combine_chunks().flatten(), pa.array(held), pa.array(n),
             pa.array(unpack(row["n_known"]).astype(np.int64)),
             pa.array(np.frombuffer(row["base"], np.float64)), pa.array(total)], out_type.names)

    mine = scored.filter("part is null").select("chunk", "ids", *doc_fields)
    out = mine.groupBy("chunk").cogroup(weights.groupBy("chunk")).applyInArrow(close, out_type)
    return out.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known",
                      F.lit(m.total).cast("long").alias("train_tokens"), "base_score", "score")


def _unknown(m: Model, stats: list[int]) -> float:
    """Probability of the unknown word: what the discounts of all known words leave."""
    if not m.total:
        return 1.0
    low = sum(stats[r - 1] * (r - m.word_d[r] * r) for r in range(1, CUT + 1))
    frequent = m.distinct - sum(stats[:CUT])
    return (low + frequent * _KEEP_BACK) / m.total
