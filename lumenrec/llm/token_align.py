"""Alignment of two tokenizers' tokens by their bytes, and how usual every linked id pair is.

Both tokenizations of a text cover the same bytes, so the byte offsets at which tokens of both
end cut them into groups: the intersection of two sets of cumulative ends, each a dictionary
from end to index; the sorted common ends slice both id lists.  Inside a slice every pair of
tokens whose byte ranges overlap is a link.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import in_tasks, no_collector, parts
from .bpe import byte_level
from .common import Scratch
from .katz import pack, pack_sorted, unpack, unpack_sorted
from .packing import _Kept

_CHUNK = 6_000_000        # bytes of text whose documents share a table of id pairs; a longer text has its own
_SLICE = 20_000           # id pairs in one row of such a table
_KEPT, _KEPT_CHARS = 200_000, 64      # aligned segments a worker keeps in each of two generations, and their length
_AT_ONCE = 20_000         # new segments aligned together
_worker: dict = {}

# A text is cut where both tokenizers break whatever stands around: before a single space
# between two characters that are neither white space nor the space's mark.
_CUT = re.compile(" (?<=[^\\s▁] )(?=[^\\s▁])")
_ODD = re.compile("\\A | (?:[\\s▁]|\\Z)|[\\s▁] ")


def segments(text: str) -> list[str]:
    """Pieces that together with a space before each are the space and the text."""
    return _CUT.split(text) if _ODD.search(text) else text.split(" ")


# ---- fixed value: how a byte-level tokenizer of this kind splits a text before it merges ---
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# ---------------------------------------------------------------------------------------------


def _plain_ranks(spec: dict, to_byte: dict[str, int]) -> dict[bytes, int] | None:
    """Ranks of a file whose ids are in order of its merges (None for any other): the library for
    ranks then gives the same ids in a fifth of the time."""
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    plain = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") is True
             and not pre.get("add_prefix_space") and model["type"] == "BPE"
             and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                                                "byte_fallback", "ignore_merges")))
    if not plain:
        return None
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    ids = [model["vocab"].get(m) for m in merged]
    singles = [model["vocab"].get(c) for c in to_byte]
    if None in ids or None in singles or ids != sorted(ids) or len(set(ids)) < len(ids) or (ids and max(singles) > ids[0]):
        return None
    return {bytes(to_byte[c] for c in t): model["vocab"][t] for t in [*to_byte, *merged]}


def byte_bpe(spec: str) -> tuple:
    """Token bytes and encoder of a byte-level tokenizer file's text, and True if tokens give back any
    text; special tokens' strings are plain text."""
    from tokenizers import Tokenizer
    t = Tokenizer.from_str(spec)
    t.encode_special_tokens = True
    to_byte = byte_level()
    table = [b""] * t.get_vocab_size()
    for token, i in t.get_vocab().items():
        table[i] = bytes(to_byte[c] for c in token) if all(c in to_byte for c in token) else token.encode()
    ranks = _plain_ranks(json.loads(spec), to_byte)
    if ranks is None:
        return table, lambda texts: [e.ids for e in t.encode_batch_fast(texts, add_special_tokens=False)]
    import tiktoken
    encode = tiktoken.Encoding("ranks", pat_str=_SPLIT, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return table, lambda texts: list(map(encode, texts)), True


def piece_bpe(model: bytes) -> tuple[list[bytes], Callable[[list[str]], list[list[int]]]]:
    """Token bytes and encoder of a sentencepiece model, which puts a space before a text."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_proto=model)
    table = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()
             for i in range(sp.get_piece_size())]
    return table, lambda texts: sp.encode(texts, num_threads=1)


class Aligner:
    """Aligns texts segment by segment; segments seen before are not encoded again."""

    def __init__(self, a, b):
        (self.bytes_a, self.encode_a, *exact), (self.bytes_b, self.encode_b) = a, b
        self.exact_a = bool(exact and exact[0])
        self.text_a, self.text_b = [str(i) for i in range(len(self.bytes_a))], [str(i) for i in range(len(self.bytes_b))]
        self.size_a, self.size_b = (np.array([len(x) for x in t], np.int64) for t in (self.bytes_a, self.bytes_b))
        self.seen = _Kept(_KEPT)

    def align(self, some: list[str]) -> list[tuple[str, bytes, int] | None]:
        """Of each text, with a space before it: its groups as text, its links as codes a * |B| + b
        (little-endian 64 bits), and the number of A tokens; None if the tokens' bytes differ from it."""
        raw = [b" " + s.encode() for s in some]
        ids_a, ids_b = self.encode_a([" " + s for s in some]), self.encode_b(some)
        good = [True] * len(some)
        a, b = (list(itertools.chain.from_iterable(x)) for x in (ids_a, ids_b))
        # tokens of all single bytes and their merges give back any text
        if not ((self.exact_a or self._gives(a, ids_a, raw, self.bytes_a, self.size_a))
                and self._gives(b, ids_b, raw, self.bytes_b, self.size_b)):
            good = [b"".join(map(self.bytes_a.__getitem__, x)) == r == b"".join(map(self.bytes_b.__getitem__, y))
                    for x, y, r in zip(ids_a, ids_b, raw)]
            ids_a, ids_b, raw = (list(itertools.compress(x, good)) for x in (ids_a, ids_b, raw))
            a, b = (list(itertools.chain.from_iterable(x)) for x in (ids_a, ids_b))
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        ends_a, ends_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        at_a, at_b = dict(zip(ends_a.tolist(), itertools.count(1))), dict(zip(ends_b.tolist(), itertools.count(1)))
        common = sorted(at_a.keys() & at_b.keys())
        cut_a, cut_b = [0, *[at_a[e] for e in common]], [0, *[at_b[e] for e in common]]
        text_a, text_b = [self.text_a[i] for i in a.tolist()], [self.text_b[i] for i in b.tolist()]
        groups = [",".join(text_a[i:i2]) + "|" + ",".join(text_b[j:j2])
                  for i, i2, j, j2 in zip(cut_a, cut_a[1:], cut_b, cut_b[1:])]
        # inside a slice every end of either side closes one link: that of the tokens around the bytes before it
        closes = np.union1d(ends_a, ends_b)
        codes = a[np.searchsorted(ends_a, closes)] * len(self.bytes_b) + b[np.searchsorted(ends_b, closes)]
        ends = np.cumsum([len(r) for r in raw])
        g = np.searchsorted(common, ends, "right").tolist()
        n = (np.searchsorted(closes, ends, "right") * 8).tolist()
        data = codes.astype("<i8").tobytes()
        found = iter([(";".join(groups[x:y]), data[k:m], len(i)) for x, y, k, m, i in zip([0, *g], g, [0, *n], n, ids_a)])
        return [next(found) if ok else None for ok in good]

    @staticmethod
    def _gives(flat: list[int], ids: list[list[int]], raw: list[bytes], table: list[bytes], size: np.ndarray) -> bool:
        """Whether the tokens of every text give back its bytes."""
        if b"".join([table[i] for i in flat]) != b"".join(raw):
            return False
        edges = np.cumsum([0] + [len(i) for i in ids])
        total = np.concatenate(([0], np.cumsum(size[flat])))[edges]
        return bool((np.diff(total) == [len(r) for r in raw]).all())

    def texts(self, texts: list[str]) -> list[tuple[str, bytes, int] | None]:
        """As :meth:`align`, of whole texts; an empty text has no tokens."""
        cut = [segments(t) if t else [] for t in texts]
        self.seen.turn()
        known = self.seen.young
        new = sorted(self.seen.unseen(set(itertools.chain.from_iterable(cut))), key=len)
        for some in _batches(new):
            known.update(zip(some, self.align(some)))
        out = []
        for some in cut:
            found = [known[s] for s in some]
            if not found or None in found:
                out.append(None)
            else:
                groups, links, n_a = zip(*found)
                out.append((";".join(groups), b"".join(links), sum(n_a)))
        for s in reversed(new):                    # long segments are not kept
            if len(s) <= _KEPT_CHARS:
                break
            del known[s]
        return out


def _batches(texts: list[str]) -> Iterator[list[str]]:
    """Runs of at most 20,000 texts and about a megabyte."""
    some, total = [], 0
    for t in texts:
        if some and (len(some) == _AT_ONCE or total + len(t) > 1_000_000):
            yield some
            some, total = [], 0
        some.append(t)
        total += len(t)
    if some:
        yield some


def _aligned(docs: DataFrame, spec_a, model_b) -> DataFrame:
    """Two kinds of rows: a document with its digests and links by place in its chunk's table of id
    pairs (pairs null), and a slice of that table with the documents that hold each pair."""
    schema = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("id", docs.schema["id"].dataType),
        *[T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")], T.StructField("groups_sha256", T.StringType()),
        T.StructField("place", T.BinaryType()), T.StructField("times", T.BinaryType()), T.StructField("first", T.LongType()),
        T.StructField("pairs", T.ArrayType(T.LongType())), T.StructField("docs", T.ArrayType(T.LongType()))])
    arrow = [pa.int64(), None, *[pa.int64()] * 4, pa.string(), pa.binary(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]

    def table(columns, id_type):
        types = [id_type if t is None else t for t in arrow]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], schema.names)

    def run(batches):
        import os
        from pyspark import TaskContext
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        key = hash((spec_a.value, model_b.value))
        if _worker.get("key") != key:
            _worker.update(key=key, aligner=Aligner(byte_bpe(spec_a.value), piece_bpe(model_b.value)))
        chunk = TaskContext.get().partitionId() << 32
        for part in parts(batches, "text", _CHUNK):
            n = part.num_rows
            id_type = part.column("id").type
            with no_collector():
                found = _worker["aligner"].texts([t or "" for t in part.column("text").to_pylist()])
            codes = [np.frombuffer(f[1], "<i8") if f else np.empty(0, np.int64) for f in found]
            size = np.array([len(c) for c in codes])
            pairs, place = np.unique(np.concatenate(codes), return_inverse=True)
            here, times = np.unique(np.repeat(np.arange(n), size) * max(1, len(pairs)) + place, return_counts=True)
            doc, place = np.divmod(here, max(1, len(pairs)))
            edge = np.searchsorted(doc, np.arange(n + 1))
            groups = [f[0].count(";") + 1 if f else 0 for f in found]
            n_a = [f[2] if f else 0 for f in found]
            nothing = [None] * n
            yield table([[chunk] * n, part.column("id"), n_a, [s + g - x for s, g, x in zip(size.tolist(), groups, n_a)],
                         groups, size, [hashlib.sha256(f[0].encode()).hexdigest() if f else "" for f in found],
                         [pack_sorted(place[a:b].astype(np.uint64)) for a, b in zip(edge, edge[1:])],
                         [pack(times[a:b].astype(np.uint64)) for a, b in zip(edge, edge[1:])], nothing, nothing, nothing], id_type)
            held = np.bincount(place, minlength=len(pairs))
            for a in range(0, len(pairs), _SLICE):
                row = [[chunk], *[[None]] * 8, [a], [pairs[a:a + _SLICE]], [held[a:a + _SLICE]]]
                yield table(row, id_type)
            chunk += 1

    return in_tasks(docs, run, schema)


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id_col``, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Both tokenizers encode a space and the text, without special tokens.  n_links counts the
    pairs of an A and a B token whose bytes overlap; the count of an id pair is the number of
    documents that hold it linked, count_sum is its sum over the links, and n_best the links
    whose count is the highest of their A id (ties included).  Null or empty texts, and those
    whose tokens do not give back the bytes, have no tokens: zeros and an empty hash.  Every row
    is a document of its own, repeated ids included; an empty table gives an empty result; other
    columns are ignored.

    Documents of six megabytes of text share a table of their distinct id pairs.  Only these
    tables are shuffled to be counted, and the counts go back to their chunk.  The highest count
    per A id is broadcast: one row for each id of A's vocabulary at most.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "token-align")
    with open(path_a, encoding="utf-8") as f:           # a few megabytes each, whatever the corpus
        spec_a = spark.sparkContext.broadcast(f.read())
    with open(path_b, "rb") as f:
        model_b = spark.sparkContext.broadcast(f.read())
    size_b = len(piece_bpe(model_b.value)[0])
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = scratch.write(_aligned(rows, spec_a, model_b), "aligned")
    held = found.filter("pairs IS NOT NULL").select("chunk", "first", F.posexplode(F.arrays_zip("pairs", "docs")).alias("at", "x")) \
        .select("chunk", (F.col("first") + F.col("at")).alias("place"), F.col("x.pairs").alias("pair"), F.col("x.docs").alias("docs"))
    counts = scratch.write(held.groupBy("pair").agg(F.sum("docs").alias("n")), "counts")
    by_a = F.expr(f"pair div {size_b}")
    best = counts.groupBy(by_a.alias("a")).agg(F.max("n").alias("best"))
    known = counts.withColumn("a", by_a).join(F.broadcast(best), "a").select("pair", "n", (F.col("n") == F.col("best")).alias("top"))
    back = held.join(known, "pair").select("chunk", "place", "n", "top")
    plain = found.filter("pairs IS NULL").drop("first", "pairs", "docs").withColumnRenamed("chunk", "of_chunk")
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    schema = T.StructType([plain.schema["id"], *[T.StructField(n, T.LongType()) for n in names], T.StructField("groups_sha256", T.StringType())])

    def weigh(documents: pa.Table, table: pa.Table) -> pa.Table:
        place = table.column("place").to_numpy()
        n, top = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        n[place], top[place] = table.column("n").to_numpy(), table.column("top").to_numpy()
        best, total = [], []
        for p, t in zip(documents.column("place").to_pylist(), documents.column("times").to_pylist()):
            at, times = unpack_sorted(p).astype(np.int64), unpack(t).astype(np.int64)
            best.append(int(times @ top[at]))
            total.append(int(times @ n[at]))
        out = [documents.column(c) for c in ("id", "n_a", "n_b", "n_groups", "n_links")]
        return pa.Table.from_arrays([*out, pa.array(best, pa.int64()), pa.array(total, pa.int64()), documents.column("groups_sha256")], schema.names)

    return plain.groupBy("of_chunk").cogroup(back.groupBy("chunk")).applyInArrow(weigh, schema).withColumnRenamed("id", id_col)
