"""Best-fit packing of tokenised documents into sequences."""

from __future__ import annotations

import itertools
import re
import zlib
from collections.abc import Iterator
from json import loads

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import in_tasks, no_collector, parts
from .bpe import _ragged, byte_level
from .common import Scratch

_WORDS_KEPT, _PIECES_KEPT = 250_000, 500_000      # in each of two generations that a Python worker keeps
_WORDS_AT_ONCE = 20_000
_TEXT_AT_ONCE = 5_000_000      # bytes of text whose unseen words are gathered together
_worker: dict = {}

# ---- fixed values: how the lower-casing word tokenizer splits a word ---------------------
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# --------------------------------------------------------------------------------------------
_CONTRACTED = ("s", "t", "re", "ve", "m", "ll", "d")
# white space, letters, numbers and the rest of lower-cased Latin-1, as Unicode has them
_SPACE, _LETTER, _NUMBER, _SIGN = range(4)
_CLASS = np.full(256, _SIGN, np.uint8)
_CLASS[[*range(9, 14), 32, 0x85, 0xA0]] = _SPACE
_CLASS[[*range(97, 123), 0xAA, 0xB5, 0xBA, *range(0xDF, 0xF7), *range(0xF8, 0x100)]] = _LETTER
_CLASS[[*range(48, 58), 0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE]] = _NUMBER
_HASHED_AT_ONCE = 2_000_000        # characters whose parts are hashed by running sums
_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)


def _part_bounds(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each part of lower-cased Latin-1 text: runs of letters, single numbers, runs
    of signs; an apostrophe that stands alone takes the letters of a contraction."""
    kind = _CLASS[x]
    before = np.concatenate(([_SPACE], kind[:-1]))
    begin = (kind != before) | (kind == _NUMBER)
    after = np.concatenate((kind[1:], [_SPACE]))
    quote = np.flatnonzero((x == 39) & (before != _SIGN) & (after == _LETTER))
    if quote.size:
        one = np.append(x, [0, 0])[quote + 1]
        two = np.append(x, [0, 0, 0])[quote + 2]
        for letters in _CONTRACTED:
            hit = quote[(one == ord(letters[0])) & ((two == ord(letters[1])) if len(letters) == 2 else True)]
            end = hit + 1 + len(letters)
            begin[hit + 1] = False
            inside = end[end < len(x)]
            begin[inside] |= kind[inside] == _LETTER
    first = np.flatnonzero(begin & (kind != _SPACE))
    breaks = np.flatnonzero(begin)
    last = np.append(breaks, len(x))[np.searchsorted(breaks, first) + 1]
    return first, last


class _Powers:
    """Powers of an odd multiplier and of its inverse modulo 2^64, for hashes by running sums."""

    def __init__(self, base: int):
        def powers(b):
            out = np.full(_HASHED_AT_ONCE + 1, b, np.uint64)
            out[0] = 1
            return np.multiply.accumulate(out)
        self.up, self.down = powers(base), powers(pow(base, -1, 1 << 64))

    def hashes(self, x: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((x.astype(np.uint64) + np.uint64(1)) * self.up[:len(x)])))
        return (total[last] - total[first]) * self.down[first]


class _Kept:
    """A dictionary of two generations: what is used again outlives those that are not."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def turn(self) -> None:
        if len(self.young) > self.most:
            self.old, self.young = self.young, {}

    def unseen(self, keys: set) -> list:
        """Those of the keys that no generation has; the others are young afterwards."""
        young, old = self.young, self.old
        new = [k for k in keys if k not in young]
        if old:
            again = [k for k in new if k in old]
            young.update(zip(again, [old[k] for k in again]))
            new = [k for k in new if k not in young]
        return new


class WordIds:
    """Ids of white-space separated words by a tokenizer that drops white space, as bytes.

    Such a tokenizer encodes each word by itself, so a text's ids are those of its words and a
    word seen before is not encoded again.  A special token's string in a text is that token; it
    must hold no white space.  If the file is of the lower-casing kind with the split above, texts
    in Latin-1 are split here, and their parts take the place of words.
    """

    def __init__(self, json: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_str(json)
        self.words, self.pieces = _Kept(_WORDS_KEPT), _Kept(_PIECES_KEPT)
        self.powers: list[_Powers] = []
        self.ranks, self.rank_ids = _word_end_ranks(json)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # a special token's string begins with a sign that no text split here holds
        self.splits = _splits_as_known(json) and all(t.startswith("<") for t in added)
        self.word_end = np.zeros(self.tokenizer.get_vocab_size(), bool)
        self.word_end[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True

    def _encode(self, words: list[bytes]) -> Iterator[bytes]:
        for a in range(0, len(words), _WORDS_AT_ONCE):
            some = [w.decode() for w in words[a:a + _WORDS_AT_ONCE]]
            starts = np.cumsum([0] + [len(w) + 1 for w in some[:-1]])
            found = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            at = np.array([o[0] for o in found.offsets], np.int64)
            n = np.bincount(np.searchsorted(starts, at, "right") - 1, minlength=len(some))
            yield from _cut(found.ids, np.cumsum(n))

    def _encode_parts(self, parts: list[str]) -> Iterator[bytes]:
        """As _encode, of parts that the tokenizer does not split: each ends with its only word-end token."""
        for a in range(0, len(parts), _WORDS_AT_ONCE):
            some = parts[a:a + _WORDS_AT_ONCE]
            if self.ranks is None:
                found, = self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)
                ids = np.array(found.ids, np.int64)
            else:
                ids = self.rank_ids[self.ranks.encode_ordinary("\0".join([*some, ""]))]
            yield from _cut(ids, np.flatnonzero(self.word_end[ids]) + 1)

    def texts(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        out = [b""] * len(texts)
        simple = [i for i, t in enumerate(texts) if self.splits and _simple(t)]
        self.pieces.turn()
        some, held = [], 0
        for i in simple:
            if some and held + len(texts[i]) >= _HASHED_AT_ONCE:
                self._by_parts(texts, some, out)
                some, held = [], 0
            some.append(i)
            held += len(texts[i]) + 1
        self._by_parts(texts, some, out)
        others = set(range(len(texts))) - set(simple)
        words = {i: texts[i].encode().split() for i in others}
        self.words.turn()
        new = self.words.unseen(set(itertools.chain.from_iterable(words.values())))
        if new:
            self.words.young.update(zip(new, self._encode(new)))
        for i, x in words.items():
            out[i] = b"".join([self.words.young[w] for w in x])
        return out

    def _by_parts(self, texts: list[str], some: list[int], out: list[bytes]) -> None:
        """The ids of the texts ``some`` through their distinct parts, which two 64-bit hashes tell apart."""
        if not some:
            return
        low = "\n".join([texts[i] for i in some]).lower()
        x = np.frombuffer(low.encode("latin-1"), np.uint8)
        if len(x) > _HASHED_AT_ONCE:              # one text by itself
            parts = _PARTS.findall(low)
            new = self.pieces.unseen(set(parts))
            self.pieces.young.update(zip(new, self._encode_parts(new)))
            out[some[0]] = b"".join([self.pieces.young[p] for p in parts])
            return
        first, last = _part_bounds(x)
        if not self.powers:
            self.powers = [_Powers(m) for m in _MULTIPLIERS]
        one, two = (p.hashes(x, first, last) for p in self.powers)
        which, distinct = pd.factorize(one)
        at = np.empty(len(distinct), np.int64)
        at[which[::-1]] = np.arange(len(one))[::-1]            # the first place of each
        if not ((two[at][which] == two) & ((last - first)[at][which] == last - first)).all():
            raise AssertionError("parts of one hash differ")
        parts = [low[a:b] for a, b in zip(first[at].tolist(), last[at].tolist())]
        new = self.pieces.unseen(set(parts))
        if new:
            self.pieces.young.update(zip(new, self._encode_parts(new)))
        found = [self.pieces.young[p] for p in parts]
        count = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids = np.frombuffer(b"".join(found), "<u4")
        data = _ragged(ids, np.cumsum(count) - count, count, which).astype("<u4").tobytes()
        ends = np.cumsum([len(texts[i]) + 1 for i in some])
        token = np.concatenate(([0], np.cumsum(count[which])))[np.searchsorted(first, np.concatenate(([0], ends)))] * 4
        for i, a, b in zip(some, token.tolist(), token[1:].tolist()):
            out[i] = data[a:b]


# the same split by a pattern, for a text longer than the running sums reach
_PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]"
                    "|[^a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe\t-\r \x85\xa0]+")


def _simple(text: str) -> bool:
    """Whether a text is Latin-1 and holds no ``<`` and no NUL."""
    if "<" in text or "\0" in text:
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _cut(ids, ends: np.ndarray) -> list[bytes]:
    """The ids up to each end, as little-endian 32-bit numbers."""
    data, ends = np.asarray(ids, "<u4").tobytes(), (ends * 4).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def _word_end_ranks(json: str):
    """An encoder for parts that each end in NUL, by the library for ranks, and the file's id of each
    of its ids; (None, None) for a file whose ids are not in order of its merges.

    The mark of a word's end is a symbol of its own there: joined to the byte before it first, as
    these pairs have the least ranks, it leaves what the file's merges begin with.
    """
    import tiktoken
    model, to_byte = loads(json)["model"], byte_level()
    vocab = model["vocab"]
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    ends = [c + "</w>" for c in to_byte]
    ids = [vocab.get(m) for m in merged]
    if (any(t not in vocab for t in (*to_byte, *ends)) or None in ids or ids != sorted(set(ids))
            or any(model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges"))):
        return None, None

    def raw(token: str) -> bytes:
        return bytes(to_byte[c] for c in token.removesuffix("</w>")) + b"\0" * token.endswith("</w>")

    order = sorted(to_byte, key=to_byte.get) + [t for t in ends if to_byte[t[0]]] + merged
    ranks = {raw(t): i for i, t in enumerate(order)}
    known = {i: vocab[t] for i, t in enumerate(order)}
    if len(ranks) != len(order):
        return None, None
    encoder = tiktoken.Encoding("word ends", pat_str=r"[^\x00]+\x00", mergeable_ranks=ranks, special_tokens={})
    return encoder, np.array([known[i] for i in range(len(order))], np.int64)


def _splits_as_known(json: str) -> bool:
    """Whether a tokenizer file normalizes and splits as the constants above say."""
    spec = loads(json)
    norm, pre = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    first, *rest = pre.get("pretokenizers") or [{}]
    return ([n["type"] for n in norm.get("normalizers", [])] == _NORMALIZERS and first.get("pattern") == {"Regex": _SPLIT}
            and first.get("invert") is True and [r["type"] for r in rest] == ["ByteLevel"] and rest[0].get("use_regex") is False
            and spec["model"].get("end_of_word_suffix") == "</w>")


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                     max_tokens: int = 4096, end_id: int = 1, checksums: bool = False) -> DataFrame:
    """Documents as pieces of at most ``max_tokens`` ids: ``id_col``, piece, start, length, ids (binary),
    or with ``checksums`` the CRC-32 of ids, ids_crc32 (long), in place of them.

    A document is its text's ids (null: empty) and ``end_id``; only a longer one is cut, every
    ``max_tokens`` ids.  ids holds little-endian unsigned 32-bit numbers.  The tokenizer file
    must name one that drops white space.  Rows are encoded one by one; nothing is shuffled.
    """
    sc = docs.sparkSession.sparkContext
    with open(tokenizer_path, encoding="utf-8") as f:      # a few megabytes, whatever the corpus
        json = sc.broadcast(f.read())
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
                           T.StructField("length", T.LongType()),
                           T.StructField("ids_crc32", T.LongType()) if checksums else T.StructField("ids", T.BinaryType())])
    last = np.array([end_id], "<u4").tobytes()

    def run(batches):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        key = hash(json.value)
        if _worker.get("key") != key:
            _worker.update(key=key, ids=WordIds(json.value))
        step = 4 * max_tokens
        for part in parts(batches, chars=_TEXT_AT_ONCE):
            row, start, out = [], [], []
            with no_collector():
                found = _worker["ids"].texts([t or "" for t in part.column("text").to_pylist()])
            for i, ids in enumerate(found):
                ids += last
                for a in range(0, len(ids), step):
                    row.append(i)
                    start.append(a // 4)
                    out.append(ids[a:a + step])
            starts = np.array(start, np.int64)
            ids = pa.array([zlib.crc32(x) for x in out], pa.int64()) if checksums else pa.array(out, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [part.column("id").take(pa.array(row, pa.int64())), pa.array((starts // max_tokens).astype(np.int32)),
                 pa.array(starts), pa.array([len(x) // 4 for x in out], pa.int64()), ids], schema.names)

    return in_tasks(rows, run, schema).withColumnRenamed("id", id_col)


def best_fit(length: np.ndarray, cost: np.ndarray, capacity: tuple[float, float, float],
             weights: tuple[float, float, float], select: str) -> np.ndarray:
    """Bin of each item by vector best-fit in decreasing order of length.

    An item takes (length, 1, cost) of a bin's (tokens, documents, attention cost).  Among the
    open bins with room in every dimension it goes to the one of least weighted residual norm
    after it (``select="norm"``), or of greatest weighted dot product of item and residual
    (``"dot"``); ties go to the oldest bin.  Both are in units of the capacities.
    """
    cap = np.array(capacity, float)
    w = np.array(weights, float)
    order = np.lexsort((np.arange(len(length)), -length))
    item = np.stack((length, np.ones(len(length)), cost), axis=1) / cap
    least = np.minimum.accumulate(item[order][::-1], axis=0)[::-1]     # least need of the items to come
    out = np.empty(len(length), np.int64)
    used, opened, slack = 0, 0, 1e-9
    room, room_names = np.ones((1024, 3)), np.zeros(1024, np.int64)
    for k, i in enumerate(order.tolist()):
        if k % 256 == 0 and used:                     # bins without room for any item to come are closed
            on = (room[:used] >= least[k] - slack).all(axis=1)
            n = int(on.sum())
            room[:n], room_names[:n] = room[:used][on], room_names[:used][on]
            used = n
        residual = room[:used]
        fits = np.flatnonzero((residual >= item[i] - slack).all(axis=1))
        if fits.size:
            if select == "dot":
                best = fits[np.argmax(residual[fits] @ (w * item[i]))]
            else:
                best = fits[np.argmin(((residual[fits] - item[i]) ** 2) @ w)]
        else:
            if used == len(room):
                room, room_names = np.concatenate((room, np.ones_like(room))), np.concatenate((room_names, room_names))
            best, room[used], room_names[used] = used, 1.0, opened
            used, opened = used + 1, opened + 1
        room[best] -= item[i]
        out[i] = room_names[best]
    return out


def _pack_partitions(items: DataFrame, groups: int, base: int, capacity, weights, select) -> DataFrame:
    """Items dealt evenly over ``groups`` tasks, each packed by itself; adds sequence_id, offset, filled."""
    schema = T.StructType([*items.schema.fields, T.StructField("sequence_id", T.LongType()),
                           T.StructField("offset", T.LongType()), T.StructField("filled", T.LongType())])
    at = items.columns.index("length")

    def run(batches):
        from pyspark import TaskContext
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        table = pa.Table.from_batches(got).combine_chunks()
        length = table.column(at).to_numpy().astype(np.int64)
        bins = best_fit(length, length.astype(float) ** 2, capacity, weights, select)
        order = np.lexsort((np.arange(len(bins)), bins))
        ends = np.cumsum(length[order])
        first = np.concatenate(([True], np.diff(bins[order]) != 0))
        begin = (ends - length[order])[first][np.cumsum(first) - 1]
        offset = np.empty(len(bins), np.int64)
        offset[order] = ends - length[order] - begin
        filled = np.bincount(bins, weights=length).astype(np.int64)[bins]
        name = base + (TaskContext.get().partitionId() << 32) + bins
        out = pa.Table.from_arrays([*table.columns, pa.array(name), pa.array(offset), pa.array(filled)],
                                   names=[*table.column_names, "sequence_id", "offset", "filled"])
        yield from out.to_batches(max_chunksize=10_000)

    return in_tasks(items.repartition(groups), run, schema)


def pack(pieces: DataFrame, scratch: Scratch, max_tokens: int = 4096, max_documents: int | None = None,
         max_cost: float | None = None, weights: tuple[float, float, float] = (1.0, 1e-6, 1e-6),
         select: str = "norm", group_rows: int = 20_000, full: float = 0.998) -> DataFrame:
    """Pieces (a written table with a ``length`` of at most ``max_tokens``) with sequence_id and offset.

    Capacities of a sequence: tokens, documents, and attention cost (the sum of squared
    lengths); those left out do not bind.  Pieces are dealt evenly over tasks of about
    ``group_rows`` rows and packed there; the sequences that stay less than ``full`` are opened
    again and their pieces packed anew in a second pass over all tasks.  Each task leaves a
    bin or two unfilled at the end, whatever the size of the table.
    """
    capacity = (max_tokens, max_documents or max_tokens, max_cost or float(max_tokens) ** 2)
    names = pieces.columns
    first = scratch.write(_pack_partitions(pieces, _groups(pieces, group_rows), 0, capacity, weights, select), "packed")
    loose = first.filter(F.col("filled") < full * max_tokens).select(*names)
    again = _pack_partitions(loose, _groups(loose, group_rows), 1 << 60, capacity, weights, select)
    done = first.filter(F.col("filled") >= full * max_tokens)
    return done.unionByName(again).drop("filled")


def _groups(rows: DataFrame, group_rows: int) -> int:
    return max(1, -(-rows.count() // group_rows))


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   max_tokens: int = 4096, end_id: int = 1, **options) -> DataFrame:
    """One row per piece: ``id_col``, piece, start, length, ids_crc32, sequence_id, offset.

    Null text is empty: the document is ``end_id`` alone.  Rows are documents of their own, so
    repeated rows and null ids are packed like any; an empty table gives an empty result; other
    columns are ignored.  ``options`` go to :func:`pack`.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    plain = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    pieces = tokenized_pieces(plain, tokenizer_path, "__id", "__text", max_tokens, end_id, checksums=True)
    pieces = scratch.write(pieces, "pieces")
    return pack(pieces, scratch, max_tokens, **options).withColumnRenamed("__id", id_col)
