"""Byte-level BPE encoding and decoding on padded numpy matrices."""

from __future__ import annotations

import base64
import heapq
import itertools
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import cuts, in_tasks, parts, texts

_NONE = np.int32(2**31 - 1)
_EMPTY = np.uint64(2**64 - 1)
_BITS = 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_WIDTHS = (2, 3, 4, 6, 8, 12, 16, 24, 32, 64, 128, 256)   # length buckets in bytes
_LONG = _WIDTHS[-1]
_DECODED_AT_ONCE = 2_000_000       # ids; a token of up to 128 bytes keeps a slice far under 2 GB


class Ranks:
    """A vocabulary of byte strings with ranks, and a hashed table of the pairs that merge."""

    def __init__(self, lines: bytes):
        rank = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines.splitlines() if x)}
        size = max(rank.values()) + 1
        words = [b""] * size
        for w, r in rank.items():
            words[r] = w
        self.byte = np.array([rank[bytes([b])] for b in range(256)], np.int32)
        self.length = np.array([len(w) for w in words], np.int64)
        self.offset = np.concatenate(([0], np.cumsum(self.length)[:-1])).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(words), np.uint8)
        self.pair = {}
        for w, r in rank.items():
            for k in range(1, len(w)):
                a, b = rank.get(w[:k]), rank.get(w[k:])
                if a is not None and b is not None:
                    self.pair[a << 32 | b] = r
        keys = np.fromiter(self.pair.keys(), np.uint64, len(self.pair))
        values = np.fromiter(self.pair.values(), np.int32, len(self.pair))
        self.keys = np.full(1 << _BITS, _EMPTY, np.uint64)
        self.values = np.full(1 << _BITS, _NONE, np.int32)
        slot = self._slot(keys)
        while keys.size:                               # open addressing, all keys at a time
            free = self.keys[slot] == _EMPTY
            first = np.zeros(keys.size, bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = free & first
            self.keys[slot[put]], self.values[slot[put]] = keys[put], values[put]
            keys, values, slot = keys[~put], values[~put], (slot[~put] + 1) & ((1 << _BITS) - 1)

    @staticmethod
    def _slot(keys):
        return ((keys * _ODD) >> np.uint64(64 - _BITS)).astype(np.int64)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids (an id below 0 is padding); _NONE where a pair does not merge."""
        shape = left.shape
        left, right = left.ravel(), right.ravel()
        out = np.full(left.size, _NONE, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        keys = left[todo].astype(np.uint64) << np.uint64(32) | right[todo].astype(np.uint64)
        slot = self._slot(keys)
        while todo.size:
            held = self.keys[slot]
            hit = held == keys
            out[todo[hit]] = self.values[slot[hit]]
            on = ~hit & (held != _EMPTY)
            todo, keys, slot = todo[on], keys[on], (slot[on] + 1) & ((1 << _BITS) - 1)
        return out.reshape(shape)

    # ---------------------------------------------------------------- one bucket

    def _merge(self, ids: np.ndarray, found: list, rows: np.ndarray) -> None:
        """Merge all rows of a padded matrix; appends (rows, matrix, lengths) to ``found``.

        Each round every row merges its leftmost pair of least rank; rows without a pair leave
        the matrix.
        """
        width = ids.shape[1]
        ranks = self.lookup(ids[:, :-1], ids[:, 1:])
        place = np.arange(width)
        while True:
            at = ranks.argmin(axis=1) if width > 1 else np.zeros(len(ids), np.int64)
            least = ranks[np.arange(len(ids)), at] if width > 1 else np.full(len(ids), _NONE)
            done = least == _NONE
            if done.any():
                found.append((rows[done], ids[done], (ids[done] >= 0).sum(axis=1)))
                on = ~done
                ids, ranks, rows, at, least = ids[on], ranks[on], rows[on], at[on], least[on]
            if not len(ids):
                return
            each = np.arange(len(ids))
            # close the gap behind the merged pair
            shifted = np.concatenate((ids[:, 1:], np.full((len(ids), 1), -1, np.int32)), axis=1)
            ids = np.where(place[None, :] > at[:, None], shifted, ids)
            ids[each, at] = least
            shifted = np.concatenate((ranks[:, 1:], np.full((len(ids), 1), _NONE, np.int32)), axis=1)
            ranks = np.where(place[None, :-1] > at[:, None], shifted, ranks)
            # the pairs on either side of the merged one
            ranks[each, np.minimum(at, width - 2)] = np.where(
                at < width - 1, self.lookup(ids[each, at], ids[each, np.minimum(at + 1, width - 1)]), _NONE)
            before = at > 0
            ranks[each[before], at[before] - 1] = self.lookup(ids[each[before], at[before] - 1], ids[each[before], at[before]])

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """The same order of merges for one long piece, by a heap of (rank, place)."""
        ids = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = self.pair
        heap = [(r, i) for i in range(n - 1) if (r := pair.get(ids[i] << 32 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else n
            if j >= n or pair.get(ids[i] << 32 | ids[j]) != rank:
                continue
            ids[i], ids[j] = rank, -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := pair.get(ids[i] << 32 | ids[k])) is not None:
                    heapq.heappush(heap, (r, i))
            p = before[i]
            if p >= 0 and (r := pair.get(ids[p] << 32 | ids[i])) is not None:
                heapq.heappush(heap, (r, p))
        return np.array([x for x in ids if x >= 0], np.int32)

    # ---------------------------------------------------------------- many pieces

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after another, and how many each has."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        count = np.zeros(len(pieces), np.int64)
        data = np.frombuffer(b"".join(pieces), np.uint8)
        start = np.cumsum(size) - size
        bucket = np.searchsorted(_WIDTHS, size)
        found: list = []
        for b, width in enumerate(_WIDTHS):
            rows = np.flatnonzero((bucket == b) & (size > 0))
            for cut in range(0, len(rows), max(1, 2_000_000 // width)):
                some = rows[cut:cut + max(1, 2_000_000 // width)]
                at = start[some][:, None] + np.arange(width)[None, :]
                inside = np.arange(width)[None, :] < size[some][:, None]
                ids = np.where(inside, self.byte[data[np.minimum(at, len(data) - 1)]], np.int32(-1))
                self._merge(ids, found, some)
        longer = [(i, self._merge_long(pieces[i])) for i in np.flatnonzero(size > _LONG).tolist()]
        for rows, _, lengths in found:
            count[rows] = lengths
        for i, ids in longer:
            count[i] = len(ids)
        place = np.cumsum(count) - count
        out = np.empty(int(count.sum()), np.int32)
        for rows, ids, lengths in found:
            inside = np.arange(ids.shape[1])[None, :] < lengths[:, None]
            out[(place[rows][:, None] + np.arange(ids.shape[1])[None, :])[inside]] = ids[inside]
        for i, ids in longer:
            out[place[i]:place[i] + len(ids)] = ids
        return out, count

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all ids one after another, and the length of each."""
        length = self.length[ids]
        shift = self.offset[ids] - (np.cumsum(length) - length)
        return self.bytes[np.repeat(shift, length) + np.arange(int(length.sum()))], length


def byte_level() -> dict[str, int]:
    """Byte of each character of a byte-level vocabulary: the printable bytes stand for themselves,
    the others for the characters from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(c): b for c, b in [*zip(plain, plain), *zip(itertools.count(256), rest)]}


def _ragged(values: np.ndarray, start: np.ndarray, count: np.ndarray, pick: np.ndarray) -> np.ndarray:
    """The runs ``pick`` of a ragged array, one after another."""
    n = count[pick]
    shift = start[pick] - (np.cumsum(n) - n)
    return values[np.repeat(shift, n) + np.arange(int(n.sum()))]


_ranks: dict[int, Ranks] = {}


def _load(lines: bytes) -> Ranks:
    """The vocabulary's tables, built once in each Python worker."""
    key = hash(lines)
    if key not in _ranks:
        _ranks.clear()
        _ranks[key] = Ranks(lines)
    return _ranks[key]


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """Per row: ``id_col`` and ids (array of int) of the whole text.

    Each match of ``pattern`` is encoded separately by the ranks; no special tokens.  Equal
    pieces of a slice of about two million bytes are encoded once, in matrices of one length
    bucket each; pieces over 256 bytes take a heap with the same order of merges, as a matrix
    row would take quadratic time.

    Null or empty text has no ids.  Rows are encoded one by one: repeated rows, null ids and
    empty tables need no rule; other columns are ignored.  Nothing is shuffled.
    """
    sc = docs.sparkSession.sparkContext
    with open(ranks_path, "rb") as f:           # about one megabyte, whatever the corpus
        table = sc.broadcast(f.read())
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches):
        import regex
        split = regex.compile(pattern).findall
        ranks = _load(table.value)
        for part in parts(batches):
            seen: dict[str, int] = defaultdict()
            seen.default_factory = seen.__len__
            pieces = [split(t) for t in texts(part)]
            per = np.fromiter(map(len, pieces), np.int64, len(pieces))
            pick = np.fromiter((seen[p] for ps in pieces for p in ps), np.int64, int(per.sum()))
            ids, count = ranks.encode([p.encode() for p in seen])
            start = np.cumsum(count) - count
            edge = np.concatenate(([0], np.cumsum(per)))
            tokens = np.concatenate(([0], np.cumsum(count[pick])))[edge]
            values = _ragged(ids, start, count, pick)
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.ListArray.from_arrays(pa.array(tokens, pa.int32()), pa.array(values, pa.int32()))],
                ["id", "ids"])

    return in_tasks(rows, run, schema).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ranks_path: str, ids_col: str = "ids", to: str = "decoded") -> DataFrame:
    """The rows with the bytes of their ids in the binary column ``to`` (null ids: no bytes).

    Rows are decoded in slices of about two million ids, one row at least.
    """
    sc = encoded.sparkSession.sparkContext
    with open(ranks_path, "rb") as f:
        table = sc.broadcast(f.read())
    at = encoded.columns.index(ids_col)
    plain = encoded.toDF(*[f"c{i}" for i in range(len(encoded.columns))])
    schema = T.StructType([*plain.schema.fields, T.StructField("out", T.BinaryType())])

    def run(batches):
        ranks = _load(table.value)
        for batch in batches:
            count = pc.fill_null(pc.list_value_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            for a, b in cuts(count, _DECODED_AT_ONCE):
                part = batch.slice(a, b - a)
                data, length = ranks.decode(part.column(at).flatten().to_numpy(zero_copy_only=False))
                edge = np.concatenate(([0], np.cumsum(length)))[np.concatenate(([0], np.cumsum(count[a:b])))]
                out = pa.Array.from_buffers(pa.binary(), part.num_rows,
                                            [None, pa.py_buffer(edge.astype(np.int32)), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([*part.columns, out], [*part.schema.names, "out"])

    return in_tasks(plain, run, schema).toDF(*encoded.columns, to)
