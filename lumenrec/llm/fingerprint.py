"""Document fingerprints by locally consistent parsing."""

from __future__ import annotations

import base64
import hashlib
import itertools
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import in_tasks, parts

BINS = 64            # registers of a level
_FEW = 12            # filled registers from which a level is compared; a text of more phrases has another level
_EMPTY = 0xFFFF
_CHARS = 300_000     # code points that are parsed at a time
_EDGE = np.uint64(1 << 63)     # stands before, between and after texts

_u64 = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _u64(33))) * _u64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _u64(29))) * _u64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _u64(32))


_WEIGHT = _mix(np.arange(1, 65, dtype=np.uint64) * _u64(0x9E3779B97F4A7C15)) | _u64(1)


def _toss(label: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Deterministic coin tossing: twice the lowest bit in which a label differs from the one
    before it, plus that bit.  Neighbours that differ get labels that differ; 64-bit labels
    become less than 129, then 16, then 8.  A text's first label sees the edge alone."""
    before = np.empty_like(label)
    before[1:] = label[:-1]
    before[0] = label[0]
    change = label ^ before
    low = change & (~change + label.dtype.type(1))
    k = np.bitwise_count(low - label.dtype.type(1))
    bit = (label >> np.minimum(k, 8 * label.itemsize - 1).astype(label.dtype)) & label.dtype.type(1)
    out = (2 * k + bit.astype(np.uint8)).astype(np.uint8)
    out[edge] = 255
    return out


def _parse(x: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level up: the names of the phrases of ``x``, and which of them are edges.

    Runs of one symbol become one symbol; phrases begin where the tossed labels peak, so where
    they begin depends on a few neighbours alone; a name hashes a phrase's symbols in order.
    """
    keep = np.empty(len(x), bool)
    keep[0] = True
    np.not_equal(x[1:], x[:-1], out=keep[1:])
    keep |= edge
    at = np.flatnonzero(keep)
    run = np.diff(at, append=len(x))
    y, e = x[at], edge[at]
    several = run > 1
    y[several] = _mix(y[several] + run[several].astype(np.uint64) * _u64(0x9E3779B97F4A7C15))
    label = _toss(y, e)
    label = _toss(label, e)
    label = _toss(label, e)
    begin = e.copy()
    begin[1:] |= e[:-1]
    begin[1:-1] |= (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    begin[0] = True
    first = np.flatnonzero(begin)
    place = np.arange(len(y)) - first[np.cumsum(begin) - 1]
    name = _mix(np.add.reduceat(y * _WEIGHT[place & 63], first))
    e = e[first]
    name[e] = _EDGE
    return name, e


def _registers(texts: list[str]) -> list[np.ndarray]:
    """Registers (level, bin) of each text: sixteen bits of the phrase name that comes first in its
    bin by sixteen others.  A text has levels until one has few phrases, whatever its length."""
    n = len(texts)
    size = np.fromiter(map(len, texts), np.int64, n)
    total = int(size.sum()) + n + 1
    edge = np.zeros(total, bool)
    edge[np.concatenate(([0], np.cumsum(size + 1)))] = True
    x = np.empty(total, np.uint64)
    x[edge] = _EDGE
    x[~edge] = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    levels, more = [], np.ones(n, bool)
    count = np.zeros(n, np.int64)
    while more.any():
        x, edge = _parse(x, edge)
        text = (np.cumsum(edge) - 1)[~edge]
        name = x[~edge]
        own = np.minimum((name >> _u64(8)) & _u64(0xFFFF), _u64(_EMPTY - 1))
        cell = text.astype(np.uint64) * _u64(BINS) + (name & _u64(BINS - 1))
        key = np.sort((cell << _u64(32)) | (name >> _u64(48)) << _u64(16) | own)
        out = np.full((n, BINS), _EMPTY, np.uint16)
        if key.size:
            cell = key >> _u64(32)
            first = np.concatenate(([True], cell[1:] != cell[:-1]))
            out.reshape(-1)[cell[first].astype(np.int64)] = key[first] & _u64(0xFFFF)
        levels.append(out)
        count += more
        more &= np.bincount(text, minlength=n) > _FEW
    whole = np.stack(levels, axis=1)
    return [whole[i, :k] for i, k in enumerate(count.tolist())]


def registers(texts: list[str]) -> list[np.ndarray]:
    """Registers of many texts, about 300,000 code points at a time."""
    out, some, held = [], [], 0
    for t in texts:
        some.append(t)
        held += len(t)
        if held >= _CHARS:
            out += _registers(some)
            some, held = [], 0
    return out + _registers(some) if some else out


def encoded(regs: list[np.ndarray]) -> list[str]:
    """Fingerprints as text: base64 of the registers (little-endian), level by level."""
    return [base64.b64encode(r.astype("<u2").tobytes()).decode() for r in regs]


def _stacked(regs: list[np.ndarray], levels: int) -> np.ndarray:
    out = np.full((len(regs), levels, BINS), _EMPTY, np.uint16)
    for i, r in enumerate(regs):
        out[i, :len(r)] = r
    return out


def likeness(first: list[np.ndarray], second: list[np.ndarray]) -> np.ndarray:
    """Share of equal registers among those filled in either, pair by pair (0 to 1).

    Compared at the highest level at which both have at least 12 filled registers, else at the
    first level; two empty texts are alike, an empty and another text are not.
    """
    if not first:
        return np.empty(0)
    levels = max(map(len, itertools.chain(first, second)))
    a, b = _stacked(first, levels), _stacked(second, levels)
    fa, fb = a != _EMPTY, b != _EMPTY
    enough = (fa.sum(axis=2) >= _FEW) & (fb.sum(axis=2) >= _FEW)
    level = np.where(enough.any(axis=1), levels - 1 - enough[:, ::-1].argmax(axis=1), 0)
    each = np.arange(len(a))
    x, y, fx, fy = a[each, level], b[each, level], fa[each, level], fb[each, level]
    either = (fx | fy).sum(axis=1)
    same = ((x == y) & fx & fy).sum(axis=1)
    return np.where(either == 0, 1.0, same / np.maximum(either, 1))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``id_col``, n_chars (code points) and fingerprint of the whole text.

    Null text is empty; an empty text's registers are empty.  Rows are parsed one by one:
    repeated rows, null ids and empty tables need no rule; other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("n_chars", T.LongType()),
                           T.StructField("fingerprint", T.StringType())])

    def run(batches):
        for part in parts(batches):
            some = [t or "" for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), pa.array([len(t) for t in some], pa.int64()), pa.array(encoded(registers(some)))],
                ["id", "n_chars", "fingerprint"])

    return in_tasks(rows, run, schema).withColumnRenamed("id", id_col)


# ---------------------------------------------------------------- texts edited with their neighbour's

_VALUES = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
_TYPES = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
_PER_PART, _SAMPLED = 500, 40      # rows of a part at least; sampled keys for each part


def _compared(chain: list[str]) -> list[list]:
    """The columns _VALUES of each text but the last, each edited with the one after it."""
    edited = []
    for t, following in pairwise(chain):
        half = len(t) // 2
        edited.append(t[:len(t) - half] + following[:half])
    own, new = registers(chain), registers(edited)
    names = encoded(own)
    return [[len(t) for t in chain[:-1]], [hashlib.sha256(t.encode()).hexdigest() for t in edited],
            names[:-1], encoded(new), likeness(own[:-1], new).tolist(), likeness(own[:-1], own[1:]).tolist()]


def _after(keys: list, at: Column, kind: T.DataType) -> Column:
    """How many of the sorted ``keys`` are not greater than ``at``, by binary search."""
    if not keys:
        return F.lit(0)
    table = F.array(*[F.struct(F.lit(k[0]).cast(kind).alias("id"), F.lit(k[1]).alias("tk"), F.lit(k[2]).alias("row")) for k in keys])

    def halve(acc, _):
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        up = F.struct((mid + 1).alias("lo"), acc["hi"].alias("hi"))
        down = F.struct(acc["lo"].alias("lo"), mid.alias("hi"))
        return F.when(acc["lo"] >= acc["hi"], acc).when(F.get(table, mid) <= at, up).otherwise(down)

    steps = F.sequence(F.lit(1), F.lit(len(keys).bit_length()))
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(keys)).alias("hi"))
    return F.aggregate(steps, start, halve, lambda acc: acc["lo"])


def _parts_in_order(rows: DataFrame) -> DataFrame:
    """``rows`` (id, tk, row, text) with the ordered part they belong to, and for each part one more
    row after its last: the text of the first row of the next part (after the last: of the first).

    Parts begin at sampled rows, whose keys are constants of the plan: a lost task is computed
    again with the same parts.  The sample only balances them.  If so many rows are equal that they
    fill parts, ``row``, their place in the input, splits them.
    """
    spark = rows.sparkSession
    n = rows.count()
    parts_ = max(1, min(8 * int(spark.conf.get("spark.sql.shuffle.partitions")), n // _PER_PART))
    order, keys = [F.asc_nulls_first("id"), "tk", "row"], []
    plain = rows.withColumn("row", F.lit(0).cast("long"))
    for rows in (plain, rows) if parts_ > 1 else (plain,):
        if parts_ > 1:
            some = rows.select("id", "tk", "row").sample(min(1.0, _SAMPLED * parts_ / n), seed=1).orderBy(*order).collect()
            keys = [tuple(some[i * len(some) // parts_]) for i in range(1, parts_)] if len(some) >= parts_ else []
            keys = list(dict.fromkeys(keys))
            if len(keys) == parts_ - 1:          # else equal rows fill whole parts: their places tell them apart
                break
    kind = rows.schema["id"].dataType
    placed = rows.withColumn("part", _after(keys, F.struct("id", "tk", "row"), kind)).withColumn("follows", F.lit(0))
    first = rows.orderBy(*order).limit(1).select(F.lit(len(keys)).alias("part"), "text")
    begins = first
    if keys:
        at = spark.createDataFrame([(*k, i) for i, k in enumerate(keys)], T.StructType(
            [T.StructField("b_id", kind), *[T.StructField(c, T.LongType()) for c in ("b_tk", "b_row")], T.StructField("part", T.IntegerType())]))
        found = rows.join(F.broadcast(at), F.col("id").eqNullSafe(F.col("b_id")) & (F.col("tk") == F.col("b_tk")) & (F.col("row") == F.col("b_row")))
        begins = found.select("part", "text").unionByName(first)
    none = [F.lit(None).cast(kind).alias("id"), *[F.lit(0).cast("long").alias(c) for c in ("tk", "row")]]
    return placed.unionByName(begins.select(*none, "text", "part", F.lit(1).alias("follows")))


def edited_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its fingerprint, that of its edited text, and two likenesses.

    The edited text has the last floor(n_chars / 2) code points replaced by the first as many
    (or all) of the next row's text, in ascending order of the id; after the last comes the
    first.  Returns ``id_col``, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    Null text is empty; null ids come first; rows with one id are ordered by a hash of the
    text, equal rows among them in any order (they are alike); a lone row is its own neighbour;
    an empty table gives an empty result; other columns are ignored.

    Texts are shuffled once, in ordered parts, and a task walks the rows of its parts; nothing
    else is written.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("tk"), F.monotonically_increasing_id().alias("row"), text.alias("text"))
    order = ["part", "follows", F.asc_nulls_first("id"), "tk", "row"]
    laid = _parts_in_order(rows).repartition("part").sortWithinPartitions(*order).select("id", "part", "follows", "text")
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("n_chars", T.LongType()),
                           *[T.StructField(n, T.StringType()) for n in _VALUES[1:4]],
                           *[T.StructField(n, T.DoubleType()) for n in _VALUES[4:]]])

    def walk(batches):
        last = None
        for part in parts(batches):
            chain = part if last is None else pa.Table.from_batches([last, part]).combine_chunks().to_batches()[0]
            n = chain.num_rows - 1
            if n:
                found = [pa.array(v, t) for v, t in zip(_compared(chain.column("text").to_pylist()), _TYPES)]
                own = pc.equal(chain.column("follows").slice(0, n), 0)       # what follows a part is no row of it
                yield pa.RecordBatch.from_arrays([chain.column("id").slice(0, n), *found], schema.names).filter(own)
            last = chain.slice(n, 1)

    return in_tasks(laid, walk, schema).withColumnRenamed("id", id_col)
