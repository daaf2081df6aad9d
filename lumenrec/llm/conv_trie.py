"""Prefix trie of rebuilt conversations by composable fingerprints.

A conversation is rebuilt from the head of a base conversation and its own later turns.  Its
text is never put together: a sequence of turns has the fingerprint (n, sum of t_i * b^(i-1)),
t_i the hash of turn i, in four lanes modulo 2^31 - 1.  These form a monoid, so the fingerprint
of every rebuilt prefix follows from two numbers of the base, two of the own conversation and a
constant, and the parts of one long conversation are hashed in different tasks and composed.

Equality is exact, not only likely.  Equal turn hashes are compared by the turns' roles and
texts; prefixes of one fingerprint must refer to the same last turn, which by induction makes
the whole prefixes equal.  If either fails, everything is hashed anew with another seed.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import in_tasks
from .common import Scratch

P = (1 << 31) - 1
LANES = 4
NODE = ("depth", "f1", "f2")          # a node's key: depth and packed fingerprint
_IDS = 50_000                         # conversation ids in one piece of a node's list of ends
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _bases(seed: int) -> list[int]:
    """A multiplier for each lane."""
    return [int.from_bytes(hashlib.sha256(f"{seed}:{k}".encode()).digest()[:8], "big") % (P - 2) + 2 for k in range(LANES)]


# ---- turns: fingerprints of the prefixes of every conversation ---------------------------

def _pack(lanes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Four lanes (rows) of 31 bits in two longs."""
    v = lanes.astype(np.int64)
    return v[0] | v[1] << 31, v[2] | v[3] << 31


def _unpack(*packed: int) -> list[int]:
    return [p >> s & P for p in packed for s in (0, 31)]


class _Prefixes:
    """Prefix sums of the turn hashes of conversations that follow each other in sorted batches."""

    def __init__(self, bases: list[int]):
        self.bases = bases
        self.power = np.ones((LANES, 1), np.uint64)
        self.conv, self.n, self.h, self.size = None, 0, np.zeros(LANES, np.uint64), 0

    def _powers(self, n: int) -> np.ndarray:
        while self.power.shape[1] < n:
            more = self.power * np.array([pow(b, self.power.shape[1], P) for b in self.bases], np.uint64)[:, None] % P
            self.power = np.concatenate((self.power, more), axis=1)
        return self.power

    def add(self, conv: np.ndarray, keys: np.ndarray, size: np.ndarray):
        """Position, prefix hash, hash before and bytes before each turn, counted from where this began."""
        m = len(conv)
        new = np.concatenate(([True], conv[1:] != conv[:-1]))
        start = np.flatnonzero(new)
        at = np.cumsum(new) - 1
        place = np.arange(m) - start[at]
        t = (keys & np.uint32(P)).astype(np.uint64).T % P
        term = t * self._powers(m)[:, place] % P

        def within(x):                                  # sums from the start of the own run
            s = np.cumsum(x, axis=-1)
            return s - (s - x)[..., start[at]]

        h, total = within(term) % P, within(size)
        pos, before = place + 1, total - size
        if conv[0] == self.conv:                        # the first run goes on with the last batch's
            k = int(start[1]) if len(start) > 1 else m
            w = np.array([pow(b, self.n, P) for b in self.bases], np.uint64)[:, None]
            term[:, :k] = term[:, :k] * w % P
            h[:, :k] = (h[:, :k] * w + self.h[:, None]) % P
            pos[:k] += self.n
            before[:k] += self.size
        self.conv, self.n, self.h, self.size = conv[-1], int(pos[-1]), h[:, -1].copy(), int(before[-1] + size[-1])
        return pos, h, (h + P - term) % P, before


_PREFIX = T.StructType([T.StructField(n, T.LongType()) for n in
                        ("pid", "conv", "pos", "h1", "h2", "g1", "g2", "r1", "r2", "size", "before")])


def _local_prefixes(sorted_turns: DataFrame, seed: int) -> DataFrame:
    """Per turn its place, prefix fingerprint (h), the one before it (g), reference to the turn's
    hash (r), bytes of its text and bytes before, all counted within the task."""
    bases = _bases(seed)

    def run(batches):
        from pyspark import TaskContext
        pid = TaskContext.get().partitionId()
        state = _Prefixes(bases)
        for b in batches:
            if not b.num_rows:
                continue
            conv, size = b.column("conv").to_numpy(), b.column("size").to_numpy()
            raw = np.frombuffer(b"".join(b.column("key").to_pylist()), np.uint8).reshape(-1, 16)
            pos, h, g, before = state.add(conv, raw.view("<u4"), size)
            ref = raw.view("<i8")
            columns = [np.full(len(conv), pid), conv, pos, *_pack(h), *_pack(g), ref[:, 0], ref[:, 1], size, before]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], _PREFIX.names)

    return in_tasks(sorted_turns, run, _PREFIX)


def _lanes(c1: str | Column, c2: str | Column) -> list[Column]:
    out = []
    for c in (c1, c2):
        c = F.col(c) if isinstance(c, str) else c
        out += [c.bitwiseAND(F.lit(P)), F.shiftright(c, 31).bitwiseAND(F.lit(P))]
    return out


def _packed(lanes: list[Column]) -> tuple[Column, Column]:
    return (lanes[0].bitwiseOR(F.shiftleft(lanes[1], 31)), lanes[2].bitwiseOR(F.shiftleft(lanes[3], 31)))


def _then(first: list[Column], shift: list[Column], second: list[Column]) -> tuple[Column, Column]:
    """Monoid product: ``second`` moved by ``shift`` behind ``first``."""
    return _packed([(a + s * b % P) % P for a, s, b in zip(first, shift, second)])


def _composed(local: DataFrame, seed: int) -> DataFrame:
    """Prefixes of whole conversations: what earlier tasks hold of a conversation is put before.

    A sorted partition shares at most its first conversation with those before it, so the driver
    gets two numbers of each partition and then one partial product of each shared conversation
    and partition.
    """
    spark = local.sparkSession
    ends = local.groupBy("pid").agg(F.min("conv").alias("lo"), F.max("conv").alias("hi")).collect()
    seen: dict[int, int] = {}
    for e in ends:
        for c in {e.lo, e.hi}:
            seen[c] = seen.get(c, 0) + 1
    shared = [(c,) for c, n in seen.items() if n > 1]
    if not shared:
        return local.drop("pid")
    parts = local.join(F.broadcast(spark.createDataFrame(shared, "conv long")), "conv", "left_semi").groupBy("conv", "pid") \
        .agg(F.max("pos").alias("n"), F.max(F.struct("pos", "h1", "h2")).alias("h"), F.sum("size").alias("size")) \
        .select("conv", "pid", "n", "h.h1", "h.h2", "size").collect()
    carry, bases = [], _bases(seed)
    for conv, rows in itertools.groupby(sorted(parts, key=lambda r: (r.conv, r.pid)), key=lambda r: r.conv):
        n, h, size = 0, [0] * LANES, 0
        for r in rows:
            w = [pow(b, n, P) for b in bases]
            if n:
                carry.append((conv, r.pid, n, size, *h, *w))
            h = [(x + y * z) % P for x, y, z in zip(h, w, _unpack(r.h1, r.h2))]
            n, size = n + r.n, size + r.size
    names = [f"{x}{k}" for x in "cw" for k in range(LANES)]
    carried = spark.createDataFrame(carry, "conv long, pid long, n0 long, size0 long, " + ", ".join(f"{n} long" for n in names))
    j = local.join(F.broadcast(carried), ["conv", "pid"], "left")
    first, shift = ([F.col(f"{x}{k}") for k in range(LANES)] for x in "cw")
    moved = {}
    for a, b in (("h1", "h2"), ("g1", "g2")):
        x, y = _then(first, shift, _lanes(a, b))
        moved |= {a: F.when(F.col("n0").isNull(), F.col(a)).otherwise(x), b: F.when(F.col("n0").isNull(), F.col(b)).otherwise(y)}
    return j.select("conv", (F.col("pos") + F.coalesce("n0", F.lit(0))).alias("pos"), *[c.alias(n) for n, c in moved.items()],
                    "r1", "r2", "size", (F.col("before") + F.coalesce("size0", F.lit(0))).alias("before"))


def _turn_prefixes(turns: DataFrame, scratch: Scratch, seed: int) -> DataFrame:
    """(conv, pos, h1, h2, g1, g2, r1, r2, size, before) of every turn."""
    # a conversation's order needs roles and texts only where turn numbers repeat in it
    repeated = not turns.groupBy("conv", "turn").count().filter("count > 1").isEmpty()
    key = F.unhex(F.substring(F.sha2(_turn_bytes(seed), 256), 1, 32))
    rows = turns.select("conv", "turn", key.alias("key"), F.octet_length("text").cast("long").alias("size"),
                        *(["role", "text"] if repeated else []), F.monotonically_increasing_id().alias("row"))
    order = [F.asc_nulls_first(c) for c in ("conv", "turn", *(("role", "text") if repeated else ()), "row")]
    laid = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "key", "size")
    return _composed(scratch.write(_local_prefixes(laid, seed), f"turns-{seed}"), seed)


def _turn_bytes(seed: int) -> Column:
    """A turn's role and text, told apart by the role's length."""
    return F.concat(F.lit(f"{seed}:"), F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))


def _same_hash_same_turn(turns: DataFrame, seed: int) -> bool:
    """Compares the roles and texts of all turns with equal hashes."""
    key = F.substring(F.sha2(_turn_bytes(seed), 256), 1, 32).alias("key")
    return turns.select(key, "role", "text").distinct().groupBy("key").count().filter("count > 1").isEmpty()


# ---- rebuilt conversations ----------------------------------------------------------------

def _conversations(turns: DataFrame, base: Callable, head: Callable, max_head: int, seed: int) -> DataFrame:
    """What every rebuilt conversation is made of, one row each: the base's head, where its own
    turns are cut and moved to, its length, bytes and end."""
    entry = F.struct("pos", "h1", "h2", "g1", "g2", "r1", "r2", "size", "before")
    per = turns.groupBy("conv").agg(
        F.max("pos").alias("n"), F.sum("size").alias("bytes"), F.max(F.struct("pos", "h1", "h2")).alias("last"),
        F.array_sort(F.collect_list(F.when(F.col("pos") <= max_head, entry))).alias("head"))
    own = per.withColumn("cut", F.least(F.lit(max_head), head(F.col("conv"))).cast("int")).withColumn("base", base(F.col("conv")))
    heads = per.select(F.col("conv").alias("b"), F.col("head").alias("b_head"))
    j = own.join(heads, own.base == heads.b, "left")
    taken = F.slice(F.coalesce("b_head", F.array().cast(per.schema["head"].dataType)), F.lit(1), F.col("cut"))
    j = j.withColumn("b_head", taken).withColumn("k", F.size("b_head"))

    def upto(array: str, n: str, field: str) -> Column:      # of the array's n-th entry, 0 before the first
        return F.coalesce(F.get(array, F.col(n) - 1)[field], F.lit(0).cast("long"))

    # own turns start after the cut; they move by the base's head less the cut: b^(k - cut)
    shift = []
    for b in _bases(seed):
        back = [pow(b, P - 1 - i, P) for i in range(max_head + 1)]
        shift.append(F.element_at(F.array(*[F.lit(x).cast("long") for x in back]), F.col("cut") - F.col("k") + 1))
    s1, s2 = _packed(shift)
    j = j.withColumns({"b1": upto("b_head", "k", "h1"), "b2": upto("b_head", "k", "h2"),
                       "b_bytes": upto("b_head", "k", "before") + upto("b_head", "k", "size"),
                       "c1": upto("head", "cut", "h1"), "c2": upto("head", "cut", "h2"),
                       "c_bytes": upto("head", "cut", "before") + upto("head", "cut", "size"), "s1": s1, "s2": s2})
    more = F.col("n") > F.col("cut")
    e1, e2 = _moved(F.col("last.h1"), F.col("last.h2"))
    return j.select("conv", "cut", "k", "b_head", "b1", "b2", "b_bytes", "c1", "c2", "c_bytes", "s1", "s2",
                    (F.col("k") + F.greatest(F.col("n") - F.col("cut"), F.lit(0))).alias("length"),
                    (F.col("b_bytes") + F.when(more, F.col("bytes") - F.col("c_bytes")).otherwise(0)).alias("bytes"),
                    F.when(more, e1).otherwise(F.col("b1")).alias("e1"), F.when(more, e2).otherwise(F.col("b2")).alias("e2"))


def _moved(h1: Column, h2: Column) -> tuple[Column, Column]:
    """The fingerprint of the base's head and the own turns after the cut up to the prefix h."""
    own = [(x - c + P) % P for x, c in zip(_lanes(h1, h2), _lanes("c1", "c2"))]
    return _then(_lanes("b1", "b2"), _lanes("s1", "s2"), own)


def _rebuilt(turns: DataFrame, convs: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """One row per rebuilt conversation and depth from 0: its fingerprint, its parent's, the last
    turn's reference and bytes, and the bytes before it."""
    zero = F.lit(0).cast("long")
    root = F.struct(*[zero.alias(n) for n in ("pos", "h1", "h2", "g1", "g2", "r1", "r2", "size", "before")])
    head = convs.select("conv", "length", *extra, F.explode(F.concat(F.array(root), F.col("b_head"))).alias("x")).select(
        "conv", "length", *extra, F.col("x.pos").alias("depth"), F.col("x.h1").alias("f1"), F.col("x.h2").alias("f2"),
        F.col("x.g1").alias("p1"), F.col("x.g2").alias("p2"), "x.r1", "x.r2", "x.size", "x.before")
    j = turns.join(convs.drop("b_head"), "conv").filter(F.col("pos") > F.col("cut"))
    f, p = _moved(F.col("h1"), F.col("h2")), _moved(F.col("g1"), F.col("g2"))
    own = j.select("conv", "length", *extra, (F.col("pos") - F.col("cut") + F.col("k")).alias("depth"),
                   f[0].alias("f1"), f[1].alias("f2"), p[0].alias("p1"), p[1].alias("p2"), "r1", "r2", "size",
                   (F.col("before") - F.col("c_bytes") + F.col("b_bytes")).alias("before"))
    return head.unionByName(own)


def _ends(convs: DataFrame) -> DataFrame:
    """(depth, f1, f2, ends_sha256) of the nodes at which conversations end.

    Ids are sorted by range of node and id, so a node with very many ends lies over many tasks;
    each packs the ids it has, and a node's hash reads those pieces one after the other.
    """
    names = [*NODE, "conv"]
    pieces = T.StructType([T.StructField(n, T.LongType()) for n in names] + [T.StructField("ids", T.BinaryType())])
    done = T.StructType([*pieces.fields[:3], T.StructField("ends_sha256", T.StringType())])
    each = _IDS

    def pack(batches):
        node, first, ids = None, None, []

        def piece():
            return pa.RecordBatch.from_arrays(
                [pa.array([v], pa.int64()) for v in (*node, first)] + [pa.array([",".join(map(str, ids)).encode()], pa.binary())], names + ["ids"])

        for b in batches:
            rows, out = list(zip(*[b.column(n).to_pylist() for n in names])), []
            for key, some in itertools.groupby(rows, key=lambda r: r[:3]):
                some = [r[3] for r in some]
                if key != node:
                    if ids:
                        out.append(piece())
                    node, first, ids = key, some[0], []
                for a in range(0, len(some), each):
                    if len(ids) >= each:
                        out.append(piece())
                        first, ids = some[a], []
                    ids += some[a:a + each]
            if out:
                yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
        if ids:
            yield piece()

    def hashed(batches):
        node, sha = None, None
        for b in batches:
            out = []
            for r in zip(*[b.column(n).to_pylist() for n in NODE], b.column("ids").to_pylist()):
                if r[:3] != node:
                    if node:
                        out.append((*node, sha.hexdigest()))
                    node, sha = r[:3], hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(r[3])
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(done.names, r)) for r in out])
        if node:
            yield pa.RecordBatch.from_pylist([dict(zip(done.names, (*node, sha.hexdigest())))])

    rows = convs.select(F.col("length").alias("depth"), F.col("e1").alias("f1"), F.col("e2").alias("f2"), "conv")
    packed = in_tasks(rows.repartitionByRange(*names).sortWithinPartitions(*names), pack, pieces)
    return in_tasks(packed.repartition(*NODE).sortWithinPartitions(*names), hashed, done)


# ---- the trie ---------------------------------------------------------------------------------

def prefix_trie(turns: DataFrame, base: Callable[[Column], Column], head: Callable[[Column], Column], max_head: int,
                id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations.

    Conversation c is rebuilt from the first ``head(c)`` turns (at most ``max_head``) of
    conversation ``base(c)`` and its own turns after its first ``head(c)``.  Turns go by number,
    null first, equal numbers by role and text; null role or text is empty; rows without an id
    belong to no conversation.  Repeated rows are turns of their own.  An absent base gives no
    turns, so a rebuilt conversation may have none: it ends at the root.  An empty table gives
    no nodes; other columns are ignored.

    Returns conv_id (the smallest conversation that starts with the prefix), depth,
    parent_conv_id (null at the root), n_convs, n_children, n_leaves, saved_tokens (bytes of all
    but the first copy, over the subtree) and ends_sha256 (of the sorted ids that end there).

    A conversation's smallest-member nodes are the end of its path, so sums over subtrees are
    sums over the members of a node, whatever the depth; no level is visited after another.
    Every sum is taken within a task before it is shuffled.
    """
    spark = turns.sparkSession
    scratch = Scratch(spark, "conv-trie")
    rows = turns.select(F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"),
                        *[F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))]) \
        .filter(F.col("conv").isNotNull())
    for seed in itertools.count():
        if not _same_hash_same_turn(rows, seed):
            continue
        t = _turn_prefixes(rows, scratch, seed)
        convs = scratch.write(_conversations(t, base, head, max_head, seed), f"convs-{seed}")
        found = _rebuilt(t, convs).groupBy(*NODE).agg(
            F.min("conv").alias("owner"), F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.max("before").alias("before"),
            F.max(F.col("length") > F.col("depth")).alias("inner"),
            *[g(c).alias(f"{n}_{c}") for c in ("r1", "r2") for n, g in (("lo", F.min), ("hi", F.max))])
        found = scratch.write(found, f"found-{seed}")
        if found.filter("lo_r1 <> hi_r1 OR lo_r2 <> hi_r2").isEmpty():
            break
    # of each conversation: the first node of its path whose smallest member it is
    first = found.groupBy("owner").agg(F.min(F.struct("depth", "p1", "p2", "before")).alias("x"),
                                       F.count_if(~F.col("inner")).alias("leaf")) \
        .select("owner", F.col("x.depth").alias("own"), "x.p1", "x.p2", F.col("x.before").alias("own_before"), "leaf")
    up = found.select((F.col("depth") + 1).alias("own"), F.col("f1").alias("p1"), F.col("f2").alias("p2"), F.col("owner").alias("up"))
    first = first.join(up, ["own", "p1", "p2"], "left").drop("p1", "p2").withColumnRenamed("owner", "conv")
    convs = scratch.write(convs.join(first, "conv", "left").withColumns({
        "own": F.coalesce("own", F.col("length") + 1), "own_before": F.coalesce("own_before", "bytes"),
        "leaf": F.coalesce("leaf", F.lit(0).cast("long"))}), "owners")
    nodes = _rebuilt(t, convs, ("own", "own_before", "leaf", "up")).groupBy(*NODE).agg(
        F.min("conv").alias("conv_id"), F.max(F.when(F.col("own") == F.col("depth"), F.col("up"))).alias("up"),
        F.count(F.lit(1)).alias("n_convs"),
        F.count_if((F.col("own") <= F.col("depth") + 1) & (F.col("length") > F.col("depth"))).alias("n_children"),
        F.sum("leaf").alias("n_leaves"),
        F.sum(F.greatest(F.col("own_before") - F.col("before"), F.lit(0))).alias("saved_tokens"))
    return nodes.join(_ends(convs), list(NODE), "left").select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("up", "conv_id")).alias("parent_conv_id"),
        "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"))


GROUP, HEADS = 5, 9       # conversations that share a base; a head has fewer than HEADS turns


def rebuilt_trie(turns: DataFrame, **columns) -> DataFrame:
    """:func:`prefix_trie` with base c - c % 5 and head crc32(decimal c) % 9."""
    return prefix_trie(turns, lambda c: c - c % GROUP, lambda c: F.crc32(c.cast("string").cast("binary")) % HEADS, HEADS - 1, **columns)


ORACLE_SQL = """
WITH t AS MATERIALIZED (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
n AS MATERIALIZED (SELECT conv_id, count(*) AS n FROM t GROUP BY conv_id),
c AS MATERIALIZED (
  SELECT n.conv_id AS c, n.conv_id - n.conv_id % 5 AS b,
         xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(n.conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
             lambda s, y: list_reduce([xor(s, y), 0, 0, 0, 0, 0, 0, 0, 0], lambda z, i: xor(z >> 1, 3988292384 * (z & 1)))),
             4294967295::BIGINT) % 9 AS h FROM n),
r AS MATERIALIZED (
  SELECT c, pos AS d, role, text FROM c JOIN t ON t.conv_id = b AND pos <= h
  UNION ALL
  SELECT c, pos - h + least(h, coalesce(n.n, 0)), role, text
  FROM c JOIN t ON t.conv_id = c AND pos > h LEFT JOIN n ON n.conv_id = b),
p AS MATERIALIZED (
  SELECT c, d, strlen(text) AS size,
         sha256(string_agg(strlen(role) || ':' || role || strlen(text) || ':' || text, '') OVER (PARTITION BY c ORDER BY d)) AS k FROM r
  UNION ALL SELECT c, 0, 0, '' FROM c),
e AS MATERIALIZED (SELECT c, max(d) AS d, max_by(k, d) AS k FROM p GROUP BY c),
x AS MATERIALIZED (SELECT d, k, min(c) AS o, count(*) AS n, max(size) AS size FROM p GROUP BY d, k),
y AS MATERIALIZED (
  SELECT x.d, x.k, x.o, x.n, x.size, q.k AS up, pa.o AS up_o
  FROM x LEFT JOIN p q ON q.c = x.o AND q.d = x.d - 1 LEFT JOIN x pa ON pa.d = q.d AND pa.k = q.k),
ch AS (SELECT d - 1 AS d, up AS k, count(*) AS n_children FROM y WHERE d > 0 GROUP BY ALL),
z AS MATERIALIZED (SELECT y.*, coalesce(n_children, 0) AS n_children FROM y LEFT JOIN ch ON ch.d = y.d AND ch.k = y.k),
s AS (SELECT q.d, q.k, count(*) FILTER (WHERE z.n_children = 0) AS n_leaves, sum((z.n - 1) * z.size)::BIGINT AS saved_tokens
      FROM z JOIN p q ON q.c = z.o AND q.d <= z.d GROUP BY q.d, q.k),
f AS (SELECT d, k, string_agg(c::VARCHAR, ',' ORDER BY c) AS ids FROM e GROUP BY d, k)
SELECT z.o AS conv_id, z.d AS depth, z.up_o AS parent_conv_id, z.n AS n_convs, z.n_children, n_leaves, saved_tokens,
       sha256(coalesce(ids, '')) AS ends_sha256
FROM z JOIN s ON s.d = z.d AND s.k = z.k LEFT JOIN f ON f.d = z.d AND f.k = z.k"""
