"""MinHash-style near-duplicate detection with SetSketch registers."""

from __future__ import annotations

import math
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .arrow import in_tasks, parts
from .common import Scratch, without
from .shingles import mix, shingle_sets

BANDS, ROWS = 16, 4
M = BANDS * ROWS                  # registers; 2 bytes each
BASE, RATE, LIMIT = 1.001, 20.0, 65_534
_DOUBT = 18.0                     # log-likelihood ratio from which a pair is not verified
_BLOCKS = 128
_PAIRS_EACH = 2_000               # untested pairs a bucket member may have on average to be all tested at once
_REPS_BROADCAST = 500_000         # rows (of 24 bytes) up to which wanted texts are looked up by broadcast

_u64 = np.uint64
_SEED = mix(np.arange(1, M + 1, dtype=np.uint64) * _u64(0x9E3779B97F4A7C15))
_ODD = mix(_SEED) | _u64(1)


# ---------------------------------------------------------------- registers

def sketch(sets: list[np.ndarray]) -> np.ndarray:
    """SetSketch registers (set, M) of non-empty sets.

    Register i of a set is floor(1 - log_b(x)) for the least x of its elements' exponential
    variates of rate a, cut to 0..q+1: the largest of per-element values, so the registers of a
    union are the elementwise maxima.  Equal registers are as likely as the Jaccard similarity.
    """
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    out = np.zeros((len(sets), M), np.uint64)
    done = 0
    while done < len(sets):                       # blocks that stay in the cache
        upto, held = done, 0
        while upto < len(sets) and (upto == done or held + size[upto] <= 32_768):
            held += size[upto]
            upto += 1
        h = np.concatenate(sets[done:upto])
        start = np.cumsum(size[done:upto]) - size[done:upto]
        for i in range(M):
            out[done:upto, i] = np.maximum.reduceat((h ^ _SEED[i]) * _ODD[i], start)
        done = upto
    u = ((out >> _u64(11)).astype(np.float64) + 0.5) / 2.0**53
    k = np.floor(1 - np.log(-np.log(u) / RATE) / math.log(BASE))
    return np.clip(k, 0, LIMIT + 1).astype(np.uint16)


def _less(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)


def plausible(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray, threshold: float) -> np.ndarray:
    """Whether a similarity of at least ``threshold`` is plausible for pairs of register rows.

    The likelihood of the numbers of greater, lesser and equal registers, given the set sizes,
    as a function of the similarity; a pair is implausible if its best value from the threshold
    on is e**18 times less likely than its best value at all.
    """
    if not len(a):
        return np.empty(0, bool)
    more, fewer = (a > b).sum(axis=1), (a < b).sum(axis=1)
    equal = M - more - fewer
    u = (na / (na + nb))[:, None]
    v = 1 - u
    most = np.minimum(u / v, v / u)                # no similarity is beyond the ratio of the sizes
    grid = np.linspace(0.0, 1.0, 101)[None, :] * most
    grid = np.concatenate((grid, np.clip(threshold, 0, most)), axis=1)
    p, q = _less(u - v * grid), _less(v - u * grid)
    tiny = 1e-300
    ll = (more[:, None] * np.log(np.maximum(p, tiny)) + fewer[:, None] * np.log(np.maximum(q, tiny))
          + equal[:, None] * np.log(np.maximum(1 - p - q, tiny)))
    ok = grid >= threshold - 1e-9
    return np.where(ok, ll, -np.inf).max(axis=1) >= ll.max(axis=1) - _DOUBT


# ---------------------------------------------------------------- connected components

def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, root) of every node of the written table ``edges`` (a, b): root is the least node
    that can be reached.

    Labels fall to the least label of the neighbours and then to their label's own label, so
    long chains halve each round; every round is a written table.
    """
    both = scratch.write(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))),
                         f"{name}-both")
    labels = scratch.write(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                           .select("node", F.least("node", "m").alias("root")), f"{name}-0")
    step = 0
    while True:
        step += 1
        near = (both.join(labels.select(F.col("node").alias("b"), "root"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("m")))
        low = labels.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "m").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("root").alias("further"))
        new = low.join(jump, "low", "left").select("node", F.least("low", F.coalesce("further", "low")).alias("root"), "old")
        seen = Observation()
        new = scratch.write(new.observe(seen, F.count_if(F.col("root") != F.col("old")).alias("changed")), f"{name}-{step}")
        labels = new.select("node", "root")
        if not seen.get["changed"]:
            return labels


# ---------------------------------------------------------------- the operator

def _sketched(docs: DataFrame, shingle: int) -> DataFrame:
    """(id, tk, n, node, regs): node is the hash of the shingle set; null for an empty one."""
    from pyspark.sql import types as T
    schema = T.StructType([docs.schema["id"], T.StructField("tk", T.LongType()), T.StructField("n", T.LongType()),
                           T.StructField("node", T.BinaryType()), T.StructField("regs", T.BinaryType())])

    def run(batches):
        for part in parts(batches):
            sets = shingle_sets(part.column("text").to_pylist(), shingle)
            some = [s for s in sets if len(s)]
            regs = iter(sketch(some)) if some else iter(())
            yield pa.RecordBatch.from_arrays(
                [part.column("id"), part.column("tk"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                 pa.array([next(regs).tobytes() if len(s) else None for s in sets], pa.binary())],
                ["id", "tk", "n", "node", "regs"])

    return in_tasks(docs, run, schema)


def _sets(rows: DataFrame, shingle: int) -> DataFrame:
    """(node, shingles) of rows (node, text): the sorted hashes as bytes."""
    def run(batches):
        for part in parts(batches):
            sets = shingle_sets(part.column("text").to_pylist(), shingle)
            yield pa.RecordBatch.from_arrays([part.column("node"), pa.array([s.tobytes() for s in sets], pa.binary())],
                                             ["node", "shingles"])
    return in_tasks(rows, run, "node binary, shingles binary")


def _column(part: pa.RecordBatch, name: str, dtype: str) -> np.ndarray:
    return np.frombuffer(b"".join(part.column(name).to_pylist()), dtype)


def _band_keys() -> Column:
    """The bands of ``regs``: an array of hashes, each of a band's number and its registers."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(
        b, F.substring(F.col("regs"), b * (2 * ROWS) + 1, F.lit(2 * ROWS))))


class _Search:
    """One run: the written tables that its steps share."""

    def __init__(self, docs: DataFrame, percent: int, shingle: int):
        self.scratch = Scratch(docs.sparkSession, "near-dup")
        self.percent, self.shingle = percent, shingle
        self.docs = docs
        write = self.scratch.write
        self.rows = write(_sketched(docs, shingle), "rows")
        own = self.rows.filter(F.col("id").isNotNull() & F.col("node").isNotNull())
        # texts with one shingle set are one class; a hot class meets as one row per task
        self.classes = write(own.groupBy("node", "n", "regs").agg(F.min(F.struct("id", "tk")).alias("rep")), "classes")
        members = self.classes.select("node", "n", F.explode(_band_keys()).alias("key"))
        shared = write(members.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("key"), "shared")
        self.members = write(members.join(shared, "key"), "members")
        self.edges: DataFrame | None = None       # links found so far
        self.roots: DataFrame | None = None       # their components
        self.n_tables = 0
        self.sets = self._needed_sets()

    def _name(self, what: str) -> str:
        self.n_tables += 1
        return f"{what}-{self.n_tables}"

    def _needed_sets(self) -> DataFrame:
        """Shingle sets of the classes that share a bucket with another."""
        wanted = self.classes.join(self.members.select("node").distinct(), "node", "left_semi").select(
            "node", F.col("rep.id").alias("r_id"), F.col("rep.tk").alias("r_tk"))
        wanted = self.scratch.write(wanted, "wanted")
        if wanted.count() <= _REPS_BROADCAST:
            wanted = F.broadcast(wanted)
        texts = self.docs.join(wanted, (F.col("id") == F.col("r_id")) & (F.col("tk") == F.col("r_tk")))
        return self.scratch.write(_sets(texts.select("node", "text"), self.shingle).dropDuplicates(["node"]), "sets")

    def _size_fits(self, a: str, b: str):
        return 100 * F.least(a, b) >= self.percent * F.greatest(a, b)

    def _test(self, pairs: DataFrame) -> None:
        """Verify pairs (a, na, b, nb), by likelihood and then on full sets, and add the links."""
        threshold, percent = self.percent / 100, self.percent
        swap = F.col("a") > F.col("b")
        pairs = pairs.select(F.least("a", "b").alias("a"), F.when(swap, F.col("nb")).otherwise(F.col("na")).alias("na"),
                             F.greatest("a", "b").alias("b"), F.when(swap, F.col("na")).otherwise(F.col("nb")).alias("nb"))
        regs = self.classes.select("node", "regs")
        held = (pairs.distinct().join(regs.select(F.col("node").alias("a"), F.col("regs").alias("ra")), "a")
                .join(regs.select(F.col("node").alias("b"), F.col("regs").alias("rb")), "b")
                .select("a", "b", "na", "nb", "ra", "rb"))

        def likely(batches):
            for part in batches:
                if not part.num_rows:
                    continue
                ra, rb = (_column(part, c, np.uint16).reshape(-1, M) for c in ("ra", "rb"))
                na, nb = (part.column(c).to_numpy().astype(float) for c in ("na", "nb"))
                keep = plausible(ra, rb, na, nb, threshold)
                yield part.select(["a", "b"]).filter(pa.array(keep))

        candidates = in_tasks(held, likely, "a binary, b binary")
        full = (candidates.join(self.sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
                .join(self.sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
                .select("a", "b", "sa", "sb"))

        def confirm(batches):
            for part in parts(batches, "sa"):
                keep = []
                for x, y in zip(part.column("sa").to_pylist(), part.column("sb").to_pylist()):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    both = np.concatenate((x, y))
                    both.sort()
                    same = int((both[1:] == both[:-1]).sum())
                    keep.append(100 * same >= percent * (len(x) + len(y) - same))
                yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

        seen = Observation()
        links = in_tasks(full, confirm, "a binary, b binary").observe(seen, F.count(F.lit(1)).alias("n"))
        links = self.scratch.write(links, self._name("links"))
        if seen.get["n"]:
            self.edges = links if self.edges is None else self.edges.unionByName(links)
            self.roots = components(self.edges, self.scratch, self._name("roots"))

    # ------------------------------------------------------------ which pairs to test

    def _active(self, members: DataFrame, *more: str) -> tuple[DataFrame, int]:
        """Members of buckets that still hold two components, (key, node, n, root), and how many."""
        if self.roots is not None:
            members = members.join(self.roots, "node", "left").select(
                "key", "node", "n", F.coalesce("root", "node").alias("root"), *more)
        else:
            members = members.select("key", "node", "n", F.col("node").alias("root"), *more)
        open_ = (members.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
                 .filter("lo <> hi").select("key"))
        seen = Observation()
        active = members.join(open_, "key").observe(seen, F.count(F.lit(1)).alias("n"))
        active = self.scratch.write(active, self._name("active"))
        return active, seen.get["n"]

    def _shared(self, active: DataFrame) -> DataFrame:
        """(key, node, n, s): s is how many shingles of a member another active class has too.

        No link of the member has a larger intersection than s.
        """
        nodes = active.select("node").distinct()

        def run(batches):
            for part in parts(batches, "shingles"):
                some = part.column("shingles").to_pylist()
                values = np.frombuffer(b"".join(some), np.int64)
                edge = np.cumsum([0] + [len(s) // 8 for s in some])
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(values))],
                    ["node", "s"])

        lists = in_tasks(self.sets.join(nodes, "node", "left_semi"), run, "node binary, s array<bigint>")
        alone = (lists.select(F.xxhash64("node").alias("nk"), F.explode_outer("s").alias("s"))
                 .groupBy("s").agg(F.count(F.lit(1)).alias("c"), F.min("nk").alias("nk")).filter("c = 1")
                 .groupBy("nk").agg(F.count(F.lit(1)).alias("u")))
        return (active.withColumn("nk", F.xxhash64("node")).join(alone, "nk", "left")
                .select("key", "node", "n", (F.col("n") - F.coalesce("u", F.lit(0))).alias("s")))

    def _pair_fits(self, na: str, sa: str, nb: str, sb: str):
        """Whether sizes and shared shingles allow a link: J = i / (na + nb - i) for an
        intersection i of at most min(sa, sb)."""
        i = F.least(sa, sb)
        return 100 * i >= self.percent * (F.col(na) + F.col(nb) - i)

    def _blocks(self, active: DataFrame) -> DataFrame:
        """(node, t): how many shingles of each active class lie in each of 128 blocks of the hash space."""
        def run(batches):
            for part in parts(batches, "shingles"):
                some = part.column("shingles").to_pylist()
                t = np.stack([np.bincount(np.frombuffer(x, np.uint64) & _u64(_BLOCKS - 1), minlength=_BLOCKS) for x in some])
                edge = np.arange(len(some) + 1, dtype=np.int32) * _BLOCKS
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.ListArray.from_arrays(
                    pa.array(edge), pa.array(t.ravel().astype(np.int32)))], ["node", "t"])

        nodes = active.select("node").distinct()
        return in_tasks(self.sets.join(nodes, "node", "left_semi"), run, "node binary, t array<int>")

    def _blocks_fit(self):
        """Whether the blocks allow a link: an intersection has at most the lesser count in each."""
        i = F.aggregate(F.zip_with("t", "ht", lambda x, y: F.least(x, y)), F.lit(0), lambda a, x: a + x)
        return 100 * i >= self.percent * (F.col("n") + F.col("hn") - i)

    def _hopeful(self, active: DataFrame) -> DataFrame:
        """Members (key, node, n, s) for whose size and shared shingles a partner's size exists in
        the bucket.

        A member of n shingles, s of them shared, can only be linked with classes of
        ``percent * n / 100`` to ``s * (100 + percent) / percent - n`` shingles; sizes are looked
        up by cells two percent wide, so a member that might have a partner always stays.
        """
        p, width = self.percent / 100, math.log(1.02)
        t = self.scratch.write(self._shared(active), self._name("shared"))
        cell = lambda c: F.floor(F.log(c) / width).cast("int")
        lo, hi = F.col("n") * p, F.least(F.col("s") * (1 + 1 / p) - F.col("n"), F.col("n") / p)
        there = t.groupBy("key", cell(F.col("n").cast("double")).alias("cell")).agg(F.count(F.lit(1)).alias("c"))
        own = cell(F.col("n").cast("double"))
        asked = t.filter(hi >= lo * (1 - 1e-9)).select(
            "key", "node", "n", "s", own.alias("own"),
            F.explode_outer(F.sequence(cell(lo) - 1, cell(hi) + 1)).alias("cell"))
        found = asked.join(there, ["key", "cell"]).filter((F.col("cell") != F.col("own")) | (F.col("c") > 1))
        return found.select("key", "node", "n", "s").distinct()

    def _star(self, active: DataFrame, priority, hubs_each: int, fits) -> DataFrame:
        """Test up to ``hubs_each`` members of each bucket against all others of other components;
        returns the members without those hubs, whose relations are then known."""
        sub = F.pmod(F.xxhash64("node", F.lit(7)), F.lit(hubs_each)).alias("sub")
        fields = [c for c in active.columns if c not in ("key", "node")]
        best = F.min(F.struct(priority.alias("p"), F.col("node").alias("hub"), *[F.col(c).alias(f"h{c}") for c in fields])).alias("h")
        hubs = self.scratch.write(active.groupBy("key", sub).agg(best).select(
            "key", "h.hub", *[f"h.h{c}" for c in fields]), self._name("hubs"))
        pairs = active.join(hubs, "key").filter((F.col("root") != F.col("hroot")) & fits)
        self._test(pairs.select(F.col("hub").alias("a"), F.col("hn").alias("na"), F.col("node").alias("b"), F.col("n").alias("nb")))
        return active.join(hubs.select("key", F.col("hub").alias("node")), ["key", "node"], "left_anti")

    def run(self) -> None:
        """Test pairs of bucket members until no bucket holds two untested members of different
        components that might be linked.

        First a star around one member of each bucket, which joins most groups of copies.  In the
        buckets that still hold several components, members leave for whose size and shared
        shingles no partner's size exists; then a star around those that share most.  The pairs
        left in a bucket, of members of different components that an exact bound allows, are all
        tested, or, as long as there are very many, more stars follow, with four times the
        centres each time; a star tests a linear number of pairs and settles its centres.
        Members of one component are never paired, so a group of copies costs about its size,
        and no pair of a bucket that might be linked is given up.
        """
        rest, n = self._active(self.members)
        if not n:
            return
        rest = self._star(rest, F.xxhash64("node"), 1, self._size_fits("n", "hn")).select("key", "node", "n")
        active, n = self._active(rest)
        if not n:
            return
        hopeful = self._hopeful(active)
        hubs_each, fits = 1, self._pair_fits("n", "s", "hn", "hs")
        while True:
            active, n = self._active(hopeful, "s")
            if not n:
                return
            if hubs_each > 1:
                per = active.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"))
                left = per.groupBy("key").agg((F.pow(F.sum("c"), 2) - F.sum(F.col("c") * F.col("c"))).alias("p"))
                if (left.agg(F.sum("p")).first()[0] or 0) <= _PAIRS_EACH * n:
                    break
            hopeful = self._star(active, 1 - F.col("s") / F.col("n"), hubs_each, fits).select("key", "node", "n", "s")
            hubs_each = min(hubs_each * 4, 1024)
        # a pair that shares several bands is joined in the first of them alone
        active = active.join(self.classes.select("node", _band_keys().alias("keys")), "node").join(self._blocks(active), "node")
        other = active.select("key", *[F.col(c).alias(f"h{c}") for c in ("node", "n", "s", "root", "keys", "t")])
        first = F.get(F.array_compact(F.zip_with("keys", "hkeys", lambda x, y: F.when(x == y, x))), F.lit(0)) == F.col("key")
        pairs = active.join(other, "key").filter((F.col("node") < F.col("hnode")) & (F.col("root") != F.col("hroot"))
                                                 & fits & first & self._blocks_fit())
        self._test(pairs.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("hnode").alias("b"), F.col("hn").alias("nb")))

    def result(self) -> DataFrame:
        """(id, n, component) of every row."""
        classes = self.classes.select("node", F.col("rep.id").alias("cid"))
        if self.roots is not None:
            classes = self.scratch.write(classes.join(self.roots, "node", "left").select(
                "node", "cid", F.coalesce("root", "node").alias("root")), "rooted")
            least = classes.groupBy("root").agg(F.min("cid").alias("component"))
            classes = classes.join(least, "root").select("node", "component")
        else:
            classes = classes.select("node", F.col("cid").alias("component"))
        classes = self.scratch.write(classes, "components")
        # rows without a set or an id stand for themselves; the rest look their class up
        empty = self.rows.filter(F.col("node").isNull() | F.col("id").isNull()).select(
            "id", "tk", "n", F.col("id").alias("component"))
        linked = self.rows.filter(F.col("node").isNotNull() & F.col("id").isNotNull()).select("id", "tk", "n", "node")
        return empty.unionByName(linked.join(classes, "node").select("id", "tk", "n", "component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85,
                    shingle: int = 5) -> DataFrame:
    """Per row: ``id_col``, n_shingles, component_id, kept.

    Documents are sets of distinct ``shingle``-word shingles (words between ASCII white space,
    A-Z lower-cased; fewer words: the whole sequence as one).  Two are linked if 100 times the
    intersection is at least ``percent`` times the union, counted on full sets; component_id is
    the smallest id that links reach, kept tells whether that is the row's own.

    Candidates share one of 16 bands of four SetSketch registers: a pair of similarity 0.85 is
    missed with probability below 1e-5.  Every pair of a bucket is either tested, or in one
    component already, or ruled out by an exact bound.

    Null or empty text has an empty set and is linked with nothing.  A null id is not compared:
    its component is null and it is kept.  Rows with one id are compared as rows of their own;
    equal rows are in one component and all kept or all not.  An empty table gives an empty
    result; other columns are ignored.
    """
    out = _components(docs, id_col, text_col, percent, shingle)
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.col("component").alias("component_id"),
                      (F.col("id").isNull() | (F.col("id") == F.col("component"))).alias("kept"))


def _components(docs: DataFrame, id_col: str, text_col: str, percent: int, shingle: int) -> DataFrame:
    """(id, tk, n, component); tk is a hash of the text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    plain = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("tk"), text.alias("text"))
    search = _Search(plain, percent, shingle)
    search.run()
    return search.result()


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 85,
             shingle: int = 5) -> DataFrame:
    """The rows of ``docs`` that :func:`near_duplicates` keeps, with all their columns: of each
    group of linked documents the one with the smallest id."""
    found = _components(docs, id_col, text_col, percent, shingle)
    gone = found.filter(F.col("id") != F.col("component")).select(
        F.col("id").alias("g_id"), F.col("tk").alias("g_key")).distinct()
    gone = Scratch(docs.sparkSession, "near-dup").write(gone, "copies")
    return without(docs, gone, id_col, F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
