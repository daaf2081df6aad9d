import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from lumenrec.llm import conv_trie
from tests.llm.helpers import CLASHING, records

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def brute(rows):
    """Rebuilds every conversation as a tuple of turns and walks the trie node by node."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in convs.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        whole[c] = tuple(turns.get(c - c % 5, [])[:h] + own[h:])
    members, ends = defaultdict(list), defaultdict(list)
    for c, seq in whole.items():
        ends[seq].append(c)
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    out = []
    for node, who in members.items():
        below = [x for x in members if x[:len(node)] == node]
        kids = [x for x in below if len(x) == len(node) + 1]
        leaves = sum(not any(len(y) == len(x) + 1 and y[:-1] == x for y in below) for x in below)
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in below if x)
        sha = hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()
        out.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(kids), leaves, saved, sha))
    return sorted(out, key=repr)


def chats(seed=3, n=60):
    rnd = random.Random(seed)
    pool = [("user", "hi"), ("user", "hé 😀"), ("assistant", "yes"), ("assistant", None), (None, "x"), ("", "x"), ("user", "")]
    rows = []
    for c in range(n):
        if c % 17 == 5:
            continue                      # some conversations are absent, bases among them
        for t in range(rnd.randrange(1, 14)):
            rows.append((c, t, *rnd.choice(pool[:3] if t < 4 else pool)))
    rnd.shuffle(rows)
    return rows


EDGES = [
    (0, 0, "user", "a"), (0, 1, "assistant", "b"), (0, None, "user", "first"), (None, 0, "user", "nobody"), (None, None, None, None),
    (1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "assistant", "a"), (1, None, None, None), (1, None, "z", ""),
    (11, 3, "ab", "c"), (12, 3, "a", "bc"), (13, 3, "user", "w " * 100_000), (14, 3, "user", "w " * 100_000),
    (-3, 1, "user", "minus"), (-7, 1, "user", "minus"), (10 ** 15, 1, "user", "far"), (10 ** 15 + 3, 1, "user", "far"),
    *[(21, i, "user", f"t{i % 7}") for i in range(400)], *[(22, i, "user", f"t{i % 7}") for i in range(400)],
    *[(25, i, "user", "same") for i in range(50)], *[(26, i, "user", "same") for i in range(70)],
]


def negative_safe(rows):
    """The query's base of a negative id rounds towards zero, as % does in SQL."""
    return [r for r in rows if r[0] is None or r[0] >= 0]


@pytest.mark.parametrize("rows", [chats(), negative_safe(EDGES), []])
def test_trie_against_brute_force(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ["conv", "pos", "depth", "h1", "f1", *CLASHING]})
    assert records(conv_trie.rebuilt_trie(df.repartition(5)), *COLUMNS) == brute(rows)


def test_one_conversation_over_many_tasks_and_copies(spark):
    rnd = random.Random(8)
    long = [(40, i, "user", rnd.choice("abc")) for i in range(3000)]
    copies = [(c, i, "user", f"turn {i}") for c in range(100, 400) for i in range(12)]
    rows = long + copies + chats(5, 30)
    want = brute_long(rows)
    assert records(conv_trie.rebuilt_trie(spark.createDataFrame(rows, SCHEMA).repartition(9)), *COLUMNS) == want


def brute_long(rows):
    """As ``brute``, summing from the leaves up, for long conversations."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append((turn, role or "", text or ""))
    turns = {c: [t[1:] for t in sorted(v)] for c, v in convs.items()}
    kids, who, ends, size, up = defaultdict(dict), defaultdict(list), defaultdict(list), {0: 0}, {0: None}
    depth, new = {0: 0}, 1
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 9
        node = 0
        who[0].append(c)
        for t in turns.get(c - c % 5, [])[:h] + turns[c][h:]:
            if t not in kids[node]:
                kids[node][t] = new
                up[new], depth[new], size[new] = node, depth[node] + 1, len(t[1].encode())
                new += 1
            node = kids[node][t]
            who[node].append(c)
        ends[node].append(c)
    leaves, saved = [0] * new, [0] * new
    for x in range(new - 1, -1, -1):
        leaves[x] += not kids[x]
        saved[x] += (len(who[x]) - 1) * size[x]
        if x:
            leaves[up[x]] += leaves[x]
            saved[up[x]] += saved[x]
    return sorted(((who[x][0], depth[x], who[up[x]][0] if x else None, len(who[x]), len(kids[x]), leaves[x], saved[x],
                    hashlib.sha256(",".join(map(str, ends[x])).encode()).hexdigest()) for x in range(new)), key=repr)


@pytest.mark.parametrize("rows", [chats(11, 40), EDGES])
def test_sql_text_gives_the_same(spark, rows):
    con = duckdb.connect()
    df = spark.createDataFrame(rows, SCHEMA)
    conversations = df.toArrow()
    con.register("conversations", conversations)
    got = con.sql(conv_trie.ORACLE_SQL)
    at = [got.columns.index(c) for c in COLUMNS]
    assert sorted((tuple(r[i] for i in at) for r in got.fetchall()), key=repr) == records(conv_trie.rebuilt_trie(df), *COLUMNS)


def test_equal_fingerprints_of_different_turns_are_found_and_hashed_anew(spark, monkeypatch):
    """With one multiplier for the first seed all orders of the same turns collide."""
    rows = [(c, i, "user", x) for c, seq in {0: "abcabcabcabc", 5: "abcabcabccba", 10: "abcabcabcbac"}.items() for i, x in enumerate(seq)]
    true = conv_trie._bases
    monkeypatch.setattr(conv_trie, "_bases", lambda seed: [1] * 4 if seed == 0 else true(seed))
    assert records(conv_trie.rebuilt_trie(spark.createDataFrame(rows, SCHEMA)), *COLUMNS) == brute(rows)


def test_many_ends_of_one_node_are_hashed_piece_by_piece(spark, monkeypatch):
    monkeypatch.setattr(conv_trie, "_IDS", 7)
    rows = [(c, i, "user", f"turn {i}") for c in range(0, 900) for i in range(9)]
    assert records(conv_trie.rebuilt_trie(spark.createDataFrame(rows, SCHEMA)), *COLUMNS) == brute_long(rows)
