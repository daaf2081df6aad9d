import base64
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from lumenrec.llm import bpe
from lumenrec.llm.arrow import cuts
from tests.llm.helpers import docs, edge_rows

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in open(PATH, "rb").read().splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def ranks():
    return bpe.Ranks(open(PATH, "rb").read())


def test_pieces_of_every_length(ranks, reference):
    rnd = random.Random(8)
    pieces = [bytes(rnd.choice(b"abcdefghiaeiou etn\xc3\xa9\xff\x00") for _ in range(rnd.randint(1, 300))) for _ in range(400)]
    pieces += [b"a" * n for n in (1, 2, 3, 255, 256, 257, 1000)] + [b"ab" * 200, b"", b"\xf0\x9f\x98\x80"]
    ids, count = ranks.encode(pieces)
    at = 0
    for p, n in zip(pieces, count.tolist()):
        assert ids[at:at + n].tolist() == (reference._core_bpe.encode_single_piece(p) if p else []), p
        assert ranks.decode(ids[at:at + n])[0].tobytes() == p
        at += n


def test_matrix_rounds_and_heap_agree(ranks):
    rnd = random.Random(9)
    for _ in range(200):
        p = bytes(rnd.choice(b"thean ing") for _ in range(rnd.randint(2, 60)))
        ids, _ = ranks.encode([p])
        assert ids.tolist() == ranks._merge_long(p).tolist()


def test_lookup_misses_and_padding(ranks):
    a, b = np.array([[0, -1, 5]], np.int32), np.array([[-1, 3, 50_000]], np.int32)
    assert (ranks.lookup(a, b) == bpe._NONE).all()


def test_documents(spark, reference):
    rows = [*edge_rows(), (50, " ".join("it's I'll 12345 __init__ \t\t  x".split(" ")) * 30), (51, "a" * 3000 + " " * 3000)]
    ids = bpe.encode(docs(spark, rows), PATH, public_tokenizers.PATTERN)
    got = bpe.decode(ids, PATH).collect()
    want = sorted(((d, reference.encode_ordinary(t or ""), (t or "").encode()) for d, t in rows), key=repr)
    assert sorted(((r.doc_id, list(r.ids), bytes(r.decoded)) for r in got), key=repr) == want
    assert bpe.decode(bpe.encode(docs(spark, []), PATH, public_tokenizers.PATTERN), PATH).count() == 0


def test_decode_slices_by_ids(spark, monkeypatch):
    """Rows of very different sizes, several to a slice and one over many; null ids."""
    rnd = random.Random(3)
    lists = [[rnd.randrange(50_000) for _ in range(rnd.choice((0, 1, 5, 400)))] for _ in range(60)] + [None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "doc_id int, ids array<int>").coalesce(1)
    plain = {r.doc_id: bytes(r.decoded) for r in bpe.decode(df, PATH).collect()}
    ranks = bpe.Ranks(open(PATH, "rb").read())
    assert plain == {i: ranks.decode(np.array(x or [], np.int32))[0].tobytes() for i, x in enumerate(lists)}


def test_cuts_keep_every_row_and_their_bound():
    rnd = np.random.default_rng(2)
    for sizes in ([], [5], [0, 0, 0], [10**9, 1, 10**9], rnd.integers(0, 50, 300)):
        got = cuts(sizes, 100)
        assert [i for a, b in got for i in range(a, b)] == list(range(len(sizes)))
        assert all(b - a == 1 or sum(sizes[a:b]) < 200 + max(sizes) for a, b in got)


def test_batches_are_bounded_by_bytes(spark):
    """What ``parts`` relies on: Spark ends a batch at 64 MB whatever its rows."""
    def count(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["n"])
    df = spark.range(150).selectExpr("repeat('x', 1000000) AS t").coalesce(1)
    got = [r.n for r in df.mapInArrow(count, "n long").collect()]
    assert len(got) > 1 and max(got) < 80_000_000
