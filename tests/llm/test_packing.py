import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from lumenrec.llm import packing
from lumenrec.llm.common import Scratch
from tests.llm.helpers import docs, edge_rows

PATH = public_tokenizers.path("word_bpe_49k.json")


def check_bins(bins, length, cost, capacity):
    for b in set(bins.tolist()):
        on = bins == b
        assert length[on].sum() <= capacity[0] and on.sum() <= capacity[1] and cost[on].sum() <= capacity[2] * (1 + 1e-9)


def test_every_capacity_holds():
    rnd = np.random.default_rng(2)
    length = rnd.integers(1, 4097, 800)
    cost = length.astype(float) ** 2
    for capacity in ((4096, 4096, 4096.0**2), (4096, 3, 4096.0**2), (4096, 50, 1.7e7), (4096, 2, 1.7e7)):
        for select in ("norm", "dot"):
            bins = packing.best_fit(length, cost, capacity, (1.0, 0.2, 0.2), select)
            check_bins(bins, length, cost, capacity)


def plain_best_fit(length, capacity):
    """One-dimensional best fit, decreasing, by loops."""
    room, out = [], {}
    for i in sorted(range(len(length)), key=lambda i: (-length[i], i)):
        fits = [b for b in range(len(room)) if room[b] >= length[i]]
        b = min(fits, key=lambda b: (room[b], b)) if fits else len(room)
        if b == len(room):
            room.append(capacity)
        room[b] -= length[i]
        out[i] = b
    return len(room)


def test_as_good_as_best_fit():
    rnd = np.random.default_rng(4)
    length = np.minimum(rnd.lognormal(6, 1, 1500).astype(int) + 1, 4096)
    bins = packing.best_fit(length, length.astype(float) ** 2, (4096, 4096, 4096.0**2), (1.0, 1e-6, 1e-6), "norm")
    assert len(set(bins.tolist())) <= plain_best_fit(length.tolist(), 4096)


def test_empty_and_single():
    none = np.empty(0, np.int64)
    assert len(packing.best_fit(none, none.astype(float), (10, 10, 100.0), (1, 1, 1), "norm")) == 0
    assert packing.best_fit(np.array([10]), np.array([100.0]), (10, 10, 100.0), (1, 1, 1), "dot").tolist() == [0]


def test_word_ids_are_the_texts_ids():
    rnd = random.Random(3)
    t = Tokenizer.from_file(PATH)
    w = packing.WordIds(open(PATH, encoding="utf-8").read())
    bits = ["Hello", "don't", "12345", "Éa", "é", "́", "İx", "ΟΔΟΣ", "ﬁ", "a b", "\x1c", " ", "\n", "\t", "中文", "😀", "!!", "_", "'ll", "K", "a.b"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40))) for _ in range(400)] + ["", " "]
    for text, ids in zip(texts, w.texts(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, text


def test_parts_of_plain_words_and_generations(monkeypatch):
    monkeypatch.setattr(packing, "_WORDS_KEPT", 200)
    monkeypatch.setattr(packing, "_PIECES_KEPT", 100)
    rnd = random.Random(11)
    t = Tokenizer.from_file(PATH)
    w = packing.WordIds(open(PATH, encoding="utf-8").read())
    assert w.splits
    letters = "abZÀÉÞßÿéñ019'.,-<>|_$ªµº×÷\xad\xa0\x85\x1c ŁΣ"
    for _ in range(30):
        texts = [" ".join("".join(rnd.choice(letters[:rnd.choice((14, 24, len(letters)))]) for _ in range(rnd.randint(1, 9)))
                          for _ in range(60)) for _ in range(4)]
        for text, ids in zip(texts, w.texts(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, text
        assert len(w.words.young) <= 200 + 240 and len(w.words.old) <= 200 + 240


def test_every_latin_1_character_is_split_as_the_tokenizer_does():
    rnd = random.Random(5)
    t = Tokenizer.from_file(PATH)
    w = packing.WordIds(open(PATH, encoding="utf-8").read())
    every = [chr(c) for c in range(1, 256) if chr(c) != "<"]
    few = "ab'sStTreVeMlLd É1²ª µ.-\x85\xa0\x1c\t"
    texts = ["".join(rnd.choice(every if k % 2 else few) for _ in range(rnd.randrange(1, 40))) for k in range(3000)]
    assert all(map(packing._simple, texts))
    for text, ids in zip(texts, w.texts(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, text


def test_parts_by_ranks_and_by_the_tokenizer_are_the_same():
    rnd = random.Random(7)
    w = packing.WordIds(open(PATH, encoding="utf-8").read())
    assert w.ranks is not None
    parts = [t.removesuffix("</w>") for t in w.tokenizer.get_vocab() if t.isascii() and t.removesuffix("</w>").isalpha() and t.islower()][:20_000]
    parts += ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyzäöüßéèñ") for _ in range(rnd.randrange(1, 30))) for _ in range(20_000)]
    parts += ["".join(rnd.choice("!.-_#*()[]{}'+=~") for _ in range(rnd.randrange(1, 9))) for _ in range(500)] + list("0123456789²³¼")
    fast = list(w._encode_parts(parts))
    w.ranks = None
    assert fast == list(w._encode_parts(parts))


def test_many_texts_share_running_sums(monkeypatch):
    monkeypatch.setattr(packing, "_HASHED_AT_ONCE", 300)
    rnd = random.Random(12)
    t = Tokenizer.from_file(PATH)
    w = packing.WordIds(open(PATH, encoding="utf-8").read())
    bits = ["it's", "Don't", "l'été", "'", "''s", "rock'n'roll", "we'll", "x'", "12", " ", "\n", "é", "Ω", "<|endoftext|>", "word"]
    texts = ["".join(rnd.choice(bits) + rnd.choice(["", " "]) for _ in range(rnd.randrange(0, 25))) for _ in range(300)] + ["long " * 200, ""]
    for text, ids in zip(texts, w.texts(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, text


def test_special_tokens_in_a_text(spark):
    rnd = random.Random(8)
    t = Tokenizer.from_file(PATH)
    w = packing.WordIds(open(PATH, encoding="utf-8").read())
    assert all(not set(x.content) & set(" \t\n\r\x0b\x0c") for x in t.get_added_tokens_decoder().values())
    bits = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "|>", "a", "Word", "é", "́", "don't", " ", " ", "\n", "中", "😀"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 30))) for _ in range(400)]
    texts += ["a <|endoftext|> b", "a<|endoftext|>b", "<|startoftext|><|endoftext|>", "x<|endoftext|> y"]
    for text, ids in zip(texts, w.texts(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, text
    out = packing.pack_documents(docs(spark, [(1, "a <|endoftext|> b")]), PATH).collect()
    assert [r.length for r in out] == [4]


def test_documents_are_packed_whole(spark):
    rows = [*edge_rows(), *[(100 + i, "word " * random.Random(i).randint(1, 900)) for i in range(150)]]
    t = Tokenizer.from_file(PATH)
    out = packing.pack_documents(docs(spark, rows), PATH, group_rows=40).collect()
    want = []
    for d, text in rows:
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 1]
        for k, a in enumerate(range(0, len(ids), 4096)):
            part = ids[a:a + 4096]
            want.append((d, k, a, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out), key=repr) == sorted(want, key=repr)
    sequences = {}
    for r in out:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    total = sum(x[3] for x in want)
    assert len(sequences) <= -(-total // 4096) + 2
    assert packing.pack_documents(docs(spark, []), PATH).count() == 0


def test_other_capacities_in_spark(spark):
    pieces = spark.createDataFrame([(i, 100 + i) for i in range(60)], "i int, length long")
    out = packing.pack(pieces, Scratch(spark, "test"), max_tokens=4096, max_documents=5, group_rows=25).collect()
    sizes = {}
    for r in out:
        sizes[r.sequence_id] = sizes.get(r.sequence_id, 0) + 1
    assert len(out) == 60 and max(sizes.values()) <= 5
