import hashlib
import json
import random
from collections import Counter

import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lumenrec.llm import token_align
from tests.llm.helpers import docs, edge_rows, prose, records

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


class Whole:
    """Encodes whole texts and compares byte ranges one by one."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        marks = {chr(c): c for c in [*range(33, 127), *range(161, 173), *range(174, 256)]}
        n = 0
        for c in range(256):
            if c not in marks.values():
                marks[chr(256 + n)] = c
                n += 1
        self.bytes_a = {i: bytes(marks[c] for c in t) for t, i in self.a.get_vocab().items() if t != "<|endoftext|>"}

    def byte_b(self, i):
        p = self.b.id_to_piece(i)
        return bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()

    def tokens(self, text):
        raw = b" " + (text or "").encode()
        if not text:
            return None
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        x, y = [self.bytes_a[i] for i in a], [self.byte_b(i) for i in b]
        return (a, x, b, y) if b"".join(x) == raw == b"".join(y) else None

    def links(self, text):
        """Groups as text, and the id pair of every overlapping pair of tokens."""
        t = self.tokens(text)
        if t is None:
            return None
        a, x, b, y = t
        spans = []
        for ids, parts in ((a, x), (b, y)):
            end, out = 0, []
            for i, p in zip(ids, parts):
                out.append((end, end + len(p), i))
                end += len(p)
            spans.append(out)
        ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, pairs, start = [], [], 0
        for e in ends:
            p, q = ([s for s in some if start <= s[0] < e] for some in spans)
            groups.append(",".join(str(s[2]) for s in p) + "|" + ",".join(str(s[2]) for s in q))
            pairs += [(u[2], v[2]) for u in p for v in q if u[0] < v[1] and v[0] < u[1]]
            start = e
            spans = [[s for s in some if s[0] >= e] for some in spans] if len(spans[0]) < 3000 else spans
        return len(a), len(b), groups, pairs


def brute(rows):
    whole = Whole()
    found = [(r[0], whole.links(r[1])) for r in rows]
    counts = Counter(p for _, f in found if f for p in set(f[3]))
    best = Counter()
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for i, f in found:
        if f is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, pairs = f
        out.append((i, n_a, n_b, len(groups), len(pairs), sum(counts[p] == best[p[0]] for p in pairs), sum(counts[p] for p in pairs),
                    hashlib.sha256(";".join(groups).encode()).hexdigest()))
    return sorted(out, key=repr)


ODD = ["<|endoftext|> and <s> </s> <unk> <0x41>", " lead", "trail ", "two  spaces   three", "a\n b\t c\r\nd", "x▁y ▁ z", "▁",
       "nbsp   x   y", "don't we'll 'S 's ' s", "ﬁ ½ ① é é", "日本語 テキスト と 漢字", "🙂👩‍👩‍👧 🙂", "\x00 \x1c \x85   z",
       "123 4567 89,01 -5", "a" * 500, " ", "   ", "\n", "Ġ Ċ x", "مرحبا بالعالم", "नमस्ते दुनिया"]


def rows():
    rnd = random.Random(6)
    small = [r for r in edge_rows() if not r[1] or len(r[1]) < 20_000]
    return small + [(100 + i, t) for i, t in enumerate(ODD)] + [(200 + i, prose(rnd, 40)) for i in range(30)]


def test_align_against_brute_force(spark):
    df = docs(spark, rows()).repartition(4)
    assert records(token_align.align_tokenizers(df, A, B), *COLUMNS) == brute(rows())


def test_very_long_texts_and_many_chunks(spark, monkeypatch):
    rnd = random.Random(2)
    some = [(1, prose(rnd, 30_000, 3000)), (2, "x" * 60_000), (3, prose(rnd, 50)), (4, None)]
    df = docs(spark, some).repartition(3)
    got = {r[0]: r[1:] for r in records(token_align.align_tokenizers(df, A, B), *COLUMNS)}
    whole = Whole()
    for i, text in some:
        t = whole.tokens(text)
        assert got[i][:2] == ((len(t[0]), len(t[2])) if t else (0, 0))
        assert got[i][3] == got[i][0] + got[i][1] - got[i][2]          # every cut inside a group adds a link
    assert got[4] == (0, 0, 0, 0, 0, 0, "")


def test_empty_table(spark):
    out = token_align.align_tokenizers(docs(spark, [(1, "x")]).filter("false"), A, B)
    assert out.columns == list(COLUMNS) and out.count() == 0


_aligner = token_align.Aligner(token_align.byte_bpe(open(A, encoding="utf-8").read()), token_align.piece_bpe(open(B, "rb").read()))
_whole = Whole()


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab Zé'ts\n\t ▁.,12日🙂\x1ć<|>"), max_size=40))
def test_segments_give_the_whole_texts_tokens(text):
    found, want = _aligner.texts([text])[0], _whole.links(text)
    assert (found is None) == (want is None)
    if want:
        size = len(_aligner.bytes_b)
        assert found[0] == ";".join(want[2]) and found[2] == want[0]
        assert sorted(divmod(int(c), size) for c in token_align.np.frombuffer(found[1], "<i8")) == sorted(want[3])


def test_words_seen_before_come_from_the_worker_and_old_ones_go():
    aligner = token_align.Aligner((_aligner.bytes_a, _aligner.encode_a), (_aligner.bytes_b, _aligner.encode_b))
    aligner.seen.most = 50
    rnd = random.Random(1)
    for _ in range(30):
        text = prose(rnd, 60)
        assert aligner.texts([text])[0] == _aligner.texts([text])[0]
        assert len(aligner.seen.young) <= 50 + 61 and len(aligner.seen.old) <= 50 + 61


def test_ids_are_the_files_own_and_other_files_keep_their_library():
    spec = json.loads(open(A, encoding="utf-8").read())
    assert token_align._plain_ranks(spec, token_align.byte_level()) is not None
    rnd = random.Random(4)
    texts = [*ODD, *[prose(rnd, 200, 3000) for _ in range(20)], "".join(map(chr, range(32, 3000))), "ab" * 4000]
    assert _aligner.encode_a(texts) == [_whole.a.encode(t, add_special_tokens=False).ids for t in texts]
    for change in ({"normalizer": {"type": "Lowercase"}}, {"pre_tokenizer": None}, {"model": spec["model"] | {"merges": spec["model"]["merges"][::-1]}}):
        assert token_align._plain_ranks(spec | change, token_align.byte_level()) is None
