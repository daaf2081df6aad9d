import math
import random
import re

from lumenrec.llm import secret_scan as s
from tests.llm.helpers import docs, edge_rows, records

BASE = re.compile(r"""(?a:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(t):
    t, out = t or "", []
    out += [(m.start(), 0, m.end()) for m in BASE.finditer(t) if len(m[1]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return [(a, e, s.KINDS[k]) for a, k, e in sorted(out)]


def texts():
    rnd = random.Random(6)
    bits = ["password", "PassWord", "passwd", "secret", "token", "api_key", "APIKEY", "ſecret", "toKen", "=", ":", " ", "  ", '"', "'",
            "hunter2", "abcdefgh", "A1b2C3d4E5", "AKIA" + "Q" * 12, "AKIA", "0123456789abcdef" * 2, "f" * 31, "😀", "é", "\n", "====", "/"]
    return [(i, "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 30)))) for i in range(500)]


def test_fixed_formats_against_brute_force():
    for _, t in texts():
        assert [x[:3] for x in s.find_spans(t, 40.0) if x[2] != s.GUESS] == brute(t)


def exhaustive(value):
    """Cheapest segmentation by trying all of them."""
    bits, ends = s._char_bits(value), s._segments(value, s._char_bits(value))

    def best(j, brute):
        if j == 0:
            return 0.0
        options = [best(i, False) + c + s._SEGMENT for i, c, _ in ends[j]] if not brute else []
        options += [best(i, False) + s._SEGMENT + (j - i) * bits for i in range(j)]
        return min(options)
    return best(len(value), False)


def test_segmentation_is_the_cheapest():
    for value in ("", "a", "hunter2", "qwerty12", "abab", "pass1990", "zxcvxq", "Monkey7x"):
        assert abs(s.guess_bits(value) - exhaustive(value)) < 1e-9


def test_guess_costs():
    weak = ["password", "Password1", "p@ssw0rd", "qwertyuiop", "aaaaaaaaaaaa", "1990-05-12", "abcabcabcabc", "dragon123"]
    strong = ["3aef074f60e834b34e", "xK9#mPq2$vLw", "b53afbbde08d4a0c35aeabb4"]
    assert max(map(s.guess_bits, weak)) < 30 < 60 < min(map(s.guess_bits, strong))


def test_contextual_values():
    found = lambda t: [t[a:e] for a, e, kind, _ in s.find_spans(t, 40.0) if kind == s.GUESS]
    assert found("db_passphrase: kT7$pQz!9wRv#x") == ["kT7$pQz!9wRv#x"]
    assert found("access-key = 'Zx81kqPw02LmvnB4'") == ["Zx81kqPw02LmvnB4"]
    assert found("password: password123") == [] and found("token: your-token-here") == []
    assert found("the secret of the matter: nothing") == [] and found("kT7$pQz!9wRv#x alone") == []


def test_very_long_value_is_linear():
    rnd = random.Random(1)
    value = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz0123456789") for _ in range(20_000))
    assert s.guess_bits(value) > 50_000


def test_spark_scan_and_redaction(spark):
    rows = [*edge_rows(), *[(100 + i, t) for i, t in texts()[:60]], (900, "token=" + "a1" * 10 + " end"), (900, "token=" + "a1" * 10 + " end")]
    got = s.scan_secrets(docs(spark, rows))
    want = sorted(((d, [x[:3] for x in s.find_spans(t or "", 40.0)]) for d, t in rows), key=repr)
    assert sorted(((r.doc_id, [(x.start, x.end, x.kind) for x in r.spans]) for r in got.collect()), key=repr) == want
    out = s.redact_secrets(docs(spark, rows))
    assert out.columns == docs(spark, rows).columns
    texts_ = records(out.filter("doc_id = 900"), "text", "n_chars", "key")
    assert texts_ == [("[SECRET] end", 12, 2)] * 2
    assert out.filter("text IS NULL").count() == 2 and out.filter("char_length(text) <> n_chars").count() == 0
    assert s.scan_secrets(docs(spark, [])).count() == 0 and s.redact_secrets(docs(spark, [])).count() == 0


def segment_bits(value, i, j, bits):
    """Cheapest way to guess value[i:j] as one segment, from the definitions alone."""
    part, low, out = value[i:j], value[i:j].lower(), [float("inf")]
    for form, extra in ((low, 0), (low.translate(s._LEET), 2)):
        if len(part) >= 3 and form in s._RANK:
            out.append(math.log2(s._RANK[form] + 1) + extra + (part != low) + (part[1:] != low[1:]))
    if re.fullmatch(r"(19|20)\d\d", part):
        out.append(math.log2(60))
    day, month = "(0?[1-9]|[12][0-9]|3[01])", "(0?[1-9]|1[0-2])"
    if (re.fullmatch(rf"(19|20)\d\d(?P<s>[-/._ ]?){month}(?P=s){day}", part)
            or re.fullmatch(rf"{day}(?P<s>[-/._ ]){day}(?P=s)\d\d(\d\d)?", part)):
        out.append(math.log2(60 * 365 * 4))
    if len(part) == 1 and part in s._SEPARATORS:
        out.append(math.log2(s._SEPARATORS.index(part) + 2))
    for p in (1, 2, 3, 4):
        if len(part) >= max(3, 2 * p) and part == (part[:p] * len(part))[:len(part)]:
            out.append(p * bits + math.log2(len(part) / p))
    steps = [s._step(a, b) for a, b in zip(low, low[1:])]
    if len(part) >= 3 and None not in steps:
        out.append(math.log2(94) + 1.5 * (1 + sum(a != b for a, b in zip(steps, steps[1:]))) + math.log2(len(part)))
    return min(out)


def independent(value):
    bits, n = s._char_bits(value), len(value)
    best = [0.0]
    for j in range(1, n + 1):
        best.append(min(best[i] + 1 + min(segment_bits(value, i, j, bits), (j - i) * bits) for i in range(j)))
    return best[-1]


def test_segmentation_against_an_independent_search():
    rnd = random.Random(21)
    bits = ["a", "aa", "ab", "1", "11", "qaz", "xsw", "edc", "trustno1", "Love", "p4ss", "1990", "12", "31", "/", "-", "_", "X", "9", "asdf", "cba"]
    values = ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 9))) for _ in range(300)]
    values += ["trustno1qazxswedc", "a" * 90, "ab" * 40 + "b" * 30, "1" * 60, "199012121990", "5/12/12/1990", "qwertyuiop" * 6, "abcdcba" * 9]
    for value in values:
        assert abs(s.guess_bits(value) - independent(value)) < 1e-9, value


def test_ordinary_words_are_no_secrets():
    for text in ("auth: middleware/handlers", "pwd: /home/user/projects", "token: trustno1qazxswedc", "auth: authentication-provider"):
        assert s.find_spans(text, 40.0) == [] or all(k != s.GUESS for _, _, k, _ in s.find_spans(text, 40.0)), text


def test_long_runs_are_linear():
    assert s.guess_bits("a" * 100_000) < 30 and s.guess_bits("1" * 50_000) < 30 and s.guess_bits("qwerty" * 10_000) > 30


WORDS = {"de": "bundes verfassungs gericht benutzer verwaltung schlüssel größe", "es": "identificador usuario contraseña administración",
         "fr": "utilisateur authentification clé déploiement", "en": "session handler middleware provider"}


def corpus(n=30):
    rnd = random.Random(3)
    rows = []
    for lang, some in WORDS.items():
        for i in range(n):
            words = some.split() * 2 + [f"{lang}{rnd.randrange(50)}" for _ in range(10)]
            rnd.shuffle(words)
            rows.append((len(rows), " ".join(words) + " auth: qmzkvjxhbwtgr", lang, "s"))
    return rows


def test_corpus_words_per_language(spark):
    rows = [*corpus(), (900, None, "de", "s"), (901, "", None, "s"), (902, "seldom seldom seldom", "de", "s")]
    got = {r.word: r.rank for r in s.corpus_words(docs(spark, rows)).collect()}
    assert all(w in got for some in WORDS.values() for w in some.split())
    assert "seldom" not in got and "qmzkvjxhbwtgr" not in got          # too few documents; a credential's value
    assert s.corpus_words(docs(spark, [])).count() == 0
    counts = {}
    for _, t, lang, _ in rows:
        for w in {w for w in re.findall(r"[^\W\d_]+", (t or "").replace("auth: qmzkvjxhbwtgr", "").lower()) if 3 <= len(w) <= 20}:
            counts[lang or "", w] = counts.get((lang or "", w), 0) + 1
    for each in (1000, 8, 3):
        want = {}
        for (lang, w), n in counts.items():
            own = [m for (x, _), m in counts.items() if x == lang and m >= 5]
            if n >= 5 and sum(m >= n for m in own) <= each:
                want[w] = min(1 + sum(m > n for m in own), want.get(w, 10**9))
        assert {r.word: r.rank for r in s.corpus_words(docs(spark, rows), each=each).collect()} == want
    first = s.corpus_words(docs(spark, rows), most=3).collect()
    assert [r.rank for r in first] == sorted(got.values())[:3]


PLAIN_VALUES = ["Bundesverfassungsgericht", "Benutzerverwaltung", "identificador", "identificador-usuario", "https://docs.example.org/login",
                "os.environ['API_KEY_NAME']", "process.env.SECRET_TOKEN", "authentification/utilisateur", "settings.auth.provider",
                "getenv(\"API_TOKEN\")", "session_handler", "config::session::provider"]
SECRET_VALUES = ["3aef074f60e834b34e", "xK9#mPq2$vLw", "https://docs.example.org/9fQ2xLmZ8vTr41Kp", "os.environ.kT7pQz9wRvx2Lm", "Zx81kqPw02LmvnB4",
                 "qmzkvjxhbwtgr", "user:kT7$pQz!9wRv@docs.example.org"]


def test_values_in_four_languages_addresses_and_identifiers(spark):
    rows = corpus() + [(1000 + i, f"auth: {v}", "en", "s") for i, v in enumerate(PLAIN_VALUES + SECRET_VALUES)]
    got = {r.doc_id: [x.kind for x in r.spans] for r in s.scan_secrets(docs(spark, rows), lang_col="lang").collect()}
    assert [v for i, v in enumerate(PLAIN_VALUES) if s.GUESS in got[1000 + i]] == []
    assert [v for i, v in enumerate(SECRET_VALUES, len(PLAIN_VALUES)) if s.GUESS not in got[1000 + i]] == []
    out = dict(records(s.redact_secrets(docs(spark, rows), lang_col="lang"), "doc_id", "text"))
    assert all(out[1000 + i] == f"auth: {v}" for i, v in enumerate(PLAIN_VALUES))
    assert all("[SECRET]" in out[1000 + i] for i, _ in enumerate(SECRET_VALUES, len(PLAIN_VALUES)))


def test_a_reference_with_a_costly_part_is_as_costly():
    assert s.value_bits("process.env.TOKEN") < s.guess_bits("process.env.TOKEN")
    for value in ("kT7.pQz.9wRv", "a.b9x.Zq1", "https://x.org/3aef074f60e834b34e", "plain"):
        assert s.value_bits(value) == s.guess_bits(value)
