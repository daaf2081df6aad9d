import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from lumenrec.llm import url_filter
from lumenrec.llm.common import Scratch
from tests.llm.helpers import CLASHING, records

SCHEMA = "page_id long, url string, html string"
COLUMNS = ("page_id", "host", "path", "rule", "verdict")


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def parts(url):
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3:]
    host = re.match(r"[^/?#]*", rest)[0]
    return lower(host), re.match(r"[^?#]*", rest[len(host):])[0]


def best_rule(host, path, rules):
    fit = []
    for verdict, rule in rules:
        at, slash, rest = rule.partition("/")
        if (host == at or host.endswith("." + at)) and path.startswith(slash + rest):
            fit.append((-len(rule), verdict != "block", rule, verdict))
    return (min(fit)[2], min(fit)[3]) if fit else (None, None)


def brute_scores(seeds, links, rounds=url_filter.ROUNDS):
    """The walk by plain loops over a dictionary of links."""
    d, unit = 0.85, 65536
    out, into = Counter(), Counter()
    for (a, b), n in links.items():
        out[a] += n
        into[b] += n
    start = {h: [math.floor(x * ((1 - d) * unit)) for x in s] for h, s in seeds.items()}
    state = start
    for _ in range(rounds):
        new = defaultdict(lambda: [0, 0], {h: list(s) for h, s in start.items()})
        for (a, b), n in links.items():
            new[b][0] += math.floor(float(state.get(a, (0, 0))[0]) * (d * n / out[a]))
            new[a][1] += math.floor(float(state.get(b, (0, 0))[1]) * (d * n / into[b]))
        state = new
    return {h: tuple(s) for h, s in state.items()}


def brute(rows, rules=url_filter.RULES):
    judged = [(i, *parts(u), *best_rule(*parts(u), rules)) for i, u, _ in rows]
    seeds = defaultdict(lambda: [0, 0])
    for _, host, _, rule, verdict in judged:
        if host and rule:
            seeds[host][verdict == "block"] += 1
    links = Counter()
    for (_, host, _, _, _), (_, _, html) in zip(judged, rows):
        for to in {lower(x) for x in re.findall(r"""(?:[Hh]ref|HREF|src|action)\s*=\s*["']?\s*(?:[a-zA-Z][\w+.-]*:)?//([^/?#"'<>\s]+)""", html or "")}:
            if host and to != host:
                links[host, to] += 1
    scores = brute_scores(seeds, links)
    out = []
    for i, host, path, rule, verdict in judged:
        trust, distrust = scores.get(host, (0, 0))
        out.append((i, host, path, rule, verdict or ("block" if distrust > trust else "allow")))
    return sorted(out, key=repr)


def link(*hosts):
    return "<p>" + " ".join(f'<a class=x href="https://{h}/p?q=1">x</a>' for h in hosts) + "</p>"


EDGES = [
    (1, "http://WWW.Example.com/en/a?b#c", None), (2, "https://m.example.com/en/1", ""), (3, "https://example.com/de/1", "x"),
    (4, "http://shop.net/es/1", link("good.org")), (4, "http://shop.net/es/1", link("good.org")), (5, "http://shop.net/de/1", "//"),
    (6, None, link("shop.net")), (7, "", link("shop.net")), (8, "no-scheme.net/es/", None), (None, "http://x.org", None),
    (9, "http://x.com", None), (10, "http://x.com?y=/", None), (11, "http://x.com#/", None), (12, "a://b://c.net/es/", None),
    (13, "://net/es/1", None), (14, "http:///es/1", link("shop.net")), (15, "http://notexample.com/en/1", None),
    (16, "http://x.org/" + "p/" * 50_000, "<a href='//shop.net/'>" * 3 + "w " * 100_000),
    (17, "http://ring.org/1", '<form ACTION = ftp://Shop.NET:80/x><img src="//shop.net"><a HREF="/rel"><a href=shop.net/x>'),
    (18, "http://quiet.org/1", link("good.org")), (19, "http://good.org/é 😀", None), (20, "http://net/fr/", None),
]


def graph_rows(seed=4):
    """Farms that link to blocked hosts, sites that trusted ones link to, and a hub with a third of the pages."""
    rnd = random.Random(seed)
    rows = []
    hosts = [f"h{i}.org" for i in range(40)] + [f"t{i}.com" for i in range(8)] + [f"b{i}.net" for i in range(8)]
    for i in range(400):
        host = "hub.org" if i % 3 == 0 else rnd.choice(hosts)
        path = rnd.choice(["/es/1", "/fr/x", "/de/2", "/en/"])
        to = [rnd.choice(hosts + ["hub.org"]) for _ in range(rnd.randrange(4))]
        rows.append((i, f"https://{host}{path}", link(*to)))
    return rows


@pytest.mark.parametrize("rows", [EDGES, graph_rows(), []])
def test_judge_against_brute_force(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ["host", "path", "rule", "verdict", *CLASHING]})
    assert records(url_filter.judge_pages(df), *COLUMNS) == brute(rows)


@pytest.mark.parametrize("rows", [EDGES, graph_rows(5)])
def test_sql_text_gives_the_same(spark, rows):
    con = duckdb.connect()
    df = spark.createDataFrame(rows, SCHEMA)
    pages = df.toArrow()
    con.register("pages", pages)
    got = con.sql(url_filter.oracle_sql())
    at = [got.columns.index(c) for c in COLUMNS]
    assert sorted((tuple(r[i] for i in at) for r in got.fetchall()), key=repr) == brute(rows)


def test_longest_rule_wins_and_ties_block(spark):
    rules = [("allow", "a.org/"), ("block", "w.a.org/"), ("allow", "a.org/xy"), ("allow", "a.org/x/long/")]
    rows = [(1, "http://w.a.org/xy", None), (2, "http://w.a.org/z", None), (3, "http://a.org/xy", None), (4, "http://w.a.org/x/long/1", None)]
    got = records(url_filter.judge_pages(spark.createDataFrame(rows, SCHEMA), rules), "page_id", "rule", "verdict")
    assert got == [(1, "w.a.org/", "block"), (2, "w.a.org/", "block"), (3, "a.org/xy", "allow"), (4, "a.org/x/long/", "allow")]


def test_distrust_reaches_those_who_link_to_blocked_hosts_and_trust_outweighs_it(spark):
    bad = [(i, "http://spam.net/es/1", None) for i in range(50)]
    farm = [(100, "http://farm.org/1", link("spam.net")), (101, "http://far.org/1", link("farm.org")),
            (102, "http://clean.org/1", link("farm.example.org"))]
    good = [(200 + i, "http://paper.com/1", link("kind.org")) for i in range(500)]
    mixed = [(900, "http://kind.org/1", link("spam.net", "paper.com"))]
    out = url_filter.judge_pages(spark.createDataFrame(bad + farm + good + mixed, SCHEMA)).filter("rule IS NULL")
    assert dict(records(out, "page_id", "verdict")) == {100: "block", 101: "block", 102: "allow", 900: "allow"}


def test_scores_equal_plain_loops_and_do_not_depend_on_partitions(spark):
    rnd = random.Random(9)
    links = Counter((f"h{rnd.randrange(30)}", f"h{rnd.randrange(30)}") for _ in range(200))
    links = Counter({k: n for k, n in links.items() if k[0] != k[1]})
    links.update({(f"h{i}", "hot") : 3 for i in range(30)})
    seeds = {f"h{i}": (i % 3, (i + 1) % 4) for i in range(0, 30, 2)}
    s = spark.createDataFrame([(h, *v) for h, v in seeds.items()], "host string, trust long, distrust long")
    e = spark.createDataFrame([(*k, n) for k, n in links.items()], "src string, dst string, pages long")
    want = {h: v for h, v in brute_scores(seeds, links).items()}
    for parts_ in (1, 7):
        got = url_filter.host_scores(s.repartition(parts_), e.repartition(parts_), Scratch(spark, "t"))
        assert {r.host: (r.trust, r.distrust) for r in got.collect()} == want


def test_plan_is_native(spark):
    rows = graph_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    plan = url_filter.judge_pages(df)._jdf.queryExecution().toString() + url_filter.host_links(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan.replace("PythonRDD", ""))
