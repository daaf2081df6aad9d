"""URL filter: rules of host and path, and trust and distrust spread over the links between hosts.

Built-in functions only.  Pages that a rule allows make their host trusted, pages that a rule
blocks make it distrusted.  Trust walks along the links (personalised PageRank from the
trusted hosts), distrust walks against them (to those who link to blocked hosts).  A page that
no rule fits is blocked if its host has more distrust than ``threshold`` times its trust.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, UPPER, Scratch, ascii_lower

RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
         ("block", "net/es/"), ("block", "net/fr/")]

_HOST = r"(?s)^.*?://([^/?#]*)"
_PATH = r"(?s)^.*?://[^/?#]*([^?#]*)"
# the host of an absolute or protocol-relative link in a tag's attribute
_LINK = (r"""(?:[Hh][Rr][Ee][Ff]|[Ss][Rr][Cc]|[Aa][Cc][Tt][Ii][Oo][Nn])[\x20\x09-\x0D]*=[\x20\x09-\x0D]*["']?[\x20\x09-\x0D]*"""
         r"""(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#"'<>\x20\x09-\x0D]+)""")
UNIT = 65536                  # scores are whole numbers of 1/65536 page: sums do not depend on the order of rows
DAMPING, ROUNDS, THRESHOLD = 0.85, 20, 1
_CUT_EVERY = 5                # rounds between two written states
_BROADCAST_ROWS = 500_000     # hosts (of about 30 bytes) up to which the counted blocked hosts are broadcast


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, _HOST, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, _PATH, 1), F.lit(""))


def _ordered(rules: list[tuple[str, str]]) -> list[tuple[str, str]]:
    """Longest rule first; of equally long ones a blocking one first, then by text."""
    return sorted(set(rules), key=lambda r: (-len(r[1]), r[0] != "block", r[1]))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits as struct (rule, verdict), or null.

    A rule ``host/path`` fits its host and all subdomains if the path starts with the rule's.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in reversed(_ordered(rules)):
        at, slash, rest = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(slash + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Links between hosts: (src, dst, pages), the pages of ``src`` that link to ``dst``.

    Absolute and protocol-relative links of href, src and action attributes; a host's links to
    itself do not count.  Pages are summed up before anything is shuffled.
    """
    p = pages.select(host_of(F.col(url)).alias("src"), F.col(html).alias("html")).filter(F.contains("html", F.lit("//")))
    found = F.transform(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1)), ascii_lower)
    links = p.select("src", F.explode(F.array_distinct(found)).alias("dst"))
    return links.filter((F.col("src") != "") & (F.col("src") != F.col("dst"))).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("pages"))


def _spread(state: DataFrame, shares: DataFrame, seeds: DataFrame) -> DataFrame:
    """One round: the seeds' restart and what the links bring of the state, in whole units."""
    def carried(score: str, share: str) -> Column:
        return F.floor(F.col(score).cast("double") * F.col(share))

    def zero(name: str) -> Column:
        return F.lit(0).cast("long").alias(name)

    trust = shares.join(state.filter("trust > 0"), shares.src == state.host) \
        .select(F.col("dst").alias("host"), carried("trust", "forward").alias("trust"), zero("distrust"))
    distrust = shares.join(state.filter("distrust > 0"), shares.dst == state.host) \
        .select(F.col("src").alias("host"), zero("trust"), carried("distrust", "backward").alias("distrust"))
    return seeds.unionByName(trust).unionByName(distrust).groupBy("host") \
        .agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))


def host_scores(seeds: DataFrame, links: DataFrame, scratch: Scratch, damping: float = DAMPING,
                rounds: int = ROUNDS) -> DataFrame:
    """Trust and distrust of hosts in 1/65536 pages: (host, trust, distrust).

    ``seeds``: (host, trust, distrust) in pages; ``links``: (src, dst, pages).  A walk restarts
    at its seeds with probability ``1 - damping`` and ends at a host without further links.
    Scores only grow from round to round, so equal totals mean that nothing changes any more;
    else it ends after ``rounds`` rounds.  State is written every five rounds.
    """
    def total(host: str, name: str) -> DataFrame:
        return links.groupBy(F.col(host).alias(name)).agg(F.sum("pages").alias(f"{name}_pages"))

    out, into = total("src", "o"), total("dst", "i")
    shares = links.join(out, links.src == out.o).join(into, links.dst == into.i).select(
        "src", "dst", (F.lit(damping) * F.col("pages") / F.col("o_pages")).alias("forward"),
        (F.lit(damping) * F.col("pages") / F.col("i_pages")).alias("backward"))
    shares = scratch.write(shares, "shares")
    start = seeds.select("host", *[F.floor(F.col(c) * F.lit((1 - damping) * UNIT)).alias(c) for c in ("trust", "distrust")])
    start = state = scratch.write(start, "state-0")
    if shares.isEmpty():
        return state

    def totals(s):
        return s.agg(F.sum("trust"), F.sum("distrust")).first()

    done, before = 0, totals(state)
    while done < rounds:
        step = min(_CUT_EVERY, rounds - done)
        for _ in range(step):
            state = _spread(state, shares, start)
        done += step
        state = scratch.write(state, f"state-{done}")
        after = totals(state)
        if after == before:
            break
        before = after
    return state


def judge_pages(pages: DataFrame, rules: list[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url",
                html_col: str = "html", damping: float = DAMPING, rounds: int = ROUNDS, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``pages``: ``id_col``, host, path, rule, verdict.

    ``rules``: a short list of (allow or block, ``host/path``).  A rule's page has its verdict;
    any other is blocked if its host's distrust exceeds ``threshold`` times its trust, and else
    allowed (so also with neither).  A url that is null or holds no ``://`` has empty host and
    path, which no rule with a path fits; null html has no links.  Repeated rows are judged and
    counted as often as they occur; an empty table gives an empty result; other columns are
    ignored.  The pages' text is read once, for the links; only hosts are shuffled, summed up
    before.  The blocked hosts are broadcast if a count finds few, else both sides are shuffled
    and adaptive execution splits a hot host.
    """
    scratch = Scratch(pages.sparkSession, "url-filter")
    p = pages.select(F.col(id_col).alias("__id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    p = p.withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    seeds = p.filter((F.col("host") != "") & F.col("r").isNotNull()).groupBy("host") \
        .agg(*[F.count_if(F.col("r.verdict") == v).alias(c) for c, v in (("trust", "allow"), ("distrust", "block"))])
    links = scratch.write(host_links(pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html"))), "links")
    scores = host_scores(seeds, links, scratch, damping, rounds)
    bad = scores.filter(F.col("distrust") > F.lit(threshold) * F.col("trust")).select(F.col("host").alias("bad"))
    bad = scratch.write(bad, "blocked")
    if bad.count() <= _BROADCAST_ROWS:
        bad = F.broadcast(bad)
    verdict = F.coalesce(F.col("r.verdict"), F.when(F.col("bad").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return p.join(bad, p.host == bad.bad, "left") \
        .select(F.col("__id").alias(id_col), "host", "path", F.col("r.rule").alias("rule"), verdict.alias("verdict"))


def oracle_sql(rules: list[tuple[str, str]] = RULES) -> str:
    """The same in DuckDB's SQL over ``pages``, all rounds written out."""
    def text(s: str) -> str:
        return "'" + s.replace("'", "''") + "'"

    def lower(s: str) -> str:
        return f"translate({s}, '{UPPER}', '{LOWER}')"

    def case(value) -> str:
        whens = []
        for verdict, rule in _ordered(rules):
            at, slash, rest = rule.partition("/")
            whens.append(f"WHEN (host = {text(at)} OR ends_with(host, {text('.' + at)})) AND starts_with(path, {text(slash + rest)}) "
                         f"THEN {text(value(verdict, rule))}")
        return "CASE " + " ".join(whens) + " END"

    ctes = [f"""p AS MATERIALIZED (
  SELECT page_id, coalesce({lower(f"regexp_extract(url, {text(_HOST)}, 1)")}, '') AS host,
         coalesce(regexp_extract(url, {text(_PATH)}, 1), '') AS path, html FROM pages)""",
            f"""r AS MATERIALIZED (
  SELECT page_id, host, path, {case(lambda v, _: _)} AS rule, {case(lambda v, _: v)} AS verdict FROM p)""",
            f"""l AS (SELECT host AS src, unnest(list_distinct(list_transform(regexp_extract_all(html, {text(_LINK)}, 1), lambda x: {lower('x')}))) AS dst
  FROM p WHERE contains(html, '//') AND host <> '')""",
            "e AS (SELECT src, dst, count(*) AS n FROM l WHERE src <> dst GROUP BY ALL)",
            f"""w AS MATERIALIZED (
  SELECT src, dst, {DAMPING}::DOUBLE * n / sum(n) OVER (PARTITION BY src) AS f,
         {DAMPING}::DOUBLE * n / sum(n) OVER (PARTITION BY dst) AS b FROM e)""",
            f"""s0 AS MATERIALIZED (
  SELECT host, floor(count(*) FILTER (WHERE verdict = 'allow') * {(1 - DAMPING) * UNIT!r}::DOUBLE)::BIGINT AS t,
         floor(count(*) FILTER (WHERE verdict = 'block') * {(1 - DAMPING) * UNIT!r}::DOUBLE)::BIGINT AS d
  FROM r WHERE host <> '' AND rule IS NOT NULL GROUP BY host)"""]
    for k in range(ROUNDS):
        ctes.append(f"""s{k + 1} AS MATERIALIZED (SELECT host, sum(t)::BIGINT AS t, sum(d)::BIGINT AS d FROM (
  SELECT * FROM s0 UNION ALL
  SELECT dst, floor(t::DOUBLE * f)::BIGINT, 0 FROM w JOIN s{k} ON src = host UNION ALL
  SELECT src, 0, floor(d::DOUBLE * b)::BIGINT FROM w JOIN s{k} ON dst = host) GROUP BY host)""")
    return f"""WITH {", ".join(ctes)}
SELECT page_id, r.host, path, rule,
       coalesce(verdict, CASE WHEN s.d > {THRESHOLD} * s.t THEN 'block' ELSE 'allow' END) AS verdict
FROM r LEFT JOIN s{ROUNDS} s ON r.host = s.host"""
