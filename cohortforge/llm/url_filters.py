"""URL filters: rules by host and path, and for the rest the link graph between hosts.

Trust flows from the hosts that rules allow along links; distrust flows from the hosts that rules
block to those that link to them. Both are personalised PageRanks over the same weighted host edges,
the one forward, the other reversed. A host whose distrust outweighs its trust is blocked.

Scores are whole numbers of parts of a seed (`SCALE`): sums do not depend on the order in which
tasks deliver them, so a rerun after a lost executor, or another cluster, judges every host alike.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortforge.llm.shared import staged

SCALE = 1_000_000_000  # score of a whole seed
DAMPING = 85  # per cent of a host's score that it passes on
ROUNDS = 40  # what later rounds would add is under 0.2 per cent of the seeds
KEPT = 8  # rounds between writing the scores to the shared folder
MARGIN = 10_000_000  # by so much distrust must outweigh trust
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOST, PATH = r"(?s)^.*?://([^/?#]*)", r"(?s)^.*?://[^/?#]*([^?#]*)"
# the host of a link that names one: after the scheme, or from `//` on
BLANK = r"[\x09-\x0D\x20]"
LINK = rf"""[\x09-\x0D\x20"'/](?:[Hh][Rr][Ee][Ff]|[Ss][Rr][Cc]){BLANK}*={BLANK}*["']?{BLANK}*(?:[Hh][Tt][Tt][Pp][Ss]?:)?//([^/?#"'\x09-\x0D\x20>\\]+)"""


class Rule(NamedTuple):
    """`verdict` for the urls of `host` and all its subdomains whose path starts with `path`."""

    verdict: str
    host: str
    path: str = "/"


# The rules of the registered query.
RULES = (
    Rule("allow", "com"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def host_of(url: Column) -> Column:
    """What follows the first `://`, up to the path, in lower case; else empty."""
    return lowered(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null where none does.

    Of rules of one length that with the longer host wins, then a blocking one. The list is part
    of the plan: it is meant for hundreds of rules kept by hand, not for a table of hosts.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    shortest_first = sorted(rules, key=lambda r: (len(r.host + r.path), len(r.host), r.verdict == "block", r))
    for r in shortest_first:
        fits = ((host == r.host) | host.endswith(f".{r.host}")) & path.startswith(r.path)
        name, verdict = F.when(fits, F.lit(r.host + r.path)).otherwise(name), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def judged_by_rules(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(page_id, host, path, rule, ruled) of every page."""
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    return parts.withColumns({"rule": rule, "ruled": verdict})


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): links between different hosts, and the number of pages that have them."""
    links = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)), lowered))
    found = pages.where("html is not null").select(host_of(F.col("url")).alias("src"), F.explode(links).alias("dst"))
    return found.where("src <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("weight"))


def seeds(ruled: DataFrame) -> DataFrame:
    """(host, trust, distrust): the shares of a host's pages that rules allow and block."""
    share = lambda verdict: F.expr(f"{SCALE} * count_if(ruled = '{verdict}') div count(*)")
    known = ruled.where("host <> ''").groupBy("host")
    return known.agg(share("allow").alias("trust"), share("block").alias("distrust"))


def spread(start: DataFrame, edges: DataFrame) -> DataFrame:
    """(host, score): personalised PageRank of the hosts of `start` (host, seed) over `edges`.

    A round joins the scores to the edges by source and adds what arrives by target, reduced before
    the shuffle. What a host without outgoing edges would pass on is lost.
    """
    out = edges.groupBy("src").agg(F.sum("weight").alias("total"))
    shares = staged(edges.join(out, "src").select("src", "dst", "weight", "total"), "shares")
    own = start.where("seed > 0").select("host", F.expr(f"seed * {100 - DAMPING} div 100").alias("score"))
    own = staged(own, "seeds")
    part = F.expr(f"cast(score as decimal(20,0)) * {DAMPING} * weight div (total * 100)")
    scores, before = own, None
    for k in range(1, ROUNDS + 1):
        passed = shares.join(scores.withColumnRenamed("host", "src"), "src").select(F.col("dst").alias("host"), part.alias("score"))
        scores = passed.unionByName(own).groupBy("host").agg(F.sum("score").alias("score"))
        if k % KEPT == 0 or k in (1, ROUNDS):
            scores = staged(scores, "scores")
            mark = scores.agg(F.count("*"), F.sum("score"), F.sum(F.xxhash64("host", "score").cast("decimal(38,0)"))).first()
            if mark == before:
                break
            before = mark
    return scores


def host_verdicts(ruled: DataFrame, edges: DataFrame) -> DataFrame:
    """(host, trust, distrust, block) for every host with a score."""
    start = staged(seeds(ruled), "hosts")
    edges = staged(edges, "edges")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    trust = spread(start.select("host", F.col("trust").alias("seed")), edges)
    distrust = spread(start.select("host", F.col("distrust").alias("seed")), back)
    both = trust.withColumnRenamed("score", "trust").join(
        distrust.withColumnRenamed("score", "distrust"), "host", "full_outer"
    ).select("host", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("trust", "distrust")))
    return both.withColumn("block", F.col("distrust") >= F.col("trust") + MARGIN)


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Every page's verdict: page_id, host, path, rule, verdict, trust, distrust.

    A rule that fits decides; else the page's host by its scores: blocked where distrust is at least
    `MARGIN` over trust, allowed otherwise, so a host without any evidence is allowed. A null url,
    and one without `://`, has an empty host and path and is allowed. A null html has no links;
    links without a host are links to the page's own and no edges. Rows that repeat are judged each.
    An empty table gives an empty result. Columns other than page_id, url and html are not read.
    """
    ruled = judged_by_rules(pages, rules)
    hosts = staged(host_verdicts(ruled, host_edges(pages.select("url", "html"))), "verdicts")
    by_host = ruled.join(hosts, "host", "left")
    verdict = F.coalesce("ruled", F.when(F.col("block"), "block").otherwise("allow"))
    scores = (F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("trust", "distrust"))
    return by_host.select("page_id", "host", "path", "rule", verdict.alias("verdict"), *scores)
