"""URL filter: host rules, and for hosts they say nothing about, trust and distrust over links.

Every step is a DataFrame operation. Hosts whose pages a rule allows or blocks are seeds, by the
share of their pages. Trust is a personalised PageRank along host links from the allowed seeds;
distrust is one along the reversed links from the blocked seeds, as who links to a blocked host
shares its distrust. A page that no rule fits is blocked if its host's distrust exceeds its trust
by the threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclake.llm.common import ascii_lower
from civiclake.plans.scratch import written

#: (action, host and start of the path).
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)

DAMPING = 0.85
ROUNDS = 20

#: By how much distrust must exceed trust: what a host has on its own if half its pages are blocked.
THRESHOLD = (1 - DAMPING) / 2

#: Rounds after which the scores are written, so that plans and recomputation stay short.
WRITTEN_EVERY = 5

#: Parts that the pages of one host are cut into to meet the host's verdict.
HOST_SALTS = 16

LINK = r"""(?i)\bhref\s*=\s*["']?\s*((?:https?:)?//[^"'\s>]+)"""


def url_host(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    """What stands after the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise("")


def matching_rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(the longest fitting rule, its action), nulls without one."""
    name, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        rule_host, _, rule_path = rule.partition("/")
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(f"/{rule_path}")
        name, action = F.when(fits, rule).otherwise(name), F.when(fits, what).otherwise(action)
    return name, action


def host_links(pages: DataFrame, url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(source, target, weight): pages of a host that link to another host, counted per pair."""
    links = pages.select(
        url_host(F.col(url_column)).alias("source"),
        F.explode(F.array_distinct(F.regexp_extract_all(F.col(html_column), F.lit(LINK), F.lit(1)))).alias("link"),
    )
    target = url_host(F.when(F.col("link").startswith("//"), F.concat(F.lit("http:"), "link")).otherwise(F.col("link")))
    return (
        links.select("source", target.alias("target"))
        .where("source != '' AND target != '' AND source != target")
        .groupBy("source", "target")
        .agg(F.count(F.lit(1)).alias("weight"))
    )


def _flow(links: DataFrame, start: str, end: str) -> DataFrame:
    """(start, end, share): each start's links as shares that sum to 1."""
    total = links.groupBy(start).agg(F.sum("weight").alias("total"))
    return links.join(total, start).select(
        F.col(start).alias("start"), F.col(end).alias("end"), (F.col("weight") / F.col("total")).alias("share")
    )


def propagate(seeds: DataFrame, links: DataFrame) -> DataFrame:
    """(host, trust, distrust) after ``ROUNDS`` rounds; ``seeds`` has host, trusted and blocked shares."""
    own = (1 - DAMPING) * F.col("trusted"), (1 - DAMPING) * F.col("blocked")
    scores = seeds.select("host", "trusted", "blocked", own[0].alias("trust"), own[1].alias("distrust"))
    if links.isEmpty():
        return scores.select("host", "trust", "distrust")
    forward, backward = written(_flow(links, "source", "target"), "flow"), written(_flow(links, "target", "source"), "flow")
    scores = written(scores, "scores")
    for n in range(1, ROUNDS + 1):
        parts = [
            flow.join(scores, F.col("start") == F.col("host"))
            .where(F.col(name) > 0)
            .groupBy("end")
            .agg((DAMPING * F.sum(F.col(name) * F.col("share"))).alias("received"))
            .select(F.col("end").alias("host"), *(F.col("received").alias(c) if c == name else F.lit(0.0).alias(c) for c in ("trust", "distrust")))
            for flow, name in ((forward, "trust"), (backward, "distrust"))
        ]
        received = parts[0].unionByName(parts[1]).groupBy("host").agg(F.sum("trust").alias("t"), F.sum("distrust").alias("d"))
        scores = scores.join(received, "host", "left").select(
            "host", "trusted", "blocked",
            (own[0] + F.coalesce("t", F.lit(0.0))).alias("trust"),
            (own[1] + F.coalesce("d", F.lit(0.0))).alias("distrust"),
        )
        if n % WRITTEN_EVERY == 0:
            scores = written(scores, "scores")
    return scores.select("host", "trust", "distrust")


def filter_urls(
    pages: DataFrame, rules=RULES, id_column: str = "page_id", url_column: str = "url", html_column: str = "html"
) -> DataFrame:
    """Per page: id, ``host``, ``path``, ``rule`` (the longest fitting one, else null), ``verdict``.

    A null url, or one without ``://``, has empty host and path and no rule, and is allowed. Null or
    broken html links nowhere. Rows without id and repeated rows pass through, one output row per
    input row; other columns are not read. Rules are a short list that is part of the plan.
    """
    url = F.col(url_column)
    judged = pages.select(F.col(id_column), url_host(url).alias("host"), url_path(url).alias("path"))
    rule, action = matching_rule(F.col("host"), F.col("path"), rules)
    judged = judged.select(id_column, "host", "path", rule.alias("rule"), action.alias("action"))
    share = [F.coalesce(F.avg((F.col("action") == what).cast("double")), F.lit(0.0)) for what in ("allow", "block")]
    every = F.coalesce("action", F.lit("none"))
    seeds = judged.withColumn("action", every).groupBy("host").agg(share[0].alias("trusted"), share[1].alias("blocked"))
    links = host_links(pages, url_column, html_column)
    ends = links.select(F.col("target").alias("host")).union(links.select(F.col("source").alias("host")))
    nodes = seeds.unionByName(ends.select("host", F.lit(0.0).alias("trusted"), F.lit(0.0).alias("blocked")))
    nodes = nodes.groupBy("host").agg(F.max("trusted").alias("trusted"), F.max("blocked").alias("blocked"))
    scores = propagate(nodes, links)
    blocked = scores.where(F.col("distrust") - F.col("trust") >= THRESHOLD).select(
        F.col("host").alias("blocked_host")
    )
    verdict = F.coalesce("action", F.when(F.col("blocked_host").isNull(), "allow").otherwise("block"))
    # one host may have a third of all pages: its pages are spread over salts, and its verdict copied to each
    salts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(HOST_SALTS - 1).cast("bigint")))
    blocked = blocked.select("blocked_host", salts.alias("blocked_salt"))
    salted = judged.withColumn("salt", F.pmod(F.xxhash64(id_column, "path"), F.lit(HOST_SALTS)))
    same = (F.col("host") == F.col("blocked_host")) & (F.col("salt") == F.col("blocked_salt"))
    return salted.join(blocked, same, "left").select(
        id_column, "host", "path", "rule", verdict.alias("verdict")
    )
