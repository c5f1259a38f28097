"""URL verdicts: prefix rules first, link-graph trust and distrust for what no rule fits.

Trust is personalised PageRank from hosts that rules allow, along host edges; distrust is the same from
hosts that rules block, against the edges, since a page that links to bad hosts is suspect. Edges are
absolute links of the pages, to hosts with and without pages of their own, and, as pages of one site rarely
link each other absolutely, a host and the host directly above it are joined both ways where both have
pages. A host counts as a seed once for each of its pages under a rule, and once for each linked address
(host and path) under a rule that has no page. Scores are whole numbers (shares of
``UNIT``), so they do not depend on the order of additions; ``UNIT`` is large enough for a page's share of
10^11 seeds to pass many hops. Links are read in any case and with blanks around ``=``; a user part and a
default port of their host do not count. A host is blocked where its distrust exceeds
its trust; a host that neither reaches is allowed.

A null url or one without ``://`` has empty host and path, fits no rule and is allowed. Null html has no
links. Null page_ids and repeated rows are judged as rows of their own. An empty table gives no rows.
Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolake.llm import common

# (verdict, host and path): a rule fits its host and all subdomains where the path starts with its own.
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
UNIT = 10**30
SCORE = "decimal(38, 0)"
DAMPING = 85  # per cent
ROUNDS = 10
CUT_EVERY = 5
# Fixed: links with a host in markup.
LINK = r"""(?i)(?:href|src)[ \t\r\n]*=[ \t\r\n]*["']?(?:https?:)?//([^/?#"'> ]+)"""
# The same with the path.
TARGET = LINK + r"""([^?#"'> ]*)"""
# Fixed: what stands before and after a linked host without naming another one.
USER, PORT = "^.*@", ":(80|443)?$"

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Lower-cased host and path; both empty without a scheme."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def by_length(rules: Sequence[tuple[str, str]]) -> list[tuple[str, str]]:
    """Longest rule first, ties by the rule's text."""
    return sorted(rules, key=lambda r: (-len(r[1]), r[1]))


def fits(host: Column, path: Column, rule: str) -> Column:
    own, slash, start = rule.partition("/")
    return ((host == own) | host.endswith("." + own)) & path.startswith(slash + start)


def decide(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for word, text in reversed(by_length(rules)):
        fit = fits(host, path, text)
        rule, verdict = F.when(fit, text).otherwise(rule), F.when(fit, word).otherwise(verdict)
    return rule, verdict


def apply_rules(pages: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """page_id, host, path, the longest fitting rule and its verdict, null where none fits."""
    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = decide(F.col("host"), F.col("path"), rules)
    return rows.withColumns({"rule": rule, "verdict": verdict})


def linked(pages: DataFrame, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """Distinct (source, target, path, verdict) of absolute links; the path is null where no rule fits."""
    host, _ = split_url(F.col("url"))
    found = F.array_distinct(F.regexp_extract_all("html", F.lit(TARGET), F.lit(0)))
    rows = pages.select(host.alias("source"), F.explode(found).alias("link")).where("source <> ''")
    target = F.regexp_replace(F.regexp_replace(F.regexp_extract("link", TARGET, 1), USER, ""), PORT, "")
    target = F.translate(target, UPPER, LOWER)
    rows = rows.select("source", target.alias("target"), F.regexp_extract("link", TARGET, 2).alias("path"))
    _, verdict = decide(F.col("target"), F.col("path"), rules)
    rows = rows.withColumn("verdict", verdict)
    path = F.when(F.col("verdict").isNotNull(), F.col("path"))
    return rows.select("source", "target", path.alias("path"), "verdict").distinct()


def host_edges(links: DataFrame, hosts: DataFrame) -> DataFrame:
    """Distinct (source, target) of links between different hosts, and of ties between hosts that have pages."""
    links = links.where("source <> target").select("source", "target").distinct()
    above = F.regexp_extract("host", r"^[^.]+\.(.+)$", 1)
    ties = hosts.select(F.col("host").alias("source"), above.alias("target")).join(
        hosts.select(F.col("host").alias("target")), "target", "left_semi"
    )
    back = ties.select(F.col("target").alias("source"), F.col("source").alias("target"))
    return links.unionByName(ties).unionByName(back).distinct()


def seed_hosts(ruled: DataFrame, links: DataFrame, hosts: DataFrame) -> DataFrame:
    """(host, allowed, blocked): pages and linked addresses without pages under a rule of each kind."""
    addresses = links.where("verdict is not null").select(F.col("target").alias("host"), "path", "verdict").distinct()
    paged = ruled.where("verdict is not null").select("host", "path").distinct()
    unseen = addresses.join(paged, ["host", "path"], "left_anti")
    counts = [F.count(F.when(F.col("verdict") == w, 1)).alias(n) for w, n in (("allow", "allowed"), ("block", "blocked"))]
    return (
        hosts.select("host", "allowed", "blocked")
        .unionByName(unseen.groupBy("host").agg(*counts))
        .groupBy("host")
        .agg(F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked"))
    )


def whole_part(top: Column, by: Column) -> Column:
    """Whole-number division of scores, exact to the last digit."""
    return ((top - top % by) / by).cast(SCORE)


def propagate(seeds: DataFrame, edges: DataFrame, rounds: int = ROUNDS, damping: int = DAMPING) -> DataFrame:
    """(kind, host, score) after ``rounds`` steps of personalised PageRank from (kind, host, seed) over
    (kind, source, target); kinds do not mix. What reaches a host without edges ends there."""
    degree = edges.groupBy("kind", "source").agg(F.count("*").alias("degree"))
    out = common.keep(edges.join(degree, ["kind", "source"]))
    seeds = common.keep(seeds.withColumn("seed", F.col("seed").cast(SCORE)))
    scores = seeds.select("kind", "host", F.col("seed").alias("score"))
    back = seeds.select("kind", "host", whole_part(F.col("seed") * (100 - damping), F.lit(100)).alias("score"))
    step = whole_part(F.col("score") * damping, 100 * F.col("degree")).alias("score")
    for turn in range(1, rounds + 1):
        spread = out.join(scores.withColumnRenamed("host", "source"), ["kind", "source"]).select(
            "kind", F.col("target").alias("host"), step
        )
        scores = spread.unionByName(back).groupBy("kind", "host").agg(F.sum("score").cast(SCORE).alias("score"))
        if turn % CUT_EVERY == 0 and turn < rounds:
            scores = common.keep(scores)
    return scores


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, rounds: int = ROUNDS, damping: int = DAMPING
) -> DataFrame:
    """Every page with host, path, rule, verdict and its host's trust and distrust."""
    ruled = apply_rules(pages, rules)
    hosts = common.keep(
        ruled.where("host <> ''")
        .groupBy("host")
        .agg(
            F.count(F.when(F.col("verdict") == "allow", 1)).alias("allowed"),
            F.count(F.when(F.col("verdict") == "block", 1)).alias("blocked"),
        )
    )
    links = common.keep(linked(pages, rules))
    starts = common.keep(seed_hosts(ruled, links, hosts))
    total = starts.agg(F.sum("allowed").alias("allow"), F.sum("blocked").alias("block")).first()
    pairs = host_edges(links, hosts)
    edges = pairs.withColumn("kind", F.lit("allow")).unionByName(
        pairs.select(F.col("target").alias("source"), F.col("source").alias("target"), F.lit("block").alias("kind"))
    )
    seeds = None
    for kind, count in (("allow", "allowed"), ("block", "blocked")):
        part = UNIT // max(1, total[kind] or 0)
        made = starts.where(F.col(count) > 0).select(
            F.lit(kind).alias("kind"), "host", (F.col(count) * F.lit(Decimal(part))).cast(SCORE).alias("seed")
        )
        seeds = made if seeds is None else seeds.unionByName(made)
    scores = propagate(seeds, edges, rounds, damping)
    of_host = scores.groupBy("host").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), F.lit(0)).cast(SCORE).alias(name)
            for k, name in (("allow", "trust"), ("block", "distrust"))
        ]
    )
    named = ruled.join(of_host, "host", "left")
    trust, distrust = (F.coalesce(F.col(c), F.lit(0)).cast(SCORE) for c in ("trust", "distrust"))
    own = F.when(distrust > trust, "block").otherwise("allow")
    return named.select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", own).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"),
    )
