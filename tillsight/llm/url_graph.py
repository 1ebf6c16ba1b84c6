"""URL filters: rules first, then trust and distrust propagated over host links.

Host edges come from the absolute links of the pages' html. Seeds come from the
rules: a host's trusted (blocked) share is the share of its pages that a rule
allows (blocks); a host without pages here is seeded by the links to it in the same way. Trust is a personalised PageRank from the trusted seeds along
the links; distrust is one from the blocked seeds against them, so hosts that link
to blocked hosts are distrusted. A page without a rule is blocked when its
host's distrust exceeds its trust by more than half of what one fully blocked
seed has by itself. Rounds go on until no host's rank can change by more than ``SMALL`` of that.

All of it is DataFrame functions. Links are counted per pair of hosts before any
shuffle, so a host with very many pages is a few rows.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no
rule and is allowed; null or empty html has no links; a link without a path means ``/``; repeated rows are judged one by
one, and each counts as a page of its host; other columns are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, ascii_lower, written

DAMPING = 0.85
#: A page without a rule is blocked above it.
THRESHOLD = (1 - DAMPING) / 2
#: Share of the threshold that a rank may still be off, and rounds that are never needed (0.85 ** 400 is under 1e-28).
SMALL, MOST_ROUNDS = 1e-6, 400
_LINK = r"""(?i)(?:href|src|action)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)([^?#"'\s<>]*)"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host after the first ``://``, A-Z lower-cased, and the path up to ``?`` or ``#``."""
    host = ascii_lower(F.regexp_extract(url, "://([^/?#]*)", 1))
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, rule_host + rule_path).otherwise(rule)
        verdict = F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame, rules: list[tuple[str, str, str]] = ()) -> DataFrame:
    """(src, dst, n, good, bad) of links between different hosts: links, and those that a rule allows and blocks."""
    links = pages.where(F.col("html").contains("//") & (F.col("host") != "")).select("host", F.explode(F.regexp_extract_all("html", F.lit(_LINK), F.lit(0))).alias("link"))
    links = links.select(F.col("host").alias("src"), ascii_lower(F.regexp_extract("link", _LINK, 1)).alias("dst"), F.regexp_extract("link", _LINK, 2).alias("path")).where("src <> dst")
    _, verdict = fitting_rule(F.col("dst"), F.when(F.col("path") == "", "/").otherwise(F.col("path")), list(rules))
    return (links.withColumn("verdict", verdict).groupBy("src", "dst")
            .agg(F.count("*").alias("n"), F.count_if(F.col("verdict") == "allow").alias("good"), F.count_if(F.col("verdict") == "block").alias("bad")))


def propagate(seeds: DataFrame, edges: DataFrame, most_rounds: int = MOST_ROUNDS) -> DataFrame:
    """(host, rank): ``rank = (1 - DAMPING) * seed + DAMPING * sum of what neighbours pass on``.

    ``seeds`` has every host once; ``edges`` (src, dst, share) with shares of a source that sum to 1.
    Each round only passes on what the last one added (``new``). What all later rounds can
    add, to all hosts together and so to any, is at most ``sum(new) * DAMPING / (1 - DAMPING)``.
    """
    rank = seeds.select("host", ((1 - DAMPING) * F.col("seed")).alias("rank"), ((1 - DAMPING) * F.col("seed")).alias("new"))
    if not edges.take(1):
        return rank.drop("new")
    for _ in range(most_rounds):
        passed = (edges.join(rank.where("new > 0").select("host", "new"), F.col("src") == F.col("host"))
                  .groupBy("dst").agg((DAMPING * F.sum(F.col("new") * F.col("share"))).alias("got")))
        got = F.coalesce("got", F.lit(0.0))
        rank = rank.drop("new").join(passed, F.col("host") == F.col("dst"), "left").select("host", (F.col("rank") + got).alias("rank"), got.alias("new")).checkpoint()
        left = rank.agg(F.sum("new")).first()[0] or 0.0
        if left * DAMPING / (1 - DAMPING) <= SMALL * THRESHOLD:
            return rank.drop("new")
    raise RuntimeError(f"ranks still change after {most_rounds} rounds")


def judge(pages: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust for every row of ``pages`` (page_id, url, html)."""
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("by_rule", verdict)
    hosts = written(rows.where("host <> ''").groupBy("host").agg(
        F.count("*").alias("pages"), F.avg(F.when(F.col("by_rule") == "allow", 1.0).otherwise(0.0)).alias("good"),
        F.avg(F.when(F.col("by_rule") == "block", 1.0).otherwise(0.0)).alias("bad")), "hosts")
    edges = written(host_edges(pages.select(host.alias("host"), "html"), rules), "host-edges")
    # hosts without pages of their own are judged by the links to them
    named = (edges.groupBy(F.col("dst").alias("host")).agg(F.sum("n").alias("pages"), (F.sum("good") / F.sum("n")).alias("good"), (F.sum("bad") / F.sum("n")).alias("bad"))
             .join(hosts.select("host"), "host", "left_anti"))
    hosts = hosts.unionByName(named)

    def shares(src: str, dst: str) -> DataFrame:
        total = edges.groupBy(F.col(src).alias("s")).agg(F.sum("n").alias("total"))
        return written(edges.join(total, F.col(src) == F.col("s")).select(F.col(src).alias("src"), F.col(dst).alias("dst"), (F.col("n") / F.col("total")).alias("share")), f"shares-{src}")

    trust = propagate(hosts.select("host", F.col("good").alias("seed")), shares("src", "dst")).withColumnRenamed("rank", "trust")
    distrust = propagate(hosts.select("host", F.col("bad").alias("seed")), shares("dst", "src")).withColumnRenamed("rank", "distrust")
    scores = written(trust.join(distrust, "host"), "host-scores")
    if scores.count() <= BROADCAST_ROWS:
        scores = F.broadcast(scores)
    bad = F.coalesce(F.col("distrust") - F.col("trust") > THRESHOLD, F.lit(False))
    return rows.join(scores, "host", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("by_rule", F.when(bad, "block").otherwise("allow")).alias("verdict"), "trust", "distrust")
