"""URL filters: rules by host and path, and trust carried along the links between hosts.

Hosts of pages that a rule allows are trusted seeds, hosts of pages that a rule blocks are
distrusted seeds. Personalised PageRank carries trust forward along host edges, the same walk on
reversed edges carries distrust back to those who link to blocked hosts. A host is blocked when its
distrust exceeds its trust; pages without a rule get their host's verdict.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obsvar.llm.ranges import fresh
from obsvar.session import materialise

DAMPING, CUT_EVERY = 0.85, 4
#: What ranks may lack, summed over all hosts: each round leaves at most ``DAMPING`` of what was lacking.
TOLERANCE = 1e-4
ROUNDS = math.ceil(math.log(TOLERANCE) / math.log(DAMPING))
#: Steps of one partition of the walk: a small graph is not spread over as many tasks as the pages.
STEPS = 200_000
#: Hosts up to this number are broadcast to the pages (some 60 bytes each); more meet in a shuffle.
BROADCAST_HOSTS = 100_000
#: Absolute and protocol-relative targets of links.
LINK = r"""(?:href|src)\s*=\s*["']?(?:https?:)?//([^/?#"'\s>]+)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


def host_of(url: str) -> Column:
    """Between the first ``://`` and ``/ ? #`` or the end, A-Z in lower case; else empty."""
    rest = F.expr(f"substring(`{url}`, locate('://', `{url}`) + 3)")
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), UPPER, LOWER)
    return F.when(F.col(url).contains("://"), host).otherwise("")


def path_of(url: str) -> Column:
    rest = F.expr(f"substring(`{url}`, locate('://', `{url}`) + 3)")
    return F.when(F.col(url).contains("://"), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)).otherwise("")


def first_rule(rules: Sequence[Rule], host: str = "host", path: str = "path") -> Column:
    """(rule, verdict) of the longest rule that fits host or a parent domain, and the path's start."""
    longest = sorted(rules, key=lambda r: (-len(r.host + r.path), r.host + r.path))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in reversed(longest):
        fits = (F.col(host) == rule.host) | F.col(host).endswith("." + rule.host)
        both = F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits & F.col(path).startswith(rule.path), both).otherwise(found)
    return found


def host_edges(pages: DataFrame, html: str = "html", host: str = "host") -> DataFrame:
    """(a, b, w): links from host to host counted by page, and domains with their parents.

    A host and its parent domain (down to two labels) are linked both ways with weight one, as one
    owner runs both.
    """
    targets = F.array_distinct(
        F.transform(F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1)), lambda x: F.translate(x, UPPER, LOWER))
    )
    links = pages.filter(F.col(html).contains("//")).select(F.col(host).alias("a"), F.explode(targets).alias("b"))
    links = links.filter("a <> '' and b <> '' and a <> b").groupBy("a", "b").agg(F.count("*").cast("double").alias("w"))
    links = materialise(links)
    hosts = pages.select(F.col(host).alias("h")).distinct().union(links.select("b")).filter("h <> ''").distinct()
    labels = F.split("h", r"\.")
    depth = F.size(labels)
    chain = hosts.filter(depth > 2).select(
        F.explode(
            F.transform(
                F.sequence(F.lit(1), depth - 2),
                lambda k: F.struct(
                    F.array_join(F.slice(labels, k, depth), ".").alias("a"), F.array_join(F.slice(labels, k + 1, depth), ".").alias("b")
                ),
            )
        ).alias("e")
    ).select("e.*").distinct()
    kin = chain.union(chain.select("b", "a")).withColumn("w", F.lit(1.0))
    return links.union(kin).groupBy("a", "b").agg(F.sum("w").alias("w"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust) after so many rounds, enough for ``TOLERANCE``; ``seeds`` has the two starting shares by host.

    A host passes on its trust by the weights of its links, and its distrust by the weights of the
    links that lead to it. What hosts without such links hold ends there. Ranks are rounded to 15
    digits, so that the order of sums does not show.
    """
    ahead = edges.groupBy("a").agg(F.sum("w").alias("out"))
    behind = edges.groupBy("b").agg(F.sum("w").alias("in"))
    zero = F.lit(0.0)
    forward = edges.join(ahead, "a").select("a", "b", (F.col("w") / F.col("out")).alias("t"), zero.alias("d"))
    backward = edges.join(behind, "b").select(F.col("b").alias("a"), F.col("a").alias("b"), zero.alias("t"), (F.col("w") / F.col("in")).alias("d"))
    steps = materialise(forward.union(backward).groupBy("a", "b").agg(F.sum("t").alias("t"), F.sum("d").alias("d")))
    parts = max(1, -(-steps.count() // STEPS))
    steps, seeds = steps.coalesce(parts), materialise(seeds.coalesce(parts))
    ranks = seeds
    start = seeds.select("host", (F.col("trust") * (1 - damping)).alias("trust"), (F.col("distrust") * (1 - damping)).alias("distrust"))
    for turn in range(rounds):
        moved = steps.join(ranks.withColumnRenamed("host", "a"), "a").select(
            F.col("b").alias("host"), (damping * F.col("t") * F.col("trust")).alias("trust"), (damping * F.col("d") * F.col("distrust")).alias("distrust")
        )
        total = start.union(moved).groupBy("host")
        ranks = total.agg(F.round(F.sum("trust"), 15).alias("trust"), F.round(F.sum("distrust"), 15).alias("distrust")).coalesce(parts)
        if turn % CUT_EVERY == CUT_EVERY - 1:
            ranks = materialise(ranks)
    return ranks


def judged(pages: DataFrame, rules: Sequence[Rule], url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` without ``html``, with host, path, rule and verdict (allow or block).

    A null url, or one without ``://``, has no host: no rule fits and nothing speaks against it, so
    it is allowed, like a host that no walk reaches, and one whose trust and distrust are equal.
    Repeated pages count as often as they are there. A null html has no links. Columns with the
    names of the new ones are replaced, all others stay. Without allowed or without blocked pages
    that side has no seeds and stays zero.
    """
    new = ("host", "path", "rule", "verdict")
    parts = pages.drop(*new).withColumn("host", host_of(url)).withColumn("path", path_of(url))
    found, gone = fresh("_rule", parts), fresh("_blocked", parts)
    ruled = parts.withColumn(found, first_rule(rules))
    narrow = ruled.select("host", F.col(f"{found}.verdict").alias("verdict"))
    count = narrow.filter("host <> '' and verdict is not null").groupBy("host").agg(
        F.count_if(F.col("verdict") == "allow").alias("good"), F.count_if(F.col("verdict") == "block").alias("bad")
    )
    count = materialise(count)
    good, bad = count.agg(F.sum("good"), F.sum("bad")).first()
    seeds = count.select("host", (F.col("good") / float(good or 1)).alias("trust"), (F.col("bad") / float(bad or 1)).alias("distrust"))
    ranks = propagate(host_edges(parts.select("host", html), html), seeds)
    blocked = materialise(ranks.filter("round(distrust - trust, 12) > 0").select(F.col("host").alias(gone)))
    small = F.broadcast if blocked.count() <= BROADCAST_HOSTS else (lambda df: df)
    joined = ruled.drop(html).join(small(blocked), F.col("host") == F.col(gone), "left")
    own = F.when(F.col(gone).isNotNull(), "block").otherwise("allow")
    verdict = F.coalesce(F.col(f"{found}.verdict"), own)
    return joined.withColumn("rule", F.col(f"{found}.rule")).withColumn("verdict", verdict).drop(found, gone)
