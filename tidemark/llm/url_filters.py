"""URL filters: rules on host and path, and trust propagated over the link graph for all other pages.

Hosts whose pages a rule allows are trusted seeds, hosts whose pages a rule blocks are distrusted ones, each
to the share of their pages the rules cover.  Trust is a personalised PageRank along links between hosts,
distrust one against them.  A page no rule fits is judged by its host.  Everything is built-in expressions;
links are summed up per pair of hosts before anything iterates, and what each round moves is stored.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.chunks import _q
from tidemark.llm.storage import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""
DAMPING, MARGIN = 0.85, 0.25
TOLERANCE = 1e-6  # how far a host's trust and distrust may be from those of endless rounds
ROUNDS = 8  # of the SQL, which cannot go on until nothing changes


@dataclass(frozen=True)
class Rule:
    """Fits its host and all subdomains where the path begins with `path`."""

    verdict: str
    host: str
    path: str


RULES = (Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"))


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty if there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits (of equally long ones the first), or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(reversed(rules), key=lambda r: len(r.host + r.path)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        found = F.when(fits, F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def host_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst, n): links from one host to another, by pair of hosts."""
    links = pages.select(host_of(F.col(_q(url_col))).alias("src"),
                         F.explode(F.regexp_extract_all(F.col(_q(html_col)), F.lit(LINK), F.lit(1))).alias("dst"))
    links = links.select("src", F.translate("dst", UPPER, LOWER).alias("dst"))
    return links.filter("src <> '' AND src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(seeds: DataFrame, links: DataFrame, damping: float = DAMPING, rounds: int | None = None,
              tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust) from (host, trust, distrust) of seeds and (src, dst, n) of links.

    Personalised PageRank with restarts at the seeds, in units of 1 - damping, so that a seed without links
    keeps the value it was given.  A round moves on what the one before moved, and a host has the sum of all.
    All that a round moves is at most `damping` of the round before, so the sum over hosts bounds what is
    still to come at any of them; without `rounds` it goes on until that is `tolerance` or less.
    """
    if rounds is None and not 0 <= damping < 1:
        raise ValueError(f"rounds without end at damping {damping}")
    links = stored(links, "links")
    out, into = (links.groupBy(F.col(c).alias("host")).agg(F.sum("n").alias(s)) for c, s in (("src", "n_out"), ("dst", "n_in")))
    hosts = seeds.select("host").unionByName(links.select(F.col("src").alias("host"))).unionByName(links.select(F.col("dst").alias("host")))
    nodes = hosts.distinct().join(seeds.select("host", "trust", "distrust"), "host", "left")
    nodes = stored(nodes.na.fill(0.0, ["trust", "distrust"]), "hosts")
    flows = links.join(out, links["src"] == out["host"]).drop("host").join(into, F.col("dst") == into["host"]).drop("host")
    forward = flows.select(F.col("src").alias("from"), F.col("dst").alias("to"), (F.col("n") / F.col("n_out")).alias("a"), F.lit(0.0).alias("b"))
    back = flows.select(F.col("dst").alias("from"), F.col("src").alias("to"), F.lit(0.0).alias("a"), (F.col("n") / F.col("n_in")).alias("b"))
    flows = stored(forward.unionByName(back), "flows")
    moves = "trust > 0 OR distrust > 0"
    moved, parts, done = nodes.filter(moves), [nodes], 0
    while done != rounds:
        moved = stored(flows.join(moved, flows["from"] == moved["host"]).groupBy(F.col("to").alias("host")).agg(
            (damping * F.sum(F.col("trust") * F.col("a"))).alias("trust"),
            (damping * F.sum(F.col("distrust") * F.col("b"))).alias("distrust")).filter(moves), "moved")
        done += 1
        parts.append(moved)
        if len(parts) > 16:
            parts = [stored(_summed(parts), "ranks")]
        if rounds is None:
            left = moved.agg(F.greatest(F.sum("trust"), F.sum("distrust")).alias("left")).first()["left"] or 0.0
            if left * damping / (1 - damping) <= tolerance:
                break
    return _summed(parts)


def _summed(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))


def url_filter(pages: DataFrame, rules: Sequence[Rule] = RULES, page_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               damping: float = DAMPING, rounds: int | None = None, margin: float = MARGIN) -> DataFrame:
    """page_id, host, path, rule (of the longest rule that fits, or null), verdict (`allow` or `block`), trust and
    distrust (of the host), one row per row of `pages`.

    Without a rule a page is blocked if its host's distrust is `margin` or more above its trust.

    Nulls: a null url, or one without `://`, has an empty host and path, fits no rule and is allowed; null
    html has no links; null ids are pages like others.  Repeated rows are judged each, and count for their
    host each.  Of equally long rules that fit the first one counts.  Empty tables give no rows.  Texts are
    searched whole.  The rules are a list in the plan, so they should be some hundreds at most.
    """
    url = F.col(_q(url_col)).cast("string")
    judged = pages.select(F.col(_q(page_col)).alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"))
    judged = judged.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    by_rule = F.col("found.verdict")
    seeds = judged.filter("host <> ''").groupBy("host").agg(
        (F.count_if(by_rule == "allow") / F.count("*")).alias("trust"), (F.count_if(by_rule == "block") / F.count("*")).alias("distrust"))
    ranks = propagate(seeds, host_links(pages, url_col, html_col), damping, rounds).withColumnRenamed("host", "of")
    rows = judged.join(ranks, F.col("host") == F.col("of"), "left").drop("of")
    zero = F.lit(0.0)
    blocked = F.coalesce("distrust", zero) - F.coalesce("trust", zero) >= margin
    return rows.select("page_id", "host", "path", F.col("found.rule").alias("rule"),
                       F.coalesce(by_rule, F.when(blocked, "block").otherwise("allow")).alias("verdict"),
                       F.coalesce("trust", zero).alias("trust"), F.coalesce("distrust", zero).alias("distrust"))
