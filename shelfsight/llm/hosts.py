"""URL filter: host and path rules, and trust carried over the links between hosts.

DataFrame functions only. Pages that a rule fits are seeds: allowed ones give their host
trust, blocked ones distrust. Trust follows links as personalised PageRank, distrust runs
against them, so that hosts linking to blocked ones lose standing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfsight.llm.staging import discard, stage

DAMPING = 0.85
#: The rounds end when all ranks together change by less than this share of the seeds.
SETTLED = 1e-6
#: A host is blocked if its share of all distrust is above this many times its share of all
#: trust, and above this part of the mean share of the hosts that distrust reaches.
RATIO = 1.0
FLOOR = 1e-3


@dataclass(frozen=True)
class Rule:
    """``text`` is a host and the beginning of a path, as ``example.org/en/``."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


RULES = (
    Rule("org/", "allow"),
    Rule("example.org/es/", "block"),
    Rule("example.org/en/1", "block"),
    Rule("com/fr/", "allow"),
    Rule("com/de/", "block"),
)

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    """What stands between the first :// and /, ?, # or the end, A to Z lowered; else empty."""
    host = F.coalesce(F.regexp_extract(url, _URL, 1), F.lit(""))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule] = RULES) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; nulls if none does.

    A rule fits its host and all its subdomains if the path begins with the rule's. Of rules
    of one length the first listed wins.
    """
    longest = sorted(rules, key=lambda r: -len(r.text))
    none = F.struct(
        F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict")
    )

    def branch(rest: Column, rule: Rule) -> Column:
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        return F.when(
            fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        ).otherwise(rest)

    return reduce(branch, reversed(longest), none)


def host_links(pages: DataFrame) -> DataFrame:
    """(source, target) of every pair of different hosts with a link from one to the other."""
    links = pages.select(
        host_of(F.col("url")).alias("source"),
        F.explode(F.regexp_extract_all("html", F.lit(_HREF), F.lit(1))).alias("href"),
    )
    absolute = F.when(F.col("href").startswith("//"), F.concat(F.lit("http:"), "href")).otherwise(
        F.col("href")
    )
    return (
        links.select("source", host_of(absolute).alias("target"))
        .where("source <> '' and target <> '' and source <> target")
        .distinct()
    )


def standing(
    seeds: DataFrame, links: DataFrame, damping: float = DAMPING, rounds: int | None = None
) -> DataFrame:
    """(host, trust, distrust) of every host that a seed reaches.

    ``seeds`` has host, allowed and blocked (pages, or shares of them). A round gives a host 1 - damping of its
    own seed and damping of what its neighbours pass on in equal shares. Rounds go on until
    the ranks settle, which damping below 1 sees to however far a host is from a seed; a
    caller may ask for fewer. The ranks of a round go to the shared folder.
    """
    forward = links.select(F.lit("trust").alias("kind"), F.col("source").alias("a"), F.col("target").alias("b"))
    backward = links.select(F.lit("distrust").alias("kind"), F.col("target").alias("a"), F.col("source").alias("b"))
    arrows = forward.union(backward)
    share = arrows.groupBy("kind", "a").agg((F.lit(1.0) / F.count("*")).alias("share"))
    arrows = stage(arrows.join(share, ["kind", "a"]))
    sown = seeds.select(
        "host",
        F.explode(
            F.create_map(
                F.lit("trust"), F.col("allowed").cast("double"),
                F.lit("distrust"), F.col("blocked").cast("double"),
            )
        ).alias("kind", "seed"),
    ).where("seed > 0")
    sown = stage(sown)
    total = sown.agg(F.sum("seed")).first()[0] or 0.0
    ranks = stage(sown.select("kind", "host", (F.col("seed") * (1 - damping)).alias("rank")))
    for _ in count() if rounds is None else range(rounds):
        passed = (
            arrows.join(ranks.withColumnRenamed("host", "a"), ["kind", "a"])
            .groupBy("kind", F.col("b").alias("host"))
            .agg((F.sum(F.col("rank") * F.col("share")) * damping).alias("rank"))
        )
        own = sown.select("kind", "host", (F.col("seed") * (1 - damping)).alias("rank"))
        after = stage(own.union(passed).groupBy("kind", "host").agg(F.sum("rank").alias("rank")))
        change = (
            after.select("kind", "host", "rank")
            .union(ranks.select("kind", "host", -F.col("rank")))
            .groupBy("kind", "host")
            .agg(F.sum("rank").alias("change"))
            .agg(F.sum(F.abs("change")))
            .first()[0]
            or 0.0
        )
        discard(ranks)
        ranks = after
        if change <= SETTLED * total:
            break
    discard(arrows, sown)
    return ranks.groupBy("host").agg(
        *(
            F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("rank"))), F.lit(0.0)).alias(k)
            for k in ("trust", "distrust")
        )
    )


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, trust and distrust of its host.

    The allowed pages share a trust of 1, the blocked ones a distrust of 1, so that neither
    outweighs the other by its number. The verdict is that of the longest fitting rule.
    Without one a page is blocked if its host's distrust is above RATIO times its trust and
    above FLOOR times the mean of hosts with distrust, else allowed; so hosts that no seed
    reaches, and pages without a host, are allowed. Null urls and urls without
    :// have an empty host and path. Null html has no links; repeated rows count as pages
    each and come out as often. An empty table gives an empty table; further columns are not
    read.
    """
    ruled = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    ).withColumn("__rule", matching_rule(F.col("host"), F.col("path"), rules))
    seeds = (
        ruled.where("host <> '' and __rule.verdict is not null")
        .groupBy("host")
        .agg(
            F.count_if(F.col("__rule.verdict") == "allow").alias("allowed"),
            F.count_if(F.col("__rule.verdict") == "block").alias("blocked"),
        )
    )
    seeds = stage(seeds)
    allowed, blocked = seeds.agg(F.sum("allowed"), F.sum("blocked")).first()
    shares = seeds.select(
        "host",
        (F.col("allowed") / F.lit(float(allowed or 1))).alias("allowed"),
        (F.col("blocked") / F.lit(float(blocked or 1))).alias("blocked"),
    )
    ranks = standing(shares, host_links(pages.select("url", "html")))
    reached, whole = ranks.where("distrust > 0").agg(F.count("*"), F.sum("distrust")).first()
    floor = FLOOR * (whole or 0.0) / max(reached, 1)
    discard(seeds)
    trust, distrust = (F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust"))
    method = F.when((distrust > trust * RATIO) & (distrust > floor), "block").otherwise("allow")
    return ruled.join(ranks, "host", "left").select(
        "page_id",
        "host",
        "path",
        F.col("__rule.rule").alias("rule"),
        F.coalesce("__rule.verdict", method).alias("verdict"),
        F.round(trust, 12).alias("trust"),
        F.round(distrust, 12).alias("distrust"),
    )
