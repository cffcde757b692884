"""Which pages to crawl or keep: rules by host and path, and trust spread over host links.

Pages that no rule covers are judged by their host. Trust starts at hosts with allowed pages and
follows links; distrust starts at hosts with blocked pages and follows links backwards, to those
that link to them (personalised PageRank, both at once). DataFrame functions only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ringtrail.llm.rows import release, staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Up to the first blank, `>` or `#`: the host comes before any of them, quoted or not.
LINK = r'(?i)<a\s[^>]*?href\s*=\s*["\x27]?\s*([^"\x27\s>#]*)'
ABSOLUTE = "^([A-Za-z][A-Za-z0-9+.-]*:)?//"
#: Rounds between two tables of scores.
STEP = 4


@dataclass(frozen=True)
class Rule:
    verdict: str
    #: Host, then path from the first slash on.
    rule: str

    def fits(self, host: Column, path: Column) -> Column:
        own, slash, rest = self.rule.partition("/")
        return ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)


def _rest(url: Column) -> Column:
    """What follows the first `://`; NULL without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + F.lit(3), F.length(url)))


def host_of(url: Column) -> Column:
    found = F.regexp_extract(_rest(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _by_rule(rules: list[Rule], host: Column, path: Column, value: str) -> Column:
    found = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.rule)):
        found = F.when(rule.fits(host, path), F.lit(getattr(rule, value))).otherwise(found)
    return found


def host_links(pages: DataFrame) -> DataFrame:
    """src, dst, n: links between different hosts, counted; relative links stay on their host."""
    found = pages.select(
        F.col("host").alias("src"),
        F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("link"),
    )
    absolute = F.when(F.col("link").startswith("//"), F.concat(F.lit(":"), "link")).otherwise(
        F.col("link")
    )
    ends = found.where(F.col("link").rlike(ABSOLUTE)).select("src", host_of(absolute).alias("dst"))
    ends = ends.where((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
    return ends.groupBy("src", "dst").agg(F.count("*").alias("n"))


def spread(seeds: DataFrame, links: DataFrame, rest: float, damping: float) -> DataFrame:
    """host, trust, distrust from seeds of the same columns, each less than `rest` below its limit.

    Rounds go on until all that is still under way, of all hosts together, is below `rest`. A host
    passes `damping` of its trust to those it links to, by number of links, and of its distrust to
    those that link to it. What a host without links would pass is lost.
    """
    ways = links.select(F.lit("trust").alias("kind"), "src", "dst", "n").unionByName(
        links.select(
            F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "n"
        )
    )
    total = ways.groupBy("kind", "src").agg(F.sum("n").alias("total"))
    ways = staged(
        ways.join(total, ["kind", "src"]).select(
            "kind", "src", "dst", (F.lit(damping) * F.col("n") / F.col("total")).alias("part")
        ),
        "links",
    )
    start = staged(
        seeds.select(
            F.col("host").alias("src"),
            F.explode(F.create_map(F.lit("trust"), "trust", F.lit("distrust"), "distrust")).alias(
                "kind", "score"
            ),
        ).where("score > 0"),
        "seeds",
    )
    scores = start
    total = before = start.agg(F.sum("score")).first()[0] or 0.0
    if total and not ways.isEmpty():
        # After n rounds at most total * damping ** (n + 1) / (1 - damping) is under way.
        most = math.ceil(math.log(rest * (1 - damping) / total) / math.log(damping))
        shrink = damping**STEP
        for done in range(1, max(most, 1) + 1):
            passed = scores.join(ways, ["kind", "src"]).select(
                F.col("dst").alias("src"), "kind", (F.col("score") * F.col("part")).alias("score")
            )
            scores = start.unionByName(passed).groupBy("kind", "src").agg(F.sum("score").alias("score"))
            if done % STEP == 0:
                scores = staged(scores, "scores")
                if done > STEP:
                    release(last)
                last = scores
                now = scores.agg(F.sum("score")).first()[0]
                # What was added since the last table shrinks by this factor, table by table.
                if (now - before) * shrink / (1 - shrink) < rest:
                    break
                before = now
    of = lambda kind: F.round(F.sum(F.when(F.col("kind") == kind, F.col("score")).otherwise(0.0)), 6)
    return scores.groupBy(F.col("src").alias("host")).agg(
        of("trust").alias("trust"), of("distrust").alias("distrust")
    )


def judge(
    pages: DataFrame,
    rules: list[Rule],
    rest: float = 1e-9,
    damping: float = 0.85,
    least_distrust: float = 0.05,
) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust for every row.

    The longest rule that fits decides; of equally long ones the first in the list. Other pages are
    blocked if their host's distrust is at least `least_distrust` and above its trust. A host's own
    seeds are the shares of its pages that rules allow and block. Trust spreads until every host's
    score is within `rest` of its limit, so only closer ties can fall either way. Without url or `://` host and
    path are empty, and such a page is allowed. NULL html has no links. Only page_id, url and html
    are read; repeated rows stay repeated. `rules` are a short list.
    """
    found = pages.select("page_id", "url", "html").select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html"
    )
    host, path = F.col("host"), F.col("path")
    found = found.withColumns(
        {"rule": _by_rule(rules, host, path, "rule"), "decided": _by_rule(rules, host, path, "verdict")}
    )
    share = lambda verdict: F.avg(F.when(F.col("decided") == verdict, 1.0).otherwise(0.0))
    seeds = (
        found.where("host <> ''")
        .groupBy("host")
        .agg(share("allow").alias("trust"), share("block").alias("distrust"))
    )
    scores = spread(seeds, host_links(found), rest, damping)
    known = found.drop("html").join(scores, "host", "left")
    trust, distrust = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("trust", "distrust"))
    by_host = F.when((distrust >= least_distrust) & (distrust > trust), "block").otherwise("allow")
    return known.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("decided", by_host).alias("verdict"),
        trust.alias("trust"),
        distrust.alias("distrust"),
    )
