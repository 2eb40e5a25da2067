"""URL filters: rules first, then trust and distrust spread over host links."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platelake.llm.text import ascii_lower, whole
from platelake.session import cut_lineage, drop_scratch

DAMPING = 0.6
ROUNDS = 8
# A host is blocked if distrust makes up this share of its trust and distrust.
# Sharing among many linkers and further steps make both small, so they are
# held against each other and not against a fixed amount.
SHARE = 0.5
# Distrust below this is none: it is what seven steps leave of a blocked host.
FLOOR = 0.02
# A quoted value ends with its own quote sign, one without at white space.
LINK = (r"(?i)\b(?:href|src)[ \t\n\f\r]*=[ \t\n\f\r]*"
        r"""(?:"[^"<>]*"|'[^'<>]*'|[^ \t\n\f\r"'<>]+)""")
# What stands ahead of the value.
ATTRIBUTE = r"^[^=]*=[ \t\n\f\r]*"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty if there is no ``://``."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(
        F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _longest(rules: Sequence[Rule], host: Column, path: Column, value) -> Column:
    """``value`` of the longest rule that fits. The rule list is a parameter
    of the job, so it is part of the expression."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(
            path, F.lit(rule.path))
        out = F.when(fits, F.lit(value(rule))).otherwise(out)
    return out


def judged(pages: DataFrame, rules: Sequence[Rule] = RULES, url: str = "url",
           row: str = "row") -> DataFrame:
    """Each row as a struct with ``host``, ``path``, ``rule`` and
    ``rule_verdict`` (null where no rule fits)."""
    parts = pages.select(
        F.struct("*").alias(row), url_host(F.col(url)).alias("host"),
        url_path(F.col(url)).alias("path"))
    return parts.select(
        row, "host", "path",
        _longest(rules, F.col("host"), F.col("path"), lambda r: r.name).alias("rule"),
        _longest(rules, F.col("host"), F.col("path"), lambda r: r.verdict).alias("rule_verdict"))


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``src``, ``dst`` and ``n``: how many links lead from host to host.

    Links without a host stay on the page's own and are left out, as are all
    links of a host to itself. Links to hosts without any page count.
    """
    host = url_host(F.col(url))
    found = F.regexp_extract_all(whole(html), F.lit(LINK), F.lit(0))
    links = pages.select(host.alias("src"), F.explode(found).alias("found"))
    value = F.regexp_replace("found", ATTRIBUTE, "")
    quoted = F.startswith(value, F.lit('"')) | F.startswith(value, F.lit("'"))
    links = links.select("src", F.when(
        quoted, F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value).alias("to"))
    to = F.when(F.startswith("to", F.lit("//")), url_host(F.concat(F.lit(":"), F.col("to"))))
    to = to.when(F.col("to").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), url_host(F.col("to")))
    return (
        links.select("src", to.otherwise(F.lit("")).alias("dst"))
        .where("src <> '' and dst <> '' and src <> dst")
        .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    )


def seeds(judged_pages: DataFrame) -> DataFrame:
    """``host`` with ``trusted`` and ``blocked``: the shares of its pages that
    a rule allows or blocks."""
    verdict = F.col("rule_verdict")
    return judged_pages.where("host <> ''").groupBy("host").agg(
        F.avg(F.when(verdict == "allow", 1.0).otherwise(0.0)).alias("trusted"),
        F.avg(F.when(verdict == "block", 1.0).otherwise(0.0)).alias("blocked"))


def _spread(edges: DataFrame, seed: DataFrame, rounds: int, damping: float) -> DataFrame:
    """Personalised PageRank: ``host``, ``score``. ``edges`` (src, dst, share)
    share out 1 per source; ``seed`` (host, weight) must hold every host.

    Scores are not scaled to sum to one: a host keeps its whole weight and
    passes on ``damping`` of its score, so an isolated one scores its weight.
    Every few rounds the scores become a written table, which keeps plans
    short and lost executors cheap.
    """
    spark, paths = edges.sparkSession, []
    score = seed.select("host", F.col("weight").alias("score"))
    for k in range(rounds):
        sent = edges.join(score, edges["src"] == score["host"]).groupBy("dst").agg(
            F.sum(F.col("share") * F.col("score")).alias("got"))
        score = seed.join(sent, seed["host"] == sent["dst"], "left").select(
            "host", (F.col("weight") + damping * F.coalesce("got", F.lit(0.0))).alias("score"))
        if k % 4 == 3 or k == rounds - 1:
            score, path = cut_lineage(score, "scores", with_path=True)
            paths.append(path)
    for path in paths[:-1]:
        drop_scratch(spark, path)
    return score


def propagate(
    links: DataFrame, seed_hosts: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING,
) -> DataFrame:
    """``host``, ``trust`` and ``distrust`` of every host in links or seeds.

    Trust flows along links from trusted hosts; distrust flows back along them
    from blocked ones, so whoever links to a blocked host takes a part of it.
    Links out of (or, for distrust, into) a host share by their number.
    """
    links = cut_lineage(links, "links")
    if links.isEmpty():
        return seed_hosts.select(
            "host", F.col("trusted").alias("trust"), F.col("blocked").alias("distrust"))
    ends = links.select(F.col("src").alias("host")).union(links.select("dst"))
    everyone = ends.union(seed_hosts.select("host")).distinct()
    weights = cut_lineage(everyone.join(seed_hosts, "host", "left").select(
        "host", F.coalesce("trusted", F.lit(0.0)).alias("trusted"),
        F.coalesce("blocked", F.lit(0.0)).alias("blocked")), "seeds")

    def shared(src: str, dst: str) -> DataFrame:
        total = links.groupBy(src).agg(F.sum("n").alias("total")).withColumnRenamed(src, "_from")
        return links.join(total, links[src] == total["_from"]).select(
            F.col(src).alias("src"), F.col(dst).alias("dst"),
            (F.col("n") / F.col("total")).alias("share"))

    trust = _spread(shared("src", "dst"), weights.select(
        "host", F.col("trusted").alias("weight")), rounds, damping)
    distrust = _spread(shared("dst", "src"), weights.select(
        "host", F.col("blocked").alias("weight")), rounds, damping)
    return trust.select("host", F.col("score").alias("trust")).join(
        distrust.select("host", F.col("score").alias("distrust")), "host")


def filter_urls(
    pages: DataFrame, rules: Sequence[Rule] = RULES, url: str = "url", html: str = "html",
    rounds: int = ROUNDS, damping: float = DAMPING, share: float = SHARE, floor: float = FLOOR,
    row: str = "row",
) -> DataFrame:
    """Each row as a struct with ``host``, ``path``, ``rule`` (null if none
    fits), ``verdict``, ``trust`` and ``distrust`` of its host.

    A rule's verdict stands. Elsewhere a page is blocked if its host has a
    distrust of ``floor`` at least, and distrust makes up ``share`` of trust and
    distrust: hosts that link to blocked ones, directly or by others, unless
    trusted hosts link to them as much; also hosts with blocked pages of their
    own and nothing that speaks for them. Null urls and urls without ``://``
    have no host, no scores and are allowed. Repeated rows and ids are judged
    alike, row by row. Pages of one host are counted before any shuffle and
    joined to its scores, never gathered.
    """
    marked = judged(pages, rules, url, row)
    # A table of its own: the pages of a hot host can then be split in the join.
    scores = cut_lineage(
        propagate(host_links(pages, url, html), seeds(marked), rounds, damping), "host-scores")
    scored = marked.join(scores, "host", "left")
    # Rounded, so that sums in another order give the same verdict on a tie.
    ahead = F.round(F.col("distrust") * (1 - share) - F.col("trust") * share, 9) >= 0
    own = F.when((F.round("distrust", 9) >= floor) & ahead, F.lit("block")).otherwise(F.lit("allow"))
    return scored.select(
        row, "host", "path", "rule", F.coalesce("rule_verdict", own).alias("verdict"),
        "trust", "distrust")
