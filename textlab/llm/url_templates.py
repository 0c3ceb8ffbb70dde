"""URL filter: listed rules first, then a tree of path templates per host, in built-in functions only.

A rule has a host and the start of a path. It fits the host itself and all its subdomains; the longest fitting rule decides.
Urls that a rule decides are the labelled ones (block is bad, allow is good); the other urls are judged by their template.

The tree grows by levels over distinct (host, path). At a node of a host, a segment stays as it is if it holds a
share of the node's urls, or if it is no number and a share of all hosts has it at that level; any other segment is variable and becomes
a wildcard, `#n` for numbers (perhaps with an extension) and `#w` for all else. A `#` cannot come from a path. Segments below `depth` are one tail, `#t`.
Sibling branches with labelled urls are put in the order of their share of bad ones; neighbours whose shares do not differ
significantly (two proportions, `z` standard errors) are one branch. Its purity is the share of bad ones among its labelled urls,
smoothed by `strength` urls with the share of the same template over all hosts, which is smoothed by the share over all urls
in turn. A template with a purity above `limit` is rejected.

Null urls and those without `://` have an empty host and path, which is a template of its own. Repeated urls count once
and get the same verdict; a row given twice comes out twice. Rows without labels anywhere are judged by a share of one half, which
is not above the limit. Only the key and the url are read. Counts combine before they are shuffled, a hot host meets in joins alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from textlab.session import stage

_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
NUMBER = r"^[0-9]+(\.[A-Za-z0-9]+)?\z"


@dataclass(frozen=True)
class Rule:
    """`allow` or `block` for a host with its subdomains and all paths with this start."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


@dataclass(frozen=True)
class Growth:
    """How the tree grows, merges and judges."""

    depth: int = 6
    least_urls: int = 5
    least_percent: int = 1  # of the urls at the node, or of the hosts at the level
    least_hosts: int = 20
    z: float = 2.0
    strength: float = 10.0
    limit: float = 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _CAPITALS, _SMALL), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def ruled(rules: Sequence[Rule], host: Column, path: Column, value) -> Column:
    """`value` of the longest rule that fits; null if none does."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.name)):
        found = F.when(rule.fits(host, path), F.lit(value(rule))).otherwise(found)
    return found


def _segment(level: int) -> Column:
    return F.get(F.filter(F.split("path", "/"), lambda s: s != ""), F.lit(level))


def _grown(rows: DataFrame, level: int, growth: Growth) -> DataFrame:
    """Rows one level further down: the segment or its wildcard goes to the end of `template` and, merged, of `branch`."""
    rows = rows.withColumn("segment", _segment(level))
    inner = rows.filter("segment IS NOT NULL")
    counts = stage(inner.groupBy("host", "branch", "segment").agg(F.count(F.lit(1)).alias("n")), "url-segments")
    totals = counts.groupBy("host", "branch").agg(F.sum("n").alias("total"))
    hosts = counts.groupBy("host", "segment").agg(F.count(F.lit(1)).alias("n")).groupBy("segment").agg(F.count(F.lit(1)).alias("hosts"))
    all_hosts = counts.select("host").distinct().count()  # one number
    many = (F.col("hosts") >= growth.least_hosts) & (F.col("hosts") * 100 >= all_hosts * growth.least_percent) & ~F.col("segment").rlike(NUMBER)
    common = hosts.filter(many).select("segment", F.lit(True).alias("common"))
    frequent = (F.col("n") >= growth.least_urls) & (F.col("n") * 100 >= F.col("total") * growth.least_percent)
    named = counts.join(totals, ["host", "branch"]).join(common, "segment", "left")
    wildcard = F.when(F.col("segment").rlike(NUMBER), "#n").otherwise("#w")
    kept = named.filter(frequent | F.col("common")).select("host", "branch", "segment", F.lit(True).alias("literal"))
    rows = rows.join(kept, ["host", "branch", "segment"], "left")
    rows = rows.withColumn("child", F.when(F.col("literal"), F.col("segment")).when(F.col("segment").isNotNull(), wildcard))
    rows = stage(rows.select("host", "path", "bad", "template", "branch", "child"), "url-children")
    merged = stage(_merged_children(rows, growth), "url-branches")
    rows = rows.join(merged, ["host", "branch", "child"], "left")
    below = lambda parent, child: F.when(F.col("child").isNull(), F.col(parent)).otherwise(F.concat(parent, F.lit("/"), child))
    return rows.select("host", "path", "bad", below("template", F.col("child")).alias("template"), below("branch", F.coalesce("name", "child")).alias("branch"))


def _merged_children(rows: DataFrame, growth: Growth) -> DataFrame:
    """`(host, branch, child, name)`: one name for neighbours, by share, that do not differ significantly.

    A node has at most 100 / least_percent frequent children and the few that a share of all hosts has, so a window over them is small.
    """
    labelled = rows.filter("child IS NOT NULL AND bad IS NOT NULL")
    counts = labelled.groupBy("host", "branch", "child").agg(F.sum("bad").alias("b"), F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("host", "branch").orderBy("share", "child")
    shares = counts.withColumn("share", F.col("b") / F.col("n"))
    beside = shares.withColumns({"pb": F.lag("b").over(order), "pn": F.lag("n").over(order), "ps": F.lag("share").over(order)})
    pooled = (F.col("b") + F.col("pb")) / (F.col("n") + F.col("pn"))
    gap = F.col("share") - F.col("ps")
    differs = gap * gap > growth.z * growth.z * pooled * (1 - pooled) * (1 / F.col("n") + 1 / F.col("pn"))
    runs = beside.withColumn("differs", F.coalesce(differs.cast("int"), F.lit(0))).withColumn("run", F.sum("differs").over(order))
    inside = Window.partitionBy("host", "branch", "run")
    names = F.sort_array(F.collect_list("child").over(inside))
    name = F.when(F.size(names) > 1, F.concat(F.lit("#{"), F.array_join(names, "|"), F.lit("}"))).otherwise(F.col("child"))
    return runs.select("host", "branch", "child", name.alias("name"))


def templates(urls: DataFrame, growth: Growth = Growth()) -> DataFrame:
    """`(host, path, bad, template, branch)` of distinct `(host, path, bad)`; bad is 1, 0 or null for not labelled."""
    rows = stage(urls.select("host", "path", "bad", F.lit("").alias("template"), F.lit("").alias("branch")), "urls")
    deepest = rows.agg(F.max(F.size(F.filter(F.split("path", "/"), lambda s: s != "")))).first()[0] or 0
    for level in range(min(deepest, growth.depth)):
        rows = stage(_grown(rows, level, growth), "url-levels")
    if deepest > growth.depth:
        tail = lambda column: F.when(_segment(growth.depth).isNotNull(), F.concat(column, F.lit("/#t"))).otherwise(F.col(column)).alias(column)
        rows = rows.select("host", "path", "bad", tail("template"), tail("branch"))
    return rows


def purities(rows: DataFrame, growth: Growth = Growth()) -> DataFrame:
    """`(host, branch, template, purity)` of all templates of `templates`."""
    spread = rows.groupBy("host", "branch", "template").agg(F.coalesce(F.sum("bad"), F.lit(0)).alias("b"), F.count("bad").alias("n"))
    spread = stage(spread, "url-templates")
    everywhere = spread.agg(F.sum("b").alias("b"), F.sum("n").alias("n")).first()  # two numbers
    overall, strength = F.lit(((everywhere["b"] or 0) + 1) / ((everywhere["n"] or 0) + 2)), F.lit(growth.strength)
    by_template = spread.groupBy("template").agg(F.sum("b").alias("tb"), F.sum("n").alias("tn"))
    by_template = by_template.select("template", ((F.col("tb") + strength * overall) / (F.col("tn") + strength)).alias("prior"))
    by_branch = spread.groupBy("host", "branch").agg(F.sum("b").alias("bb"), F.sum("n").alias("bn"))
    both = spread.select("host", "branch", "template").join(by_branch, ["host", "branch"]).join(by_template, "template")
    return both.select("host", "branch", "template", ((F.col("bb") + strength * F.col("prior")) / (F.col("bn") + strength)).alias("purity"))


def judged(pages: DataFrame, rules: Sequence[Rule], growth: Growth = Growth(), key: str = "page_id", url: str = "url") -> DataFrame:
    """`(key, host, path, rule, verdict, template, purity)` of every row; the template is that of the merged tree."""
    host, path = host_and_path(F.col(f"`{url}`"))
    rows = pages.select(F.col(f"`{key}`").alias("key"), host.alias("host"), path.alias("path"))
    bad = F.when(F.col("verdict") == "block", 1).when(F.col("verdict") == "allow", 0)
    urls = rows.select("host", "path").distinct().withColumn("verdict", ruled(rules, F.col("host"), F.col("path"), lambda r: r.verdict))
    placed = templates(urls.select("host", "path", bad.alias("bad")), growth)
    pure = stage(purities(placed, growth), "url-purities")
    found = placed.select("host", "path", "branch", "template").join(pure, ["host", "branch", "template"]).select("host", "path", "branch", "purity")
    both = rows.join(stage(found, "url-verdicts"), ["host", "path"])
    own = F.when(F.col("purity") > growth.limit, "block").otherwise("allow")
    return both.select(
        F.col("key").alias(key),
        "host",
        "path",
        ruled(rules, F.col("host"), F.col("path"), lambda r: r.name).alias("rule"),
        F.coalesce(ruled(rules, F.col("host"), F.col("path"), lambda r: r.verdict), own).alias("verdict"),
        F.col("branch").alias("template"),
        F.round("purity", 6).alias("purity"),
    )
