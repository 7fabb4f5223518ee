"""URL filter: longest host and path rules, and for the rest a tree of path templates per host.

Paths become shapes (hexadecimal and digit runs of a segment generalised), and only counts of shapes go on: pages, allowed and
blocked ones. The tree grows level by level from the root of every host. A segment stays literal below a node if it has SUPPORT
pages and one page in RARE of the node's; all others share the wildcard ``*``, so a node has at most RARE + 1 branches. Branches
that follow each other in order of blocked share and don't differ, by chi-square tests of that share and of the share of
paths that end, are merged into one. A node of fewer than SUPPORT pages is not split. A template is rejected if its blocked share
among labelled pages, smoothed by two pages of either kind, is REJECT or more; without labels it is never rejected.

A level is a few map-side aggregates over shapes and joins to tables of nodes and branches. No host is gathered in one task.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urlsieve.llm.narrow import join_narrow
from urlsieve.operators.joins import spread_lookup
from urlsieve.session import stage_table

SUPPORT, RARE, REJECT = 8, 20, 0.8
#: Chi-square of one degree of freedom at five in a hundred.
SIMILAR = 3.841
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
Rules = list[tuple[str, str, str]]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def shape_of(path: Column) -> Column:
    """Segments that are not empty, joined by slashes, runs of 16 and more hexadecimal digits as {x}, of digits as {n}."""
    general = lambda s: F.regexp_replace(F.regexp_replace(s, "[0-9a-fA-F-]{16,}", "{x}"), "[0-9]+", "{n}")
    return F.array_join(F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), general), "/")


def longest_rule(host: Column, path: Column, rules: Rules) -> tuple[Column, Column]:
    """(rule as host and path, its verdict) of the longest of (host, path, verdict) that fits; nulls if none does.

    Of rules of equal length the first in order of text counts. The rules are a declaration and do not grow with the data.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for where, start, what in sorted(rules, key=lambda r: (len(r[0] + r[1]), [-ord(c) for c in r[0] + r[1]])):
        fits = ((host == where) | host.endswith("." + where)) & path.startswith(start)
        rule, verdict = F.when(fits, where + start).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def _similar(bad, good, ends, n):
    """Whether this row and the one before don't differ; counts as doubles, the same order of steps at every use."""
    def close(a, b, c, d):
        a, b, c, d = (x.cast("double") for x in (a, b, c, d))
        cross = a * d - b * c
        return (a + b + c + d) * cross * cross <= F.lit(SIMILAR) * (a + b) * (c + d) * (a + c) * (b + d)
    return lambda w: close(bad, F.lag(bad).over(w), good, F.lag(good).over(w)) & close(ends, F.lag(ends).over(w), n - ends, (F.lag(n).over(w) - F.lag(ends).over(w)))


def merge_branches(branches: DataFrame) -> DataFrame:
    """(host, node, branch, name) of (host, node, branch, n, good, bad, ends): merged branches share the name ``{a,b}``."""
    share = (F.col("bad") + 2) / (F.col("good") + F.col("bad") + 4)
    rows = branches.withColumn("share", share).withColumn("labelled", F.col("good") + F.col("bad") > 0)
    w = Window.partitionBy("host", "node", "labelled").orderBy("share", "branch")
    same = _similar(F.col("bad"), F.col("good"), F.col("ends"), F.col("n"))(w)
    rows = rows.withColumn("fresh", F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1)).withColumn("class", F.sum("fresh").over(w))
    names = F.array_sort(F.collect_list("branch").over(Window.partitionBy("host", "node", "labelled", "class")))
    return rows.select("host", "node", "branch", F.when(F.size(names) == 1, F.col("branch")).otherwise(
        F.concat(F.lit("{"), F.array_join(names, ","), F.lit("}"))).alias("name"))


def grow_tree(shapes: DataFrame) -> DataFrame:
    """(host, shape, good, bad, template) of (host, shape, n, good, bad), unique on host and shape."""
    open_, done, depth = stage_table(shapes.select("host", "shape", "n", "good", "bad", F.lit("").alias("node")), "tree"), [], 1
    while True:
        parts = F.split("shape", "/")
        kids = open_.withColumn("child", F.coalesce(F.get(parts, depth - 1), F.lit(""))).withColumn("ending", F.when(F.size(parts) == depth, F.col("n")).otherwise(0))
        sums = [F.sum(c).alias(c) for c in ("n", "good", "bad")]
        children = stage_table(kids.groupBy("host", "node", "child").agg(*sums, F.sum("ending").alias("ends")), "tree-children")
        nodes = children.groupBy("host", "node").agg(F.sum("n").alias("total"))
        wide = join_narrow(children.filter("child <> ''"), nodes.filter(F.col("total") >= SUPPORT), ["host", "node"])
        literal = (F.col("n") >= SUPPORT) & (F.col("n") * RARE >= F.col("total"))
        branches = wide.withColumn("branch", F.when(literal, F.col("child")).otherwise("*")).groupBy("host", "node", "branch").agg(*sums, F.sum("ends").alias("ends"))
        names = stage_table(merge_branches(branches), "tree-branches")
        kids = join_narrow(kids.drop("ending"), names.select("host", "node", F.col("branch").alias("child"), "name"), ["host", "node", "child"], "left")
        rest = nodes.join(names.filter("branch = '*'").select("host", "node", F.col("name").alias("other")), ["host", "node"], "left")
        kids = join_narrow(kids, rest, ["host", "node"], "left")
        small, end = F.col("total") < SUPPORT, F.col("child") == ""
        template = F.when(small, F.concat("node", F.lit("/**"))).when(end, F.when(F.col("node") == "", "/").otherwise(F.col("node")))
        below = F.concat("node", F.lit("/"), F.coalesce("name", "other"))
        level = stage_table(kids.select("host", "shape", "n", "good", "bad", template.alias("template"), below.alias("below")), "tree")
        done.append(level.filter("template is not null").select("host", "shape", "good", "bad", "template"))
        open_ = level.filter("template is null").select("host", "shape", "n", "good", "bad", F.col("below").alias("node"))
        depth += 1
        if open_.isEmpty():
            return functools.reduce(DataFrame.unionAll, done)


def judge_urls(pages: DataFrame, rules: Rules, label: str | None = None) -> DataFrame:
    """(page_id, host, path, rule, template, purity, verdict), one row per row of ``pages`` (page_id of any type, url).

    ``label``: name of a column with ``allow`` or ``block`` for pages that are labelled; by default pages are labelled by the rules.
    ``verdict`` is the rule's, or the template's where no rule fits. ``purity``: smoothed share of blocked pages among the labelled
    ones of the template, null without any. A null url, or one without ``://``, has an empty host and path. Repeated rows and null
    identifiers are judged each on its own; other columns are left out, so names cannot clash. An empty table gives no rows.
    """
    url = F.col("url")
    named = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), *([F.col(label).alias("label")] if label else []))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    named = named.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"), (F.col("label") if label else verdict).alias("label"),
                         shape_of(F.col("path")).alias("shape"))
    count = lambda what: F.sum(F.when(F.col("label") == what, 1).otherwise(0)).alias("good" if what == "allow" else "bad")
    shapes = stage_table(named.groupBy("host", "shape").agg(F.count(F.lit(1)).alias("n"), count("allow"), count("block")), "shapes")
    placed = stage_table(grow_tree(shapes), "templates")
    sums = placed.groupBy("host", "template").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    purity = F.when(F.col("good") + F.col("bad") > 0, (F.col("bad") + 2) / (F.col("good") + F.col("bad") + 4))
    judged = join_narrow(placed.drop("good", "bad"), sums.select("host", "template", purity.alias("purity")), ["host", "template"])
    key = F.concat("host", F.lit(" "), "shape")
    found = spread_lookup(named.withColumn("key", key).withColumn("row", F.monotonically_increasing_id()), judged.select(key.alias("key"), "template", "purity"),
                          "key", "row", shapes.select(key.alias("key"), F.col("n").alias("count")))
    own = F.when(F.coalesce(F.col("purity") >= REJECT, F.lit(False)), "block").otherwise("allow")
    return found.select("page_id", "host", "path", "rule", "template", "purity", F.coalesce("ruled", own).alias("verdict"))
