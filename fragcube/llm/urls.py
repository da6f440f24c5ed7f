"""URL filters: fixed rules, and a tree of path templates per host.

The paths of a host form a tree.  Level by level, a segment becomes ``*`` where
it varies (it has a digit, or it is one of many rare siblings).  Branches whose pages are
distributed alike (how they go on, and which verdicts the rules give them) merge:
each is compared with the largest of its siblings, which gives ``+``, and else with
the largest of those in its own cell of distributions, which gives that one's name and ``+``.
Levels follow until every path is alone below its template; what is left of such a
path needs no siblings.  What remains is a small set of templates.  Pages that
a rule decides are the labelled ones: a template is rejected when the share of
blocked among its labelled pages, smoothed towards the blocked share of all its host's
pages (a half at most, so labels have to speak for it), is at least ``PURITY``.  Pages without a rule take the verdict of their template, and pages without
host are allowed.

Pages are counted per host and path before anything else is joined, so a host
with a third of all pages is a few rows, and the tree is handled with aggregates
and joins only.  A null or malformed URL has empty host and path and verdict
"allow".  Rows that repeat a ``page_id`` are judged one by one.  Only ``page_id``
and ``url`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fragcube.session import materialise, materialise_observed

#: Rules and their verdicts.
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
#: A segment varies if it has under one in so many pages of a node that has more children than this.
BRANCHES = 16
#: Greatest distance between the page distributions of branches that merge.
SIMILAR = 0.1
#: Steps of each share in a cell of distributions.
STEPS = 4
PURITY = 0.8
#: Labelled pages that the host's share counts for.
PRIOR = 5.0

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def located(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL; both empty if it is null or has no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^([^/?#]*)", 1), CAPITALS, CAPITALS.lower())
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, below = rule.split("/", 1)
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{below}")
        out = F.when(fits, rule).otherwise(out)
    return out


def _counts() -> list[Column]:
    return [F.sum(c).alias(c) for c in ("n", "blocked", "allowed")]


def level(paths: DataFrame, depth: int) -> DataFrame:
    """Generalise the segment at ``depth`` of every path and merge similar branches."""
    here = F.get("segments", F.lit(depth))
    deeper = F.get("segments", F.lit(depth + 1))
    rows = paths.withColumn("here", here)
    nodes = rows.filter("here is not null").groupBy("host", "template", "here").agg(*_counts())
    parents = nodes.groupBy("host", "template").agg(F.count(F.lit(1)).alias("children"), F.sum("n").alias("pages"))
    varies = F.col("here").rlike("[0-9]") | ((F.col("children") > BRANCHES) & (F.col("n") * BRANCHES < F.col("pages")))
    named = nodes.join(parents, ["host", "template"]).select("host", "template", "here", F.when(varies, "*").otherwise(F.col("here")).alias("name"))
    rows = rows.join(named, ["host", "template", "here"], "left")
    # what the pages of each branch are like: how they go on and what the rules say
    kind = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    branch = rows.filter("name is not null").groupBy("host", "template", "name").agg(
        F.sum("n").alias("n"), kind(deeper.isNull()).alias("ends"), kind(deeper.rlike("[0-9]")).alias("numbers"),
        F.sum("blocked").alias("blocked"), F.sum("allowed").alias("allowed"),
    )
    shares = F.array(*(F.col(c) / F.col("n") for c in ("ends", "numbers", "blocked", "allowed")))
    branch = branch.filter("name <> '*'").select("host", "template", "name", "n", shares.alias("shares"))
    branch = branch.withColumn("cell", F.transform("shares", lambda x: F.round(x * STEPS).cast("int")))
    biggest = lambda: F.max_by(F.struct("name", "shares"), F.struct("n", "name"))
    by_cell = branch.groupBy("host", "template", "cell").agg(biggest().alias("own"), F.count(F.lit(1)).alias("k"))
    of_all = branch.groupBy("host", "template").agg(biggest().alias("largest"), F.count(F.lit(1)).alias("literal"))
    # a branch of few pages is similar within what chance does to few pages
    apart = lambda c: F.aggregate(F.zip_with("shares", f"{c}.shares", lambda a, b: F.abs(a - b)), F.lit(0.0), lambda s, d: s + d)
    near = lambda c: (apart(c) <= SIMILAR + 1 / F.sqrt("n")) & (F.col("name") != F.col(f"{c}.name"))
    merged = branch.join(of_all.filter("literal > 1"), ["host", "template"]).join(by_cell, ["host", "template", "cell"])
    group = F.when(near("largest"), F.struct(F.lit("+").alias("step"), F.col("largest.name").alias("into")))
    group = group.when(near("own"), F.struct(F.concat("own.name", F.lit("+")).alias("step"), F.col("own.name").alias("into")))
    merged = merged.select("host", "template", "name", group.alias("g")).filter("g is not null").select("host", "template", "name", "g.step", "g.into")
    # a leader that itself joins the largest stays there
    led = merged.select("host", "template", F.col("into").alias("name"), "step").distinct()
    into = merged.select("host", "template", "name", "step").unionByName(led).groupBy("host", "template", "name").agg(F.min("step").alias("joins"))
    rows = rows.join(into, ["host", "template", "name"], "left")
    step = F.when(F.col("here").isNull(), "").otherwise(F.concat(F.lit("/"), F.coalesce("joins", "name")))
    return rows.withColumn("template", F.concat("template", step)).select(*paths.columns)


def templates_of(paths: DataFrame) -> DataFrame:
    """Adds ``template`` to distinct paths (``host, path, n, blocked, allowed``)."""
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    rows = paths.withColumn("segments", segments).withColumn("template", F.lit(""))
    names = lambda depth: F.concat_ws("", F.transform(
        F.slice("segments", depth + 1, F.greatest(F.size("segments") - depth, F.lit(0))),
        lambda s: F.concat(F.lit("/"), F.when(s.rlike("[0-9]"), "*").otherwise(s)),
    ))
    done, depth = None, 0
    while True:
        # a path alone below its template has no siblings further down: what is left of it is named at once
        members = rows.groupBy("host", "template").agg(F.count(F.lit(1)).alias("members"))
        goes_on = (F.col("members") > 1) & (F.size("segments") > depth)
        rows, seen = materialise_observed(
            rows.join(members, ["host", "template"]).withColumn("goes_on", goes_on).drop("members"), "level", F.sum(F.col("goes_on").cast("int")).alias("open"),
        )
        ended = rows.filter("not goes_on").withColumn("template", F.concat("template", names(depth))).select(*paths.columns, "template")
        done = ended if done is None else done.unionByName(ended)
        if not seen["open"]:
            return done
        rows = level(rows.filter("goes_on").drop("goes_on"), depth)
        depth += 1


def judged(paths: DataFrame) -> DataFrame:
    """``host``, ``template``, its smoothed ``purity`` and whether it is ``rejected``."""
    by_template = paths.groupBy("host", "template").agg(*_counts())
    by_host = paths.groupBy("host").agg(F.least(F.sum("blocked") / F.sum("n"), F.lit(0.5)).alias("host_share"))
    labelled = F.col("blocked") + F.col("allowed")
    purity = (F.col("blocked") + PRIOR * F.col("host_share")) / (labelled + PRIOR)
    rows = by_template.join(by_host, "host").withColumn("purity", purity)
    return rows.select("host", "template", "purity", (F.col("purity") >= PURITY).alias("rejected"))


def filter_urls(pages: DataFrame, rules: dict[str, str] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity`` of every page."""
    host, path = located(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule = rule_of(F.col("host"), F.col("path"), rules)
    verdict = F.lit(None).cast("string")
    for name, says in rules.items():
        verdict = F.when(F.col("rule") == name, says).otherwise(verdict)
    rows = rows.withColumn("rule", rule).withColumn("says", verdict)
    # digits vary in any case, so pages that differ in them only are counted together first
    masked = F.regexp_replace("path", "[^/]*[0-9][^/]*", "0")
    counted = rows.filter("host <> ''").groupBy("host", masked.alias("path")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum((F.col("says") == "block").cast("int")).alias("blocked"), F.sum((F.col("says") == "allow").cast("int")).alias("allowed"),
    ).na.fill(0, ["blocked", "allowed"])
    paths = templates_of(materialise(counted, "paths"))
    verdicts = materialise(paths.select("host", "path", "template").join(judged(paths), ["host", "template"]), "verdicts")
    placed = rows.withColumn("masked", masked).join(verdicts.withColumnRenamed("path", "masked"), ["host", "masked"], "left")
    final = F.coalesce("says", F.when(F.col("rejected"), "block").otherwise("allow"))
    return placed.select("page_id", "host", "path", "rule", final.alias("verdict"), "template", "purity")
