"""URL filters: rules by host and path, and a tree of path templates that learns from them.

Pages under a rule are labelled examples. Per host, paths grow into a tree of templates: numbers and
long hexadecimal runs become wildcards, a branch with many rarely used children becomes one wildcard,
and siblings whose shares of blocked examples do not differ significantly are merged. A template is
rejected when its share of blocked examples, smoothed towards its branch, its host and all pages, is
high. A page takes the verdict of its longest rule, else of its template.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import keep

# The production rules.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"),
         ("com/fr/", "allow"), ("com/de/", "block"))
# A template has so many segments; what follows in a path is one wildcard.
DEPTH = 8
# Children beyond which a branch is variable; or so many, each with few pages.
MANY_CHILDREN, SOME_CHILDREN, FEW_PAGES = 64, 8, 4
# Two siblings are alike unless the difference of their shares exceeds so many standard errors.
ALIKE = 1.96
# Weight of the level above in a smoothed share, and the share at which a template is rejected.
PRIOR_PAGES, REJECT = 5.0, 0.8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

col = F.col


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty if it is null or has no ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest rule that fits, or null. A rule fits its host and all subdomains."""
    fits = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        at = rule.find("/") if "/" in rule else len(rule)
        own, start = rule[:at], rule[at:]
        match = ((host == own) | host.endswith("." + own)) & path.startswith(start)
        fits = F.when(match, F.lit(rule)).otherwise(fits)
    return fits


def segments(path: Column) -> Column:
    """Segments of a path with hexadecimal runs as ``<h>``, numbers as ``<n>``, the deep end as ``*``."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    named = F.transform(parts, lambda s: F.regexp_replace(F.regexp_replace(
        s, r"(?=[0-9a-f]*[0-9])(?=[0-9a-f]*[a-f])[0-9a-f]{8,}", "<h>"), r"[0-9]+", "<n>"))
    return F.when(F.size(named) > DEPTH, F.concat(F.slice(named, 1, DEPTH), F.array(F.lit("*")))).otherwise(named)


def _share(blocked: Column, labelled: Column, above: Column) -> Column:
    return (blocked + F.lit(PRIOR_PAGES) * above) / (labelled + F.lit(PRIOR_PAGES))


def _named_children(kids: DataFrame) -> DataFrame:
    """Names of the children of narrow branches after merging siblings that are alike."""
    branch = ["host", "parent"]
    labelled = kids.filter(col("labelled") > 0).withColumn("share", col("blocked") / col("labelled"))
    order = Window.partitionBy(*branch).orderBy("share", "child")
    n, m = col("labelled"), F.lag("labelled").over(order)
    k, j = col("blocked"), F.lag("blocked").over(order)
    both = (k + j) / (n + m)
    error = F.sqrt(both * (1 - both) * (1 / n + 1 / m))
    differs = F.coalesce(F.abs(k / n - j / m) > F.lit(ALIKE) * error, F.lit(False))
    groups = (labelled.withColumn("differs", differs.cast("int"))
              .withColumn("group", F.sum("differs").over(order.rowsBetween(Window.unboundedPreceding, 0))))
    # Siblings without examples say nothing about each other's shares: they are one group.
    groups = groups.select(*branch, "child", "group").unionByName(
        kids.filter(col("labelled") == 0).select(*branch, "child", F.lit(-1).cast("long").alias("group")))
    names = groups.groupBy(*branch, "group").agg(F.array_join(F.sort_array(F.collect_list("child")), "|").alias("name"))
    return groups.join(names, branch + ["group"]).select(*branch, "child", "name")


def templates(pages: DataFrame) -> DataFrame:
    """(host, shape, template, n, labelled, blocked): the template of every path shape of a host.

    ``pages`` has host, segments, labelled and blocked. Pages are counted per host and shape first, so
    that a host with a third of all pages is spread and small from here on.
    """
    shape = F.array_join("segments", "/")
    rows = keep(pages.groupBy("host", shape.alias("shape"), "segments").agg(
        F.count("*").alias("n"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
        .withColumn("parent", F.lit("")))
    levels = rows.agg(F.max(F.size("segments")).alias("m")).first().m or 0
    for depth in range(levels):
        here = rows.filter(F.size("segments") > depth).withColumn("child", col("segments")[depth])
        kids = keep(here.groupBy("host", "parent", "child").agg(
            *[F.sum(c).alias(c) for c in ("n", "labelled", "blocked")]))
        branches = kids.groupBy("host", "parent").agg(F.count("*").alias("children"), F.sum("n").alias("pages"))
        branches = branches.select("host", "parent", (
            (col("children") > MANY_CHILDREN) | ((col("children") >= SOME_CHILDREN)
                                                 & (col("pages") < FEW_PAGES * col("children")))).alias("wide"))
        branches = keep(branches)
        names = _named_children(kids.join(branches.filter(~col("wide")), ["host", "parent"], "left_semi"))
        named = (here.join(branches, ["host", "parent"])
                 .join(names, ["host", "parent", "child"], "left")
                 .withColumn("parent", F.concat("parent", F.lit("/"), F.when(col("wide"), "*").otherwise(col("name"))))
                 .select(*rows.columns))
        rows = keep(named.unionByName(rows.filter(F.size("segments") <= depth)))
    return rows.withColumnRenamed("parent", "template")


def rejected(found: DataFrame) -> DataFrame:
    """(host, shape, template, purity): the smoothed share of blocked examples of every template."""
    sums = [F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")]
    everywhere = found.agg(*sums).select(
        F.coalesce(F.try_divide("blocked", "labelled"), F.lit(0.0)).alias("share")).first().share
    found = found.withColumn("branch", F.substring_index("template", "/", 2))

    def level(by: list[str], name: str, above: DataFrame | None) -> DataFrame:
        sums_here = found.groupBy(*by).agg(*sums)
        if above is None:
            return sums_here.select(*by, _share(col("blocked"), col("labelled"), F.lit(everywhere)).alias(name))
        joined = sums_here.join(above, [c for c in by if c in above.columns])
        return joined.select(*by, _share(col("blocked"), col("labelled"), col(above.columns[-1])).alias(name))

    hosts = level(["host"], "host_share", None)
    branches = level(["host", "branch"], "branch_share", hosts)
    leaves = level(["host", "branch", "template"], "purity", branches)
    return found.join(leaves, ["host", "branch", "template"]).select("host", "shape", "template", "purity")


def judge(df: DataFrame, rules: Sequence[tuple[str, str]] = RULES, url: str = "url",
          reject: float = REJECT) -> DataFrame:
    """``df`` with host, path, rule, template, purity and verdict.

    The rules are a short list given by the caller. Urls that are null or have no ``://`` have an empty
    host and path and share one template; without any example everything is allowed. Repeated rows get
    equal verdicts; columns of ``df`` with the names of the new ones are replaced.
    """
    new = ("host", "path", "rule", "template", "purity", "verdict")
    host, path = host_and_path(col(f"`{url}`"))
    pages = df.select(*[col(f"`{c}`") for c in df.columns if c not in new], host.alias("host"), path.alias("path"))
    blocked = [r for r, verdict in rules if verdict == "block"]
    pages = (pages.withColumn("rule", longest_rule(col("host"), col("path"), rules))
             .withColumn("__ruled", F.when(col("rule").isNotNull(), F.when(
                 col("rule").isin(blocked) if blocked else F.lit(False), "block").otherwise("allow")))
             .withColumn("__segments", segments(col("path"))))
    examples = pages.select("host", col("__segments").alias("segments"), col("__ruled").isNotNull().cast("long").alias("labelled"),
                            F.coalesce(col("__ruled") == "block", F.lit(False)).cast("long").alias("blocked"))
    verdicts = keep(rejected(templates(examples)).withColumnRenamed("shape", "__shape"))
    return (pages.withColumn("__shape", F.array_join("__segments", "/")).join(verdicts, ["host", "__shape"])
            .withColumn("verdict", F.coalesce(
                col("__ruled"), F.when(col("purity") >= reject, "block").otherwise("allow")))
            .select(*[col(f"`{c}`") for c in df.columns if c not in new], *new))

