"""URL verdicts: fixed host/path rules first, then a path-template tree per host.

The tree is learned from the urls the rules already judge. Per host, path segments that
vary (numbers, hex ids, and nodes with many rare children) become wildcards; sibling
branches whose share of blocked urls does not differ significantly are merged, and those
without judged urls join them when all judged ones agree. A template's share of blocked urls
among judged ones is smoothed towards that of its parent, the parent's towards its own, up
to the host and the corpus; a template is rejected when the smoothed share is high. So
templates without judged urls follow their branch and host, and on hosts without any judged
url they keep the corpus-wide share.

Counting starts from distinct (host, path) pairs, combined before each shuffle, so a hot
host costs one row per node. A null url, or one without ``://``, has empty host and path,
fits no rule and is allowed. Repeated urls count as often as they occur. Paths deeper than
``DEPTH`` segments share one tail wildcard: they are judged by their first segments. Urls of
any length are taken whole. Extra columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEPTH = 4
MANY_CHILDREN = 16  # a node with more distinct literal children than this, each seen
RARE = 8.0  # fewer times than this on average, has a variable child segment
Z = 1.96  # siblings closer than this to their pooled share are merged
WEIGHT = 2.0  # pseudo-observations at the parent's share
REJECT_AT = 0.8


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parse(url: Column) -> tuple[Column, Column]:
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Name of the longest rule that fits, else null; rules are few and become one CASE."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, rule.name).otherwise(out)
    return out


def segments(path: Column) -> Column:
    """Path segments with plainly variable ones generalised by shape."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    shaped = F.transform(
        parts,
        lambda s: F.when(s.rlike("^[0-9]+$"), "{n}")
        .when(s.rlike("^[0-9a-fA-F-]{16,}$"), "{id}")
        .otherwise(F.regexp_replace(s, "[0-9]+", "{n}")),
    )
    head = F.slice(shaped, 1, DEPTH)
    return F.when(F.size(shaped) > DEPTH, F.concat(head, F.array(F.lit("**")))).otherwise(head)


def judged(pages: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``pages`` (page_id, url) with host, path, rule and segments."""
    host, path = parse(F.col("url"))
    verdicts = F.create_map(*[F.lit(x) for r in rules for x in (r.name, r.verdict)])
    return (
        pages.select("page_id", host.alias("host"), path.alias("path"))
        .withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
        .withColumn("given", F.try_element_at(verdicts, F.col("rule")))
        .withColumn("segs", segments(F.col("path")))
    )


def _with_wildcards(nodes: DataFrame, level: int) -> DataFrame:
    """Replace segment ``level`` by ``*`` under parents with many rare children."""
    at = F.get("segs", F.lit(level))
    above = F.slice("segs", 1, level)
    parents = (
        nodes.filter(F.size("segs") > level)
        .groupBy("host", above.alias("above"), at.alias("seg"))
        .agg(F.sum("n").alias("n"))
        .groupBy("host", "above")
        .agg(F.count("*").alias("children"), F.sum("n").alias("n"))
        .filter((F.col("children") > MANY_CHILDREN) & (F.col("n") < RARE * F.col("children")))
        .select("host", "above", F.lit(True).alias("variable"))
    )
    general = F.transform(
        "segs", lambda s, i: F.when((i == level) & F.col("variable"), "*").otherwise(s)
    )
    return (
        nodes.withColumn("above", above)
        .join(parents, ["host", "above"], "left")
        .withColumn("segs", F.when(F.size("segs") > level, general).otherwise(F.col("segs")))
        .drop("above", "variable")
        .groupBy("host", "raw", "segs")
        .agg(*[F.sum(c).alias(c) for c in ("n", "good", "bad")])
    )


def _smoothed(found: DataFrame, prior: float) -> DataFrame:
    """``found`` (host, template, counts) with the purity, backed off node by node."""
    depth = F.sequence(F.lit(0), F.size("template"))
    nodes = found.withColumn(
        "node", F.explode(F.transform(depth, lambda d: F.slice("template", 1, d)))
    )
    counts = nodes.groupBy("host", "node").agg(
        F.sum("good").alias("node_good"), F.sum("bad").alias("node_bad")
    )
    # One entry per level: DEPTH + 2 at most.
    path = F.array_sort(F.collect_list(F.struct(F.size("node"), "node_good", "node_bad")))
    purity = F.aggregate(
        "path",
        F.lit(prior),
        lambda p, c: (c["node_bad"] + WEIGHT * p) / (c["node_good"] + c["node_bad"] + WEIGHT),
    )
    return (
        nodes.join(counts, ["host", "node"])
        .groupBy("host", "template", "n", "good", "bad")
        .agg(path.alias("path"))
        .withColumn("purity", purity)
        .drop("path")
    )


def templates(rows: DataFrame, keep) -> tuple[DataFrame, DataFrame]:
    """(host, raw segments -> template) and (host, template -> counts, purity, rejected).

    ``keep(df, name)`` stores a small table and reads it back.
    """
    nodes = rows.groupBy("host", F.col("segs").alias("raw")).agg(
        F.count("*").alias("n"),
        F.count_if(F.col("given") == "allow").alias("good"),
        F.count_if(F.col("given") == "block").alias("bad"),
    )
    nodes = nodes.withColumn("segs", F.col("raw"))
    for level in range(DEPTH):
        nodes = _with_wildcards(nodes, level)
    nodes = keep(nodes, "nodes")

    tree = keep(
        nodes.groupBy("host", "segs").agg(*[F.sum(c).alias(c) for c in ("n", "good", "bad")]),
        "tree",
    )
    # Siblings: templates of one host that differ in their first segment only. The host's
    # root has none.
    rest = F.when(F.size("segs") > 0, F.slice("segs", 2, DEPTH))
    seen = F.col("good") + F.col("bad")
    pooled = (
        tree.filter(F.size("segs") > 0)
        .groupBy("host", rest.alias("rest"))
        .agg(
            F.sum("good").alias("all_good"),
            F.sum("bad").alias("all_bad"),
            F.count_if(seen > 0).alias("judged"),
        )
    )
    share = F.try_divide(F.col("all_bad"), F.col("all_good") + F.col("all_bad"))
    spread = F.sqrt(F.try_divide(F.greatest(share * (1 - share), F.lit(1e-9)), seen))
    # Null for a branch without judged urls: it has nothing to compare.
    alike = F.abs(F.try_divide(F.col("bad"), seen) - share) <= Z * spread
    compared = tree.withColumn("rest", rest).join(pooled, ["host", "rest"], "left")
    differing = (
        compared.filter(~alike)
        .groupBy("host", "rest")
        .agg(F.lit(True).alias("differ"))
    )
    joins = F.coalesce(alike, F.col("differ").isNull()) & (F.col("judged") > 1)
    merged = keep(
        compared.join(differing, ["host", "rest"], "left")
        .withColumn(
            "template",
            F.when(joins, F.concat(F.array(F.lit("*")), F.col("rest"))).otherwise(F.col("segs")),
        )
        .select("host", "segs", "template", "n", "good", "bad"),
        "merged",
    )
    prior = merged.agg(F.sum("bad") / F.greatest(F.sum("good") + F.sum("bad"), F.lit(1))).first()[0]
    found = keep(
        merged.groupBy("host", "template").agg(
            *[F.sum(c).alias(c) for c in ("n", "good", "bad")]
        ),
        "templates",
    )
    scored = _smoothed(found, float(prior or 0.0)).withColumn(
        "rejected", F.col("purity") >= REJECT_AT
    )
    mapping = nodes.select("host", "raw", "segs").join(
        merged.select("host", "segs", "template"), ["host", "segs"]
    )
    return mapping.select("host", "raw", "template"), scored


def url_verdicts(pages: DataFrame, rules: Sequence[Rule], keep) -> DataFrame:
    """page_id, host, path, rule, verdict, template, purity."""
    rows = judged(pages, rules)
    mapping, scored = templates(rows, keep)
    rejects = keep(
        mapping.join(scored, ["host", "template"]).select(
            "host", F.col("raw").alias("segs"), "template", "purity", "rejected"
        ),
        "verdicts",
    )
    method = F.when(F.col("rejected"), "block").otherwise("allow")
    return rows.join(rejects, ["host", "segs"], "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("given", method).alias("verdict"),
        F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"),
        "purity",
    )
