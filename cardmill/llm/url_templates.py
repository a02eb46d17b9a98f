"""Operator 12, URL filters: rules by host and path, and a tree of path templates for what no rule fits.

The tree is grown one path segment at a time, for all hosts at once, over distinct URLs with their counts:

1. A segment that is frequent below its host and prefix stays as it is; all others become a wildcard by their shape.
2. Branches below one prefix whose shares of blocked labels do not differ by more than chance are merged, and grow
   on together.
3. A finished template is rejected if its labelled rows, smoothed by one row of either kind, are nearly all blocked.

Rows that a rule fits are labelled by it; other labels may be given. Only DataFrame functions are used. A prefix has a
bounded number of frequent segments, so no group that is collected grows with the data, and what is joined to the
URLs is written first, so that Spark can split a host with a third of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from cardmill.llm.common import ascii_lower, free
from cardmill.operators.sizing import broadcast_within
from cardmill.session import materialize

ADDED = ("host", "path", "rule", "verdict", "template", "purity")
# Segments beyond this many are one wildcard.
MOST_SEGMENTS = 8
# A segment stays if it has this many rows and this share of the rows below its prefix; so 50 at most do.
LEAST_ROWS = 5
LEAST_SHARE = 0.02
# Longer segments are variable.
MOST_CHARS = 64
# Branches with fewer labelled rows are not merged; others are where the difference of their shares is within
# this many standard errors.
LEAST_LABELS = 5
ERRORS = 1.96
# Smoothed share of blocked labels at which a template is rejected.
REJECT = 0.9
MOST_RULES = 500
# Endings that a wildcard keeps.
ENDINGS = "html htm php asp aspx jsp pdf xml json txt"


@dataclass(frozen=True)
class Rule:
    """A verdict (``allow`` or ``block``) for a host with its subdomains, below a path; written like ``net/es/``."""

    verdict: str
    text: str

    def __post_init__(self):
        if self.verdict not in ("allow", "block") or "/" not in self.text:
            raise ValueError(f"not a rule: {self.verdict} {self.text}")

    def fits(self, host: Column, path: Column) -> Column:
        own, slash, below = self.text.partition("/")
        return ((host == own) | host.endswith("." + own)) & path.startswith(slash + below)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL, both empty where it is null or has no ``://``."""

    def part(group: int) -> Column:
        return F.coalesce(F.regexp_extract(url, r"://([^/?#]*)([^?#]*)", group), F.lit(""))

    return ascii_lower(part(1)), part(2)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """``text`` and ``verdict`` of the longest rule that fits, of equally long ones the first as text; or null."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"at most {MOST_RULES} rules, which are part of the plan")
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text, r.verdict))
    cases = [
        F.when(r.fits(host, path), F.struct(F.lit(r.text).alias("text"), F.lit(r.verdict).alias("verdict"))) for r in ordered
    ]
    return F.coalesce(*cases, F.lit(None).cast("struct<text: string, verdict: string>"))


def _wildcard(segment: Column) -> Column:
    """A variable segment by its shape; the empty one behind a last slash stays."""
    number = F.when(segment.rlike(r"^[0-9]+(\.[a-z]+)?$"), "<number>").when(segment.rlike(r"^[0-9a-f-]{8,}$"), "<hex>")
    ending = F.regexp_extract(segment, rf"\.({'|'.join(ENDINGS.split())})$", 0)
    return F.when(segment == "", "").otherwise(F.concat(F.coalesce(number, F.lit("<any>")), ending))


def _literal(segment: Column) -> Column:
    """The segment without the characters that templates use."""
    for mark, code in (("|", "%7C"), ("{", "%7B"), ("}", "%7D"), ("<", "%3C")):
        segment = F.replace(segment, F.lit(mark), F.lit(code))
    return segment


COUNTS = ("n", "labelled", "blocked")


def _sums() -> list[Column]:
    return [F.sum(c).alias(c) for c in COUNTS]


def _frequent(urls: DataFrame) -> DataFrame:
    """The segments that stay, by host and prefix."""
    here = urls.where(F.col("segment").isNotNull() & (F.length("segment") <= MOST_CHARS) & (F.col("segment") != ""))
    counted = here.groupBy("host", "prefix", "segment").agg(F.sum("n").alias("own")).where(F.col("own") >= LEAST_ROWS)
    totals = urls.where(F.col("segment").isNotNull()).groupBy("host", "prefix").agg(F.sum("n").alias("total"))
    kept = counted.join(totals, ["host", "prefix"]).where(F.col("own") >= LEAST_SHARE * F.col("total"))
    return kept.select("host", "prefix", "segment", _literal(F.col("segment")).alias("literal"))


def _alike(a: Column, b: Column) -> Column:
    """Whether the blocked shares of two branches differ by no more than chance."""
    share = (a["blocked"] + b["blocked"]) / (a["labelled"] + b["labelled"])
    variance = share * (1 - share) * (1 / a["labelled"] + 1 / b["labelled"])
    difference = a["blocked"] / a["labelled"] - b["blocked"] / b["labelled"]
    return difference * difference <= ERRORS * ERRORS * variance


def _merged(urls: DataFrame) -> DataFrame:
    """New names of branches that are merged: neighbours in the order of their blocked shares, one after the other."""
    branches = urls.where(F.col("child").isNotNull()).groupBy("host", "prefix", "child").agg(*_sums())
    branches = branches.where(F.col("labelled") >= LEAST_LABELS)
    one = F.struct((F.col("blocked") / F.col("labelled")).alias("share"), "child", "labelled", "blocked")
    grouped = branches.groupBy("host", "prefix").agg(F.array_sort(F.collect_list(one)).alias("branches"))
    grouped = grouped.where(F.size("branches") > 1)

    def add(groups: Column, branch: Column) -> Column:
        new = F.struct(F.array(branch["child"]).alias("names"), branch["labelled"].alias("labelled"), branch["blocked"].alias("blocked"))
        last = F.get(groups, F.size(groups) - 1)
        both = F.struct(
            F.concat(last["names"], F.array(branch["child"])).alias("names"),
            (last["labelled"] + branch["labelled"]).alias("labelled"),
            (last["blocked"] + branch["blocked"]).alias("blocked"),
        )
        joined = F.concat(F.slice(groups, F.lit(1), F.size(groups) - 1), F.array(both))
        return F.when((F.size(groups) > 0) & _alike(last, branch), joined).otherwise(F.concat(groups, F.array(new)))

    none = F.array().cast("array<struct<names: array<string>, labelled: bigint, blocked: bigint>>")
    groups = grouped.select("host", "prefix", F.explode(F.aggregate("branches", none, add)).alias("group"))
    groups = groups.where(F.size("group.names") > 1)
    name = F.concat(F.lit("{"), F.array_join(F.array_sort("group.names"), "|"), F.lit("}"))
    return groups.select("host", "prefix", F.explode("group.names").alias("child"), name.alias("name"))


def _grow(urls: DataFrame, level: int) -> DataFrame:
    """Prefixes one segment longer, where there is one."""
    segment = F.get("segments", F.lit(level))
    if level == MOST_SEGMENTS:
        child = F.when(segment.isNotNull(), "<rest>")
        urls = urls.withColumn("child", child)
    else:
        urls = urls.withColumn("segment", segment)
        frequent = broadcast_within(materialize(_frequent(urls), "frequent-segments"))
        urls = urls.join(frequent, ["host", "prefix", "segment"], "left")
        child = F.when(F.col("segment").isNotNull(), F.coalesce("literal", _wildcard(F.col("segment"))))
        urls = materialize(urls.withColumn("child", child).drop("segment", "literal"), "url-children")
    merged = broadcast_within(materialize(_merged(urls), "merged-branches"))
    urls = urls.join(merged, ["host", "prefix", "child"], "left")
    longer = F.concat("prefix", F.lit("/"), F.coalesce("name", "child"))
    return materialize(urls.withColumn("prefix", F.coalesce(longer, "prefix")).drop("child", "name"), "url-prefixes")


def path_templates(urls: DataFrame) -> DataFrame:
    """``urls`` (distinct ``host``, ``path`` with ``n``, ``labelled``, ``blocked``) with their ``template`` and its ``purity``."""
    segments = F.split(F.substring("path", F.lit(2), F.length("path")), "/", MOST_SEGMENTS + 1)
    rooted = F.when(F.col("path").startswith("/"), segments).otherwise(F.array().cast("array<string>"))
    urls = materialize(urls.withColumns({"segments": rooted, "prefix": F.lit("")}), "urls")
    for level in range(urls.agg(F.max(F.size("segments"))).first()[0] or 0):
        urls = _grow(urls, level)
    urls = urls.drop("segments").withColumnRenamed("prefix", "template")
    purity = (F.sum("blocked") + 1) / (F.sum("labelled") + 2)
    purities = materialize(urls.groupBy("host", "template").agg(purity.alias("purity")), "template-purity")
    return urls.join(broadcast_within(purities), ["host", "template"])


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], url_col: str = "url", label: Column | None = None, reject: float = REJECT
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict``, ``template`` and ``purity``; input columns of these names are replaced.

    The longest rule that fits decides. Otherwise the template of the URL does: it is blocked where ``purity``, the
    smoothed share of blocked rows among the labelled rows of the template, is at least ``reject``. A row is
    labelled by ``label`` (``allow`` or ``block``) or, where that is null, by its rule; a template without labels
    has a purity of one half and is allowed.

    * URLs that are null, empty or without ``://`` have an empty host and path and share one template.
    * Paths are read whole; segments behind the eighth are one wildcard, and so are segments of over 64 characters.
    * Repeated rows count as often as they occur and come out repeated; an empty table gives an empty table.
    * Nulls in other columns and further columns do no harm; names starting with ``_llm_`` are reserved.
    """
    if not 0.5 < reject <= 1:
        raise ValueError("reject is above one half, the purity of a template without labels")
    pages = free(pages, *ADDED)
    host, path = host_and_path(F.col(f"`{url_col}`"))
    pages = pages.withColumns({"_llm_host": host, "_llm_path": path})
    host, path = F.col("_llm_host"), F.col("_llm_path")
    rule = matching_rule(host, path, rules)
    known = rule["verdict"] if label is None else F.coalesce(label, rule["verdict"])
    urls = pages.groupBy(host.alias("host"), path.alias("path")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(known.isin("allow", "block")).alias("labelled"),
        F.count_if(known == "block").alias("blocked"),
    )
    judged = materialize(path_templates(urls).select("host", "path", "template", "purity"), "url-verdicts")
    judged = broadcast_within(judged)
    rows = pages.join(judged, (host == judged["host"]) & (path == judged["path"]))
    method = F.when(F.col("purity") >= reject, "block").otherwise("allow")
    columns = [F.col(f"`{c}`") for c in pages.columns if not c.startswith("_llm_")]
    return rows.select(
        *columns,
        host.alias("host"),
        path.alias("path"),
        rule["text"].alias("rule"),
        F.coalesce(rule["verdict"], method).alias("verdict"),
        "template",
        "purity",
    )
