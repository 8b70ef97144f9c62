"""URL filters with redirect equivalence, in DataFrame functions only.

A rule decides a url by itself. Redirect and canonical-link edges make urls aliases of each other;
the decision of any alias reaches those that no rule decides.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrytab.llm.common import ascii_lower
from ferrytab.llm.graph import components

ALLOW, BLOCK = "allow", "block"


class UrlRule(NamedTuple):
    """Fits ``host`` and its subdomains where the url's path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def url_node(url: Column) -> Column:
    """Graph node of a url: host, path and query without scheme and fragment; null without ``://``."""
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*(\?[^#]*)", 1)
    return F.when(F.locate("://", url) > 0, F.concat(url_host(url), url_path(url), query))


def matching_rule(host: Column, path: Column, rules: list[UrlRule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; of equal rules the allowing one. Null if none fits.

    The rules become one expression, so their number is that of a policy file, not of the pages.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.verdict == ALLOW)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


_TAG_LINK = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical[\"'\s>/][^>]*>?"
_TAG_META = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"


def _target(tag: Column, pattern: str) -> Column:
    return F.nullif(F.trim(F.regexp_extract(tag, pattern, 1)), F.lit(""))


def link_edges(pages: DataFrame) -> DataFrame:
    """Edges (``node``, ``alias``) of pages to the targets of their canonical link and of their refresh redirect.

    Targets without a scheme are completed from the page's url. Pages whose url has no ``://`` have none.
    """
    link, meta = F.regexp_extract("html", _TAG_LINK, 0), F.regexp_extract("html", _TAG_META, 0)
    targets = F.array(
        _target(link, r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"), _target(meta, r"(?is)\burl\s*=\s*[\"']?([^\"'\s>;]+)")
    )
    found = pages.where(F.locate("://", F.col("url")) > 0).select("url", F.explode(targets).alias("target"))
    target, host = F.col("target"), url_host(F.col("url"))
    folder = F.regexp_extract(url_path(F.col("url")), "^(.*/)?[^/]*$", 1)
    full = (
        F.when(F.locate("://", target) > 0, target)
        .when(target.startswith("//"), F.concat(F.lit(":"), target))
        .when(target.startswith("/"), F.concat(F.lit("://"), host, target))
        .otherwise(F.concat(F.lit("://"), host, F.when(folder == "", F.lit("/")).otherwise(folder), target))
    )
    return found.where("target is not null").select(url_node(F.col("url")).alias("node"), url_node(full).alias("alias"))


def filter_urls(pages: DataFrame, rules: list[UrlRule], edges: DataFrame | None = None) -> DataFrame:
    """``pages`` (page_id, url, html) with host, path, rule and verdict.

    The verdict is that of the url's own rule. Without one, it comes from the component of aliases:
    allow if any alias is allowed by a rule (allow goes before block), block if one is blocked, and
    allow if none is decided. ``edges`` (node, alias; see :func:`url_node`) may add redirects from
    crawl logs to those found in the html. Repeated pages are judged alike; null urls are allowed.
    """
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    base = pages.select("page_id", host.alias("host"), path.alias("path"), url_node(F.col("url")).alias("node"))
    judged = base.withColumn("rule", rule).withColumn("own", verdict)
    links = link_edges(pages)
    graph = components(links.unionByName(edges) if edges is not None else links)
    # The rules also decide aliases that are no page themselves.
    ends = F.concat(F.lit("://"), F.col("node"))
    node_rule = matching_rule(url_host(ends), url_path(ends), rules)[1]
    by_root = (
        graph.select("root", node_rule.alias("own"))
        .groupBy("root")
        .agg(F.max(F.col("own") == ALLOW).alias("allowed"), F.max(F.col("own") == BLOCK).alias("blocked"))
    )
    inherited = graph.join(by_root, "root").select(
        "node", F.when(F.col("blocked") & ~F.coalesce("allowed", F.lit(False)), BLOCK).otherwise(ALLOW).alias("shared")
    )
    # Pages without a node meet no alias; their own key keeps them from meeting in one task.
    key = F.coalesce("node", F.concat(F.lit("\x00"), F.xxhash64("page_id").cast("string")))
    return (
        judged.withColumn("node", key)
        .join(inherited, "node", "left")
        .select("page_id", "host", "path", "rule", F.coalesce("own", "shared", F.lit(ALLOW)).alias("verdict"))
    )
