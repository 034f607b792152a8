"""URL filters: host and path rules, whose block decisions reach every alias of a URL.

DataFrame functions only. A rule fits its host and all subdomains if the path starts with the rule's path; the
longest (host and path together; block before allow in a tie) decides. For URLs without a rule the redirect
equivalence decides: URLs are joined by the redirects and canonical links between them (of the pages themselves:
``<link rel="canonical">`` and ``<meta http-equiv="refresh">`` outside of comments and scripts; more redirects, say of a crawl log, may be
given), the connected components are classes of aliases, and a class with a URL that a rule blocks is blocked. An explicit allow has
precedence: a URL that a rule allows stays allowed whatever its class, and a class with such a URL passes no block on.
URLs that are only named as targets count in their class, though they have no page.

A URL names one resource whatever its fragment and the case of its scheme and host. Targets may be absolute, relative to the scheme, host or
folder, with dot segments; ``&amp;`` in them is read as ``&``, quotes are optional.

The scan of the rules is one projection. Links are deduplicated before anything is joined; components run in rounds of joins and partial
aggregates (a hub of many links is never in one place), and what is joined back to the pages is only the blocked aliases,
a table on the shared folder of known size, so Spark broadcasts it only if it is small and splits hot keys otherwise.

Cases: a null URL, or one without ``://``, has empty host and path, fits no rule, has no aliases and is allowed; null or empty HTML has no links;
repeated rows and pages sharing a URL all come back with the same verdict; several links of a page all count; empty tables give empty results; other columns are carried along, and may have any name but those of the result (host, path, rule, verdict), which raise an error.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import components, stored

A_TO_Z, A_TO_Z_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str  # allow or block
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _lower(c: Column) -> Column:
    return F.translate(c, A_TO_Z, A_TO_Z_LOWER)


def host_of(url: Column) -> Column:
    return F.coalesce(_lower(F.regexp_extract(url, r"\A(?s:.*?)://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"\A(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (name, verdict) of the longest rule that fits, or null. One CASE: for lists of some hundred rules."""
    kind = "struct<name:string,verdict:string>"
    found = F.lit(None).cast(kind)
    for r in sorted(rules, key=lambda r: (len(r.name), r.verdict == "block", r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.name).alias("name"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def resource(url: Column) -> Column:
    """The URL without its fragment, scheme and host in lower case; null without ``://``."""
    head = F.regexp_extract(url, r"\A((?s:.*?)://[^/?#]*)", 1)
    rest = F.regexp_extract(url, r"\A(?s:.*?)://[^/?#]*([^#]*)", 1)
    whole = F.concat(_lower(head), F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest)))
    return F.when(F.instr(url, "://") > 0, whole)


def _plain(path: Column) -> Column:
    """A path without ``.`` and ``..`` segments."""
    parts = F.slice(F.split(path, "/"), 2, F.greatest(F.size(F.split(path, "/")) - 1, F.lit(0)))
    ends = F.when(path.rlike(r"/\.{1,2}\z"), F.lit("/")).otherwise(F.lit(""))
    folded = F.aggregate(
        parts, F.lit(""),
        lambda acc, s: F.when(s == "..", F.regexp_replace(acc, r"/[^/]*\z", "")).when(s == ".", acc).otherwise(F.concat(acc, F.lit("/"), s)),
    )
    return F.when(path.rlike(r"/\.{1,2}(?:/|\z)"), F.concat(folded, ends)).otherwise(path)


def target_of(link: Column, page: Column) -> Column:
    """The resource that a link on a page names; null for links that name none (empty, other schemes such as mailto)."""
    link = F.trim(F.regexp_replace(link, "(?i)&amp;", "&"))
    scheme = F.regexp_extract(page, r"\A([^:]*):", 1)
    root = F.regexp_extract(page, r"\A([^:]*://[^/?#]*)", 1)
    path, query = F.regexp_extract(link, r"\A([^?#]*)", 1), F.regexp_extract(link, r"\A[^?#]*([^#]*)", 1)
    folder = F.regexp_extract(page, r"\A[^:]*://[^/?#]*([^?#]*/)", 1)
    return (
        F.when(link.rlike(r"\A[A-Za-z][A-Za-z0-9+.-]*://"), resource(link))
        .when(link.startswith("//"), resource(F.concat(scheme, F.lit(":"), link)))
        .when(link.startswith("/"), F.concat(root, _plain(path), query))
        .when((link == "") | link.rlike(r"\A(?:#|[A-Za-z][A-Za-z0-9+.-]*:)"), F.lit(None).cast("string"))
        .when(link.startswith("?"), F.concat(F.regexp_extract(page, r"\A([^?#]*)", 1), query))
        .otherwise(F.concat(root, _plain(F.concat(folder, path)), query))
    )


def _attribute(tag: Column, name: str) -> Column:
    value = lambda k: F.regexp_extract(tag, rf"""(?i)[\s"']{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", k)
    return F.coalesce(F.nullif(value(1), F.lit("")), F.nullif(value(2), F.lit("")), value(3))


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Different (u, v): resources of the pages, and those that their canonical links and refreshes name."""
    some = pages.where(F.col(html).rlike("(?i)canonical|refresh")).select(resource(F.col(url)).alias("u"), F.col(html).alias("html"))
    body = F.regexp_replace("html", r"(?is)<!--.*?-->|<script\b.*?</script\s*>", "")
    tags = some.where("u is not null").select("u", F.explode(F.regexp_extract_all(body, F.lit(r"(?is)(<(?:link|meta)\s[^>]*>)"), F.lit(1))).alias("tag"))
    tag = F.col("tag")
    canonical = F.when(_attribute(tag, "rel").rlike(r"(?i)(?:\A|\s)canonical(?:\s|\z)"), _attribute(tag, "href"))
    moved = F.regexp_extract(_attribute(tag, "content"), r"""(?i)\A\s*[0-9.]*\s*[;,]\s*url\s*=\s*["']?([^"']*)""", 1)
    refresh = F.when(F.lower(F.trim(_attribute(tag, "http-equiv"))) == "refresh", moved)
    named = F.when(tag.rlike(r"(?i)\A<link"), canonical).otherwise(refresh)
    return tags.select("u", target_of(named, F.col("u")).alias("v")).where("v is not null and u != v").distinct()


def blocked_aliases(links: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Resources (alias) without a rule whose class of aliases is blocked. ``links``: pairs (u, v) of resources."""
    links = stored(links)
    ends = links.select("u").union(links.select("v")).distinct().withColumnRenamed("u", "node")
    ruled = ends.select("node", rule_of(host_of(F.col("node")), path_of(F.col("node")), rules)["verdict"].alias("verdict"))
    # a class's decision needs its ruled members only; a class without a blocked one needs nothing
    classes = stored(components(links).join(ruled, "node"))
    decided = classes.where("verdict is not null").groupBy("component").agg(F.max(F.col("verdict") == "allow").alias("allowed"))
    decided = decided.where("not allowed").select("component")
    return classes.where("verdict is null").join(decided, "component", "left_semi").select(F.col("node").alias("alias"))


def filter_urls(
    pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None, url: str = "url", html: str | None = "html"
) -> DataFrame:
    """The rows of ``pages`` with host, path, rule and verdict. ``redirects``: more links, (from_url, to_url)."""
    if clash := {"host", "path", "rule", "verdict"} & set(pages.columns):
        raise ValueError(f"columns of the result: {sorted(clash)}")
    rules = list(rules)
    links = [page_links(pages, url, html)] if html else []
    if redirects is not None:
        ends = redirects.select(resource(F.col("from_url")).alias("u"), target_of(F.col("to_url"), resource(F.col("from_url"))).alias("v"))
        links.append(ends.where("u is not null and v is not null and u != v"))
    row = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"), F.col(url).alias("url"))
    row = row.select("row", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    row = row.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.col("rule.verdict")
    if links:
        pairs = links[0] if len(links) == 1 else links[0].union(links[1]).distinct()
        blocked = stored(blocked_aliases(pairs, rules))
        # ruled rows need no alias: their key is null and matches nothing
        row = row.withColumn("key", F.when(F.col("rule").isNull(), resource(F.col("url"))))
        row = row.join(blocked, F.col("key") == F.col("alias"), "left")
        verdict = F.coalesce(verdict, F.when(F.col("alias").isNotNull(), F.lit("block")))
    return row.select("row.*", "host", "path", F.col("rule.name").alias("rule"), F.coalesce(verdict, F.lit("allow")).alias("verdict"))
