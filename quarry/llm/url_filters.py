"""URL rules whose decisions reach the aliases of a page.

A page's own url is judged by the longest rule that fits. Pages that no rule fits take
the decision of their aliases: canonical links and redirects of the pages are edges
between addresses, connected components of these are one document under several
urls, and a component with a blocked address is blocked, but for addresses that a rule
allows. All steps are column functions, joins and groupings.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .storage import settle


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"),
)

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
QUERY = r"(?s)^[^?#]*\?([^#]*)"
#: Parameters that tell a server where a visitor came from, and leave the page the same.
TRACKING = r"(?i)(^|&)(utm_[^=&]*|gclid|fbclid)=[^&]*"
UNSEEN = r"(?is)<!--.*?-->|<script.*?</script[^>]*>|<style.*?</style[^>]*>"
TAGS = r"(?is)<(?:link|meta)[\x09-\x0D\x20][^>]*>"
CANONICAL = r"""(?is)[\x09-\x0D\x20]rel[\x09-\x0D\x20]*=[\x09-\x0D\x20]*["']?canonical(?:["'>/\x09-\x0D\x20]|$)"""
HREF = r"""(?is)[\x09-\x0D\x20]href[\x09-\x0D\x20]*=[\x09-\x0D\x20]*(?:"([^"]*)"|'([^']*)'|([^"'>\x09-\x0D\x20]+))"""
REFRESH = r"""(?is)http-equiv[\x09-\x0D\x20]*=[\x09-\x0D\x20]*["']?refresh"""
REFRESH_URL = r"""(?is)[\x09-\x0D\x20]content[\x09-\x0D\x20]*=[\x09-\x0D\x20]*["'][\x09-\x0D\x20]*[0-9.]*[\x09-\x0D\x20]*[;,][\x09-\x0D\x20]*url[\x09-\x0D\x20]*=[\x09-\x0D\x20]*["']?([^"'>]+)"""


def host(url: Column) -> Column:
    """What follows the first ``://``, up to a slash, question mark or hash; '' for null or none."""
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def fitting(rules: Sequence[Rule], host: Column, path: Column) -> Column:
    """The longest rule that fits, as (rule, verdict); of equally long ones an allowing one. Null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.verdict == "allow", r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def address(url: Column) -> Column:
    """What a url has in common with the forms that servers redirect to each other; null without a host.

    Scheme, default port, fragment, slashes at the path's end and tracking parameters are left off.
    """
    query = F.regexp_replace(F.regexp_replace(F.regexp_extract(url, QUERY, 1), TRACKING, ""), "^&+", "")
    bare = F.regexp_replace(host(url), ":(80|443)?$", "")
    joined = F.concat(bare, F.regexp_replace(path(url), "/+$", ""), F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query)))
    return F.when(bare != "", joined)


def _resolved(link: Column, host: Column, path: Column) -> Column:
    """The url that a link of a page leads to, null for other schemes and for links without a base. Dot segments stay as they are."""
    link = F.replace(F.trim(link), F.lit("&amp;"), F.lit("&"))
    base = F.concat(F.lit("http://"), host)
    folder = F.regexp_replace(path, "[^/]*$", "")
    relative = F.when(link.startswith("/"), F.concat(base, link)).when(link.startswith("?"), F.concat(base, path, link))
    relative = relative.otherwise(F.concat(base, F.when(folder == "", F.lit("/")).otherwise(folder), link))
    return (
        F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(F.lit("http:"), link))
        .when((link == "") | link.startswith("#") | link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:") | (host == ""), F.lit(None))
        .otherwise(relative)
    )


def links(html: Column, host: Column, path: Column) -> Column:
    """The urls of a page's canonical links and refresh redirects, in order, outside comments, scripts and styles."""
    tags = F.regexp_extract_all(F.regexp_replace(html, UNSEEN, " "), F.lit(TAGS), F.lit(0))

    def target(tag: Column) -> Column:
        href = F.concat(*(F.regexp_extract(tag, HREF, k) for k in (1, 2, 3)))
        refreshed = F.regexp_extract(tag, REFRESH_URL, 1)
        return F.when(tag.rlike(CANONICAL), href).when(tag.rlike(REFRESH), refreshed)

    found = F.array_compact(F.transform(F.array_compact(F.transform(tags, target)), lambda link: _resolved(link, host, path)))
    # most pages have neither word, and need not be searched
    named = F.lower(html)
    return F.when(named.contains("canonical") | named.contains("refresh"), found).otherwise(F.array().cast("array<string>"))


def _spread(blocked: DataFrame, allowed: DataFrame, edges: DataFrame) -> DataFrame:
    """The addresses (column node) in a component with a blocked one, less those allowed."""
    rooted = settle(components(edges), "alias-roots")
    own = blocked.distinct()
    reached = own.join(rooted, "node", "left").select(F.coalesce("root", "node").alias("root")).distinct()
    members = reached.join(rooted, "root").select("node")
    return members.unionByName(own).distinct().join(allowed.distinct(), "node", "left_anti")


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, *, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages``.

    ``rules`` are a list in the program, so they are one expression in the plan. The verdict
    is that of the page's own rule; else ``allow`` if a rule allows another form of the same
    address; else ``block`` if a rule blocks an address of the component, be it a page
    or only the target of a link; else ``allow``.

    A null url, or one without ``://``, has empty host and path and no rule; its page stands
    at the address of its first link, if it has any. Null html has no links. Repeated
    rows and null ids are rows like any other. Other columns are not read; an empty table
    gives an empty result.

    Pages are read once; what is written and shuffled has no html. Only rows without a rule
    are joined, with the distinct blocked addresses, so a hot address is split by
    adaptive execution on the side of the pages.
    """
    address_of = F.col(f"`{url}`")
    read = pages.select(F.col(f"`{key}`").alias("page_id"), address_of.alias("url"), F.col(f"`{html}`").alias("html"))
    read = read.select("page_id", "url", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), "html")
    judged = read.select("page_id", "host", "path", fitting(rules, F.col("host"), F.col("path")).alias("own"), address(F.col("url")).alias("at"),
                         links(F.col("html"), F.col("host"), F.col("path")).alias("links"))
    judged = settle(judged, "judged-pages")
    linked = judged.where(F.size("links") > 0).select("at", F.explode("links").alias("link"), F.col("links")[0].alias("first"))
    ends = linked.select(F.coalesce("at", address(F.col("first"))).alias("a"), address(F.col("link")).alias("b"), "link").where("a IS NOT NULL AND b IS NOT NULL")
    # targets are judged by rules too, whether they are pages of the table or not
    targets = ends.select(F.col("b").alias("node"), fitting(rules, host(F.col("link")), path(F.col("link"))).alias("own"))
    stands = F.coalesce("at", F.when(F.size("links") > 0, address(F.get("links", F.lit(0))))).alias("node")
    decided = judged.where("own IS NOT NULL").select(F.col("at").alias("node"), "own").unionByName(targets.where("own IS NOT NULL")).where("node IS NOT NULL")
    blocked, allowed = (decided.where(F.col("own.verdict") == v).select("node") for v in ("block", "allow"))
    reached = settle(_spread(blocked, allowed, ends.select("a", "b")), "blocked-addresses")
    out = ["page_id", "host", "path", "rule", "verdict"]
    ruled = judged.where("own IS NOT NULL").select("page_id", "host", "path", "own.rule", "own.verdict")
    free = judged.where("own IS NULL").select("page_id", "host", "path", stands).join(reached.withColumn("hit", F.lit(True)), "node", "left")
    verdict = F.when(F.col("hit"), F.lit("block")).otherwise(F.lit("allow"))
    return ruled.unionByName(free.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), verdict.alias("verdict"))).select(out)


def kept_pages(pages: DataFrame, rules: Sequence[Rule] = RULES, *, key: str = "page_id", **columns: str) -> DataFrame:
    """The rows of ``pages`` whose id has an allowed row, same columns. Rows without an id all stay or go with null ids' verdicts."""
    judged = judge(pages, rules, key=key, **columns)
    allowed = judged.where("verdict = 'allow'").select(F.col("page_id").alias("__allowed_id")).distinct()
    return pages.join(allowed, F.col(f"`{key}`").eqNullSafe(F.col("__allowed_id")), "left_semi")
