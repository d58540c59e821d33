"""URL filter with redirect equivalence.

Rules are pairs of a host and the beginning of a path; a rule fits its host and all subdomains, and
the longest fitting rule decides about a page.  Pages without a rule of their own get the decision of
their aliases: addresses that refer to each other as the same page, by a canonical link, a refresh
redirect, or a redirect parameter in the address itself.  These edges are put together by
distributed connected components; in a component an explicit allow comes before a block, and
without either the page is allowed.

Everything is SQL functions and joins.  The rules are a list in the program (one array literal), meant for up to
some hundred entries.

Results for odd input: a null address, or one without ``://``, has an empty host and path, fits no rule and has no
aliases (allow); repeated addresses share their aliases; a null document has no links; an empty table
gives an empty table; extra columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from jobtide.llm.components import connected_components
from jobtide.llm.tables import stored

# action, host, beginning of the path
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TARGET_PARAMETER = r"[?&](?:url|target|dest|redirect|redirect_uri|redirect_url)=(https?(?:%3[Aa]|:)[^&#]*)"
LINK_TAG = r"(?is)<link\b[^>]*>"
META_TAG = r"(?is)<meta\b[^>]*>"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def without_dots(path: Column) -> Column:
    """A path with its ``.`` and ``..`` segments carried out, as RFC 3986 (5.2.4) says; one that is empty is ``/``."""
    segments = F.split(F.substr(path, F.lit(2)), "/")
    none = F.array().cast("array<string>")
    up = lambda kept: F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))
    walked = F.aggregate(
        segments, none, lambda kept, s: F.when(s == ".", kept).when(s == "..", up(kept)).otherwise(F.concat(kept, F.array(s)))
    )
    ended = F.when(F.element_at(segments, -1).isin(".", ".."), F.concat(walked, F.array(F.lit("")))).otherwise(walked)
    walked = F.concat(F.lit("/"), F.array_join(ended, "/"))
    return F.when(path == "", F.lit("/")).when(path.rlike(r"/\.\.?(/|$)"), walked).otherwise(path)


def address_of(url: Column) -> Column:
    """What identifies a page: host, path without dot segments and query; no scheme, no fragment; null without ``://``."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    return F.when(host_of(url) != "", F.concat(host_of(url), without_dots(path_of(url)), query))


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits (struct of rule and action); of equal ones an allow; else null."""
    known = F.array(
        *[
            F.struct(
                F.lit(len(h) + len(p)).alias("size"),
                F.lit(action == "allow").alias("allows"),
                F.lit(h + p).alias("rule"),
                F.lit(action).alias("action"),
                F.lit(h).alias("host"),
                F.lit(p).alias("path"),
            )
            for action, h, p in rules
        ]
    )
    fits = F.filter(known, lambda r: ((host == r["host"]) | F.endswith(host, F.concat(F.lit("."), r["host"]))) & F.startswith(path, r["path"]))
    return F.array_max(fits)


def _resolved(link: Column, url: Column) -> Column:
    """A link's full address, seen from the page's, as RFC 3986 (5.2.2) says; null for schemes without a host."""
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    site = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(path_of(url), r"(?s)^(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    return (
        F.when(link == "", F.lit(None).cast("string"))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(site, link))
        .when(link.startswith("#"), url)
        .when(link.startswith("?"), F.concat(site, path_of(url), link))
        .otherwise(F.concat(site, folder, link))
    )


def _unescaped(text: Column) -> Column:
    return F.replace(F.trim(text), F.lit("&amp;"), F.lit("&"))


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): addresses that a page names as itself."""
    page, body = F.col(url), F.col(html)
    quoted = r"""(?is){}\s*=\s*["']?\s*([^"'\s>]+)"""
    links = F.transform(
        F.filter(F.regexp_extract_all(body, F.lit(LINK_TAG), F.lit(0)), lambda t: t.rlike(r"""(?is)\brel\s*=\s*["']?[^"'>]*\bcanonical\b""")),
        lambda t: F.regexp_extract(t, quoted.format(r"\bhref"), 1),
    )
    refreshes = F.transform(
        F.filter(F.regexp_extract_all(body, F.lit(META_TAG), F.lit(0)), lambda t: t.rlike(r"""(?is)\bhttp-equiv\s*=\s*["']?\s*refresh\b""")),
        lambda t: F.regexp_extract(t, r"""(?is)\burl\s*=\s*["']?\s*([^"'\s>]+)""", 1),
    )
    none = F.array().cast("array<string>")
    # most documents name neither word: a plain search spares them the patterns
    links = F.when(body.ilike("%canonical%"), links).otherwise(none)
    refreshes = F.when(body.ilike("%http-equiv%"), refreshes).otherwise(none)
    wrapped = F.filter(F.array(F.try_url_decode(F.regexp_extract(page, TARGET_PARAMETER, 1))), lambda t: t.isNotNull() & (t != ""))
    targets = F.concat(F.coalesce(links, none), F.coalesce(refreshes, none), F.coalesce(wrapped, none))
    found = pages.select(page.alias("url"), F.explode(targets).alias("link"))
    ends = found.select(address_of(F.col("url")).alias("a"), address_of(_resolved(_unescaped(F.col("link")), F.col("url"))).alias("b"))
    return ends.where("a != b").distinct()


def judge(pages: DataFrame, rules=RULES, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, host, path, rule, verdict, and ``decided_by`` (rule, alias or default)."""
    edges = stored(alias_edges(pages, url, html), "aliases")
    groups = stored(connected_components(edges).toDF("address", "component"), "groups")
    given = F.col(url)
    judged = pages.select(F.col(page_id).alias("page_id"), host_of(given).alias("host"), path_of(given).alias("path"), address_of(given).alias("address"))
    judged = judged.withColumn("own", fitting_rule(F.col("host"), F.col("path"), rules))

    # the addresses that edges lead to count too, also where no page of the table has them
    named = groups.withColumn("url", F.concat(F.lit("x://"), F.col("address")))
    acts = named.select("component", fitting_rule(host_of(F.col("url")), path_of(F.col("url")), rules)["allows"].alias("allows"))
    acts = acts.where("allows IS NOT NULL").groupBy("component").agg(F.max("allows").alias("component_allows"))
    known = stored(groups.join(acts, "component").select("address", "component_allows"), "decisions")
    inherited = judged.join(known, "address", "left")
    action = F.col("own.action")
    by_alias = F.when(F.col("component_allows"), F.lit("allow")).when(~F.col("component_allows"), F.lit("block"))
    return inherited.select(
        "page_id",
        "host",
        "path",
        F.col("own.rule").alias("rule"),
        F.coalesce(action, by_alias, F.lit("allow")).alias("verdict"),
        F.when(action.isNotNull(), "rule").when(by_alias.isNotNull(), "alias").otherwise("default").alias("decided_by"),
    )
