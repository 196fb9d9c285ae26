"""Operator 10: URL filters that follow redirects and canonical links.

Host and path rules judge a URL itself; the longest rule that fits wins.  A
page that no rule fits takes the verdict of its aliases: the connected
component of its URL over canonical links, refresh redirects and given
redirect edges.  Aliases with an explicit allow come before blocked ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .scratch import Scratch

Rule = tuple[str, str, str]      # host, path prefix, 'allow' or 'block'
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

RULES: tuple[Rule, ...] = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
                           ("com", "/fr/", "allow"), ("com", "/de/", "block"))


AFTER = r"(?s)^.*?://"          # up to the first '://'


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, AFTER + r"([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, AFTER + r"[^/?#]*([^?#]*)", 1), F.lit(""))


def without_dots(path: Column) -> Column:
    """``path`` with its '.' and '..' segments resolved."""
    none = F.array().cast("array<string>")
    folder = F.when(path.rlike(r"/\.\.?$"), F.array(F.lit(""))).otherwise(none)      # a dot at the end names a folder
    parts = F.concat(F.slice(F.split(path, "/"), 2, F.length(path)), folder)
    kept = F.aggregate(parts, none, lambda out, x: F.when(
        x == "..", F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0)))).when(x == ".", out).otherwise(F.concat(out, F.array(x))))
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(F.lit("/"), F.array_join(kept, "/"))).otherwise(path)


def key_of(url: Column) -> Column:
    """What names a page: host, path ('/' if empty, dots resolved) and query,
    without scheme and fragment; null where there is no host."""
    query = F.regexp_extract(url, AFTER + r"[^?#]*(\?[^#]*)?", 1)
    path = without_dots(F.regexp_replace(path_of(url), "^$", "/"))
    return F.nullif(F.concat(host_of(url), path, query), F.concat(F.lit("/"), query))


def _longest(rules: tuple[Rule, ...], host: Column, path: Column, value) -> Column:
    out = F.lit(None).cast("string")
    for h, p, action in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.lit(value(h, p, action))).otherwise(out)
    return out


def link_edges(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """``(a, b)`` page keys that canonical links and refresh tags equate."""
    tags = F.filter(F.regexp_extract_all(F.col(html_col), F.lit(r"(?i)<(?:link|meta)\b[^>]*>"), 0), lambda t: t.rlike(
        r"""(?i)\brel\s*=\s*(?:"(?:[^"]*\s)?canonical[\s"]|'(?:[^']*\s)?canonical[\s']|canonical[\s/>])|\bhttp-equiv\s*=\s*["']?\s*refresh\b"""))
    tag = pages.select(F.col(url_col).alias("url"), F.explode(tags).alias("tag"))
    href = F.regexp_extract("tag", r"""(?i)\bhref\s*=\s*["']?\s*([^"'\s>]+)""", 1)
    moved = F.regexp_extract("tag", r"""(?i)\burl\s*=\s*["']?\s*([^"'\s>]+)""", 1)
    target = F.when(href != "", href).otherwise(moved)
    target = F.regexp_replace(target, "(?i)&(?:amp|#38|#x26);", "&")
    tag = tag.select("url", target.alias("to")).where("to <> ''")
    scheme, host = F.regexp_extract("url", r"^(.*?)://", 1), host_of(F.col("url"))
    folder = F.regexp_extract(path_of(F.col("url")), r"^(.*/)", 1)
    folder = F.when(folder == "", "/").otherwise(folder)
    full = (F.when(F.col("to").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), F.col("to"))
            .when(F.col("to").startswith("#"), F.col("url"))
            .when(F.col("to").startswith("?"), F.concat(scheme, F.lit("://"), host, path_of(F.col("url")), F.col("to")))
            .when(F.col("to").startswith("//"), F.concat(scheme, F.lit(":"), F.col("to")))
            .when(F.col("to").startswith("/"), F.concat(scheme, F.lit("://"), host, F.col("to")))
            .otherwise(F.concat(scheme, F.lit("://"), host, folder, F.col("to"))))
    ends = F.transform(F.array("url", full), key_of)
    return tag.select(ends[0].alias("a"), ends[1].alias("b")).where("a is not null and b is not null")


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, redirects: DataFrame | None = None,
               id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``pages``: ``page_id, host, path, rule, verdict``.

    ``redirects`` may add edges ``(src, dst)`` of URLs.  A rule fits its host
    and all subdomains when the path starts with the rule's; of rules of equal
    length the one later in the list wins.  With no rule of its own a page is
    allowed if an alias (page or link target) is explicitly allowed, else
    blocked if one is blocked, else allowed.  A null URL or one without '://'
    has empty host and path, no aliases and no rule; null html has no links.
    Repeated rows give repeated results; other columns are ignored; an empty
    table gives no rows.  Rules are a literal list, for up to some thousands."""
    scratch = Scratch(pages.sparkSession, "url-filter")
    edges = link_edges(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.union(redirects.select(key_of(F.col("src")), key_of(F.col("dst"))).where(
            "src is not null and dst is not null"))
    comps = scratch.save(connected_components(edges, scratch), "components")
    url = F.col(url_col)
    judged = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"),
                          key_of(url).alias("key"))
    name = lambda h, p, _: h + p            # noqa: E731
    action = lambda _h, _p, a: a            # noqa: E731
    judged = judged.select("id", "host", "path", "key", _longest(rules, F.col("host"), F.col("path"), name).alias("rule"),
                           _longest(rules, F.col("host"), F.col("path"), action).alias("own"))
    if comps.isEmpty():
        judged = judged.withColumn("alias", F.lit(None).cast("string"))
    else:
        node = F.concat(F.lit("x://"), F.col("node"))
        by = comps.withColumn("own", _longest(rules, host_of(node), path_of(node), action))
        groups = by.groupBy("component").agg(F.min("own").alias("alias"))      # 'allow' before 'block'
        judged = judged.join(comps.join(groups, "component").select(F.col("node").alias("key"), "alias"), "key", "left")
    return judged.select(F.col("id").alias(id_col), "host", "path", "rule",
                         F.coalesce("own", "alias", F.lit("allow")).alias("verdict"))
