"""Allow and block rules for urls, and what redirects make of them.

A rule is a host and the start of a path. It fits a url whose host is the rule's or below
it and whose path starts with the rule's; of the rules that fit, the longest decides, and
of equally long ones an allow rule.

Urls that redirect to each other or name one another as canonical are aliases: edges
between urls, whose connected components are found over all pages at once. A block rule
that decides on one alias blocks all aliases on which no rule decides; an alias that a
rule allows stays allowed.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import given, saved
from daybook.llm.graph import connected_components

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty
    for a url that is null or has none."""
    found = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty like the host."""
    found = F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(found, F.lit(""))


def address_of(url: Column) -> Column:
    """What names a page: host, path and query, without scheme and fragment; null if the url
    has no ``://``."""
    rest = F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^#]*)", 1)
    return F.when(F.contains(url, F.lit("://")), F.concat(host_of(url), rest))


def rule_table(rules: DataFrame) -> DataFrame:
    """``rules (rule, action)`` with host and path; of rules that repeat, an allow rule holds."""
    rows = rules.where("rule IS NOT NULL AND action IS NOT NULL").groupBy("rule").agg(
        F.min("action").alias("action")
    )
    host = F.translate(F.substring_index("rule", "/", 1), UPPER, LOWER)
    path = F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)")
    return rows.select("rule", "action", host.alias("rule_host"), path.alias("rule_path"))


def decided(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls (address, host, path)``, distinct, with the ``rule`` and ``action`` that decide.

    A url looks up its host and the domains above it, as many labels as rules have, so it is
    matched by an equi-join however many rules there are.
    """
    rules = rule_table(rules)
    labels = F.size(F.split("rule_host", r"\."))
    deepest = F.coalesce(rules.agg(F.max(labels)).scalar(), F.lit(1))
    depths = F.sequence(F.lit(1), F.least(deepest, F.size(F.split("host", r"\."))))
    looked = urls.select("address", "host", "path", F.explode(depths).alias("depth"))
    looked = looked.withColumn("domain", F.expr("substring_index(host, '.', -depth)"))
    fits = looked.join(rules, F.col("domain") == F.col("rule_host")).where(
        F.expr("startswith(path, rule_path)")
    )
    order = F.struct(F.length("rule"), F.col("action") == ALLOW, F.col("rule"))
    best = fits.groupBy("address").agg(
        F.max_by("rule", order).alias("rule"), F.max_by("action", order).alias("action")
    )
    best = best.withColumnRenamed("address", "_address")
    return urls.join(best, F.col("address") == F.col("_address"), "left").drop("_address")


# --- links --------------------------------------------------------------------


def absolute() -> Column:
    """``target``, a link on a page, as a url; null where it leads nowhere. ``page`` is the
    page's url without query, ``origin`` its scheme and host."""
    target = F.col("target")
    folder = F.regexp_extract("page", r"(?s)\A(.*/)", 1)
    folder = F.when(F.col("page") == F.col("origin"), F.concat("page", F.lit("/"))).otherwise(folder)
    return (
        F.when(target.rlike(r"(?i)\Ahttps?://"), target)
        .when(target.startswith("//"), F.concat("scheme", F.lit(":"), target))
        .when(target.rlike(r"\A([A-Za-z][A-Za-z0-9+.-]*:|#)"), F.lit(None))
        .when(target.startswith("/"), F.concat("origin", target))
        .when(target.startswith("?"), F.concat("page", target))
        .otherwise(F.concat(folder, target))
    )


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(a, b)``: addresses of pages and of what they name as canonical or refresh to.

    Reads ``<link rel="canonical" href="...">`` and ``<meta http-equiv="refresh"
    content="0; url=...">``, attributes in any order and quotes, outside comments and scripts.
    """
    named = pages.where(F.col(html).rlike(r"(?i)canonical|http-equiv")).select(url, html)
    clean = F.regexp_replace(html, r"(?is)<!--.*?-->|<script\b.*?</script\s*>", "")
    tags = F.expr("regexp_extract_all(clean, '(?is)<(?:link|meta)\\\\b[^>]*>', 0)")
    rows = named.withColumn("clean", clean).select(url, F.explode(tags).alias("tag"))

    def attribute(name: str) -> Column:
        return F.regexp_extract("tag", rf"""(?is)\s{name}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", 1)

    rows = rows.select(url, "tag", *[attribute(n).alias(f"_{n}") for n in ("rel", "href", "http-equiv", "content")])
    is_link = F.col("tag").rlike(r"(?i)\A<link") & F.col("_rel").rlike(r"(?i)(\A|[\s\"'])canonical(\z|[\s\"'])")
    is_refresh = F.col("tag").rlike(r"(?i)\A<meta") & F.col("_http-equiv").rlike(
        r"""(?i)\A["']?\s*refresh\s*["']?\z"""
    )
    there = F.regexp_extract("_content", r"""(?is)\burl\s*=\s*["']?([^"']*)""", 1)
    target = F.when(is_link, F.regexp_replace("_href", r"""\A["']|["']\z""", "")).when(is_refresh, there)
    rows = rows.select(url, F.regexp_replace(F.trim(target), "&amp;", "&").alias("target"))
    rows = rows.where("target <> ''").withColumns(
        {
            "scheme": F.regexp_extract(url, r"(?s)\A(.*?)://", 1),
            "origin": F.regexp_extract(url, r"(?s)\A(.*?://[^/?#]*)", 1),
            "page": F.regexp_extract(url, r"(?s)\A(.*?://[^?#]*)", 1),
        }
    )
    links = rows.select(address_of(F.col(url)).alias("a"), absolute().alias("to"))
    links = links.select("a", address_of(F.col("to")).alias("b"))
    return links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")


def judged(
    pages: DataFrame,
    rules: DataFrame,
    redirects: DataFrame | None = None,
    url: str = "url",
    html: str | None = "html",
) -> DataFrame:
    """``pages`` with ``host``, ``path``, the deciding ``rule`` or null, and the ``verdict``.

    ``rules (rule, action)`` like ``("example.com/en/", "block")``; ``redirects (from, to)``
    are urls; edges also come from the pages' ``html``. Links to pages that are not in the
    table count: an alias there may be the blocked one. A page with a null url or one without
    ``://`` is on no host, has no alias and is allowed, as is what no rule and no alias blocks.
    Rows that repeat are judged alike. Own columns of the added names are replaced.
    """
    added = ["host", "path", "rule", "verdict"]
    rows = given(pages, added, url=F.col(url), address=address_of(F.col(url)))
    edges = pages.sparkSession.createDataFrame([], "a string, b string")
    if html is not None:
        edges = edges.union(page_links(pages, url, html))
    if redirects is not None:
        moved = redirects.select(
            address_of(F.col("from")).alias("a"), address_of(F.col("to")).alias("b")
        )
        edges = edges.union(moved.where("a IS NOT NULL AND b IS NOT NULL AND a <> b"))
    parts = saved(connected_components(edges), "aliases")
    known = rows.where("address IS NOT NULL").select("address")
    known = known.union(parts.select("node")).distinct()
    # an address is a host and what follows, so it has the url's host and path
    place = F.concat(F.lit("http://"), F.col("address"))
    urls = known.select("address", host_of(place).alias("host"), path_of(place).alias("path"))
    verdicts = decided(urls, rules).join(parts, F.col("address") == F.col("node"), "left")
    verdicts = saved(verdicts.select("address", "rule", "action", "component"), "verdicts")
    blocked = verdicts.where((F.col("action") == BLOCK) & F.col("component").isNotNull())
    blocked = blocked.select(F.col("component").alias("_component")).distinct()
    blocked = blocked.withColumn("_blocked", F.lit(True))
    verdicts = verdicts.join(blocked, F.col("component") == F.col("_component"), "left")
    verdict = F.coalesce("action", F.when(F.col("_blocked"), F.lit(BLOCK)), F.lit(ALLOW))
    verdicts = verdicts.select(F.col("address").alias("of"), "rule", verdict.alias("verdict"))
    out = rows.join(verdicts, F.col("address") == F.col("of"), "left")
    return out.select(
        "given.*",
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        "rule",
        F.coalesce("verdict", F.lit(ALLOW)).alias("verdict"),
    )


def rules_of(spark, allow: Iterable[str], block: Iterable[str]) -> DataFrame:
    """A table of rules from two lists."""
    rows = [(r, ALLOW) for r in allow] + [(r, BLOCK) for r in block]
    return spark.createDataFrame(rows, "rule string, action string")
