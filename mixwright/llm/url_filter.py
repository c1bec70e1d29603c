"""URL filters with redirect equivalence.

Rules judge urls by host and path. Pages that redirect to one another, name one another as canonical, or differ only in
scheme, www or m prefix, fragment or trailing mark are aliases (with another query it is another page); connected components over
those edges carry block decisions to aliases that no rule fits, and an explicit allow in a component takes precedence over its
blocks. Targets of links take part with what the rules say of them, whether they are pages of the table or not.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mixwright.llm.common import salted_join
from mixwright.llm.components import components

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
QUERY = r"(?s)^.*?://[^?#]*\?([^#]*)"
CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\burl\s*=\s*["']?([^"'\s>]+)"""


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


RULES = (UrlRule("block", "net", "/"), UrlRule("allow", "example.net", "/en/"), UrlRule("block", "example.com", "/de/"), UrlRule("allow", "org", "/fr/"))


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), URL, 1), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL, 2)


def query(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), QUERY, 1)


def alias_key(url: Column) -> Column:
    """One name for the plain variants of a url: host without www. or m., path without index page, .html or closing slash, and
    the query, if there is one. Null without a host."""
    bare = F.regexp_replace(host(url), r"^(?:www|m)\.", "")
    short = F.regexp_replace(path(url), r"(?:/index)?(?:\.html?)?/*$", "")
    return F.when(bare != "", F.concat(bare, F.lit("/"), F.regexp_replace(short, r"^/+", ""), _asking(query(url))))


def _asking(q: Column) -> Column:
    return F.when(q != "", F.concat(F.lit("?"), q)).otherwise("")


def resolved(target: Column, base: Column) -> Column:
    """``target`` of a link in the page at url ``base`` as a url with a scheme: //host/path, /path, and paths from the page's
    folder with . and .. in them. A query alone gives the page with that query, a fragment alone the page. A <base> tag isn't
    read."""
    inside = F.regexp_extract(target, "(?s)^[^?#]*", 0)
    folder = F.regexp_extract(path(base), "(?s)^.*/", 0)
    joined = F.when(inside == "", path(base)).when(inside.startswith("/"), inside).otherwise(F.concat(F.when(folder == "", "/").otherwise(folder), inside))
    step = lambda a, p: F.when(p == "..", F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))).when(p == ".", a).otherwise(F.concat(a, F.array(p)))
    walked = F.array_join(F.aggregate(F.split(F.regexp_replace(joined, "^/", ""), "/"), F.array().cast("array<string>"), step), "/")
    asked = F.when(target.rlike(r"(?s)^[^#]*\?"), F.regexp_extract(target, r"(?s)^[^?#]*\?([^#]*)", 1)).when(inside == "", query(base)).otherwise("")
    return F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), target).when(target.startswith("//"), F.concat(F.lit("http:"), target)).otherwise(F.concat(F.lit("http://"), host(base), F.lit("/"), walked, _asking(asked)))


def edges(pages: DataFrame) -> DataFrame:
    """(a, b, url): alias keys that a canonical link or a refresh redirect in a page's html joins, and the target's url. Relative
    targets are resolved against the page's url. A page names few targets, however large its html."""
    targets = F.concat(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(CANONICAL), F.lit(1)), F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(REFRESH), F.lit(1)))
    found = pages.where(F.col("html").rlike("(?i)<(?:link|meta)")).select("url", alias_key(F.col("url")).alias("a"), F.explode(targets).alias("to"))
    full = found.select("a", resolved(F.col("to"), F.col("url")).alias("url"))
    return full.select("a", alias_key(F.col("url")).alias("b"), "url").where("a is not null and b is not null and a <> b").distinct()


def judge(pages: DataFrame, links: DataFrame | None = None, rules: tuple[UrlRule, ...] = RULES) -> DataFrame:
    """``pages`` (page_id, url, html) -> page_id, host, path, rule, verdict, cause, a row for each row of ``pages``.

    ``links`` (a, b, url: alias keys, and the url of b) replaces the edges found in the html. Of the rules that fit a url the
    longest decides; among equally long ones the first by name. Urls that none fits get block if an alias is blocked and none is
    allowed, else allow. Null urls and urls without :// have an empty host and path, fit no rule, have no aliases and are
    allowed. Repeated rows are judged each; extra columns are ignored, whatever their names; an empty table gives no rows.
    """
    ordered = sorted(rules, key=lambda r: (-len(r.name), r.name))
    first = lambda value: F.coalesce(*(F.when(r.fits(F.col("host"), F.col("path")), F.lit(value(r))) for r in ordered)) if ordered else F.lit(None).cast("string")
    ruled = lambda df: df.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))}).withColumns({"rule": first(lambda r: r.name), "said": first(lambda r: r.verdict)}).drop("url")
    base = ruled(pages.select("page_id", "url", alias_key(F.col("url")).alias("key")))
    links = edges(pages) if links is None else links
    classes = components(links.select("a", "b"))
    # Pages and targets, one row an alias key, whatever their number; then one a component.
    aims = ruled(links.select(F.col("b").alias("key"), "url")).where("said is not null").select("key", "said", F.lit(False).alias("open"))
    spoken = base.where("key is not null").select("key", "said", F.col("rule").isNull().alias("open")).unionByName(aims)
    keys = spoken.groupBy("key").agg(F.max(F.col("said") == "block").alias("blocks"), F.max(F.col("said") == "allow").alias("allows"), F.max("open").alias("open"))
    known = keys.join(classes.select(F.col("node").alias("key"), "component"), "key", "left").withColumn("component", F.coalesce("component", "key"))
    decided = known.groupBy("component").agg((F.max("blocks") & ~F.coalesce(F.max("allows"), F.lit(False))).alias("blocked"))
    inherits = known.where("open").join(decided.where("blocked"), "component").select("key", "blocked")
    # A key of very many pages, all without a rule: its rows are dealt over tasks.
    open_ = base.where("said is null and key is not null")
    aliased = salted_join(open_, inherits, ["key"], F.xxhash64("page_id", "host", "path")).select("page_id", "host", "path", "rule", "said", "blocked")
    rest = open_.join(inherits, "key", "left_anti").unionByName(base.where("said is not null or key is null")).select("page_id", "host", "path", "rule", "said", F.lit(False).alias("blocked"))
    judged = aliased.unionByName(rest)
    verdict = F.coalesce("said", F.when(F.col("blocked"), F.lit("block")), F.lit("allow"))
    cause = F.when(F.col("rule").isNotNull(), "rule").when(F.col("blocked"), "alias").otherwise("default")
    return judged.select("page_id", "host", "path", "rule", verdict.alias("verdict"), cause.alias("cause"))
