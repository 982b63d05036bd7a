"""URL filters by redirect equivalence, in DataFrame operations only.

A url is judged by the longest rule that fits it. Urls that redirects and canonical links connect are one page under
several names: connected components over those edges carry a block to every alias that no rule decides, unless a
member of the component is explicitly allowed - an allow rule goes before a block that is merely passed on.

Edges come from the pages themselves: ``<link rel=canonical href=...>`` and ``<meta http-equiv=refresh content="0;
url=...">``, and every url has one to its canonical form (https, without tracking parameters and closing slash), so that urls
with one form are aliases; a crawler's own list of redirects can be added. Fragments don't tell urls apart. A url that is null or
has no ``://`` has an empty host and path, fits no rule, has no edges and is allowed. Rows that repeat, in pages or in
edges, change nothing; further columns are ignored; no pages give no verdicts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyguard.llm.common import HEAVY, checkpoint, semi_join
from tallyguard.llm.components import connected_components

#: (verdict, host, path): the rules of the query.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def key(url: Column) -> Column:
    """The name by which equal urls meet: no fragment, scheme and host in lower case; null without ``://``."""
    bare = F.regexp_replace(url, r"(?s)#.*$", "")
    scheme = F.translate(F.regexp_extract(bare, r"(?s)^(.*?)://", 1), UPPER, LOWER)
    rest = F.regexp_extract(bare, r"(?s)^.*?://[^/?#]*(.*)$", 1)
    return F.when(F.contains(bare, F.lit("://")), F.concat(scheme, F.lit("://"), host(bare), F.when(rest == "", "/").otherwise(rest)))


def canonical(key_: Column) -> Column:
    """The canonical form of a key: https for http, no tracking parameters, no closing slash behind a path."""
    bare = F.regexp_replace(F.regexp_replace(key_, r"(?s)^http://", "https://"), r"(?s)([?&])(?:utm_[a-z]+|gclid|fbclid)=[^&]*", "$1")
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace(bare, r"(?s)&&+", "&"), r"(?s)\?&", "?"), r"(?s)[?&]$", "")
    return F.regexp_replace(bare, r"(?s)^([^?]*://[^?]*[^/?])/+$", "$1")


def judge(host_: Column, path_: Column, rules: tuple = RULES) -> Column:
    """(rule, verdict) of the longest rule that fits, else null. ``rules`` is a list that fits an expression."""
    fits = F.lit(None)
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        near = ((host_ == h) | F.endswith(host_, F.lit(f".{h}"))) & F.startswith(path_, F.lit(p))
        fits = F.when(near, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(fits)
    return fits


def judge_by_table(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, rule, verdict) of distinct urls under a rule table of any size: (verdict, host, path).

    Each url meets the rules of its host and of every parent domain by an equi-join.
    """
    one = urls.select("url").where("url is not null").distinct().select("url", host(F.col("url")).alias("h"), path(F.col("url")).alias("p"))
    labels = F.split("h", r"\.")
    suffix = F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))).alias("suffix")
    met = one.select("url", "p", suffix).join(rules.select(F.col("verdict").alias("v"), F.col("host").alias("suffix"), F.col("path").alias("q")), "suffix").where(F.startswith("p", F.col("q")))
    rule = F.struct((F.length("suffix") + F.length("q")).alias("n"), F.concat("suffix", "q").alias("rule"), F.col("v").alias("verdict"))
    return met.groupBy("url").agg(F.max(rule).alias("r")).select("url", "r.rule", "r.verdict")


def _resolve(page: Column, href: Column) -> Column:
    """A link's absolute url: absolute, scheme-relative, root-relative or relative to the page's folder."""
    href = F.replace(F.trim(href), F.lit("&amp;"), F.lit("&"))
    scheme, root = F.regexp_extract(page, r"(?s)^(.*?)://", 1), F.regexp_extract(page, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(page, r"(?s)^(.*?://[^/?#]*(?:/(?:[^?#]*/)?)?)", 1)
    return (
        F.when(href == "", None).when(F.contains(href, F.lit("://")), href).when(F.startswith(href, F.lit("//")), F.concat(scheme, F.lit(":"), href))
        .when(F.startswith(href, F.lit("/")), F.concat(root, href)).otherwise(F.concat(folder, F.when(F.endswith(folder, F.lit("/")), "").otherwise("/"), href))
    )


def page_edges(pages: DataFrame) -> DataFrame:
    """(a, b): the keys of urls that a canonical link or a refresh connects."""
    tags = F.filter(F.regexp_extract_all("html", F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0)), lambda t: F.rlike(t, F.lit(r"(?is)rel\s*=\s*[\"']?\s*canonical\b|http-equiv\s*=\s*[\"']?\s*refresh\b")))
    tagged = pages.where(F.col("url").isNotNull() & F.rlike("html", F.lit(r"(?i)canonical|refresh"))).select("url", F.explode(tags).alias("tag"))
    canonical = F.regexp_extract("tag", r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]*)", 1)
    refresh = F.regexp_extract("tag", r"(?is)\bcontent\s*=\s*[\"']?[^\"'>]*?url\s*=\s*['\"]?([^\"'\s>]*)", 1)
    href = F.when(F.rlike("tag", F.lit(r"(?is)^<link")), canonical).otherwise(refresh)
    return tagged.select(key(F.col("url")).alias("a"), key(_resolve(F.col("url"), href)).alias("b")).where("a is not null and b is not null and a <> b").distinct()


def blocked_aliases(edges: DataFrame, rules: tuple = RULES) -> DataFrame:
    """(key): urls of components that hold a blocked and no allowed url."""
    parts = connected_components(edges)
    judged = parts.select("node", "component", judge(host(F.col("node")), path(F.col("node")), rules)["verdict"].alias("v"))
    bad = judged.groupBy("component").agg(F.max(F.col("v") == "block").alias("block"), F.max(F.col("v") == "allow").alias("allow"), F.count("*").alias("n"))
    bad = checkpoint(bad.where(F.col("block") & ~F.coalesce("allow", F.lit(False))).select("component", "n"))
    return semi_join(parts, bad, ["component"], parts.count()).select(F.col("node").alias("key"))


def _with_alias(judged: DataFrame, bad: DataFrame, names: DataFrame) -> DataFrame:
    """``judged`` with ``alias``: is its key among ``bad``, distinct keys?

    ``names``: (a, n), each key and its rows. Keys with more than one in HEAVY of the rows are broadcast: fewer than HEAVY, and of
    HEAVY times the mean url's size in all. Their rows and those without a key stay where they are.
    """
    marked = bad.withColumn("alias", F.lit(True))
    total = names.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    heavy = checkpoint(names.where(F.col("n") * HEAVY > total).select(F.col("a").alias("key")).join(marked, "key", "left").select("key", F.coalesce("alias", F.lit(False)).alias("alias")))
    near = judged.join(F.broadcast(heavy), "key", "left")
    settled = F.col("key").isNull() | F.col("alias").isNotNull()
    far = near.where(~settled).drop("alias").join(marked, "key", "left")
    return near.where(settled).unionByName(far).withColumn("alias", F.coalesce("alias", F.lit(False)))


def filter_urls(pages: DataFrame, rules: tuple = RULES, redirects: DataFrame | None = None) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict. ``redirects``: more edges, as two columns of urls."""
    names = checkpoint(pages.select(key(F.col("url")).alias("a")).where("a is not null").groupBy("a").agg(F.count("*").alias("n")))
    edges = page_edges(pages).union(names.select("a", canonical(F.col("a")).alias("b")).where("a <> b"))
    if redirects is not None:
        a, b = redirects.columns[:2]
        edges = edges.union(redirects.select(key(F.col(a)), key(F.col(b)))).where("a is not null and b is not null")
    edges = checkpoint(edges)
    judged = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), key(F.col("url")).alias("key"))
    judged = judged.withColumn("j", judge(F.col("host"), F.col("path"), rules))
    alias = F.lit(False)
    if not edges.isEmpty():
        judged = _with_alias(judged, checkpoint(blocked_aliases(edges, rules).distinct()), names)
        alias = F.col("alias")
    verdict = F.coalesce(F.col("j.verdict"), F.when(alias, "block").otherwise("allow"))
    return judged.select("page_id", "host", "path", F.col("j.rule").alias("rule"), verdict.alias("verdict"))
