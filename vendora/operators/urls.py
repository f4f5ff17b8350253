"""URL sets: rules, keywords, path trees, manifests."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as s

#: For each site, the pattern of product and of catalogue addresses; ``name`` rules look at the last path segment, ``path`` rules at the path.
RULES = (
    ("gsmarena.com", "product", "name", r"(?i)^[a-z0-9][a-z0-9_()+.,%'-]*_[a-z0-9_()+.,%'-]*-[0-9]+\.php$"),
    ("gsmarena.com", "catalogue", "name", r"(?i)^([a-z0-9][a-z0-9_()+.,%'-]*)-phones-([0-9]+)\.php$"),
    ("whatmobile.com.pk", "product", "name", r"^[A-Za-z][A-Za-z0-9']*_[A-Za-z0-9][A-Za-z0-9_]*-[A-Za-z0-9][A-Za-z0-9-]*$"),
    ("whatmobile.com.pk", "catalogue", "name", r"(?i)^(?:[A-Za-z][A-Za-z0-9']*_)?(?:Mobiles_Prices|\d+_to_\d+_Mobiles)$"),
    ("whatamobile.com.pk", "product", "path", r"(?i)^/product/[^/?#]+/?$"),
    ("whatamobile.com.pk", "catalogue", "path", r"(?i)^/product-cat/mobiles(?:/page/\d+)?/?$"),
    ("mega.pk", "product", "path", r"(?i)^/mobiles_products/\d+/[^/?#]+\.html/?$"),
    ("mega.pk", "catalogue", "path", r"(?i)^/mobiles(?:/\d+)?/?$"),
    ("daraz.pk", "product", "path", r"(?i)^/products/[^/?#]+-i\d+(?:-s\d+)?\.html/?$"),
    ("mymobile.pk", "product", "path", r"(?i)^/products/[^/?#]+/?$"),
    ("mymobile.pk", "catalogue", "path", r"(?i)^/category/[^/?#]+/?$"),
)
#: Fixed value: sites whose addresses may have a query.
WITH_QUERY = ("daraz.pk",)
#: Fixed value: words between hyphens that mark a page about a product.
NOT_PRODUCT = r"(?i)-(?:phones?|reviews?|pictures?|opinions?|prices?|videos?|related|compare|news)-"
#: Fixed value: maker and id of a paged catalogue address.
PAGED = r"(?i)^([a-z0-9][a-z0-9_()+.,%'-]*)-phones-f-([0-9]+)-[0-9]+(?:-r[0-9]+)?-p[0-9]+\.php$"


def classify(url: Column, rules=RULES, not_product: str = NOT_PRODUCT) -> Column:
    """product, catalogue or other, by the rules of the URL's site; a fragment makes it other, and so does a query where the site has none."""
    path = s.url_path(url)
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    site = s.canonical_site(s.host(url))
    out = F.when((s.url_query(url).isNotNull() & ~site.isin(*WITH_QUERY)) | s.url_fragment(url).isNotNull() | site.isNull(), "other")
    for where, kind, part, pattern in rules:
        hit = (site == where) & (name if part == "name" else path).rlike(pattern)
        if kind == "product" and part == "name":
            hit = hit & ~name.rlike(not_product)
        out = out.when(hit, kind)
    return out.otherwise("other")


def maker(url: Column) -> Column:
    """struct(slug, id) of a catalogue address, paged or not; null of others."""
    name = F.regexp_extract(s.url_path(url), r"([^/]*)$", 1)
    plain = RULES[1][3]

    def found(pattern: str) -> Column:
        return F.when(name.rlike(pattern), F.struct(F.regexp_extract(name, pattern, 1).alias("slug"), F.regexp_extract(name, pattern, 2).cast("long").alias("id")))

    return F.coalesce(found(PAGED), found(plain))


def keyword(text: Column, words: list[str]) -> Column:
    """The first of the words that the text holds, lower case, or null."""
    pattern = "(?i)(" + "|".join(map(re.escape, words)) + ")"
    return F.when(text.rlike(pattern), F.lower(F.regexp_extract(text, pattern, 1)))


def prefixes(df: DataFrame, url: str) -> DataFrame:
    """``df`` with one row for each path prefix: node, parent, depth, is_last."""
    site = s.canonical_site(s.host(F.col(url)))
    parts = F.filter(F.split(s.url_path(F.col(url)), "/"), lambda x: x != "")
    rows = df.withColumn("__site", site).withColumn("__parts", parts).withColumn("depth", F.explode(F.sequence(F.lit(0), F.size("__parts"))))
    node = lambda n: F.concat_ws("/", F.array_prepend(F.slice("__parts", 1, n), F.col("__site")))
    rows = rows.withColumn("node", node(F.col("depth"))).withColumn("parent", F.when(F.col("depth") > 0, node(F.col("depth") - 1)))
    return rows.withColumn("is_last", F.col("depth") == F.size("__parts")).drop("__site", "__parts")


def trie(df: DataFrame, url: str) -> DataFrame:
    """node, parent, depth, url (the least that ends there), urls below, children."""
    p = prefixes(df.select(url).distinct(), url)
    nodes = p.groupBy("node", "parent", "depth").agg(F.min(F.when(F.col("is_last"), F.col(url))).alias("url"), F.count("*").alias("urls"))
    kids = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("children"))
    return nodes.join(kids, "node", "left").withColumn("children", F.coalesce("children", F.lit(0)))


def keyword_branches(df: DataFrame, url: str, words: list[str]) -> DataFrame:
    """Topmost nodes whose last segment holds a keyword: node, keyword, the URL there or the node's own address, URLs in the branch."""
    nodes = trie(df, url).withColumn("keyword", keyword(F.regexp_extract("node", r"([^/]*)$", 1), words)).filter("depth > 0 AND keyword IS NOT NULL")
    split = F.split("node", "/")
    ups = nodes.filter("depth > 1").select("node", F.explode(F.transform(F.sequence(F.lit(2), F.col("depth")), lambda i: F.concat_ws("/", F.slice(split, 1, i)))).alias("up"))
    inner = ups.join(nodes.select(F.col("node").alias("up")), "up", "left_semi").select("node").distinct()
    top = nodes.join(inner, "node", "left_anti")
    return top.select("node", "keyword", F.coalesce("url", F.concat(F.lit("https://"), F.col("node"))).alias("url"), "urls")


def nested_tree(nodes: DataFrame) -> DataFrame:
    """site, tree: the nodes of :func:`trie` as one JSON tree for each site, children by name; of a node name, url if one ends there, children if there are any."""
    name, url = F.regexp_extract("node", r"([^/]*)$", 1), F.col("url")
    field = lambda k, v: F.when(v.isNotNull(), F.concat(F.lit(f'"{k}":'), v))
    quoted = lambda c: F.regexp_extract(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", 1)
    below = None
    for depth in range(nodes.agg(F.max("depth")).first()[0] or 0, -1, -1):  # the depth of an address
        here = nodes.filter(F.col("depth") == depth)
        here = here.join(below, "node", "left") if below is not None else here.withColumn("kids", F.lit(None).cast("string"))
        own = F.concat(F.lit("{"), F.concat_ws(",", field("name", quoted(name)), field("url", F.when(url.isNotNull(), quoted(url))), field("children", F.col("kids"))), F.lit("}"))
        rows = F.transform(F.array_sort(F.collect_list(F.struct(name.alias("name"), own.alias("own")))), lambda x: x["own"])
        if depth:
            below = here.groupBy(F.col("parent").alias("node")).agg(F.concat(F.lit("["), F.concat_ws(",", rows), F.lit("]")).alias("kids"))
    return here.select(F.col("node").alias("site"), own.alias("tree"))


def walk(nodes: DataFrame) -> DataFrame:
    """Nodes with their pre-order sort key: the path itself, segment by segment."""
    return nodes.withColumn("order_key", F.split("node", "/"))


def ordered_distinct(df: DataFrame, url: str, position: str) -> DataFrame:
    return df.groupBy(url).agg(F.min(position).alias(position))


def manifest_stats(df: DataFrame, url: str, done: DataFrame | None = None, rules=RULES, results: DataFrame | None = None) -> DataFrame:
    """Seen, duplicate, rejected, selected and already complete, from one row for each distinct URL; with ``results(url, ok)`` also ok and failed."""
    each = df.groupBy(s.canonical_url(F.col(url)).alias("u")).agg(F.count("*").alias("n"))
    each = each.withColumn("kind", classify(F.col("u"), rules))
    if done is not None:
        each = each.join(done.select(F.col(url).alias("u"), F.lit(True).alias("done")).distinct(), "u", "left")
    else:
        each = each.withColumn("done", F.lit(None).cast("boolean"))
    wanted = (F.col("kind") != "other") & F.col("u").isNotNull()
    more = []
    if results is not None:
        best = results.groupBy(F.col(url).alias("u")).agg(F.max("ok").alias("ok"))
        each = each.join(best, "u", "left")
        more = [F.count_if(wanted & F.col("ok")).alias("ok"), F.count_if(wanted & ~F.col("ok")).alias("failed")]
    return each.agg(
        F.sum("n").alias("seen"), F.sum(F.when(F.col("u").isNotNull(), F.col("n") - 1).otherwise(0)).alias("duplicates"), F.sum(F.when(F.col("u").isNull(), F.col("n")).when(~wanted, 1).otherwise(0)).alias("rejected"),
        F.count_if(wanted).alias("selected"), F.count_if(wanted & F.coalesce("done", F.lit(False))).alias("already_complete"), *more)


def links(df: DataFrame, key: str, html: str) -> DataFrame:
    """key, position, href of every link of a page, in order."""
    found = F.regexp_extract_all(F.col(html), F.lit(r'(?i)<a\b[^>]*?\bhref\s*=\s*["\']([^"\']+)["\']'), F.lit(1))
    return df.select(key, F.posexplode(found).alias("position", "href"))


def absolute(base: Column, href: Column) -> Column:
    """An address as seen from a page: absolute, from the site's root, or beside the page."""
    root = F.concat(F.lit("https://"), F.lower(s.host(base)))
    beside = F.concat(root, F.regexp_replace(s.url_path(base), r"[^/]*$", ""))
    return F.when(href.rlike("(?i)^https?://"), href).when(F.startswith(href, F.lit("//")), F.concat(F.lit("https:"), href)).when(F.startswith(href, F.lit("/")), F.concat(root, href)).otherwise(F.concat(F.when(F.endswith(beside, F.lit("/")), beside).otherwise(F.concat(beside, F.lit("/"))), href))


def discover(df: DataFrame, url: str, html: str, rules=RULES) -> DataFrame:
    """page, link, kind, position: what a catalogue page leads to, each link once and at its first place.

    kind is ``product`` for addresses that the rules call so, ``page`` for other catalogue pages of the page's own maker.
    """
    at = df.select(F.col(url).alias("page"), html)
    found = links(at, "page", html).withColumn("link", absolute(F.col("page"), F.col("href")))
    own, other = maker(F.col("page")), maker(F.col("link"))
    kind = F.when(classify(F.col("link"), rules) == "product", "product").when((own == other) & (F.col("link") != F.col("page")), "page")
    found = found.withColumn("kind", kind).filter("kind IS NOT NULL")
    return found.groupBy("page", "link", "kind").agg(F.min("position").alias("position"))
