"""URL and page queries over ``pages``; specification tables are built from ``part``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as s
from ..operators import nested, ordering, pages
from ..operators import urls as op
from .registry import query, table

_HOST = "lower(regexp_extract(url, '^https?://([^/?#]+)', 1))"
_PATH = "regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1)"
_SITE = f"regexp_replace({_HOST}, '^www\\.', '')"
_QUERY = "coalesce(nullif(regexp_extract(url, '^[^?#]*(\\?[^#]+)', 1), ''), '')"


def _pages(spark, d):
    return table(spark, d, "pages")


@query(f"SELECT page_id, {_SITE} AS site, 'https://' || {_HOST} || {_PATH} || {_QUERY} AS canonical, 'https://' || {_HOST} || rtrim({_PATH}, '/') AS bare, CASE WHEN {_SITE} LIKE 'm.%' THEN 'WRONG_URL_SITE' END AS error FROM pages")
def url_canonical(spark, d):
    u = F.col("url")
    site = s.canonical_site(s.host(u))
    return _pages(spark, d).select("page_id", site.alias("site"), s.canonical_url(u).alias("canonical"), s.canonical_url(u, keep_query=False).alias("bare"), s.url_error(u, F.regexp_replace(site, r"^m\.", "")).alias("error"))


@query("SELECT page_id, CASE WHEN page_id % 7 = 0 AND NOT contains(url, '?') AND NOT contains(url, '#') THEN 'product' WHEN page_id % 7 = 1 THEN 'catalogue' WHEN page_id % 7 = 2 THEN 'product' ELSE 'other' END AS kind FROM pages")
def url_classify(spark, d):
    """Addresses of known shapes made from page ids; the first keeps the page's query and fragment."""
    k = F.col("page_id")
    tail = F.regexp_extract("url", r"^[^?#]*(.*)$", 1)
    text = k.cast("string")
    u = (
        F.when(k % 7 == 0, F.concat(F.lit("https://www.gsmarena.com/apple_iphone-"), text, F.lit(".php"), tail)).when(k % 7 == 1, F.concat(F.lit("http://gsmarena.com/apple-phones-"), text, F.lit(".php")))
        .when(k % 7 == 2, F.concat(F.lit("https://mega.pk/mobiles_products/"), text, F.lit("/a-b.html"))).when(k % 7 == 3, F.concat(F.lit("https://gsmarena.com/apple_x-review-"), text, F.lit(".php")))
        .when(k % 7 == 4, F.concat(F.lit("https://gsmarena.com/apple-"), text, F.lit(".php"))).otherwise(F.col("url"))
    )
    return _pages(spark, d).select("page_id", op.classify(u).alias("kind"))


@query(f"SELECT page_id, lower(regexp_extract({_PATH}, '(?i)(en|de)', 1)) AS keyword FROM pages WHERE regexp_matches({_PATH}, '(?i)(en|de)')")
def url_keyword_flat(spark, d):
    return _pages(spark, d).select("page_id", op.keyword(s.url_path(F.col("url")), ["en", "de"]).alias("keyword")).filter("keyword IS NOT NULL")


_PREFIX = f"""(SELECT DISTINCT url, {_SITE} AS site, list_filter(string_split({_PATH}, '/'), lambda x: x <> '') AS parts FROM pages)"""
_NODES = f"""(SELECT array_to_string(list_prepend(site, parts[1:depth]), '/') AS node, CASE WHEN depth > 0 THEN array_to_string(list_prepend(site, parts[1:depth - 1]), '/') END AS parent, depth, min(CASE WHEN depth = len(parts) THEN url END) AS url, count(*) AS urls
  FROM (SELECT *, unnest(range(0, len(parts) + 1)) AS depth FROM {_PREFIX}) GROUP BY ALL)"""


@query(f"SELECT n.node, n.parent, n.depth::INTEGER AS depth, n.url, n.urls, (SELECT count(*) FROM {_NODES} c WHERE c.parent = n.node) AS children FROM {_NODES} n")
def url_trie(spark, d):
    return op.trie(_pages(spark, d), "url")


@query(f"SELECT node, urls FROM {_NODES} WHERE depth = 1")
def urls_per_branch(spark, d):
    return op.trie(_pages(spark, d), "url").filter("depth = 1").select("node", "urls")


@query(f"SELECT node, lower(regexp_extract(regexp_extract(node, '([^/]*)$', 1), '(?i)(en|1)', 1)) AS keyword, coalesce(url, 'https://' || node) AS url, urls FROM {_NODES} WHERE (depth = 1 AND regexp_matches(regexp_extract(node, '([^/]*)$', 1), '(?i)(en|1)')) OR (depth = 2 AND regexp_matches(regexp_extract(node, '([^/]*)$', 1), '(?i)(en|1)') AND NOT regexp_matches(regexp_extract(parent, '([^/]*)$', 1), '(?i)(en|1)'))")
def url_keyword_base(spark, d):
    return op.keyword_branches(_pages(spark, d), "url", ["en", "1"])


@query(f"SELECT node, depth::INTEGER AS depth, row_number() OVER (ORDER BY string_split(node, '/')) AS position FROM {_NODES}")
def tree_flatten(spark, d):
    """Nodes in pre-order, numbered without a single-partition window."""
    nodes = op.walk(op.trie(_pages(spark, d), "url"))
    return ordering.positions(nodes, ["order_key"]).select("node", "depth", "position")


@query(f"""WITH n AS (SELECT split_part(node, '/', 1) AS site, string_split(node, '/') AS place, node, depth, url FROM {_NODES}),
p AS (SELECT *, row_number() OVER (PARTITION BY site ORDER BY place)::INTEGER AS position FROM n)
SELECT p.site, p.position, u.position AS parent, p.depth::INTEGER AS depth, p.place[-1] AS name, p.url FROM p LEFT JOIN p u ON u.node = array_to_string(p.place[:-2], '/') AND p.depth > 0""")
def tree_walk(spark, d):
    """Every site's addresses as one nested JSON tree, walked again: place, parent and depth of each node."""
    trees = op.nested_tree(op.trie(_pages(spark, d), "url"))
    text = lambda k: F.try_variant_get("node", f"$.{k}", "string").alias(k)
    return nested.walk_tree(trees, "site", "tree").select("site", "position", "parent", "depth", text("name"), text("url"))


@query("SELECT page_id, position FROM (SELECT page_id, row_number() OVER (ORDER BY url, page_id) AS position FROM pages) WHERE position BETWEEN 101 AND 180")
def url_range(spark, d):
    """Positions 101 to 180: a range operator."""
    return ordering.position_range(_pages(spark, d).select("page_id", "url"), ["url", "page_id"], 101, limit=80).select("page_id", "position")


@query("""WITH u AS (SELECT 'https://mega.pk/mobiles_products/' || (page_id % 100) || '/a.html' AS u FROM pages WHERE page_id % 2 = 0 UNION ALL SELECT 'https://mega.pk/about/' || page_id FROM pages WHERE page_id % 2 = 1 UNION ALL SELECT NULL FROM pages WHERE page_id % 10 = 0), e AS (SELECT u, count(*) AS n FROM u GROUP BY u)
SELECT sum(n)::BIGINT AS seen, sum(CASE WHEN u IS NOT NULL THEN n - 1 ELSE 0 END)::BIGINT AS duplicates, sum(CASE WHEN u IS NULL THEN n WHEN contains(u, 'about') THEN 1 ELSE 0 END)::BIGINT AS rejected, count(*) FILTER (u NOT LIKE '%about%') AS selected, count(*) FILTER (u LIKE '%/4/%') AS already_complete FROM e""")
def manifest_stats(spark, d):
    p = _pages(spark, d)
    good = p.filter("page_id % 2 = 0").select(F.concat(F.lit("https://mega.pk/mobiles_products/"), (F.col("page_id") % 100).cast("string"), F.lit("/a.html")).alias("url"))
    bad = p.filter("page_id % 2 = 1").select(F.concat(F.lit("https://mega.pk/about/"), F.col("page_id").cast("string")).alias("url"))
    none = p.filter("page_id % 10 = 0").select(F.lit("not a url").alias("url"))
    done = good.filter(F.col("url").contains("/4/"))
    return op.manifest_stats(good.unionByName(bad).unionByName(none), "url", done)


@query("SELECT href, min(page_id * 1000 + i)::BIGINT AS position FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a [^>]*href=\"([^\"]+)\"', 1)) AS href, generate_subscripts(regexp_extract_all(html, '<a [^>]*href=\"([^\"]+)\"', 1), 1) - 1 AS i FROM pages) GROUP BY href")
def url_distinct(spark, d):
    """Distinct links by first place."""
    found = op.links(_pages(spark, d), "page_id", "html").withColumn("position", F.col("page_id") * 1000 + F.col("position"))
    return op.ordered_distinct(found, "href", "position")


@query(f"SELECT page_id, regexp_extract({_PATH}, '([^/]*)/*$', 1) || '.json' AS file, 'https://x.example/' || regexp_extract({_PATH}, '([^/]*)/*$', 1) AS url FROM pages")
def url_to_file(spark, d):
    name = s.file_from_url(F.col("url"))
    return _pages(spark, d).select("page_id", name.alias("file"), s.url_from_file(name, F.lit("https://x.example/")).alias("url"))


@query("SELECT 'maker' || (page_id % 5) AS slug, (page_id % 5)::BIGINT AS id, count(*) AS addresses FROM pages WHERE page_id % 5 IN (1, 3) GROUP BY ALL")
def catalogue_select(spark, d):
    """Plain and paged catalogue addresses of chosen makers."""
    k = (F.col("page_id") % 5).cast("string")
    u = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("https://gsmarena.com/maker"), k, F.lit("-phones-"), k, F.lit(".php"))).otherwise(F.concat(F.lit("https://gsmarena.com/maker"), k, F.lit("-phones-f-"), k, F.lit("-0-p2.php")))
    m = _pages(spark, d).select(op.maker(u).alias("m")).select("m.slug", "m.id")
    return m.filter(F.col("slug").isin("maker1") | F.col("id").isin(3)).groupBy("slug", "id").agg(F.count("*").alias("addresses"))


@query("SELECT page_id, trim(regexp_replace(regexp_extract(html, '<title[^>]*>([^<]*)</title>', 1), '\\s+', ' ', 'g')) AS title, len(regexp_extract_all(html, '<a [^>]*href=\"([^\"]+)\"')) AS links FROM pages WHERE contains(html, '<title')")
def page_title_links(spark, d):
    found = op.links(_pages(spark, d), "page_id", "html").groupBy("page_id").agg(F.count("*").alias("links"))
    p = _pages(spark, d).select("page_id", F.coalesce(pages.title(F.col("html")), F.lit("")).alias("title")).filter(F.col("title").isNotNull())
    return p.join(found, "page_id", "left").withColumn("links", F.coalesce("links", F.lit(0).cast("long")))


def _spec_pages(spark, d):
    """A page for each part: two sections, one of them given by three-cell rows that later rows carry on."""
    part = table(spark, d, "part")
    k = F.col("p_partkey").cast("string")
    return part.select("p_partkey", F.concat(
        F.lit("<html><h2>General</h2><table><tr><td>Brand is</td><td>"), F.col("p_brand"), F.lit("</td></tr></table><h2>More</h2><table><tr><th>Body</th><td>Size</td><td>"), F.col("p_size").cast("string"),
        F.lit("</td></tr><tr><td></td><td data-spec='kind'>"), F.col("p_type"), F.lit("</td></tr></table>"), F.lit('<script type="application/ld+json">{"@type":"Product","name":"'), F.col("p_name"),
        F.lit('","offers":{"price":"'), F.when(F.col("p_partkey") % 2 == 0, k).otherwise("1,"), F.when(F.col("p_partkey") % 2 == 0, "").otherwise("500"), F.lit('"}}</script><span>Rs 5</span></html>'),
    ).alias("html"))


@query("""SELECT p_partkey, 0 AS position, 'General' AS section, 'Brand is' AS label, p_brand AS value FROM part UNION ALL SELECT p_partkey, 1, 'Body', 'Size', CAST(p_size AS VARCHAR) FROM part UNION ALL SELECT p_partkey, 2, 'Body', 'kind', p_type FROM part""")
def spec_rows(spark, d):
    return pages.spec_rows(_spec_pages(spark, d), "p_partkey", "html")


@query("SELECT p_partkey, p_brand AS maker, CAST(p_size AS VARCHAR) AS size, p_type AS kind FROM part")
def spec_pivot(spark, d):
    rows = pages.spec_rows(_spec_pages(spark, d), "p_partkey", "html")
    alias = spark.createDataFrame([("brand", "maker")], "alias string, name string")
    return pages.pivot_specs(pages.label_aliases(rows, alias), "p_partkey", ["maker", "size", "kind"])


@query("SELECT p_partkey, p_name AS name, CASE WHEN p_partkey % 2 = 0 THEN p_partkey ELSE 1500 END::DOUBLE AS price FROM part")
def jsonld_price(spark, d):
    h = F.col("html")
    return _spec_pages(spark, d).select("p_partkey", pages.json_ld(h)["name"].alias("name"), pages.page_price(h).alias("price"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 6 < 5 THEN p_name END AS name, CASE p_partkey % 6 WHEN 4 THEN p_size + 0.5 WHEN 5 THEN NULL ELSE p_size END::DOUBLE AS price FROM part""")
def jsonld_shapes(spark, d):
    """Embedded products alone, in a list, in a graph, deep in an object, after one without an offer; and none."""
    part = table(spark, d, "part")
    k, size = F.col("p_partkey") % 6, F.col("p_size").cast("string")
    product = lambda kind, offers: F.concat(F.lit(f'{{"@type":{kind},"name":"'), F.col("p_name"), F.lit('"'), F.lit(',"offers":'), offers, F.lit("}"))
    price = lambda name, tail="": F.concat(F.lit(f'{{"{name}":'), size, F.lit(f"{tail}}}"))
    other = F.lit('{"@type":"BreadcrumbList","itemListElement":[{"@type":"ListItem","name":"none"}]}')
    bare = F.lit('{"@type":"product","name":"bare"}')
    body = (
        F.when(k == 0, product('"Product"', price("price"))).when(k == 1, F.concat(F.lit("["), other, F.lit(","), product('"PRODUCT"', F.concat(F.lit("["), price("lowPrice"), F.lit("]"))), F.lit("]")))
        .when(k == 2, F.concat(F.lit('{"@context":"x","@graph":['), other, F.lit(","), bare, F.lit(","), product('["Thing","Product"]', price("price")), F.lit("]}")))
        .when(k == 3, F.concat(F.lit('{"@type":"WebPage","mainEntity":{"about":[['), product('"Product"', F.concat(F.lit('[{"price":null},'), price("price"), F.lit("]"))), F.lit("]]}}")))
        .when(k == 4, F.concat(F.lit('{broken</script><script type="application/ld+json">'), product('"Product"', price("price", ".5")))).otherwise(other)
    )
    html = F.concat(F.lit('<script type="application/ld+json">'), body, F.lit("</script>"))
    found = pages.json_ld(html)
    return part.select("p_partkey", found["name"].alias("name"), found["price"].alias("price"))


@query("""SELECT c_custkey, x AS canonical, sha256(x) AS canonical_sha256 FROM (SELECT c_custkey, '{"Z":null,"a":[{"b":[],"k":' || c_custkey || '},' || c_nationkey || '.0,"' || c_name || '"],"é":{"":true,"B":{"x":1,"y":{}},"b":"' || c_mktsegment || '"}}' AS x FROM customer)""")
def canonical_json(spark, d):
    """Nested objects in disorder, in order."""
    c = table(spark, d, "customer")
    text = lambda x: F.col(x).cast("string")
    raw = F.concat(F.lit(' {"é": {"b" : "'), F.col("c_mktsegment"), F.lit('", "B":{"y":{},"x":1}, "":true},\n"a":[{"k":'), text("c_custkey"), F.lit(',"b":[ ]},'), text("c_nationkey"), F.lit('.0,"'), F.col("c_name"), F.lit('"],"Z":1,"Z":null}'))
    canonical = nested.canonical_json(raw)
    return c.select("c_custkey", canonical.alias("canonical"), F.sha2(canonical.cast("binary"), 256).alias("canonical_sha256"))


@query("""SELECT o_orderkey, o_custkey, coalesce(last_value(nullif(CASE WHEN o_orderkey % 4 = 0 THEN o_orderstatus END, '') IGNORE NULLS) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING), 'none') AS section FROM orders""")
def section_carry_forward(spark, d):
    """Group labels of some rows carried to those after them."""
    rows = table(spark, d, "orders").select("o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderstatus")).alias("own"), F.lit("none").alias("heading"))
    return pages.carry_section(rows, "o_custkey", "o_orderkey").select("o_orderkey", "o_custkey", "section")
