"""Price and coverage queries: a part is a product, a supplier's nation a source, its region a currency, a line item an offer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import market as op
from ..operators.ordering import quantiles, shared_dir
from .registry import query, table

OFFERS = """(SELECT p_partkey AS product_id, p_brand AS company, p_name AS name, n_name AS source, r_name AS currency,
  CAST(l_extendedprice AS DECIMAL(14,2)) AS amount, l_shipdate AS observed_at, l_quantity AS quantity, l_orderkey, l_linenumber
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def sources(spark, d: str) -> DataFrame:
    nation = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return table(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("source"), F.col("r_name").alias("currency"))


def offers(spark, d: str) -> DataFrame:
    """One row per offer; only the columns a query uses are read."""
    line, part = table(spark, d, "lineitem"), table(spark, d, "part")
    both = line.join(part, F.col("l_partkey") == F.col("p_partkey")).join(sources(spark, d), F.col("l_suppkey") == F.col("s_suppkey"))
    return both.select(
        F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("company"), F.col("p_name").alias("name"), "source", "currency",
        F.col("l_extendedprice").cast("decimal(14,2)").alias("amount"), F.col("l_shipdate").alias("observed_at"), F.col("l_quantity").alias("quantity"), "l_orderkey", "l_linenumber",
    )


_COMPARE = """count(DISTINCT source) AS sources_count, count(*) AS total_listings, CAST(min(amount) AS DOUBLE) AS min_price,
  CAST(sum(amount) AS DOUBLE) / count(amount) AS avg_price, CAST(max(amount) AS DOUBLE) AS max_price, CAST(max(amount) AS DOUBLE) - CAST(min(amount) AS DOUBLE) AS price_spread"""


@query(f"SELECT company, currency, {_COMPARE} FROM {OFFERS} WHERE amount > 0 GROUP BY ALL")
def price_comparison(spark, d):
    return op.price_comparison(offers(spark, d), ["company", "currency"])


@query(f"SELECT product_id, company, name, currency, {_COMPARE} FROM {OFFERS} WHERE amount > 0 GROUP BY ALL")
def price_comparison_product(spark, d):
    return op.price_comparison(offers(spark, d), ["product_id", "company", "name", "currency"])


@query(f"""SELECT product_id, currency, string_agg(source || ':' || CAST(CAST(amount * 100 AS BIGINT) AS VARCHAR), ';' ORDER BY amount, source) AS detail
FROM {OFFERS} WHERE amount > 0 GROUP BY ALL""")
def price_comparison_detail(spark, d):
    out = op.offers_by_price(offers(spark, d), ["product_id", "currency"], ["source"])
    one = F.transform("offers", lambda o: F.concat(o["source"], F.lit(":"), (o["amount"] * 100).cast("long").cast("string")))
    return out.select("product_id", "currency", F.concat_ws(";", one).alias("detail"))


@query(f"""SELECT product_id, string_agg(source || '=' || CAST(CAST(a * 100 AS BIGINT) AS VARCHAR), ',' ORDER BY source) AS prices FROM
  (SELECT product_id, source, arg_max(amount, (observed_at, amount)) AS a FROM {OFFERS} GROUP BY ALL) GROUP BY product_id""")
def price_map(spark, d):
    out = op.price_map(offers(spark, d), "product_id", "source", "amount", ["observed_at", "amount"])
    entries = F.transform(F.array_sort(F.map_entries("prices")), lambda e: F.concat(e["key"], F.lit("="), (e["value"] * 100).cast("long").cast("string")))
    return out.select("product_id", F.concat_ws(",", entries).alias("prices"))


def _canonical(spark, d):
    part = table(spark, d, "part")
    return part.select(F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("company"), F.col("p_name").alias("name"), F.nullif(F.col("p_size"), F.lit(1)).alias("size"), F.col("p_retailprice").cast("decimal(14,2)").alias("price"))


def _listed(spark, d):
    """One listing for each product and source: its largest quantity as size, its highest price."""
    o = offers(spark, d)
    return o.groupBy("product_id", "source").agg(F.max("quantity").cast("int").alias("size"), F.max("amount").alias("price"))


_DIFF = f"""(SELECT c.product_id, c.company, l.source, nullif(p_size, 1) AS canonical_size, l.size AS listing_size, nullif(p_size, 1) <> l.size AS size_differs,
  CAST(p_retailprice AS DECIMAL(14,2)) <> l.price AS price_differs
  FROM (SELECT p_partkey AS product_id, p_brand AS company, * FROM part) c JOIN (SELECT product_id, source, CAST(max(quantity) AS INTEGER) AS size, max(amount) AS price FROM {OFFERS} GROUP BY ALL) l
  ON c.product_id = l.product_id WHERE l.source NOT IN ('NATION_0', 'NATION_1'))"""


def _found(spark, d):
    return op.discrepancies(_canonical(spark, d), _listed(spark, d), "product_id", ["size", "price"], excluded=("NATION_0", "NATION_1"))


@query(f"SELECT * FROM {_DIFF}")
def spec_discrepancies(spark, d):
    return _found(spark, d).select("product_id", "company", "source", "canonical_size", "listing_size", "size_differs", "price_differs")


@query(f"SELECT source, count(*) AS rows, count(*) FILTER (size_differs) AS size_count, count(*) FILTER (size_differs) * 100.0::DOUBLE / count(*) AS size_pct, count(*) FILTER (price_differs) AS price_count, count(*) FILTER (price_differs) * 100.0::DOUBLE / count(*) AS price_pct FROM {_DIFF} GROUP BY source")
def discrepancy_rates(spark, d):
    return op.discrepancy_rates(_found(spark, d), ["size", "price"])


@query(f"SELECT product_id, source FROM {_DIFF} WHERE size_differs OR canonical_size > 45")
def discrepancies_only(spark, d):
    return _found(spark, d).filter(F.col("size_differs") | (F.col("canonical_size") > 45)).select("product_id", "source")


@query(f"""SELECT source, count(DISTINCT product_id) AS distinct_products, count(o.product_id) AS total_listings, avg(q) AS avg_completeness, min(observed_at) AS first_seen, max(observed_at) AS last_seen
FROM {OFFERS} o LEFT JOIN (SELECT p_partkey, CAST(p_size AS DOUBLE) AS q FROM part WHERE p_size % 7 <> 0) ON p_partkey = o.product_id GROUP BY source""")
def site_summary(spark, d):
    scores = table(spark, d, "part").filter("p_size % 7 <> 0").select(F.col("p_partkey").alias("product_id"), F.col("p_size").cast("double").alias("score"))
    return op.site_summary(offers(spark, d), scores, "source", "product_id", "product_id", "observed_at")


@query(f"SELECT source, currency, count(*) AS observations, count(DISTINCT product_id) AS products, CAST(min(amount) AS DOUBLE) AS min_price, CAST(sum(amount) AS DOUBLE) / count(*) AS avg_price, CAST(max(amount) AS DOUBLE) AS max_price, min(observed_at) AS first_observed, max(observed_at) AS last_observed FROM {OFFERS} WHERE amount > 0 GROUP BY ALL")
def site_price_summary(spark, d):
    a = F.col("amount")
    return offers(spark, d).filter(a > 0).groupBy("source", "currency").agg(
        F.count("*").alias("observations"), F.count_distinct("product_id").alias("products"), F.min(a).cast("double").alias("min_price"), (F.sum(a).cast("double") / F.count("*")).alias("avg_price"),
        F.max(a).cast("double").alias("max_price"), F.min("observed_at").alias("first_observed"), F.max("observed_at").alias("last_observed"),
    )


@query(f"SELECT source, max(observed_at) AS last_seen FROM {OFFERS} GROUP BY source ORDER BY last_seen DESC, source")
def freshness(spark, d):
    return offers(spark, d).groupBy("source").agg(F.max("observed_at").alias("last_seen")).orderBy(F.desc("last_seen"), "source")


@query(f"SELECT product_id, currency, {_COMPARE} FROM {OFFERS} WHERE amount > 0 GROUP BY ALL HAVING count(DISTINCT source) >= 2 ORDER BY price_spread DESC, product_id, currency LIMIT 10")
def max_spread_topk(spark, d):
    """The ten widest spreads among products with two sources or more: a top-k report."""
    return op.price_comparison(offers(spark, d), ["product_id", "currency"]).filter("sources_count >= 2").orderBy(F.desc("price_spread"), "product_id", "currency").limit(10)


@query(f"""SELECT * FROM (SELECT currency, company, CAST(min(amount) AS DOUBLE) AS min_price, CAST(max(amount) AS DOUBLE) AS max_price,
  row_number() OVER (PARTITION BY currency ORDER BY CAST(max(amount) AS DOUBLE) - CAST(min(amount) AS DOUBLE) DESC, company) AS rank FROM {OFFERS} GROUP BY currency, company) WHERE rank <= 15""")
def price_ranges_top(spark, d):
    """The fifteen widest price ranges of each currency: a top-k report."""
    from pyspark.sql import Window

    c = op.price_comparison(offers(spark, d), ["currency", "company"]).filter("min_price IS NOT NULL AND max_price IS NOT NULL")
    rank = F.row_number().over(Window.partitionBy("currency").orderBy(F.desc("price_spread"), "company"))
    return c.withColumn("rank", rank.cast("long")).filter("rank <= 15").select("currency", "company", "min_price", "max_price", "rank")


@query(f"SELECT product_id, source, p_size AS size, CAST(amount AS DOUBLE) AS amount FROM {OFFERS} JOIN part ON p_partkey = product_id WHERE company = 'Brand#2' AND currency = 'ASIA'")
def listing_cross_site(spark, d):
    """One company's offers in one currency beside the product's size."""
    o = offers(spark, d).filter("company = 'Brand#2' AND currency = 'ASIA'")
    sizes = table(spark, d, "part").select(F.col("p_partkey").alias("product_id"), F.col("p_size").alias("size"))
    return o.join(sizes, "product_id").select("product_id", "source", "size", F.col("amount").cast("double").alias("amount"))


_WIDE = """SELECT p.p_partkey AS product_id, p.p_brand AS company, p.p_name AS name, a.size, b.price, c.kind
FROM part p LEFT JOIN (SELECT p_partkey, p_size AS size FROM part WHERE p_size > 5) a USING (p_partkey)
LEFT JOIN (SELECT p_partkey, p_retailprice AS price FROM part WHERE p_partkey % 3 = 0) b USING (p_partkey)
LEFT JOIN (SELECT p_partkey, p_type AS kind FROM part WHERE p_partkey % 2 = 0) c USING (p_partkey)"""


@query(_WIDE)
def canonical_wide(spark, d):
    """Products with one-to-one spec tables, some rows of which are missing."""
    part = table(spark, d, "part").withColumnRenamed("p_partkey", "product_id")
    specs = {
        "display": part.filter("p_size > 5").select("product_id", F.col("p_size").alias("size")),
        "price": part.filter("product_id % 3 = 0").select("product_id", F.col("p_retailprice").alias("price")),
        "platform": part.filter("product_id % 2 = 0").select("product_id", F.col("p_type").alias("kind")),
    }
    return op.star_join(part.select("product_id", F.col("p_brand").alias("company"), F.col("p_name").alias("name")), specs, "product_id")


@query(f"""SELECT l.product_id, l.source, p_brand AS company, coalesce(string_agg(currency || '=' || CAST(CAST(m * 100 AS BIGINT) AS VARCHAR), ',' ORDER BY currency), '') AS prices,
  any_value(CAST(size AS VARCHAR) || 'x' || CAST(CAST(quantity AS INTEGER) AS VARCHAR)) AS resolution
FROM (SELECT product_id, source, currency, max(amount) AS m, max(max(quantity)) OVER (PARTITION BY product_id, source) AS quantity FROM {OFFERS} GROUP BY product_id, source, currency) l
JOIN part ON p_partkey = l.product_id LEFT JOIN (SELECT p_partkey AS k, p_size AS size FROM part WHERE p_size > 5) s ON s.k = l.product_id GROUP BY l.product_id, l.source, p_brand""")
def listing_wide(spark, d):
    """Listings with their price map and a text built of two parts, null if one is."""
    o = offers(spark, d).withColumn("key", F.struct("product_id", "source"))
    prices = op.price_map(o, "key", "currency", "amount", ["amount"])
    part = table(spark, d, "part")
    size = part.filter("p_size > 5").select(F.col("p_partkey").alias("product_id"), F.col("p_size").alias("size"))
    head = o.groupBy("product_id", "source").agg(F.max("quantity").cast("int").alias("quantity"), F.first("company").alias("company")).withColumn("key", F.struct("product_id", "source"))
    out = head.join(prices, "key", "left").join(size, "product_id", "left")
    entries = F.transform(F.array_sort(F.map_entries("prices")), lambda e: F.concat(e["key"], F.lit("="), (e["value"] * 100).cast("long").cast("string")))
    return out.select("product_id", "source", "company", F.coalesce(F.concat_ws(",", entries), F.lit("")).alias("prices"), F.concat(F.col("size").cast("string"), F.lit("x"), F.col("quantity").cast("string")).alias("resolution"))


@query("SELECT p_partkey AS product_id, p_name AS name, p_brand AS company, p_retailprice AS price FROM part WHERE p_brand = 'Brand#2' AND (p_name ILIKE '%ring%' OR p_type ILIKE '%ring%') ORDER BY p_retailprice DESC NULLS LAST, p_partkey LIMIT 20 OFFSET 5")
def registry_query(spark, d):
    part = table(spark, d, "part").select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"), F.col("p_brand").alias("company"), F.col("p_retailprice").alias("price"), F.col("p_type").alias("kind"))
    page, _ = op.registry_page(part, ["product_id", "name", "company", "price"], {"company": "Brand#2", "kind": "all"}, ("company", "kind"), "(ring)", ("name", "kind"), (F.col("price").desc_nulls_last(), F.col("product_id")), 20, 5)
    return page


@query("SELECT o_orderkey, o_custkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS position FROM orders QUALIFY position BETWEEN 1151 AND 1250")
def registry_deep_page(spark, d):
    """A deep page of all orders, dearest first, from blocks written in order."""
    root = shared_dir(spark, "pages")
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    op.write_pages(o, (F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey")), root, rows=500)
    return op.read_page(spark, root, 100, 1150)


@query("SELECT count(*) AS total FROM part WHERE p_brand = 'Brand#2' AND (p_name ILIKE '%ring%' OR p_type ILIKE '%ring%')")
def registry_total(spark, d):
    part = table(spark, d, "part").select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"), F.col("p_brand").alias("company"), F.col("p_type").alias("kind"))
    return op.registry_page(part, ["product_id"], {"company": "Brand#2"}, ("company", "kind"), "ring", ("name", "kind"), (F.col("product_id"),))[1]


@query("SELECT p_partkey AS product_id, p_name AS name FROM part WHERE p_name ILIKE '%blue%' OR p_type ILIKE '%econ%'")
def contains_search(spark, d):
    part = table(spark, d, "part")
    return part.filter(F.col("p_name").ilike("%blue%") | F.col("p_type").ilike("%econ%")).select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"))


@query("SELECT p_partkey AS product_id, p_name AS name, p_size AS size FROM part WHERE p_retailprice < 1500 AND p_type = 'ECONOMY' AND p_size >= 20 ORDER BY p_size DESC, p_name, p_partkey")
def spec_search(spark, d):
    """A flag (that a price is low), a kind and a threshold, ordered."""
    part = table(spark, d, "part").filter("p_retailprice < 1500 AND p_type = 'ECONOMY' AND p_size >= 20")
    return part.orderBy(F.desc("p_size"), "p_name", "p_partkey").select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("name"), F.col("p_size").alias("size"))


@query("SELECT coalesce(nullif(trim(CASE WHEN p_size % 5 = 0 THEN '  ' ELSE p_type END), ''), 'Unknown') AS label, count(*) AS count FROM part GROUP BY 1 ORDER BY count DESC, lower(label), label LIMIT 8")
def category_counts(spark, d):
    return op.category_counts(table(spark, d, "part"), F.when(F.col("p_size") % 5 == 0, "  ").otherwise(F.col("p_type")), 8)


@query("SELECT CASE WHEN o_orderpriority LIKE '1%' THEN 'Android' WHEN o_orderpriority LIKE '2%' THEN 'iOS' WHEN o_orderpriority LIKE '3%' THEN 'Unknown' ELSE string_split(o_orderpriority, '-')[1] END AS label, count(*) AS count FROM orders GROUP BY 1")
def os_family_counts(spark, d):
    from ..functions.scalars import os_family

    first = F.substring("o_orderpriority", 1, 1)
    text = F.when(first == "1", "Android 14, One UI").when(first == "2", "iOS 17").when(first == "3", " ").otherwise(F.concat(F.get(F.split("o_orderpriority", "-"), F.lit(0)), F.lit(" custom build")))
    return op.category_counts(table(spark, d, "orders"), os_family(text))


@query("SELECT year(o_orderdate) AS release_year, count(*) AS count FROM orders GROUP BY 1")
def year_distribution(spark, d):
    o = table(spark, d, "orders").withColumn("y", F.year("o_orderdate"))
    return o.filter(F.col("y").between(1000, 9999)).groupBy(F.col("y").cast("long").alias("release_year")).agg(F.count("*").alias("count"))


@query("SELECT count(*) AS n, count(*) FILTER (l_returnflag = 'R') AS adopted, count(*) FILTER (l_returnflag = 'R') * 100.0::DOUBLE / count(*) AS adoption_pct FROM lineitem")
def adoption_rate(spark, d):
    return op.adoption(table(spark, d, "lineitem"), F.col("l_returnflag") == "R")


@query("SELECT CAST(sum(CAST(c_acctbal AS DECIMAL(14,2))) AS DOUBLE) / count(*) AS mean, median(c_acctbal) AS median FROM customer WHERE c_acctbal > 0")
def positive_median(spark, d):
    c = table(spark, d, "customer").filter("c_acctbal > 0")
    mean = c.agg((F.sum(F.col("c_acctbal").cast("decimal(14,2)")).cast("double") / F.count("*")).alias("mean"))
    return mean.crossJoin(F.broadcast(quantiles(c, "c_acctbal", [0.5]).select(F.col("q0").alias("median"))))  # one row each


@query(f"""SELECT (SELECT count(*) FROM part) AS products, (SELECT count(*) FROM {OFFERS}) AS offers, (SELECT count(DISTINCT p_brand) FROM part) AS companies, (SELECT count(*) FROM nation) AS sources,
  (SELECT CAST(sum(p_size) AS DOUBLE) / count(p_size) FROM part) AS mean_score""")
def catalogue_kpis(spark, d):
    """Table counts, and the mean of all scores."""
    part = table(spark, d, "part")
    scores = part.agg((F.sum("p_size").cast("double") / F.count("p_size")).alias("mean_score"))
    one = lambda df, name: df.agg(F.count("*").alias(name))
    out = one(part, "products")
    for x in (one(offers(spark, d), "offers"), part.agg(F.count_distinct("p_brand").alias("companies")), one(table(spark, d, "nation"), "sources"), scores):
        out = out.crossJoin(x)
    return out


@query(f"""SELECT 'largest_source' AS insight, source AS label, n::DOUBLE AS value FROM (SELECT source, count(*) AS n FROM {OFFERS} GROUP BY 1 ORDER BY n DESC, source LIMIT 1)
UNION ALL SELECT 'top_company', p_brand, n::DOUBLE FROM (SELECT p_brand, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_brand LIMIT 1)
UNION ALL SELECT 'widest_spread', CAST(product_id AS VARCHAR), s FROM (SELECT product_id, CAST(max(amount) AS DOUBLE) - CAST(min(amount) AS DOUBLE) AS s FROM {OFFERS} GROUP BY 1 ORDER BY s DESC, product_id LIMIT 1)""")
def insights(spark, d):
    o, part = offers(spark, d), table(spark, d, "part")

    def best(df, name, label, value):
        return df.orderBy(F.desc(value), label).limit(1).select(F.lit(name).alias("insight"), F.col(label).cast("string").alias("label"), F.col(value).cast("double").alias("value"))

    spread = op.price_comparison(o, ["product_id"])
    a = best(o.groupBy("source").agg(F.count("*").alias("n")), "largest_source", "source", "n")
    b = best(part.groupBy("p_brand").agg(F.count("*").alias("n")), "top_company", "p_brand", "n")
    return a.unionByName(b).unionByName(best(spread, "widest_spread", "product_id", "price_spread"))


@query("SELECT n_name AS value, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1 ORDER BY n DESC, value LIMIT 50")
def top_values(spark, d):
    """The fifty most frequent values: a top-k report."""
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.groupBy(F.col("n_name").alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(50)
