"""Idempotence of merges, small rules."""

import pytest
from pyspark.sql import functions as F

from vendora.operators import changes, identity, market, ordering, pages, retention
from vendora.operators import urls as url_ops


def test_upsert_twice_is_once(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    batch = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1)], "k int, v string, seq int")
    once = changes.upsert(base, batch, ["k"], [F.desc("seq")])
    twice = changes.upsert(once, batch, ["k"], [F.desc("seq")])
    assert sorted(once.collect()) == sorted(twice.collect()) == [(1, "a"), (2, "d"), (3, "e")]


def test_positions_and_ranges(spark):
    df = spark.range(500).select((F.col("id") * 37 % 500).alias("x"))
    assert [r["position"] for r in ordering.positions(df, ["x"]).orderBy("x").collect()] == list(range(1, 501))
    got = ordering.position_range(df, ["x"], 101, None, 5).orderBy("x").collect()
    assert [r["x"] for r in got] == [100, 101, 102, 103, 104]
    with pytest.raises(ValueError, match="range"):
        ordering.position_range(df, ["x"], 5, 4)


def test_identity_guards(spark):
    products = spark.createDataFrame([(1, "Sony Xperia 1 III"), (2, "Samsung Galaxy S24"), (3, "Samsung Galaxy S24 Ultra"), (4, "Samsung Galaxy A15")], "product_id long, name string")
    titles = spark.createDataFrame([(1, "Sony Xperia 1 Mark 3 black"), (2, "Samsung Galaxy S24 Ultra new"), (3, "Samsung Galaxy S23"), (4, "Samsung Galaxy A15s")], "listing_id long, title string")
    got = {r["listing_id"]: r["product_id"] for r in identity.fuzzy_identity(titles, products).collect()}
    assert got == {1: 1, 2: 3}


def test_identity_keeps_common_tokens(spark):
    # 1,200 products have "galaxy" and "phone" each; the rarer token "teal" belongs to another product
    names = [(i, f"galaxy phone {'x' * (i % 40 + 1)}{chr(97 + i // 40)}") for i in range(1200)] + [(5000, "galaxy phone"), (5001, "teal lamp of glass")]
    titles = [(1, "galaxy phone teal"), (2, "phone galaxy"), (3, "glass lamp teal"), (4, "nothing alike")]
    products = spark.createDataFrame(names, "product_id long, name string")
    got = {r["listing_id"]: (r["product_id"], r["similarity"]) for r in identity.fuzzy_identity(spark.createDataFrame(titles, "listing_id long, title string"), products).collect()}
    want = {}
    for k, title in titles:
        t = set(title.split())
        sims = [(-len(t & set(n.split())) / len(t | set(n.split())), i) for i, n in names]
        if min(sims)[0] <= -0.5:
            want[k] = (min(sims)[1], -min(sims)[0])
    assert got == want and got[1] == (5000, 2 / 3)


def test_id_stability_under_permutation(spark):
    df = spark.createDataFrame([("A", "x"), ("B", "x"), ("C", "y")], "ident string, base string")
    a = identity.unique_slugs(df, F.col("ident"), F.col("base"))
    b = identity.unique_slugs(df.orderBy(F.desc("ident")).repartition(3), F.col("ident"), F.col("base"))
    assert sorted(a.select("ident", "slug").collect()) == sorted(b.select("ident", "slug").collect())
    assert identity.id_collisions(a, "slug", F.col("ident")).count() == 0


def test_registry_bounds(spark):
    df = spark.range(300).select(F.col("id"), F.lit("x").alias("kind"))
    page, total = market.registry_page(df, ["id"], {"kind": "all"}, ("kind",), order=(F.col("id"),), limit=1000, offset=-5)
    assert page.count() == 100 and total.first()["total"] == 300
    with pytest.raises(ValueError, match="filter"):
        market.registry_page(df, ["id"], {"id": 1}, ("kind",))


def test_url_rules(spark):
    cases = {
        "https://www.gsmarena.com/xiaomi_redmi_note_14_4g_(global)-13616.php": "product", "https://www.gsmarena.com/xiaomi-phones-80.php": "catalogue", "https://www.gsmarena.com/i_mobile-phones-f-52-0-r1-p1.php": "other",
        "https://www.gsmarena.com/apple_iphone_16-review-2798.php": "other", "https://www.gsmarena.com/search.php3": "other", "https://www.whatmobile.com.pk/Samsung_Galaxy-A57": "product", "https://www.whatmobile.com.pk/Samsung_Mobiles_Prices": "catalogue",
        "https://www.whatmobile.com.pk/StolenMobile.php": "other", "https://www.gsmarena.com/apple_iphone_16_pro-13315.php?x=1": "other",
    }
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    assert {r["u"]: r["k"] for r in df.select("u", url_ops.classify(F.col("u")).alias("k")).collect()} == cases
    m = spark.createDataFrame([("https://www.gsmarena.com/xiaomi-phones-f-80-0-p2.php",)], "u string").select(url_ops.maker(F.col("u")).alias("m")).first()["m"]
    assert (m["slug"], m["id"]) == ("xiaomi", 80)


def test_page_facts(spark):
    html = '<h2>Main</h2><table><tr><th>Build</th></tr><tr><td>OS</td><td>Android 14</td></tr></table><span class="price">Rs. 99,999</span>'
    df = spark.createDataFrame([(1, html), (2, None)], "k long, html string")
    assert [tuple(r)[2:] for r in pages.spec_rows(df, "k", "html").collect()] == [("Build", "OS", "Android 14")]
    assert [r[0] for r in df.select(pages.page_price(F.col("html"))).collect()] == [99999.0, None]


def test_retention_edges(spark):
    empty = spark.createDataFrame([], "v double, g string")
    assert retention.gini(empty, "v").first()["gini"] == 0.0
    same = spark.createDataFrame([(5.0, "a"), (5.0, "a")], "v double, g string")
    assert retention.gini(same, "v").first()["gini"] == 0.0
    assert [r["bin"] for r in retention.histogram(same, "v", "g", 22).collect()] == [1]
    assert retention.pearson_pairs(same.withColumn("w", F.col("v")), ["v", "w"]).first()["r"] is None
