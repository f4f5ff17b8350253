"""Record files to tables, manifests, CSV contracts and constraint checks."""

import json
import os

import pytest
from pyspark.sql import functions as F

from vendora import schema
from vendora.operators import catalog, market, validation
from vendora.sources import publish, records


def record(company="Samsung", name="Galaxy A15", url="https://shop.pk/a15", **more):
    return {"CompanyName": company, "MobileName": name, "URL": url, "Year": 2024, "Month": "jan", "Network": {"2G": 1, "5G": 0}, "Body": {"Dimensions": {"DimensionA": "160.1"}, "Nano-SIM": 1}, "Display": {"Screen": "AMOLED", "Refresh-Rate": 90},
            "Memory": {"Types": [[128, 6]]}, "Sound": {"3.5mm jack": 0}, "Battery": {"Capacity": 5000, "Charging": ["25W", "wired"]}, "Colors": ["Black", None, "Blue"], "Price": [172.99, -1, "48,000"], **more}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("records")
    files = {
        "www.canon.com/a15.json": record(url="https://www.canon.com/a15.php"), "shop.pk/1.json": record(), "shop.pk/2.json": record(url="https://www.shop.pk/a15?x=2#f"), "shop.pk/3.json": record(),
        "shop.pk/4.json": record(company="SAMSUNG ", name="Galaxy  a15", url="https://shop.pk/other"), "shop.pk/5.json": record(name="", url="https://shop.pk/5"), "shop.pk/6.json": record(url="https://else.pk/6"), "shop.pk/_state.json": record(),
        "shop.pk/9.json": record(name="Galaxy+A15", url="https://shop.pk/9"),
    }
    for name, body in files.items():
        os.makedirs(root / os.path.dirname(name), exist_ok=True)
        (root / name).write_text(json.dumps(body))
    (root / "shop.pk/7.json").write_text("{not json")
    (root / "shop.pk/8.json").write_text("[1, 2]")
    (root / "shop.pk/bom.json").write_bytes(b"\xef\xbb\xbf" + json.dumps(record(url="https://shop.pk/bom")).encode())
    good, bad = records.load(records.discover(spark, str(root)))
    return catalog.convert(good, bad, F.lit("2026-01-01"), "canon.com")


def test_paths():
    assert len(schema.paths()) == 64 and len(schema.TABLES) == 28


def test_identity_and_listings(tables):
    assert {r["company_slug"] for r in tables["catalog.companies"].collect()} == {"samsung"}
    slugs = {r["product_slug"] for r in tables["catalog.products"].collect()}
    assert len(slugs) == 2 and all(x.startswith("samsung-galaxy-a15-") for x in slugs)  # two identities share a base
    rows = tables["listings.market_listings"].orderBy("source_url").collect()
    assert [r["source_url"] for r in rows] == ["https://shop.pk/9", "https://shop.pk/a15", "https://shop.pk/bom", "https://shop.pk/other", "https://www.shop.pk/a15?x=2"]
    a15 = [r for r in rows if r["source_url"] != "https://shop.pk/9"]
    assert sorted(r["instance_number"] for r in a15) == [1, 2, 3, 4]
    assert rows[1]["colors"] == ["Black", "Blue"] and rows[1]["has_3_5mm_jack"] is False and rows[1]["release_month"] == "JAN"


def test_specs_prices_and_quality(tables):
    d = tables["specs.spec_display"].first()
    assert (d["screen_technology"], d["refresh_rate_hz"], d["resolution_width"], d["pixel_density_ppi"]) == ("AMOLED", 90, 240, None)
    assert tables["specs.spec_memory"].first()["storage_ram_variants"] == "[[128,6]]"
    prices = tables["listings.listing_prices"].groupBy("listing_id").agg(F.sort_array(F.collect_list("price_index")).alias("i"), F.sum("amount").cast("double").alias("s")).collect()
    assert len(prices) == 5 and all(r["i"] == [0, 1] and r["s"] == 48172.99 for r in prices)
    assert tables["metadata.data_quality"].first()["fields_total"] == 64


def test_rejects_and_runs(tables):
    got = {(r["source_file"], r["reject_reason"]) for r in tables["metadata.etl_rejects"].collect()}
    assert got == {("shop.pk/3.json", "DUPLICATE_URL"), ("shop.pk/5.json", "MISSING_FIELD"), ("shop.pk/6.json", "WRONG_URL_SITE"), ("shop.pk/7.json", "INVALID_JSON"), ("shop.pk/8.json", "INVALID_PAYLOAD")}
    runs = {r["source_domain"]: (r["records_processed"], r["records_failed"], r["run_status"]) for r in tables["metadata.scrape_runs"].collect()}
    assert runs == {"canon.com": (1, 0, "completed"), "shop.pk": (10, 5, "completed_with_errors")}


def test_constraints_and_publish(spark, tables, tmp_path):
    assert catalog.check(tables).count() == 0
    some = {k: tables[k] for k in ("catalog.companies", "catalog.products", "listings.market_listings")}
    manifest = publish.write_tables(some, str(tmp_path / "out"), "r1")
    assert {r["table_name"]: r["rows"] for r in manifest.collect()} == {"catalog.companies": 1, "catalog.products": 2, "listings.market_listings": 5}
    assert publish.read_current(spark, str(tmp_path / "out"), "catalog.products").count() == 2
    broken = dict(some) | {"catalog.companies": tables["catalog.companies"].limit(0)}
    assert {(r["table_name"], r["rule"]) for r in catalog.check(broken).collect()} == {("catalog.products", "reference")}


def test_csv_contract(spark, tables, tmp_path):
    t = schema.TABLES["catalog.companies"]
    tables[t.name].coalesce(1).write.option("header", "true").csv(str(tmp_path / "ok"))
    df = records.read_csv_table(spark, str(tmp_path / "ok"), t)
    assert validation.violations(df, "company_id", list(t.not_null), {"company_id": "bigint"}).count() == 0
    tables[t.name].select("company_name", "company_id").coalesce(1).write.option("header", "true").csv(str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="header"):
        records.read_csv_table(spark, str(tmp_path / "bad"), t)


def test_manifests_and_sitemaps(spark):
    bodies = ['["https://a/1", {"url": "https://a/2"}]', '{"mobile_urls": [{"url": "https://a/3"}], "catalog_urls": [{"url": "https://a/c"}]}', '{"tree": {"name": "r", "children": [{"url": "https://a/4"}, {"url": null, "children": [{"url": "https://a/5"}]}]}}', "oops"]
    got = [[(r["url"], r["kind"]) for r in records.read_manifest(spark.createDataFrame([(b,)], "body string")).orderBy("position").collect()] for b in bodies]
    assert got == [[("https://a/1", "product"), ("https://a/2", "product")], [("https://a/3", "product"), ("https://a/c", "catalogue")], [("https://a/4", "product"), ("https://a/5", "product")], []]
    ns = 'xmlns="http://www.sitemaps.org/schemas/sitemap/0.9"'
    maps = spark.createDataFrame([("i", f"<sitemapindex {ns}><sitemap><loc> s1 </loc></sitemap><sitemap><loc>s2</loc></sitemap></sitemapindex>"), ("s1", f"<urlset {ns}><url><loc>u1</loc></url><url><loc>u2</loc></url></urlset>"), ("s2", "<urlset><url><loc>u1</loc></url><url><loc>u3</loc></url></urlset>")], "url string, body string")
    assert [r["url"] for r in records.read_sitemaps(maps, ["i"]).orderBy("place").collect()] == ["u1", "u2", "u3"]


def test_fingerprint_is_order_free(spark):
    df = spark.createDataFrame([("a", 1, 5), ("b", 2, 6)], "path string, length long, modificationTime long")
    other = df.orderBy(F.desc("path")).repartition(3)
    assert records.fingerprint(df, F.col("path")).first() == records.fingerprint(other, F.col("path")).first()


def test_views(spark, tables):
    from vendora.plans import views

    assert len(views.register(spark, tables, "canon.com")) == 5
    wide = spark.table("v_canonical_products")
    assert wide.count() == 2 and {"main_camera_video", "memory_technology", "has_usb_c"} <= set(wide.columns)
    full = spark.sql("SELECT prices, resolution FROM v_market_listings_full").collect()
    assert len(full) == 5 and all(list(r["prices"]) == ["PKR"] and float(r["prices"]["PKR"]) == 48000.0 and r["resolution"] == "240x240" for r in full)
    best = spark.sql("SELECT * FROM v_price_comparison WHERE total_listings = 8").first()
    assert (best["sources_count"], best["min_price"], best["max_price"]) == (1, 172.99, 48000.0) and float(best["offers"][0]["amount"]) == 172.99
    assert spark.sql("SELECT count_if(capacity_mah_differs) AS n, count(*) AS c FROM v_spec_discrepancies").first() == (0, 4)
    assert spark.table("v_site_summary").first()["total_listings"] == 5
    assert spark.sql("SELECT slugify('Redmi_Note 12'), slugify('***')").first() == ("redminote-12", "unknown")
    rows = lambda df: sorted(map(str, df.collect()))
    name = wide.orderBy(F.desc("product_id")).first()["mobile_name"]
    page, _ = market.registry_page(wide, wide.columns, {}, (), name, views.REGISTRY["products"][1], (F.desc("product_id"),), 1, 0)
    found = spark.sql("SELECT * EXCEPT (position) FROM registry_products(:q, 1, 0)", args={"q": f"({name})"})
    assert rows(found) == rows(page) and found.count() == 1
    assert [r["position"] for r in spark.sql("SELECT * FROM registry_listings(wanted => 1000, skip => 3) ORDER BY position").collect()] == [4, 5]
    assert spark.sql("SELECT * FROM registry_listings(skip => -5, wanted => 0)").count() == 1 and spark.sql("SELECT * FROM registry_listings('no such name')").count() == 0
    v = spark.table("v_price_comparison")
    c = v.first()["company_name"]
    assert rows(spark.sql("SELECT * FROM price_comparison_of(:c, 'PKR')", args={"c": c})) == rows(v.filter((F.col("company_name") == c) & (F.col("currency_code") == "PKR"))) != []
    assert rows(spark.sql("SELECT * FROM price_comparison_of()")) == rows(v)
    assert spark.sql("SELECT * FROM discrepancies_of()").count() == spark.table("v_spec_discrepancies").filter("capacity_mah_differs OR screen_technology_differs OR refresh_rate_hz_differs OR storage_ram_variants_differs").count()
