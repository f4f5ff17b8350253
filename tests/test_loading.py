"""Staged and resumable loads, inventories, finished records, smaller readers."""

import gzip
import json

import pytest
from pyspark.sql import functions as F

from vendora import schema
from vendora.functions import scalars as s
from vendora.operators import catalog, pages
from vendora.operators import urls as url_ops
from vendora.sources import loading, publish, records
from vendora.streaming import staging


def record(url, **more):
    return json.dumps({"CompanyName": "Nokia", "MobileName": "G22", "URL": url, "Price": [100], **more})


@pytest.fixture(scope="module")
def source(tmp_path_factory):
    root = tmp_path_factory.mktemp("in")
    for site, name, body in (("maker.com", "a", record("https://maker.com/a")), ("shop.pk", "b", record("https://shop.pk/b")), ("shop.pk", "c", record("https://else.pk/c"))):
        (root / site).mkdir(exist_ok=True)
        (root / site / f"{name}.json").write_text(body)
    return str(root)


def test_load_all_publishes_and_lists(spark, source, tmp_path):
    out = str(tmp_path / "out")
    manifest = loading.load_all(spark, source, out, "r1", F.lit("2026-01-01"), "maker.com")
    assert {r["table_name"]: r["rows"] for r in manifest.collect()}["catalog.products"] == 1
    good, bad = records.load(records.discover(spark, source))
    tables = catalog.convert(good, bad, F.lit("2026-01-01"), "maker.com")
    inv = catalog.inventories(tables, good, "maker.com")
    assert [(r["source_file"], r["is_canonical"], r["listing_id"] is None) for r in inv["_manifest.records"].orderBy("source_file").collect()] == [("maker.com/a.json", True, True), ("shop.pk/b.json", False, False)]
    assert [r["error_code"] for r in inv["_manifest.errors"].collect()] == ["WRONG_URL_SITE"]
    row = publish.summary(inv["_manifest.records"], inv["_manifest.errors"], manifest).first()
    assert (row["records_discovered"], row["records_written"], row["records_rejected"], row["marketplace_listings"]) == (3, 2, 1, 1)
    assert row["import_order"] == list(schema.TABLES) and row["rows_by_table"]["listings.listing_prices"] == 1
    files = publish.run_files(spark, out, "r1")
    assert files.filter(F.col("path").startswith("catalog.products/") & (F.col("length") > 0)).count() > 0
    publish.export(tables["catalog.companies"].select("company_name"), str(tmp_path / "csv"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "csv")).first()["company_name"] == "Nokia"


def test_load_resumes_and_refuses_other_input(spark, tmp_path):
    t = schema.TABLES["catalog.companies"]
    rows = [("1", "A", "a", "2026-01-01"), ("x", "B", "b", None), ("3", " ", "c", None)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in t.columns))
    df.coalesce(1).write.option("header", "true").csv(str(tmp_path / f"src/{t.name}"))
    done = loading.load_csv_tables(spark, str(tmp_path / "src"), str(tmp_path / "to"), [t.name]).first()
    assert (done["rows"], done["bad"]) == (3, 2)
    assert [r["company_name"] for r in spark.read.parquet(str(tmp_path / f"to/rows/{t.name}")).collect()] == ["A"]
    again = loading.load_csv_tables(spark, str(tmp_path / "src"), str(tmp_path / "to"), [t.name]).first()
    assert again == done
    with pytest.raises(ValueError, match="not the table"):
        loading.load_table(df.limit(1), t, str(tmp_path / "to"))


def test_source_may_not_change(spark):
    df = spark.createDataFrame([("a", 1, 5)], "path string, length long, modificationTime long")
    known = records.fingerprint(df, F.col("path"))
    records.unchanged(df, F.col("path"), known)
    with pytest.raises(ValueError, match="changed"):
        records.unchanged(df.withColumn("length", F.lit(2).cast("long")), F.col("path"), known)


def test_staged_batches(spark):
    kinds = schema.TABLES["staging.raw_json_records"].columns
    rows = [(i, "shop.pk", f"shop.pk/{i}.json", record(f"https://shop.pk/{i if i != 3 else 2}") if i != 4 else "{", "pending") for i in range(1, 6)]
    df = spark.createDataFrame(rows, "staging_id long, source_domain string, source_file string, payload string, status string")
    df = df.select(*(F.col(c) if c in df.columns else F.lit(None).cast(k).alias(c) for c, k in kinds.items()))
    runs = spark.createDataFrame([(7, 10, 10, 0, "running"), (8, 0, 0, 0, "running")], "run_id long, records_processed int, records_succeeded int, records_failed int, run_status string")
    runs = runs.withColumn("finished_at", F.lit(None).cast("timestamp"))
    assert [r["staging_id"] for r in staging.pending(df, 2).collect()] == [1, 2]
    tables, after, counted = staging.process_batch(df, runs, 7, 4, F.lit("2026-01-01"), "maker.com")
    assert {r["staging_id"]: r["status"] for r in after.collect()} == {1: "processed", 2: "processed", 3: "failed", 4: "failed", 5: "pending"}
    got = {r["run_id"]: (r["records_processed"], r["records_succeeded"], r["records_failed"], r["run_status"]) for r in counted.collect()}
    assert got == {7: (14, 12, 2, "completed_with_errors"), 8: (0, 0, 0, "running")}
    assert tables["listings.market_listings"].count() == 2


def test_bodies_manifests_customers(spark, tmp_path):
    xml = "<urlset><url><loc>u1</loc></url></urlset>"
    df = spark.createDataFrame([("s", gzip.compress(xml.encode())), ("t", xml.encode()), ("n", None)], "url string, content binary").withColumn("body", records.body_text(F.col("content")))
    assert [r["url"] for r in records.read_sitemaps(df, ["s"]).collect()] == ["u1"] and df.filter("url = 'n'").first()["body"] is None
    tree = spark.createDataFrame([(r'{"tree": {"children": [{"url": "https:\/\/a\/1"}, {"url": "https://a/1"}, {"url": "mailto:x"}]}}',)], "body string")
    assert tuple(records.manifest_counts(records.read_manifest(tree)).first()) == (3, 1, 1)
    (tmp_path / "c.csv").write_text(" Customer_ID ,Age\n1,x\n")
    assert records.read_customers(spark, str(tmp_path / "c.csv")).first().asDict() == {"customer_id": "1", "age": "x"}


def test_page_details(spark):
    html = '<h1> The <b>G22</b></h1><h2>Main &amp; more</h2><table><tr><td>Network is fast</td><td data-spec="x">4G &#x41;&#66; &lt;ok&gt;</td></tr><tr><th>Body</th><td>Size</td><td>9&nbsp;mm</td></tr><tr><td></td><td data-spec="kind">bar</td></tr><tr><td>alone</td></tr></table>4 GB RAM, Android 13'
    df = spark.createDataFrame([(1, html), (2, None)], "k long, html string")
    rows = pages.spec_rows(df, "k", "html")
    got = [tuple(r)[1:] for r in rows.orderBy("position").collect()]
    assert got == [(0, "Main & more", "Network is fast", "4G AB <ok>"), (1, "Body", "Size", "9 mm"), (2, "Body", "kind", "bar")]
    alias = spark.createDataFrame([("network", "net"), ("size", "length")], "alias string, name string")
    named = pages.label_aliases(rows, alias)
    assert {r["label"]: r["canonical"] for r in named.collect()} == {"Network is fast": "net", "Size": "length", "kind": "kind"}
    assert json.loads(pages.raw_record(rows, "k").first()["record"]) == {"Main & more": {"Network is fast": "4G AB <ok>"}, "Body": {"Size": "9 mm", "kind": "bar"}}
    more = pages.text_fallbacks({"os": F.lit("own")}, F.col("html"))
    assert tuple(df.filter("k = 1").select(pages.first_heading(F.col("html")), more["ram"], more["os"]).first()) == ("The G22", "4", "own")
    assert df.limit(1).select(s.json_sorted({"b": F.lit(1), "a": F.lit("x")})).first()[0] == '{"a":"x","b":1}'
    assert df.limit(1).select(s.text_of(F.array(F.lit("a"), F.lit(1).cast("string")), True), s.text_of(F.lit(" a  b "))).first() == ('["a","1"]', "a b")


def test_discovery_and_more_sites(spark):
    page = "https://www.gsmarena.com/nokia-phones-1.php"
    html = '<a href="nokia_g22-1.php">x</a><a href="/nokia-phones-f-1-0-p2.php">2</a><a href="acer-phones-59.php">a</a><a href="nokia_g22-1.php">again</a><a href="nokia-phones-1.php">self</a>'
    df = spark.createDataFrame([(page, html)], "url string, html string")
    got = [(r["link"], r["kind"], r["position"]) for r in url_ops.discover(df, "url", "html").orderBy("position").collect()]
    assert got == [("https://www.gsmarena.com/nokia_g22-1.php", "product", 0), ("https://www.gsmarena.com/nokia-phones-f-1-0-p2.php", "page", 1)]
    cases = {"https://www.daraz.pk/products/nokia-i12-s34.html?x=1": "product", "https://daraz.pk/products/nokia.html": "other", "https://daraz.pk/products/nokia-i1.html#f": "other", "https://mymobile.pk/products/g22/": "product", "https://mymobile.pk/products/g22?x=1": "other", "https://mymobile.pk/category/nokia": "catalogue"}
    out = spark.createDataFrame([(u,) for u in cases], "u string").select("u", url_ops.classify(F.col("u")).alias("k"), url_ops.keyword(F.col("u"), ["g.2", "products/g22"]).alias("w")).collect()
    assert {r["u"]: r["k"] for r in out} == cases and {r["w"] for r in out} == {None, "products/g22"}
