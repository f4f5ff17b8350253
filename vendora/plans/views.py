"""The five read views over the relational model, and the SQL function that writers and readers share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import market
from ..schema import SECTIONS

#: As :func:`vendora.functions.scalars.slugify_strict`.
SLUGIFY = r"""CREATE OR REPLACE TEMPORARY FUNCTION slugify(x STRING) RETURNS STRING RETURN
coalesce(nullif(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(trim(x)), '[^a-z0-9\\s-]', ''), '[\\s_]+', '-'), '-+', '-'), '^-+|-+$', ''), ''), 'unknown')"""

#: Table functions ``registry_<name>(search, wanted, skip)``: view, columns that a search looks at, order.
REGISTRY = {
    "products": ("v_canonical_products", ("company_name", "mobile_name", "chipset_name", "operating_system"), "product_id DESC"),
    "listings": ("v_market_listings_full", ("company_name", "canonical_product_name", "listing_title", "source_domain"), "scraped_at DESC, listing_id"),
    "prices": ("v_price_comparison", ("company_name", "mobile_name", "currency_code"), "price_spread DESC NULLS LAST, product_id, currency_code"),
    "discrepancies": ("v_spec_discrepancies", ("company_name", "mobile_name", "source_domain", "listing_title"), "product_id DESC, source_domain, listing_title"),
    "sites": ("v_site_summary", ("source_domain",), "total_listings DESC, source_domain"),
}


def canonical_products(t: dict[str, DataFrame]) -> DataFrame:
    """One wide row per product with every specification."""
    names = {("memory", "technology"): "memory_technology", ("camera_main", "sensor_specs"): "main_camera_specs", ("camera_main", "photo_features"): "main_camera_features", ("camera_main", "video_modes"): "main_camera_video",
             ("camera_selfie", "sensor_specs"): "selfie_camera_specs", ("camera_selfie", "video_modes"): "selfie_camera_video"}
    base = t["catalog.products"].join(t["catalog.companies"].select("company_id", "company_name"), "company_id").select("product_id", "company_name", "mobile_name", "product_slug", "created_by_source")
    parts = {"header": t["specs.product_specs"].drop("last_updated")}
    for s, cols in SECTIONS.items():
        parts[s] = t[f"specs.spec_{s}"].select("product_id", *(F.col(c).alias(names.get((s, c), c)) for c in cols))
    return market.star_join(base, parts, "product_id")


def _offers(t: dict[str, DataFrame]) -> DataFrame:
    named = t["catalog.products"].join(t["catalog.companies"].select("company_id", "company_name"), "company_id").select("product_id", "company_name", "mobile_name")
    return t["listings.market_listings"].join(named, "product_id")


def market_listings(t: dict[str, DataFrame]) -> DataFrame:
    """Listings with their prices by currency and chosen specifications; resolution is null if a side is."""
    head = _offers(t).select("listing_id", "product_id", "company_name", F.col("mobile_name").alias("canonical_product_name"), "instance_number", "source_domain", "source_url", "listing_title", "release_year", "release_month", "scraped_at")
    prices = market.price_map(t["listings.listing_prices"], "listing_id", "currency_code", "amount", ["price_index"])
    d = t["listings.listing_display"].select("listing_id", "screen_technology", "refresh_rate_hz", F.concat(F.col("resolution_width").cast("string"), F.lit("x"), F.col("resolution_height").cast("string")).alias("resolution"))
    parts = {"prices": prices, "display": d}
    for s, cols in {"platform": ["chipset_name", "operating_system"], "memory": ["storage_ram_variants"], "body": ["weight_grams"], "battery": ["capacity_mah"]}.items():
        parts[s] = t[f"listings.listing_{s}"].select("listing_id", *cols)
    out = market.star_join(head, parts, "listing_id")
    return out.withColumn("prices", F.coalesce("prices", F.create_map().cast("map<string,decimal(14,2)>")))


def price_comparison(t: dict[str, DataFrame]) -> DataFrame:
    """Sources, listings and prices of each product and currency, with the offers cheapest first."""
    keys = ["product_id", "company_name", "mobile_name", "currency_code"]
    offers = _offers(t).join(t["listings.listing_prices"].select("listing_id", "currency_code", "amount"), "listing_id")
    detail = market.offers_by_price(offers, keys, ["source_domain", "listing_title", "source_url", "instance_number"])
    return market.price_comparison(offers, keys, "source_domain").join(detail, keys)


def spec_discrepancies(t: dict[str, DataFrame], canonical_source: str) -> DataFrame:
    fields = ["capacity_mah", "screen_technology", "refresh_rate_hz", "storage_ram_variants"]

    def sides(prefix: str, key: str, head: DataFrame) -> DataFrame:
        parts = {s: t[f"{prefix}_{s}"].select(key, *c) for s, c in {"battery": ["capacity_mah"], "display": ["screen_technology", "refresh_rate_hz"], "memory": ["storage_ram_variants"]}.items()}
        return market.star_join(head, parts, key)

    named = t["catalog.products"].join(t["catalog.companies"].select("company_id", "company_name"), "company_id").join(t["specs.product_specs"].select("product_id"), "product_id")
    c = sides("specs.spec", "product_id", named.select("product_id", "company_name", "mobile_name"))
    li = sides("listings.listing", "listing_id", t["listings.market_listings"].select("listing_id", "product_id", "source_domain", "listing_title")).drop("listing_id")
    return market.discrepancies(c, li, "product_id", fields, "source_domain", (canonical_source, "original"))


def site_summary(t: dict[str, DataFrame], latest_score: bool = False) -> DataFrame:
    """Coverage by source; ``latest_score`` counts a listing once however often it was scored."""
    q = t["metadata.data_quality"].filter("listing_id IS NOT NULL").select("listing_id", "completeness_pct", "scored_at")
    return market.site_summary(t["listings.market_listings"], q, "source_domain", "product_id", "listing_id", "scraped_at", "completeness_pct", "scored_at" if latest_score else None)


def table_functions(views: dict[str, DataFrame]) -> list[str]:
    """Statements that make the table functions over registered views: a page of each view by position, price comparisons and discrepancies by argument.

    A page has the rows skip + 1 to skip + wanted, 1 to 100 of them; Spark keeps no more than those of each task before it ranks them.
    """
    columns = lambda v: ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in views[v].schema)
    out = []
    for name, (view, search, order) in REGISTRY.items():
        text = "replace(left(trim(regexp_replace(search, '[(),\\\\s]+', ' ')), 120), '*', '%')"
        hit = " OR ".join(f"{c} ILIKE concat('%', {text}, '%')" for c in search)
        out.append(f"""CREATE OR REPLACE TEMPORARY FUNCTION registry_{name}(search STRING DEFAULT '', wanted INT DEFAULT 25, skip INT DEFAULT 0) RETURNS TABLE (position INT, {columns(view)})
RETURN SELECT * FROM (SELECT row_number() OVER (ORDER BY {order}) AS position, * FROM {view} WHERE search = '' OR {hit})
WHERE position <= greatest(skip, 0) + least(greatest(wanted, 1), 100) AND position > greatest(skip, 0)""")
    out.append(f"""CREATE OR REPLACE TEMPORARY FUNCTION price_comparison_of(company STRING DEFAULT NULL, currency STRING DEFAULT NULL) RETURNS TABLE ({columns("v_price_comparison")})
RETURN SELECT * FROM v_price_comparison WHERE (company IS NULL OR company_name = company) AND (currency IS NULL OR currency_code = currency)""")
    differs = " OR ".join(c for c in views["v_spec_discrepancies"].columns if c.endswith("_differs"))
    out.append(f"""CREATE OR REPLACE TEMPORARY FUNCTION discrepancies_of(source STRING DEFAULT NULL) RETURNS TABLE ({columns("v_spec_discrepancies")})
RETURN SELECT * FROM v_spec_discrepancies WHERE (source IS NULL OR source_domain = source) AND ({differs})""")
    return out


def register(spark: SparkSession, tables: dict[str, DataFrame], canonical_source: str) -> list[str]:
    """Temporary views, the shared function and the table functions, for SQL readers."""
    views = {"v_canonical_products": canonical_products(tables), "v_market_listings_full": market_listings(tables), "v_price_comparison": price_comparison(tables),
             "v_spec_discrepancies": spec_discrepancies(tables, canonical_source), "v_site_summary": site_summary(tables)}
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    for statement in (SLUGIFY, *table_functions(views)):
        spark.sql(statement)
    return list(views)
