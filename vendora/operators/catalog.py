"""The conversion of accepted records and rejects into the relational model."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as s
from ..schema import HEADER, SECTIONS, STORED_PATHS, STORED_TOTAL, TABLES, paths
from ..sources.records import leaf, text_list
from .identity import instance_numbers, pick_one, unique_slugs
from .ordering import saved


def value(payload: Column, path: tuple[str, ...], kind: str, default) -> Column:
    """A leaf by its kind, with the table's default where the record has nothing usable."""
    c = leaf(payload, path)
    if kind == "bool":
        return s.bool_value(c, default)
    if kind == "int":
        return s.int_value(c, default) if default is not None else F.when(s.nullif_blank(c).isNotNull(), s.int_value(c, 0))
    if kind == "number":
        return s.number_value(c, default).cast("decimal(10,2)")
    if kind == "list":
        return F.filter(F.transform(F.coalesce(text_list(c), F.array().cast("array<string>")), s.clean_text), lambda x: x != "")
    if kind == "json":
        return F.when(F.startswith(F.trim(c), F.lit("[")), c).otherwise(F.lit(default))
    # empty text is stored as null, unless the column has a default
    return F.coalesce(F.nullif(s.clean_text(c), F.lit("")), F.lit(default or None).cast("string"))


def completeness(payload: Column) -> Column:
    """Leaves with a value: not null, not blank, not an empty list or object."""
    filled = [F.coalesce(~F.trim(leaf(payload, p)).isin("", "[]", "{}"), F.lit(False)).cast("int") for p in paths()]
    return reduce(lambda a, b: a + b, filled)


def stored_completeness(payload: Column) -> Column:
    """Percentage by the stored procedure's rule: its leaves that are there, blank or not, of a constant total."""
    there = reduce(lambda a, b: a + b, [leaf(payload, p).isNotNull().cast("int") for p in STORED_PATHS])
    return F.round(there.cast("decimal(10,4)") * 100 / STORED_TOTAL, 2).cast("decimal(5,2)")


def inventories(tables: dict[str, DataFrame], accepted: DataFrame, canonical_source: str) -> dict[str, DataFrame]:
    """The record inventory (one row for each record that was kept) and the error inventory of a conversion."""
    kept = tables["staging.raw_json_records"].select("record_key", "source_domain", "source_file", "source_url")
    facts = accepted.select("source_domain", "source_file", "company_name", "mobile_name", "file_sha256", completeness(F.col("r")).alias("n"))
    listed = tables["listings.market_listings"].select("source_url", "listing_id")
    out = kept.join(facts, ["source_domain", "source_file"]).join(listed, "source_url", "left").withColumn("is_canonical", F.col("source_domain") == canonical_source)
    pct = F.round(F.col("n").cast("decimal(10,4)") * 100 / len(paths()), 2).cast("decimal(5,2)")
    records = out.select("record_key", "source_domain", "source_file", "source_url", "company_name", "mobile_name", F.when(~F.col("is_canonical"), F.col("listing_id")).alias("listing_id"), "is_canonical", pct.alias("completeness_pct"), "file_sha256")
    errors = tables["metadata.etl_rejects"].select("source_domain", "source_file", "source_url", F.col("reject_reason").alias("error_code"), F.col("reject_detail").alias("error_message"))
    return {"_manifest.records": records, "_manifest.errors": errors}


def identify(records: DataFrame) -> DataFrame:
    """company and product slugs and ids; a slug shared by several identities is told apart by a hash."""
    r = records.withColumn("company_identity", s.fold_space(F.col("company_name")))
    # the least of the spellings names a company
    least = r.groupBy("company_identity").agg(F.min("company_name").alias("least"))
    least = unique_slugs(least, F.col("company_identity"), s.slugify(F.col("least")), "company_slug")
    r = r.join(least.select("company_identity", "company_slug", F.col("least").alias("company_least")), "company_identity")
    r = r.withColumn("product_identity", F.concat("company_identity", F.lit("\0"), s.fold_space(F.col("mobile_name"))))
    r = unique_slugs(r, F.col("product_identity"), F.concat("company_slug", F.lit("-"), s.slugify(F.col("mobile_name"))), "product_slug")
    return r.withColumn("company_id", s.stable_bigint("company", F.col("company_slug"))).withColumn("product_id", s.stable_bigint("product", F.col("product_slug")))


def convert(accepted: DataFrame, rejects: DataFrame, generated_at: Column, canonical_source: str, currency: str = "PKR", currency_mode: str = "fixed") -> dict[str, DataFrame]:
    """All tables of the model from accepted records and rejects; see :data:`vendora.schema.TABLES` for their columns.

    ``currency_mode='positional'`` takes the currency from a price's place among those of the record.
    """
    dup = Window.partitionBy("source_domain", "source_url").orderBy("source_file")
    ranked = accepted.withColumn("n", F.row_number().over(dup)).withColumn("winner", F.first("source_file").over(dup))
    lost = ranked.filter("n > 1").select("source_domain", "source_file", "source_url", F.lit("DUPLICATE_URL").alias("reject_reason"), F.concat(F.lit("Duplicate URL; first accepted from "), "winner").alias("reject_detail"), "payload")
    rejects = rejects.unionByName(lost)
    r = identify(ranked.filter("n = 1").drop("n", "winner"))
    r = r.withColumn("fields_populated", completeness(F.col("r"))).withColumn("is_canonical", F.col("source_domain") == canonical_source)
    listed = instance_numbers(r.filter("NOT is_canonical"), ["product_id", "source_domain"], [F.col("source_url"), F.col("source_file")])
    r = r.filter("is_canonical").withColumn("instance_number", F.lit(None).cast("long")).unionByName(listed)
    r = r.withColumn("listing_id", F.when(~F.col("is_canonical"), s.stable_bigint("listing", F.col("source_url"))))
    r = saved(r.withColumn("run_id", s.stable_bigint("scrape_run", F.col("source_domain"))), "records")
    rejects = saved(rejects, "rejects")

    now = generated_at.cast("timestamp")
    p = F.col("r")
    release = s.release_values(p["Year"], p["Month"], p["Day"])
    header = {f"release_{k}": release[k] for k in ("year", "month", "day")} | {c: value(p, *how) for c, how in HEADER.items()}
    canonical = pick_one(r.filter("is_canonical"), ["product_id"], [F.desc("fields_populated"), F.col("source_file")])
    listings = r.filter("NOT is_canonical")
    title = s.display_name(F.col("company_name"), F.col("mobile_name"))
    first = pick_one(r, ["product_id"], [F.desc("is_canonical"), F.desc("fields_populated"), F.col("source_file")])
    made_by = r.groupBy("product_id").agg(F.max("is_canonical").alias("c"), F.min("source_domain").alias("d"))
    own_slug = pick_one(r, ["product_id"], [F.desc("is_canonical"), F.col("source_file")]).select("product_id", s.slugify(title).alias("own_slug"))
    named = r.withColumn("alias_name", title).withColumn("alias_slug", s.slugify(title)).join(own_slug, "product_id").filter("alias_slug <> own_slug")

    def out(name: str, df: DataFrame, **columns: Column) -> DataFrame:
        kinds = TABLES[name].columns
        return df.select(*((columns[c] if c in columns else F.col(c)).cast(kinds[c]).alias(c) for c in kinds))

    prices = F.transform(F.coalesce(text_list(p["Price"]), F.array().cast("array<string>")), lambda x: s.number_value(x, -1.0))
    priced = listings.select("listing_id", F.posexplode(F.filter(F.transform(prices, lambda x, i: F.struct(x.alias("x"), i.alias("i"))), lambda e: e["x"] > 0)).alias("at", "e"))
    code = F.lit(currency) if currency_mode == "fixed" else s.currency_at(F.col("e.i"))
    index = F.col("at") if currency_mode == "fixed" else F.col("e.i")
    seen = r.groupBy("source_domain").agg(F.count("*").alias("ok")).join(rejects.groupBy("source_domain").agg(F.count("*").alias("bad")), "source_domain", "full")
    seen = seen.fillna(0, ["ok", "bad"])
    target = F.when(F.col("is_canonical"), F.concat(F.lit("product:"), F.col("product_id"))).otherwise(F.concat(F.lit("listing:"), F.col("listing_id")))
    n = len(paths())
    tables = {
        "metadata.scrape_runs": out("metadata.scrape_runs", seen, run_id=s.stable_bigint("scrape_run", F.col("source_domain")), started_at=now, finished_at=now, records_processed=F.col("ok") + F.col("bad"), records_succeeded=F.col("ok"), records_failed=F.col("bad"), run_status=F.when(F.col("bad") == 0, "completed").otherwise("completed_with_errors")),
        "catalog.companies": out("catalog.companies", r.groupBy("company_id", "company_slug").agg(F.min("company_least").alias("company_name")), created_at=now),
        "catalog.products": out("catalog.products", first.join(made_by, "product_id"), created_by_source=F.when(F.col("c"), canonical_source).otherwise(F.col("d")), created_at=now, updated_at=now),
        "catalog.product_aliases": out("catalog.product_aliases", pick_one(named, ["alias_slug"], [F.col("source_domain"), F.col("source_url"), F.col("source_file")]), alias_id=s.stable_bigint("alias", F.col("alias_slug")), created_at=now),
        "specs.product_specs": out("specs.product_specs", canonical, **header, specs_source=F.lit(canonical_source), last_updated=now),
        **{f"specs.spec_{k}": out(f"specs.spec_{k}", canonical, **{c: value(p, *how) for c, how in part.items()}) for k, part in SECTIONS.items()},
        "listings.market_listings": out("listings.market_listings", listings, **header, listing_title=title, raw_payload=F.col("payload"), scrape_run_id=F.col("run_id"), scraped_at=now),
        "listings.listing_prices": out("listings.listing_prices", priced, price_entry_id=s.stable_bigint("price", F.concat_ws("\0", F.col("listing_id").cast("string"), code, index.cast("string"))), currency_code=code, amount=F.col("e.x"), price_index=index, created_at=now),
        **{f"listings.listing_{k}": out(f"listings.listing_{k}", listings, **{c: value(p, *how) for c, how in part.items()}) for k, part in SECTIONS.items()},
        "metadata.data_quality": out("metadata.data_quality", r, score_id=s.stable_bigint("quality", F.concat_ws("\0", "source_domain", target, "source_file")), completeness_pct=F.round(F.col("fields_populated").cast("decimal(10,4)") * 100 / n, 2), fields_total=F.lit(n), scored_at=now),
        "metadata.etl_rejects": out("metadata.etl_rejects", rejects, reject_id=s.stable_bigint("reject", F.concat_ws("\0", "source_domain", "source_file", "reject_reason")), scrape_run_id=s.stable_bigint("scrape_run", F.col("source_domain")), raw_payload=F.col("payload"), rejected_at=now, resolved_at=F.lit(None), resolution_detail=F.lit(None)),
        "staging.raw_json_records": out("staging.raw_json_records", r, staging_id=s.stable_bigint("staging", F.concat("source_domain", F.lit("\0"), "source_file")), record_key=s.record_key(F.col("source_domain"), F.col("source_url")), ingested_at=now, processed_at=now, status=F.lit("processed")),
    }
    return {k: tables[k] for k in TABLES}


def check(tables: dict[str, DataFrame]) -> DataFrame:
    """Violations of keys, references and required columns of the whole model: table_name, rule, column, rows."""
    from .validation import fk_violations, unique_violations

    found = []
    for name, t in TABLES.items():
        if name not in tables:
            continue
        df = tables[name]
        for key in ((t.key,), *t.unique):
            found.append((name, "unique", ",".join(key), unique_violations(df, list(key))))
        for fk, parent, pk in t.references:
            if parent in tables:
                found.append((name, "reference", fk, fk_violations(df, fk, tables[parent], pk)))
        for c in (t.key, *t.not_null):
            found.append((name, "not_null", c, df.filter(F.col(c).isNull())))
    rows = [x.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table_name"), F.lit(rule).alias("rule"), F.lit(c).alias("column"), "rows") for n, rule, c, x in found]
    return reduce(DataFrame.unionByName, rows).filter("rows > 0")
