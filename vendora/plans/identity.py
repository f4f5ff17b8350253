"""Identity queries: parts are products whose brand and name repeat, documents and line items have duplicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as s
from ..operators import identity as op
from ..operators import ordering
from .registry import query, table

_ID = "(('0x' || substr(sha256('{0}' || chr(0) || {1}), 1, 16))::UBIGINT & 9223372036854775807::UBIGINT)::BIGINT"
_SLUG = "trim(regexp_replace(lower({0}), '[^a-z0-9]+', '-', 'g'), '-')"


def _id(ns: str, key: str) -> str:
    return _ID.format(ns, key)


def _part(spark, d):
    p = table(spark, d, "part")
    return p.select(F.col("p_partkey").alias("product_id"), F.col("p_brand").alias("company"), F.col("p_name").alias("name"), F.col("p_size").alias("size"), F.col("p_type").alias("kind"), F.col("p_retailprice").alias("price"))


@query(f"SELECT p_partkey AS product_id, {_id('product', 'p_brand || chr(0) || p_name')} AS stable_id, sha256(p_brand || chr(0) || p_name) AS record_key FROM part")
def stable_ids(spark, d):
    p = _part(spark, d)
    return p.select("product_id", s.stable_bigint("product", F.concat("company", F.lit("\0"), "name")).alias("stable_id"), s.record_key(F.col("company"), F.col("name")).alias("record_key"))


_WHOLE = _SLUG.format("regexp_replace(strip_accents(text), '[^\\x00-\\x7F]', '', 'g')")


@query(f"SELECT doc_id, CASE WHEN slug <> '' THEN slug ELSE 'item-' || left(sha256(text), 12) END AS slug FROM (SELECT doc_id, text, {_WHOLE} AS slug FROM documents)")
def slugs(spark, d):
    """The slug of every whole text."""
    return table(spark, d, "documents").select("doc_id", s.slugify(F.col("text")).alias("slug"))


@query("SELECT p_partkey AS product_id, trim(regexp_replace(regexp_replace(lower(p_brand || ' ' || p_name), '[^a-z0-9 -]', '', 'g'), '[ ]+', '-', 'g'), '-') AS slug FROM part")
def slugs_strict(spark, d):
    return _part(spark, d).select("product_id", s.slugify_strict(F.concat_ws(" ", "company", "name")).alias("slug"))


@query(f"""WITH p AS (SELECT *, {_SLUG.format('p_name')} AS base, p_brand || '|' || p_name AS ident FROM part)
SELECT p_partkey AS product_id, CASE WHEN n > 1 THEN base || '-' || left(sha256(ident), 8) ELSE base END AS slug FROM p JOIN (SELECT base, count(DISTINCT ident) AS n FROM p GROUP BY base) USING (base)""")
def slug_collisions(spark, d):
    p = _part(spark, d)
    return op.unique_slugs(p, F.concat_ws("|", "company", "name"), s.slugify(F.col("name"))).select("product_id", "slug")


@query("SELECT p_size AS ident, count(DISTINCT p_brand || '|' || p_name) AS keys FROM part GROUP BY 1 HAVING count(DISTINCT p_brand || '|' || p_name) > 1")
def id_collision_check(spark, d):
    """Collisions of a bad id; a good one has none (see the tests)."""
    p = _part(spark, d).withColumn("ident", F.col("size"))
    return op.id_collisions(p, "ident", F.concat_ws("|", "company", "name"))


@query("SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate, l_discount, l_tax) AS instance_number FROM lineitem")
def instance_numbers(spark, d):
    order = [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate", "l_discount", "l_tax")]
    return op.instance_numbers(table(spark, d, "lineitem"), ["l_partkey", "l_suppkey"], order).select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "instance_number")


@query("SELECT min(doc_id) AS doc_id, sha256(text) AS key FROM documents GROUP BY sha256(text)")
def dedupe_first(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("key"))
    return op.first_wins(docs, ["key"], [F.col("doc_id")], "doc_id")[0]


@query("SELECT doc_id, 'DUPLICATE_URL' AS reject_reason, winner FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY sha256(text)) AS winner FROM documents) WHERE doc_id <> winner UNION ALL SELECT l_orderkey, 'INVALID_PAYLOAD', NULL FROM lineitem WHERE l_quantity > 49.5")
def duplicate_rejects(spark, d):
    """Rejects of two kinds in one table."""
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("key"))
    lost = op.first_wins(docs, ["key"], [F.col("doc_id")], "doc_id")[1].select("doc_id", F.lit("DUPLICATE_URL").alias("reject_reason"), "winner")
    bad = table(spark, d, "lineitem").filter("l_quantity > 49.5").select(F.col("l_orderkey").alias("doc_id"), F.lit("INVALID_PAYLOAD").alias("reject_reason"), F.lit(None).cast("long").alias("winner"))
    return lost.unionByName(bad)


@query("SELECT p_brand AS company, p_name AS name, p_partkey AS product_id FROM (SELECT *, row_number() OVER (PARTITION BY p_brand, p_name ORDER BY p_size DESC, p_partkey) AS n FROM part) WHERE n = 1")
def canonical_pick(spark, d):
    return op.pick_one(_part(spark, d), ["company", "name"], [F.desc("size"), F.col("product_id")]).select("company", "name", "product_id")


@query("SELECT p_brand AS company, p_name AS name, p_partkey AS product_id, CASE WHEN p_type = 'ECONOMY' THEN p_type ELSE lo END AS created_by FROM (SELECT *, min(p_type) OVER (PARTITION BY p_brand, p_name) AS lo, row_number() OVER (PARTITION BY p_brand, p_name ORDER BY (p_type = 'ECONOMY') DESC, p_size DESC, p_partkey) AS n FROM part) WHERE n = 1")
def representative(spark, d):
    """The canonical source first, then the most complete; made by the canonical source if it is there, else by the first."""
    p = _part(spark, d)
    lo = p.groupBy("company", "name").agg(F.min("kind").alias("lo"))
    best = op.pick_one(p, ["company", "name"], [F.desc(F.col("kind") == "ECONOMY"), F.desc("size"), F.col("product_id")])
    return best.join(lo, ["company", "name"]).select("company", "name", "product_id", F.when(F.col("kind") == "ECONOMY", F.col("kind")).otherwise(F.col("lo")).alias("created_by"))


@query(f"""SELECT product_id, alias_name, alias_slug, {_id('alias', 'alias_slug')} AS alias_id FROM (
  SELECT p_partkey AS product_id, p_name || ' ' || p_type AS alias_name, {_SLUG.format("p_name || ' ' || p_type")} AS alias_slug, row_number() OVER (PARTITION BY {_SLUG.format("p_name || ' ' || p_type")} ORDER BY p_partkey) AS n
  FROM part) WHERE n = 1""")
def aliases(spark, d):
    p = _part(spark, d).withColumn("title", F.concat_ws(" ", "name", "kind")).withColumn("canon", s.slugify(F.col("name")))
    return op.aliases(p, "product_id", "title", "canon", [F.col("product_id")])


@query("SELECT user_id, event_type, value, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def latest_price(spark, d):
    """The latest observation of each key; ties by id."""
    e = table(spark, d, "events")
    last = e.groupBy("user_id", "event_type").agg(F.max_by(F.struct("value", "ts"), F.struct("ts", "event_id")).alias("x"))
    return last.select("user_id", "event_type", F.col("x.value").alias("value"), F.col("x.ts").alias("ts"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE (SELECT max(s_suppkey) FROM supplier) + sum(CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE 1 END) OVER (ORDER BY s_suppkey) END::BIGINT AS serial FROM supplier")
def serial_assign(spark, d):
    """New serials: the base's maximum plus a global running count of unseen rows."""
    sup = table(spark, d, "supplier").select("s_suppkey")
    unseen = F.when(F.col("s_suppkey") % 3 == 0, 0).otherwise(1)
    top = sup.agg(F.max("s_suppkey").alias("top"))
    out = ordering.running(sup, ["s_suppkey"], {"n": unseen}).crossJoin(F.broadcast(top))
    return out.select("s_suppkey", F.when(F.col("s_suppkey") % 3 != 0, F.col("top") + F.col("n")).cast("long").alias("serial"))


@query("SELECT p_partkey AS product_id, (p_size + sum(CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY p_brand ORDER BY p_partkey ROWS UNBOUNDED PRECEDING))::BIGINT AS instance FROM part")
def instance_assign(spark, d):
    """New instances: a base plus the group's running count of changed rows."""
    changed = F.when(F.col("product_id") % 2 == 0, 1).otherwise(0)
    out = ordering.running_by(_part(spark, d), ["company"], ["product_id"], "n", changed)
    return out.select("product_id", (F.col("size") + F.col("n")).cast("long").alias("instance"))


@query(f"""WITH b AS (SELECT p_partkey AS row_id, p_brand AS company, {_SLUG.format('p_name')} AS slug FROM part WHERE p_partkey % 2 = 1),
p AS (SELECT p_brand AS company, {_SLUG.format('p_name')} AS slug, min(p_partkey) AS pid FROM part WHERE p_partkey % 2 = 0 AND p_size > 25 GROUP BY ALL),
a AS (SELECT p_brand AS company, {_SLUG.format('p_name')} AS slug, max(p_partkey) AS aid FROM part WHERE p_partkey % 2 = 0 AND p_size <= 25 GROUP BY ALL)
SELECT row_id, coalesce(pid, aid, {_id('product', "b.company || '|' || b.slug")}) AS product_id, CASE WHEN pid IS NOT NULL THEN 'product' WHEN aid IS NOT NULL THEN 'alias' ELSE 'new' END AS matched_by
FROM b LEFT JOIN p USING (company, slug) LEFT JOIN a USING (company, slug)""")
def resolve_products(spark, d):
    p = _part(spark, d).withColumn("slug", s.slugify(F.col("name")))
    old = p.filter("product_id % 2 = 0")
    products = old.filter("size > 25").groupBy("company", F.col("slug").alias("product_slug")).agg(F.min("product_id").alias("product_id"))
    alias = old.filter("size <= 25").groupBy("company", F.col("slug").alias("alias_slug")).agg(F.max("product_id").alias("product_id"))
    batch = p.filter("product_id % 2 = 1").select(F.col("product_id").alias("row_id"), "company", "slug")
    return op.resolve(batch, products, alias).select("row_id", "product_id", "matched_by")


@query(f"""WITH e AS (SELECT DISTINCT {_SLUG.format('p_brand')} AS slug FROM part WHERE p_size < 3), b AS (SELECT DISTINCT {_SLUG.format("p_brand || p_type")} AS slug FROM part UNION SELECT DISTINCT {_SLUG.format('p_brand')} FROM part)
SELECT slug, {_id('company', 'slug')} AS company_id, false AS is_new FROM e UNION ALL SELECT slug, {_id('company', 'slug')}, true FROM b WHERE slug NOT IN (SELECT slug FROM e)""")
def company_get_or_create(spark, d):
    p = _part(spark, d)
    have = p.filter("size < 3").select(s.slugify(F.col("company")).alias("slug")).distinct().withColumn("company_id", s.stable_bigint("company", F.col("slug")))
    batch = p.select(s.slugify(F.concat("company", "kind")).alias("slug")).unionByName(p.select(s.slugify(F.col("company")).alias("slug")))
    return op.get_or_create(batch, have, "slug", "company_id", "company")


@query("""WITH l AS (SELECT p_partkey AS lid, p_name AS name, p_retailprice AS price FROM part WHERE p_partkey % 2 = 0), r AS (SELECT p_partkey AS rid, p_name AS rname, p_retailprice AS rprice FROM part WHERE p_partkey % 2 = 1)
SELECT lid, rid, match_rank FROM (SELECT lid, rid, CASE WHEN price = rprice THEN 0 ELSE 1 END AS match_rank, row_number() OVER (PARTITION BY lid ORDER BY CASE WHEN price = rprice THEN 0 ELSE 1 END, rid) AS n FROM l JOIN r ON price = rprice OR lower(trim(name)) = lower(trim(rname))) WHERE n = 1""")
def best_match(spark, d):
    """Price equal or name equal, price preferred: two equi-joins instead of a nested loop."""
    p = _part(spark, d)
    left = p.filter("product_id % 2 = 0").select(F.col("product_id").alias("lid"), "name", "price")
    right = p.filter("product_id % 2 = 1").select(F.col("product_id").alias("rid"), F.col("name").alias("rname"), F.col("price").alias("rprice"))
    keys = [(F.col("price").cast("string"), F.col("rprice").cast("string")), (F.lower(F.trim("name")), F.lower(F.trim("rname")))]
    return op.match_either(left, right, keys, "lid", [F.col("rid")]).select("lid", "rid", "match_rank")


@query("""WITH m AS (SELECT p_partkey AS lid, p_partkey + 1 AS target FROM part WHERE p_partkey % 10 = 0), r AS (SELECT p_name, min(p_partkey) AS target FROM part WHERE p_size > 40 GROUP BY p_name)
SELECT p_partkey AS lid, m.target, 'map' AS by FROM part JOIN m ON m.lid = p_partkey UNION ALL SELECT p_partkey, r.target, 'name' FROM part JOIN r USING (p_name) WHERE p_partkey NOT IN (SELECT lid FROM m)""")
def mapped_match(spark, d):
    p = _part(spark, d)
    left = p.select(F.col("product_id").alias("lid"), "name")
    mapping = p.filter("product_id % 10 = 0").select(F.col("product_id").alias("lid"), (F.col("product_id") + 1).alias("target"))
    right = p.filter("size > 40").groupBy(F.col("name").alias("rname")).agg(F.min("product_id").alias("target"))
    return op.mapped_match(left, mapping, right, "lid", F.lower("name"), "target", F.lower("rname")).select("lid", "target", "by")


@query("SELECT p_brand || '|' || p_name AS name, min(p_partkey) AS product_id FROM part GROUP BY 1 HAVING count(*) = 1")
def unique_match_only(spark, d):
    return op.unique_only(_part(spark, d).withColumn("name", F.concat_ws("|", "company", "name")), "name").select("name", "product_id")


@query("SELECT lower(p_brand) AS identity, min(CASE WHEN p_partkey % 2 = 0 THEN p_brand ELSE upper(p_brand) END) AS company_name FROM part GROUP BY 1")
def company_min_name(spark, d):
    p = _part(spark, d).withColumn("written", F.when(F.col("product_id") % 2 == 0, F.col("company")).otherwise(F.upper("company")))
    return p.groupBy(s.fold_space(F.col("written")).alias("identity")).agg(F.min("written").alias("company_name"))


@query("""WITH p AS (SELECT p_partkey, list_sort(list_distinct(string_split(lower(p_brand || ' ' || p_name), ' '))) AS t0 FROM part),
q AS (SELECT p_partkey, list_distinct(regexp_extract_all(lower(p_brand || ' ' || p_name), '[a-z0-9]+')) AS t FROM part),
l AS (SELECT p_partkey AS lid, list_distinct(regexp_extract_all(lower(p_name || ' ' || p_brand || ' new'), '[a-z0-9]+')) AS lt FROM part),
c AS (SELECT lid, p_partkey AS pid, len(list_intersect(t, lt))::DOUBLE / len(list_distinct(t || lt)) AS sim FROM l JOIN q ON list_filter(t, lambda x: regexp_matches(x, '[0-9]')) = list_filter(lt, lambda x: regexp_matches(x, '[0-9]')))
SELECT lid AS listing_id, pid AS product_id, sim AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY lid ORDER BY sim DESC, pid) AS n FROM c WHERE sim >= 0.5) WHERE n = 1""")
def fuzzy_identity(spark, d):
    """A seller's title for every part, matched to all products."""
    p = _part(spark, d)
    products = p.select("product_id", F.concat_ws(" ", "company", "name").alias("name"))
    titles = p.select(F.col("product_id").alias("listing_id"), F.concat_ws(" ", "name", "company", F.lit("new")).alias("title"))
    return op.fuzzy_identity(titles, products)


@query("SELECT lower(p_brand || ' ' || p_name) AS identity, count(*) AS products, min(p_partkey) AS first_product FROM part GROUP BY 1 HAVING count(*) > 1")
def duplicate_identities(spark, d):
    return op.duplicate_identities(_part(spark, d), s.fold_space(F.concat_ws(" ", "company", "name")))


@query("SELECT p_partkey AS product_id, CASE p_size % 6 WHEN 0 THEN 'cable' WHEN 1 THEN 'charger' WHEN 2 THEN 'dust_sticker' WHEN 3 THEN 'protective_case' END AS reason FROM part")
def accessory_reject(spark, d):
    tails = ["USB Type-C cable", "fast charger 25W", "anti dust sticker", "silicone case black", "phone only no charger", "128GB with box charger"]
    title = F.concat_ws(" ", "name", F.element_at(F.array(*map(F.lit, tails)), (F.col("size") % 6 + 1).cast("int")))
    return _part(spark, d).select("product_id", s.accessory_reason(title).alias("reason"))
