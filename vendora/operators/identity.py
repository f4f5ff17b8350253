"""Identity: deterministic ids, slugs, deduplication, canonical picks, entity resolution and fuzzy matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import slugify, stable_bigint


def unique_slugs(df: DataFrame, identity: Column, base: Column, out: str = "slug") -> DataFrame:
    """``df`` with a slug for each identity; a base shared by several identities gets ``-`` and 8 hex digits of the identity's SHA-256."""
    df = df.withColumn("__id", identity).withColumn("__base", base)
    many = df.select("__id", "__base").distinct().groupBy("__base").agg(F.count("*").alias("__n"))
    slug = F.when(F.col("__n") > 1, F.concat("__base", F.lit("-"), F.substring(F.sha2("__id", 256), 1, 8))).otherwise(F.col("__base"))
    return df.join(many, "__base").withColumn(out, slug).drop("__id", "__base", "__n")


def id_collisions(df: DataFrame, ident: str, key: Column) -> DataFrame:
    """Ids that stand for more than one natural key; must be empty."""
    return df.groupBy(ident).agg(F.count_distinct(key).alias("keys")).filter("keys > 1")


def first_wins(df: DataFrame, key: list[str], order: list[Column], name: str) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected): the first row of each key by ascending columns, and the others with the name of the one that won.

    The first is a pre-aggregated minimum that is joined back, so a key that most rows have is not one task's; only rows
    that are equal in key and order are numbered together.
    """
    df = df.withColumn("__o", F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order))))
    first = df.groupBy(*(F.col(k).alias(f"__{k}") for k in key)).agg(F.min("__o").alias("__first"), F.min_by(name, "__o").alias("winner"))
    both = df.join(first, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in key]).withColumn("__tie", F.row_number().over(Window.partitionBy(*key, "__o").orderBy(name)))
    kept = (F.col("__o") == F.col("__first")) & (F.col("__tie") == 1)
    drop = ["__o", "__first", "__tie", *(f"__{k}" for k in key)]
    return both.filter(kept).drop(*drop, "winner"), both.filter(~kept).drop(*drop)


def instance_numbers(df: DataFrame, group: list[str], order: list[Column], out: str = "instance_number") -> DataFrame:
    return df.withColumn(out, F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("long"))


def pick_one(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter("__n = 1").drop("__n")


def aliases(df: DataFrame, product: str, name: str, canonical_slug: str, order: list[Column]) -> DataFrame:
    """Alternative names of products: distinct names whose slug is not the canonical one; a slug goes to the first that has it."""
    named = df.withColumn("alias_slug", slugify(F.col(name))).filter(F.col("alias_slug") != F.col(canonical_slug))
    return pick_one(named, ["alias_slug"], order).select(product, F.col(name).alias("alias_name"), "alias_slug", stable_bigint("alias", F.col("alias_slug")).alias("alias_id"))


def get_or_create(batch: DataFrame, existing: DataFrame, slug: str, ident: str, namespace: str) -> DataFrame:
    """Existing rows and one new row, with a hash id, for each slug that was absent."""
    new = batch.select(slug).distinct().join(existing, slug, "left_anti").withColumn(ident, stable_bigint(namespace, F.col(slug)))
    return existing.select(slug, ident).withColumn("is_new", F.lit(False)).unionByName(new.select(slug, ident).withColumn("is_new", F.lit(True)))


def resolve(batch: DataFrame, products: DataFrame, alias_table: DataFrame, slug: str = "slug", company: str = "company") -> DataFrame:
    """Each row's product: by product slug, else by alias slug, both within its company, else a new id."""
    direct = products.select(company, F.col("product_slug").alias(slug), F.col("product_id").alias("__p"))
    alias = alias_table.select(company, F.col("alias_slug").alias(slug), F.col("product_id").alias("__a"))
    out = batch.join(direct, [company, slug], "left").join(alias, [company, slug], "left")
    how = F.when(F.col("__p").isNotNull(), "product").when(F.col("__a").isNotNull(), "alias").otherwise("new")
    return out.withColumn("product_id", F.coalesce("__p", "__a", stable_bigint("product", F.concat_ws("|", company, slug)))).withColumn("matched_by", how).drop("__p", "__a")


def match_either(left: DataFrame, right: DataFrame, keys: list[tuple[Column, Column]], ident: str, order: list[Column]) -> DataFrame:
    """A join on any of several equalities, the earlier preferred, then the first row of ``right`` by its columns ``order``.

    A union of equi-joins and a pick, no nested loop. Of each key's rows in ``right`` only the first can be picked, so that one
    alone is joined: a row of ``left`` meets at most one row for each equality, however many share the key.
    """
    parts = None
    for rank, (a, b) in enumerate(keys):
        first = right.withColumn("__k", b).filter("__k IS NOT NULL").groupBy("__k").agg(F.min_by(F.struct(*right.columns), F.struct(*order)).alias("__r"))
        found = left.withColumn("__k", a).join(first.select("__k", "__r.*"), "__k").drop("__k").withColumn("match_rank", F.lit(rank))
        parts = found if parts is None else parts.unionByName(found)
    return pick_one(parts, [ident], [F.col("match_rank"), *order])


def unique_only(df: DataFrame, key: str) -> DataFrame:
    """Rows whose key has one candidate."""
    single = df.groupBy(key).agg(F.count("*").alias("__c")).filter("__c = 1").drop("__c")
    return df.join(single, key, "left_semi")


def mapped_match(left: DataFrame, mapping: DataFrame, right: DataFrame, key: str, name: Column, target: str, target_name: Column) -> DataFrame:
    """A reviewed mapping wins; what it lacks is matched by name."""
    with_map = left.join(mapping, key, "left")
    done = with_map.filter(F.col(target).isNotNull()).withColumn("by", F.lit("map"))
    named = right.withColumn("__n", target_name)
    rest = with_map.filter(F.col(target).isNull()).drop(target).withColumn("__n", name).join(named.select("__n", target), "__n").drop("__n").withColumn("by", F.lit("name"))
    return done.unionByName(rest)


def tokens(name: Column) -> Column:
    """Distinct lower-case words of a model name; roman numerals and ``mark n`` as digits."""
    t = F.regexp_replace(F.lower(name), r"\bmark\s+(\d+)\b", "$1")
    for roman, digit in (("viii", "8"), ("vii", "7"), ("iii", "3"), ("vi", "6"), ("iv", "4"), ("ii", "2"), ("ix", "9")):
        t = F.regexp_replace(t, rf"\b{roman}\b", digit)
    return F.array_distinct(F.regexp_extract_all(t, F.lit("([a-z0-9]+)"), F.lit(1)))


#: Words that make another model.
VARIANTS = ("ultra", "plus", "pro", "max", "mini", "lite", "fe", "note", "fold", "flip", "neo", "edge")


def fuzzy_identity(listings: DataFrame, products: DataFrame, min_similarity: float = 0.5) -> DataFrame:
    """Best product for each listing(listing_id, title) among products(product_id, name): token Jaccard behind guards.

    Variant words and words with a digit must agree exactly. Candidates share one of the rarest tokens of both sides: of
    n tokens a match holds n * ``min_similarity`` at least, so one of the n less that, plus one, rarest is common.
    """
    # names that are the same set of words are one: the least id stands for them
    special = lambda c: F.array_sort(F.filter(c, lambda x: x.isin(*VARIANTS) | x.rlike("[0-9]")))
    p = products.groupBy(F.array_sort(tokens(F.col("name"))).alias("pt")).agg(F.min("product_id").alias("product_id")).withColumn("guard", special("pt"))
    all_listings = listings.select(F.col("listing_id").alias("__id"), F.array_sort(tokens(F.col("title"))).alias("lt"))
    li = all_listings.groupBy("lt").agg(F.min("__id").alias("listing_id")).withColumn("guard", special("lt"))
    seen = p.select(F.explode("pt").alias("t")).groupBy("t").agg(F.count("*").alias("n"))

    def rarest(df: DataFrame, ident: str, words: str) -> DataFrame:
        of = df.select(ident, "guard", F.explode(words).alias("t")).join(seen, "t", "left")
        of = of.groupBy(ident, "guard").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "t"))).alias("x"))
        some = F.slice("x", F.lit(1), F.size("x") - F.ceil(F.size("x") * min_similarity - 1e-9).cast("int") + 1)
        return of.select(ident, "guard", F.explode(some).alias("x")).select(ident, "guard", F.col("x.t").alias("t"))

    pairs = rarest(li, "listing_id", "lt").join(rarest(p, "product_id", "pt"), ["t", "guard"]).select("listing_id", "product_id").distinct()
    both = pairs.join(li.drop("guard"), "listing_id").join(p.drop("guard"), "product_id")
    both = both.withColumn("similarity", F.size(F.array_intersect("pt", "lt")) / F.size(F.array_union("pt", "lt")))
    good = both.filter(F.col("similarity") >= min_similarity)
    best = good.groupBy("listing_id").agg(F.max(F.struct("similarity", (-F.col("product_id")).alias("p"))).alias("x"), F.first("lt").alias("lt"))
    return all_listings.join(best.drop("listing_id"), "lt").select(F.col("__id").alias("listing_id"), (-F.col("x.p")).alias("product_id"), F.col("x.similarity").alias("similarity"))


def duplicate_identities(products: DataFrame, name: Column) -> DataFrame:
    """Normalised names that more than one product has."""
    return products.groupBy(name.alias("identity")).agg(F.count("*").alias("products"), F.min("product_id").alias("first_product")).filter("products > 1")
