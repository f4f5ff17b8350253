"""Price, coverage and discrepancy aggregates over products, listings and prices.

Every function takes DataFrames and column names; groups are aggregated before they move, small sides are left to
Spark's own size-based choice of join.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources import pointer
from .ordering import positions


def price_comparison(offers: DataFrame, keys: list[str], source: str = "source", amount: str = "amount") -> DataFrame:
    """Sources, listings, lowest, mean and highest price and their spread for each product and currency; only prices above zero."""
    a = F.col(amount)
    return (
        offers.filter(a > 0).groupBy(*keys)
        .agg(F.count_distinct(source).alias("sources_count"), F.count("*").alias("total_listings"), F.min(a).cast("double").alias("min_price"), (F.sum(a).cast("double") / F.count(a)).alias("avg_price"), F.max(a).cast("double").alias("max_price"))
        .withColumn("price_spread", F.col("max_price") - F.col("min_price"))
    )


def offers_by_price(offers: DataFrame, keys: list[str], detail: list[str], amount: str = "amount") -> DataFrame:
    """The offers of each group as one list, cheapest first; ties by the detail columns."""
    rows = F.sort_array(F.collect_list(F.struct(amount, *detail)))
    return offers.filter(F.col(amount) > 0).groupBy(*keys).agg(rows.alias("offers"))


def price_map(prices: DataFrame, key: str, label: str, amount: str, order: list[str]) -> DataFrame:
    """Label -> amount for each key; of several amounts the one last in order, as a later key of a JSON object wins."""
    last = prices.groupBy(key, label).agg(F.max_by(amount, F.struct(*order)).alias(amount))
    return last.groupBy(key).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(label, amount)))).alias("prices"))


def site_summary(listings: DataFrame, quality: DataFrame | None, source: str, product: str, listing: str, seen: str, score: str = "score", latest_by: str | None = None) -> DataFrame:
    """Coverage, listings, mean completeness, first and last seen for each source.

    A listing scored several times counts several times, as a left join has it; ``latest_by`` keeps its latest score instead.
    """
    if quality is not None:
        if latest_by:
            quality = quality.groupBy(listing).agg(F.max_by(score, latest_by).alias(score))
        listings = listings.join(quality.select(listing, score), listing, "left")
    mean = [] if quality is None else [F.avg(score).alias("avg_completeness")]
    return listings.groupBy(source).agg(F.count_distinct(product).alias("distinct_products"), F.count(listing).alias("total_listings"), *mean, F.min(seen).alias("first_seen"), F.max(seen).alias("last_seen"))


def star_join(base: DataFrame, parts: dict[str, DataFrame], key: str) -> DataFrame:
    """base and one-to-one tables on one key by left joins: one shuffle key throughout."""
    return reduce(lambda left, right: left.join(right, key, "left"), parts.values(), base)


def discrepancies(canonical: DataFrame, listings: DataFrame, key: str, fields: list[str], source: str = "source", excluded: tuple[str, ...] = ()) -> DataFrame:
    """Canonical against listed values; a flag is null where either side is."""
    c = canonical.select(key, *(F.col(f).alias(f"canonical_{f}") for f in fields), *[x for x in canonical.columns if x not in (key, *fields)])
    out = c.join(listings.select(key, source, *(F.col(f).alias(f"listing_{f}") for f in fields), *[x for x in listings.columns if x not in (key, source, *fields)]), key)
    if excluded:
        out = out.filter(~F.col(source).isin(*excluded))
    return out.withColumns({f"{f}_differs": F.col(f"canonical_{f}") != F.col(f"listing_{f}") for f in fields})


def discrepancy_rates(found: DataFrame, fields: list[str], by: str = "source") -> DataFrame:
    n = F.count("*")
    out = [n.alias("rows")]
    for f in fields:
        hit = F.count_if(F.col(f"{f}_differs"))
        out += [hit.alias(f"{f}_count"), (hit * 100.0 / F.greatest(n, F.lit(1))).alias(f"{f}_pct")]
    return found.groupBy(by).agg(*out)


def category_counts(df: DataFrame, column: str | Column, limit: int | None = None) -> DataFrame:
    """label, count: blank and null are Unknown; most frequent first, then by label without case."""
    c = F.col(column) if isinstance(column, str) else column
    out = df.groupBy(F.coalesce(F.nullif(F.trim(c.cast("string")), F.lit("")), F.lit("Unknown")).alias("label")).agg(F.count("*").alias("count"))
    return out.orderBy(F.desc("count"), F.lower("label"), "label").limit(limit) if limit else out


def adoption(df: DataFrame, flag: Column) -> DataFrame:
    n, hit = F.count("*"), F.count_if(flag)
    return df.agg(n.alias("n"), hit.alias("adopted"), F.try_divide(hit * 100.0, n).alias("adoption_pct"))


def registry_page(df: DataFrame, columns: list[str], filters: dict[str, object], allowed: tuple[str, ...], search: str = "", search_columns: tuple[str, ...] = (), order: tuple[Column, ...] = (), limit: int = 25, offset: int = 0) -> tuple[DataFrame, DataFrame]:
    """(page, one-row total) of an allow-listed view.

    Filters of None, '' or 'all' are ignored and values cut to 80 characters; in the search text ``(),`` are blanks, it is cut to 120
    characters and matches anywhere in any search column without case, ``*`` standing for anything. The limit is held to 1..100.
    """
    for k, v in filters.items():
        if k not in allowed:
            raise ValueError(f"not a filter: {k}")
        if v is not None and str(v) not in ("", "all"):
            df = df.filter(F.col(k).cast("string") == str(v)[:80])
    text = " ".join("".join(" " if c in "()," else c for c in search).split())[:120]
    if text and search_columns:
        df = df.filter(reduce(lambda a, b: a | b, [F.col(c).ilike(f"%{text.replace('*', '%')}%") for c in search_columns]))
    page = df.orderBy(*order).offset(max(offset, 0)).limit(min(max(limit, 1), 100)).select(*columns)
    return page, df.agg(F.count("*").alias("total"))


def write_pages(df: DataFrame, order: tuple[Column, ...], root: str, rows: int = 100_000) -> int:
    """Write ``df`` in its order, which must be total, in blocks of ``rows`` rows, and point readers to it; the number of rows.

    Nothing is sorted when a page is read, and a page of at most 100 rows lies in one block or two, however deep it is.
    """
    numbered = positions(df, [*order]).withColumn("block", F.floor((F.col("position") - 1) / rows))
    run = f"run={uuid.uuid4().hex}"
    numbered.hint("rebalance", "block").write.partitionBy("block").parquet(f"{root}/{run}")
    schema = numbered.drop("block").schema
    total = df.sparkSession.read.schema(schema).parquet(f"{root}/{run}").count()
    pointer.put(df.sparkSession, root, {"run": run, "rows": rows, "total": total, "schema": schema.jsonValue()})
    return total


def read_page(spark: SparkSession, root: str, limit: int = 25, offset: int = 0) -> DataFrame:
    """Rows offset + 1 to offset + limit, with their ``position``, in order; the limit is held to 1..100. Only the blocks that hold them are opened."""
    at = pointer.get(spark, root)
    limit, offset = min(max(limit, 1), 100), max(offset, 0)
    last = min(offset + limit, at["total"])
    schema = StructType.fromJson(at["schema"])
    if offset >= last:
        return spark.createDataFrame([], schema)
    page = spark.read.schema(schema).parquet(*(f"{root}/{at['run']}/block={b}" for b in range(offset // at["rows"], (last - 1) // at["rows"] + 1)))
    return page.filter(F.col("position").between(offset + 1, last)).orderBy("position")
