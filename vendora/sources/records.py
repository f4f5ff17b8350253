"""Readers: record files, CSV tables, URL manifests, sitemaps, customer files."""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import scalars as s
from ..schema import Table, paths


def payload_schema() -> StructType:
    """The record as nested text: lists and numbers arrive as their JSON, so nothing is inferred and nothing is lost."""
    tree: dict = {}
    for p in paths():
        node = tree
        for step in p[:-1]:
            node = node.setdefault(step, {})
        node[p[-1]] = None

    def build(t: dict) -> StructType:
        return StructType([StructField(k, StringType() if v is None else build(v)) for k, v in t.items()])

    return build(tree)


def leaf(payload: Column, path: tuple[str, ...]) -> Column:
    for step in path:
        payload = payload.getField(step)
    return payload


def text_list(c: Column) -> Column:
    """A JSON list as texts; a lone value as a list of one; null stays null."""
    return F.when(F.startswith(F.trim(c), F.lit("[")), F.from_json(c, "array<string>")).otherwise(F.when(c.isNotNull(), F.array(c)))


def discover(spark: SparkSession, root: str, domains: list[str] | None = None) -> DataFrame:
    """source_domain, source_file, content of every ``<root>/<domain>/*.json``; names that start with _ are hidden by Spark."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option("recursiveFileLookup", "true").load(root)
    parts = F.split("path", "/")
    out = raw.select(s.canonical_site(F.element_at(parts, -2)).alias("source_domain"), F.concat_ws("/", F.element_at(parts, -2), F.element_at(parts, -1)).alias("source_file"), "content", "length", "modificationTime")
    return out.filter(F.col("source_domain").isin(*domains)) if domains else out


def load(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejects) of discovered files: bytes to SHA-256, text without a byte-order mark, record, required fields, URL; the first failure gives the code."""
    text = F.regexp_replace(F.try_validate_utf8(F.col("content").cast("string")), "^﻿", "")
    rows = files.select("source_domain", "source_file", F.sha2("content", 256).alias("file_sha256"), text.alias("payload"))
    rows = rows.withColumn("json", F.try_parse_json("payload")).withColumn("r", F.from_json("payload", payload_schema()))
    kind = F.schema_of_variant("json")
    rows = rows.withColumn("company_name", s.clean_text(F.col("r.CompanyName"))).withColumn("mobile_name", s.clean_text(F.col("r.MobileName")))
    code = (
        F.when(F.col("json").isNull(), "INVALID_JSON").when(~F.startswith(kind, F.lit("OBJECT")), "INVALID_PAYLOAD")
        .when((F.col("company_name") == "") | (F.col("mobile_name") == ""), "MISSING_FIELD").otherwise(s.url_error(F.col("r.URL"), F.col("source_domain")))
    )
    rows = rows.withColumn("reject_reason", code).drop("json")
    good = rows.filter("reject_reason IS NULL").drop("reject_reason").withColumn("source_url", s.canonical_url(F.col("r.URL")))
    bad = rows.filter("reject_reason IS NOT NULL").select("source_domain", "source_file", F.coalesce(F.col("r.URL"), F.lit("")).alias("source_url"), "reject_reason", F.concat_ws(": ", "source_file", "reject_reason").alias("reject_detail"), "payload")
    return good, bad


def read_csv_table(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """All columns as text after the header was compared with the table's; types are the validator's business."""
    header = spark.read.option("header", "true").csv(path).columns
    if header != list(table.columns):
        raise ValueError(f"{table.name}: header {header} is not {list(table.columns)}")
    schema = StructType([StructField(c, StringType()) for c in table.columns])
    return spark.read.schema(schema).option("header", "true").option("enforceSchema", "false").option("multiLine", "true").option("escape", '"').csv(path)


def read_manifest(df: DataFrame, body: str = "body") -> DataFrame:
    """position, url, kind from the three shapes of a manifest: a list, an object with mobile_urls and catalog_urls, or a tree (to any depth)."""
    b = F.trim(F.col(body))
    as_urls = lambda a: F.transform(a, lambda x: F.coalesce(F.get_json_object(x, "$.url"), x))
    flat = F.when(F.startswith(b, F.lit("[")), as_urls(F.from_json(b, "array<string>")))
    mobile = as_urls(F.from_json(F.get_json_object(b, "$.mobile_urls"), "array<string>"))
    maker = as_urls(F.from_json(F.get_json_object(b, "$.catalog_urls"), "array<string>"))
    # in a tree every address stands under the key "url", in document order; it is read as the JSON text that it is
    quoted = F.regexp_extract_all(F.get_json_object(b, "$.tree"), F.lit(r'"url"\s*:\s*("(?:[^"\\]|\\.)+")'), F.lit(1))
    tree = F.transform(quoted, lambda x: F.get(F.from_json(F.concat(F.lit("["), x, F.lit("]")), "array<string>"), F.lit(0)))
    pairs = lambda a, kind: F.transform(F.coalesce(a, F.array().cast("array<string>")), lambda x: F.struct(x.alias("url"), F.lit(kind).alias("kind")))
    every = F.concat(pairs(F.coalesce(flat, mobile, tree), "product"), pairs(maker, "catalogue"))
    return df.select(F.posexplode(every).alias("position", "x")).select((F.col("position") + 1).alias("position"), "x.url", "x.kind")


def manifest_counts(entries: DataFrame) -> DataFrame:
    """One row: seen, duplicates and rejected (not http or https) addresses of a manifest read by :func:`read_manifest`."""
    each = entries.groupBy(s.canonical_url(F.col("url")).alias("u")).agg(F.count("*").alias("n"))
    good = F.col("u").isNotNull()
    return each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("seen"), F.coalesce(F.sum(F.when(good, F.col("n") - 1)), F.lit(0)).alias("duplicates"), F.coalesce(F.sum(F.when(~good, F.col("n"))), F.lit(0)).alias("rejected"))


def _inflated(bodies: pd.Series) -> pd.Series:
    return bodies.map(lambda b: None if b is None else (gzip.decompress(b) if bytes(b[:2]) == b"\x1f\x8b" else bytes(b)).decode("utf-8", "replace"))


def body_text(content: Column) -> Column:
    """Fetched bytes as text, unpacked where they are gzip."""
    return F.pandas_udf(_inflated, "string")(content)


def read_sitemaps(bodies: DataFrame, roots: list[str], depth: int = 5) -> DataFrame:
    """position, url: addresses reached from the root sitemaps over a table of fetched bodies (url, body), through at most ``depth`` indexes; ordered, each once."""
    locs = F.expr("xpath(body, '//*[local-name()=\"url\"]/*[local-name()=\"loc\"]/text()')")
    kids = F.expr("xpath(body, '//*[local-name()=\"sitemap\"]/*[local-name()=\"loc\"]/text()')")
    parsed = bodies.select(F.col("url").alias("at"), F.transform(locs, lambda x: F.trim(x)).alias("locs"), F.transform(kids, lambda x: F.trim(x)).alias("kids"))
    level = bodies.sparkSession.createDataFrame([(r, [i]) for i, r in enumerate(roots)], "at string, place array<int>")
    found = None
    for _ in range(depth + 1):
        here = level.join(parsed, "at")
        urls = here.select("place", F.posexplode("locs").alias("i", "url")).select(F.concat("place", F.array("i")).alias("place"), "url")
        found = urls if found is None else found.unionByName(urls)
        level = here.select("place", F.posexplode("kids").alias("i", "at")).select("at", F.concat("place", F.array("i")).alias("place"))
    return found.groupBy("url").agg(F.min("place").alias("place"))


def read_customers(spark: SparkSession, path: str) -> DataFrame:
    """A customer CSV with trimmed, lower-case names; values stay text until they are prepared."""
    df = spark.read.option("header", "true").csv(path)
    return df.toDF(*(c.strip().lower() for c in df.columns))


def unchanged(files: DataFrame, key: Column, known: DataFrame) -> None:
    """Raise if the files are not those of a fingerprint taken before, so that one load never mixes two inputs."""
    now, then = fingerprint(files, key).first(), known.first()
    if now != then:
        raise ValueError(f"the source changed during the load: {then} became {now}")


def fingerprint(files: DataFrame, key: Column) -> DataFrame:
    """One row: files, bytes and an order-free hash of path, size and time; equal for equal inputs in any order."""
    return files.agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), F.bit_xor(F.xxhash64(key, "length", "modificationTime")).alias("hash"))
