"""Content-addressed web archive.

An archive is a folder of two tables. ``payloads`` holds each distinct payload once, under its SHA-256;
``records`` holds one row per record with its exact header block and the digest that leads to its payload. A payload
that only one record has keeps that record's header beside it. ``read_records`` joins the others and gives back the
bytes of each record as written.

Defined cases: a null payload counts as empty. Payloads under ``min_revisit`` bytes are never shared as
revisits (they are still stored once). Rows equal in id, url and payload are told apart by their copy
number: the first is the response, the rest revisit it. A null id sorts first, as Spark orders it. Other
columns of the input do not enter the archive, whatever their names; payloads may have any length that a row can hold.
An empty table gives an empty archive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import shared_dir
from .components import HOT, HOT_KEYS, _saved

CRLF = "\r\n"
EPOCH = "1970-01-01T00:00:00Z"


def _line(name: str, value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit(CRLF))).otherwise("")


def record_id(page: Column, copy: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.when(copy > 1, F.concat(F.lit(":"), copy)).otherwise(""), F.lit(">"))


def write_archive(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", body: str = "html", min_revisit: int = 100) -> None:
    """Write one record per row of ``pages`` under ``path``; see the module text.

    Payload bytes move once, to be stored once; all other shuffles carry digests and ids.
    """
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.encode(F.coalesce(F.col(body), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("bytes", F.octet_length("payload").cast("long"))
    heads = _saved(rows.groupBy("page_id", "url", "digest", "bytes").agg(F.count("*").alias("copies")), "heads")
    # one row per digest: the response that later copies refer to, and how many parts its records are dealt over
    first = heads.groupBy("digest").agg(F.min(F.struct("page_id", "url")).alias("first"), F.sum("copies").alias("n"))
    first = _saved(first.select("digest", "first", F.ceil(F.col("n") / HOT).cast("int").alias("parts"), (F.col("n") == 1).alias("alone")), "first")
    hot = first.filter("parts > 1")
    hot = F.broadcast(hot) if hot.count() <= HOT_KEYS else hot
    # digests that very many records have come by broadcast, the others by shuffle
    cold = heads.join(hot, "digest", "left_anti").join(first.filter("parts = 1"), "digest")
    heads = heads.join(hot, "digest").unionByName(cold)
    # rows that are equal in all are told apart by their number; where they are very many, blocks of numbers are dealt over tasks first
    many = heads.filter(F.col("copies") > HOT).withColumn("block", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / HOT).cast("int"))))
    many = many.repartition("digest", "page_id", "url", "block")
    upto = F.least((F.col("block") + 1) * HOT, F.col("copies")).cast("int")
    many = many.withColumn("copy", F.explode(F.sequence(F.col("block") * HOT + 1, upto))).drop("block")
    heads = heads.filter(F.col("copies") <= HOT).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).unionByName(many)
    heads = heads.withColumn("part", F.pmod(F.xxhash64("page_id", "url", "copy"), F.col("parts")).cast("int"))
    response = (F.col("bytes") < min_revisit) | ((F.col("copy") == 1) & F.struct("page_id", "url").eqNullSafe(F.col("first")))
    heads = heads.withColumn("kind", F.when(response, "response").otherwise("revisit"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), F.col("bytes"), F.lit(CRLF + CRLF))
    body_bytes = F.when(F.col("kind") == "response", F.col("bytes")).otherwise(0)
    header = F.concat(
        F.lit(f"WARC/1.0{CRLF}"), _line("WARC-Type", F.col("kind")), _line("WARC-Record-ID", record_id(F.col("page_id"), F.col("copy"))), _line("WARC-Date", F.lit(EPOCH)),
        _line("WARC-Target-URI", F.col("url")), _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("WARC-Refers-To", F.when(F.col("kind") == "revisit", record_id(F.col("first.page_id"), F.lit(1)))),
        _line("WARC-Profile", F.when(F.col("kind") == "revisit", F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"))),
        F.lit(f"Content-Type: application/http; msgtype=response{CRLF}Content-Length: "), F.octet_length(http) + body_bytes, F.lit(CRLF + CRLF), http,
    )
    store = {"compression": "zstd"}
    heads = heads.select("page_id", F.encode(header, "UTF-8").alias("header"), "digest", "part", "kind", "alone")
    heads.filter("NOT alone").drop("alone").write.options(**store).parquet(f"{path}/records")
    payloads = rows.groupBy("digest").agg(F.first("payload").alias("payload")).join(first.select("digest", "parts", "alone"), "digest")
    payloads.join(heads.filter("alone").select("digest", "page_id", "header", "kind"), "digest", "left").write.options(**store).parquet(f"{path}/payloads")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Each record's page_id, kind, header, payload, its digest and ``record``: the bytes as a WARC file has them.

    ``verified`` is false if the stored bytes no longer have the digest under which they are stored.
    """
    records, payloads = spark.read.parquet(f"{path}/records"), spark.read.parquet(f"{path}/payloads")
    payloads = payloads.withColumn("verified", F.sha2("payload", 256) == F.col("digest"))
    alone = payloads.filter("alone").select("digest", "page_id", "header", "kind", "payload", "verified")
    body = F.when(F.col("kind") == "response", F.col("payload")).otherwise(F.encode(F.lit(""), "UTF-8"))
    # a payload that very many records have meets them in parts
    payloads = payloads.filter("NOT alone").select("digest", "payload", "verified", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return records.join(payloads, ["digest", "part"]).drop("part").unionByName(alone).withColumn("record", F.concat("header", body, F.encode(F.lit(CRLF + CRLF), "UTF-8")))


def parse_records(records: DataFrame) -> DataFrame:
    """Fields read from the record bytes: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    head = F.decode("header", "UTF-8")
    field = lambda name, value: F.nullif(F.regexp_extract(head, rf"(?dm)^{name}: {value}\r$", 1), F.lit(""))
    return records.select(
        field("WARC-Record-ID", r"<urn:page:(-?\d+)(?::\d+)?>").cast("long").alias("page_id"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        field("WARC-Payload-Digest", "sha256:([0-9a-f]{64})").alias("payload_digest"),
        field("WARC-Type", "(\\w+)").alias("record_type"),
        field("WARC-Refers-To", r"<urn:page:(-?\d+)(?::\d+)?>").cast("long").alias("refers_to"),
        "verified",
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op1: archive every row of ``pages``, read the archive back and report each record."""
    path = shared_dir(spark, "warc")
    write_archive(spark.read.parquet(f"{sf_dir}/pages.parquet"), path)
    return parse_records(read_records(spark, path))


SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes < 100 OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN payload_bytes < 100 OR page_id = first_id THEN NULL ELSE first_id END AS refers_to,
  true AS verified
FROM f"""
