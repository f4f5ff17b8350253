"""Merge queries: customers and orders are split into a base and a batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import changes as op
from ..operators.ordering import shared_dir
from ..sources.keyed import KeyedTable
from ..streaming import stateful
from .registry import query, table


def _customers(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    base = c.filter("c_custkey % 3 <> 0")
    batch = c.filter("c_custkey % 2 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1).withColumn("seq", F.lit(1))
    return base, batch.unionByName(batch.filter("c_custkey % 4 = 0").withColumn("c_mktsegment", F.lit("NEW")).withColumn("seq", F.lit(2)))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'NEW' ELSE c_mktsegment END AS c_mktsegment, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal
FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 2 = 0""")
def upsert(spark, d):
    base, batch = _customers(spark, d)
    return op.upsert(base, batch, ["c_custkey"], [F.desc("seq")])


@query("""SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE c_custkey % 3 <> 0
UNION ALL SELECT c_custkey, c_mktsegment, c_acctbal + 1 FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 2 = 0""")
def insert_absent(spark, d):
    base, batch = _customers(spark, d)
    return op.insert_absent(base, batch, ["c_custkey"], [F.col("seq")])


@query("""SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_custkey % 5 <> 0 UNION ALL SELECT o_custkey, o_orderkey, o_totalprice * 2 FROM orders WHERE o_custkey % 5 = 0 AND o_orderkey % 2 = 0""")
def replace_children(spark, d):
    """All orders of touched customers go; some come back with other prices."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    touched = o.filter("o_custkey % 5 = 0")
    return op.replace_children(o, touched.filter("o_orderkey % 2 = 0").withColumn("o_totalprice", F.col("o_totalprice") * 2), "o_custkey", touched)


@query("""SELECT min(event_id) AS event_id, user_id, event_type, value FROM events e WHERE event_id % 2 = 1 AND NOT EXISTS (SELECT 1 FROM events b WHERE b.event_id % 2 = 0 AND b.user_id = e.user_id AND b.event_type = e.event_type AND b.value = e.value) GROUP BY user_id, event_type, value""")
def price_history_append(spark, d):
    """Observations of the second half that are new, each once."""
    e = table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    return op.append_new(e.filter("event_id % 2 = 0"), e.filter("event_id % 2 = 1"), ["user_id", "event_type", "value"], [F.col("event_id")])


@query("SELECT o_orderkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'B' ELSE o_orderstatus END AS o_orderstatus FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_mktsegment = 'BUILDING' AND o_orderstatus <> 'B'")
def update_from_join(spark, d):
    """The rows that a propagated value changes."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.when(F.col("c_mktsegment") == "BUILDING", "B").alias("o_orderstatus"))
    return op.update_from(o, c, "o_custkey", ["o_orderstatus"]).select("o_orderkey", "o_orderstatus")


@query("""SELECT 'canonical' AS source, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'open', o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT 'part', o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'""")
def union_listings(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    parts = [o.filter(F.col("o_orderstatus") == k).select(F.lit(name).alias("source"), "o_orderkey", "o_totalprice") for k, name in (("F", "canonical"), ("O", "open"), ("P", "part"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def pending_files(spark, d):
    """Discovered less done."""
    return table(spark, d, "orders").select("o_orderkey").join(table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")


@query("SELECT user_id, event_type, max(ts) AS last_ts, arg_max(value, (ts, event_id)) AS value, count(*) AS seen FROM events GROUP BY ALL")
def incremental_latest(spark, d):
    """The latest value of each key, as the stream keeps it up to date; see the streaming tests."""
    from ..streaming.incremental import latest

    return latest(table(spark, d, "events"), ["user_id", "event_type"], "ts", "event_id", ["value"]).select("user_id", "event_type", F.col("ts").alias("last_ts"), "value", "seen")


@query("SELECT doc_id, CASE WHEN n_chars < 300 THEN 1 WHEN doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) THEN 2 END AS resolved_at FROM documents")
def reject_lifecycle(spark, d):
    """Every document is a reject; short ones are closed already, and those that a later table calls good are closed now."""
    rejects = table(spark, d, "documents").select("doc_id", F.when(F.col("n_chars") < 300, 1).alias("resolved_at"))
    return op.resolve_rejects(rejects, table(spark, d, "labels").filter("quality = 1"), "doc_id", F.lit(2))


def _arrivals(rows, folder: str, files: int):
    """Rows in no order of time, some of them again, as files of a growing folder."""
    again = rows.filter("event_id % 3 = 0")
    rows.unionByName(again).withColumn("at", F.xxhash64("event_id")).repartitionByRange(files, "at").drop("at").write.mode("append").parquet(folder)


@query("SELECT DISTINCT user_id, event_type, value FROM events")
def stream_history(spark, d):
    """Observations once each, over a stream in several batches and two runs, with the repeats that the second brings."""
    e, root = table(spark, d, "events"), shared_dir(spark, "history")
    for part in (e.filter("event_id % 2 = 0"), e):
        _arrivals(part, f"{root}/in", 4)
        stateful.append_once(spark, f"{root}/in", e.schema, ["user_id", "event_type", "value"], f"{root}/out", f"{root}/checkpoint", per_batch=2, partitions=4)
    return spark.read.parquet(f"{root}/out").select("user_id", "event_type", "value")


@query("SELECT user_id, event_type, max(ts) AS ts, arg_max(value, (ts, event_id)) AS value, count(*) AS seen FROM events GROUP BY ALL")
def stream_latest(spark, d):
    """The latest value of each key, kept by a stream in update mode in a keyed table."""
    e, root = table(spark, d, "events"), shared_dir(spark, "latest")
    schema = "user_id long, event_type string, ts timestamp, value double, seen long"
    kept = KeyedTable(spark, f"{root}/table", spark.createDataFrame([], schema).schema, ["user_id", "event_type"], buckets=8)
    for part in (e.filter("event_id % 2 = 0"), e.filter("event_id % 2 = 1")):
        part.repartition(3, F.xxhash64("event_id")).write.mode("append").parquet(f"{root}/in")
        stateful.keep_latest(spark, f"{root}/in", e.schema, ["user_id", "event_type"], "ts", "event_id", ["value"], kept, f"{root}/checkpoint", per_batch=2, partitions=4)
    return kept.read()


@query("""WITH e AS (SELECT user_id::VARCHAR AS record_key, event_type AS reason_code, value > 20 AS ok, ts AS t FROM events),
s AS (SELECT *, coalesce(lag(NOT ok) OVER (PARTITION BY record_key, reason_code ORDER BY t), false) AS before FROM e),
c AS (SELECT *, lead(t) OVER (PARTITION BY record_key, reason_code ORDER BY t) AS next FROM s WHERE before = ok)
SELECT record_key, reason_code, row_number() OVER (PARTITION BY record_key, reason_code ORDER BY t)::INTEGER AS occurrence, t AS opened_at, next AS resolved_at FROM c WHERE NOT ok""")
def stream_rejects(spark, d):
    """Rejects that open, are resolved and come back, over three batches in order of time."""
    e, root = table(spark, d, "events"), shared_dir(spark, "rejects")
    kept = KeyedTable(spark, f"{root}/table", spark.createDataFrame([], stateful.REJECTS).schema, ["record_key"], buckets=8)
    events = {"record_key": F.col("user_id").cast("string"), "reason_code": F.col("event_type"), "ok": F.col("value") > 20, "at": F.col("ts")}
    day = F.dayofmonth("ts")
    for part in (day < 8, day.between(8, 20), day > 20):
        e.filter(part).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stateful.follow_rejects(spark, f"{root}/in", e.schema, kept, f"{root}/checkpoint", events, partitions=4)
    return kept.read()


@query("""SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'NEW' ELSE c_mktsegment END AS c_mktsegment, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal
FROM customer WHERE c_custkey % 3 <> 0 OR c_custkey % 2 = 0""")
def bucketed_upsert(spark, d):
    """The upsert, put in a keyed table in which it opens only the buckets of its batch."""
    base, batch = _customers(spark, d)
    kept = KeyedTable(spark, shared_dir(spark, "customers"), base.schema, ["c_custkey"], buckets=8)
    kept.merge(base, lambda old, new: old.unionByName(new))
    kept.merge(batch, lambda old, new: op.upsert(old, new, ["c_custkey"], [F.desc("seq")]))
    return kept.read()
