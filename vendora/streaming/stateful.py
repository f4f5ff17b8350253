"""Streams that carry state: each observation once, the latest of each key, rejects from open to resolved.

Sources are folders of files, read in bounded batches until nothing is left (``availableNow``), so a job is run again
whenever files have come. What was seen lies in Spark's state store, kept on disk by RocksDB and copied to the checkpoint; what
comes out goes to a file sink or to a :class:`~vendora.sources.keyed.KeyedTable`, of which a batch touches the buckets it has rows for.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..sources.keyed import Change, KeyedTable
from .incremental import latest

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
REJECTS = "record_key string, reason_code string, occurrence int, opened_at timestamp, resolved_at timestamp"


def _session(spark: SparkSession, partitions: int) -> SparkSession:
    """A session of its own for a stream's settings. The number of state partitions is fixed by a checkpoint's first run."""
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    own.conf.set("spark.sql.shuffle.partitions", partitions)
    own.conf.set("spark.sql.streaming.numRecentProgressUpdates", 100_000)  # all batches of a run are counted
    return own


def _files(spark: SparkSession, source: str, schema: StructType, per_batch: int) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).parquet(source)


def _finish(query: StreamingQuery) -> dict[str, int]:
    """Counters of a run: batches, rows_in, rows_updated (keys whose state changed), rows_late (behind the watermark)."""
    query.awaitTermination()
    seen = [p for p in query.recentProgress if p["numInputRows"]]
    states = [s for p in seen for s in p["stateOperators"]]
    return {"batches": len(seen), "rows_in": sum(p["numInputRows"] for p in seen), "rows_updated": sum(s["numRowsUpdated"] for s in states), "rows_late": sum(s["numRowsDroppedByWatermark"] for s in states)}


def _into(table: KeyedTable, change: Change, source: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch step: the batch is written, so that state is read once, and merged unless the table has it already."""

    def step(batch: DataFrame, number: int) -> None:
        path = f"{table.root}/batch"
        batch.write.mode("overwrite").parquet(path)
        table.merge(table.spark.read.schema(batch.schema).parquet(path), change, (source, number))

    return step


def append_once(
    spark: SparkSession, source: str, schema: StructType, dedupe: list[str], history: str, checkpoint: str, at: str | None = None, delay: str | None = None, per_batch: int = 100, partitions: int = 64
) -> dict[str, int]:
    """Append the rows of new files whose dedupe key was not seen before to the table ``history``; restarts go on where the last run ended.

    Without ``delay`` keys are kept for ever, and repeats are found however late. With it, ``at`` is the event time: keys are forgotten
    ``delay`` after it, so repeats are found within that time, and rows that come later than that are not written but counted in
    ``rows_late``. Of rows with one key, any one is kept. History is never read; its file sink writes each batch once.
    """
    rows = _files(_session(spark, partitions), source, schema, per_batch)
    new = rows.withWatermark(at, delay).dropDuplicatesWithinWatermark(dedupe) if delay else rows.dropDuplicates(dedupe)
    return _finish(new.writeStream.format("parquet").option("path", history).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())


def keep_latest(
    spark: SparkSession, source: str, schema: StructType, key: list[str], at: str, tiebreak: str, values: list[str], table: KeyedTable, checkpoint: str, per_batch: int = 100, partitions: int = 64
) -> dict[str, int]:
    """Keep ``table`` (key, at, values, seen) at the latest values of each key; a batch hands on only the keys it has rows of.

    The state store holds one row for each key. A batch that is run again after a crash hands on the same rows, and the table knows the
    batch. Ties of ``at`` go to the largest ``tiebreak``.
    """
    rows = latest(_files(_session(spark, partitions), source, schema, per_batch), key, at, tiebreak, values)

    def change(old: DataFrame, new: DataFrame) -> DataFrame:
        return old.join(new, key, "left_anti").unionByName(new.select(*old.columns))

    return _finish(rows.writeStream.foreachBatch(_into(table, change, checkpoint)).option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True).start())


def reject_step(rejects: DataFrame, events: DataFrame) -> DataFrame:
    """``rejects`` after ``events(record_key, reason_code, ok, at)``: a failure opens a reject unless one is open, a success resolves the open one.

    Events of a record and reason count in order of time, failures first at equal times; only those that change something leave a trace. A
    reject that comes back is a new occurrence.
    """
    keys = ["record_key", "reason_code"]
    last = rejects.groupBy(*keys).agg(F.max("occurrence").alias("n"), F.max_by(F.col("resolved_at").isNull(), "occurrence").alias("open"))
    w = Window.partitionBy(*keys).orderBy("at", "ok")
    e = events.select(*keys, "ok", "at").join(last, keys, "left").withColumns({"n": F.coalesce("n", F.lit(0)), "open": F.coalesce("open", F.lit(False))})
    e = e.withColumn("before", F.coalesce(F.lag(~F.col("ok")).over(w), "open")).filter(F.col("before") == F.col("ok"))
    e = e.withColumns({"next": F.lead("at").over(w), "rank": F.count_if(~F.col("ok")).over(w), "first": F.row_number().over(w) == 1})
    new = e.filter(~F.col("ok")).select(*keys, (F.col("n") + F.col("rank")).cast("int").alias("occurrence"), F.col("at").alias("opened_at"), F.col("next").alias("resolved_at"))
    closed = e.filter(F.col("ok") & F.col("first")).select(*keys, F.col("at").alias("__at"))
    old = rejects.join(closed, keys, "left").withColumn("resolved_at", F.coalesce("resolved_at", "__at")).drop("__at")
    return old.unionByName(new.select(*old.columns))


def follow_rejects(spark: SparkSession, source: str, schema: StructType, table: KeyedTable, checkpoint: str, events: dict[str, Column] | None = None, per_batch: int = 100, partitions: int = 64) -> dict[str, int]:
    """Carry the rejects in ``table`` (:data:`REJECTS`, keyed by record_key) through batches of events; ``events`` makes their columns from the source's.

    A batch reads and writes the buckets of its records; one that is run again does nothing.
    """
    rows = _files(_session(spark, partitions), source, schema, per_batch)
    rows = rows.select(*(c.alias(k) for k, c in events.items())) if events else rows

    return _finish(rows.writeStream.foreachBatch(_into(table, reject_step, checkpoint)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
