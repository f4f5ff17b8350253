"""Staged records: pending rows in bounded batches, marked by their outcome, with the run's counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.catalog import convert
from ..operators.ordering import saved
from ..sources.records import load


def pending(staging: DataFrame, batch: int) -> DataFrame:
    """The first pending rows by id: a bounded batch."""
    return staging.filter("status = 'pending'").orderBy("staging_id").limit(batch)


def process_batch(staging: DataFrame, runs: DataFrame, run_id: int, batch: int, now: Column, canonical_source: str) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """(tables, staging, runs) after one batch: what it converts to, its rows marked ``processed`` or ``failed``, and the run's counters and status.

    A record that is rejected, or whose URL another record of the batch has, fails; it does not stop the others.
    """
    some = saved(pending(staging, batch), "batch")
    good, bad = load(some.select("source_domain", "source_file", F.encode("payload", "UTF-8").alias("content")))
    tables = convert(good, bad, now, canonical_source)
    kept = tables["staging.raw_json_records"].select("source_domain", "source_file").distinct().withColumn("__ok", F.lit(True))
    marks = saved(some.join(kept, ["source_domain", "source_file"], "left").select("staging_id", F.when(F.col("__ok"), "processed").otherwise("failed").alias("__status")), "marks")
    out = staging.join(marks, "staging_id", "left")
    out = out.withColumn("status", F.coalesce("__status", "status")).withColumn("processed_at", F.when(F.col("__status").isNotNull(), now.cast("timestamp")).otherwise(F.col("processed_at"))).select(*staging.columns)
    seen = marks.agg(F.count_if(F.col("__status") == "processed").alias("__good"), F.count_if(F.col("__status") == "failed").alias("__bad"))
    mine = F.col("run_id") == run_id
    add = {"records_processed": F.col("__good") + F.col("__bad"), "records_succeeded": F.col("__good"), "records_failed": F.col("__bad")}
    after = runs.crossJoin(F.broadcast(seen))  # one row
    after = after.withColumns({c: F.when(mine, F.col(c) + n).otherwise(F.col(c)) for c, n in add.items()})
    status = F.when(F.col("__bad") == 0, "completed").otherwise("completed_with_errors")
    after = after.withColumn("finished_at", F.when(mine, now.cast("timestamp")).otherwise(F.col("finished_at"))).withColumn("run_status", F.when(mine, status).otherwise(F.col("run_status")))
    return tables, out, after.select(*runs.columns)
