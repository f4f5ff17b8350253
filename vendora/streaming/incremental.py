"""Incremental ingestion: bounded batches of a file source, exactly once, into idempotent merges."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def latest(df: DataFrame, key: list[str], ts: str, tiebreak: str, values: list[str]) -> DataFrame:
    """The latest values of each key and how often it was seen; the same expression in batch and in streaming update mode."""
    last = F.max_by(F.struct(ts, *values), F.struct(ts, tiebreak)).alias("x")
    return df.groupBy(*key).agg(last, F.count("*").alias("seen")).select(*key, "x.*", "seen")


def drain(spark: SparkSession, source: str, schema: StructType, checkpoint: str, apply: Callable[[DataFrame, int], None], files_per_batch: int = 100, file_format: str = "parquet") -> None:
    """Feed all files not yet seen to ``apply(batch, batch_id)`` in bounded batches, then stop; the checkpoint remembers what is done."""
    stream = spark.readStream.format(file_format).schema(schema).option("maxFilesPerTrigger", files_per_batch).load(source)
    stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
