"""Keyed tables in hash buckets: a merge reads and writes only the buckets that its batch has rows for.

Files of a merge lie under ``v=<number>/bucket=<bucket>``; the pointer says for each bucket which number holds it. A merge
that stops before its pointer is in place changed nothing, and its files are written anew by the next; readers keep
what the pointer named when they began.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import pointer

Change = Callable[[DataFrame, DataFrame], DataFrame]


class KeyedTable:
    """A table whose rows lie in the bucket of their key's hash; number of buckets, key and columns are fixed when it is first written."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: list[str], buckets: int = 64):
        self.spark, self.root, self.schema, self.key, self.buckets = spark, root.rstrip("/"), schema, key, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def state(self) -> dict:
        """``at``: bucket -> the merge that holds it; ``done``: source of batches -> its last one."""
        found = pointer.get(self.spark, self.root) or {"at": {}, "done": {}, "buckets": self.buckets, "key": self.key}
        if (found["buckets"], found["key"]) != (self.buckets, self.key):
            raise ValueError(f"{self.root} has {found['buckets']} buckets of {found['key']}")
        return found

    def read(self, only: list[int] | None = None) -> DataFrame:
        """All rows, or those of some buckets; only their files are listed."""
        at = self.state()["at"]
        paths = [f"{self.root}/v={v}/bucket={b}" for b, v in at.items() if only is None or int(b) in only]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def merge(self, batch: DataFrame, change: Change, once: tuple[str, int] | None = None) -> list[int]:
        """Put ``change(rows of the batch's buckets, batch)`` in their place; returns these buckets.

        ``change`` may only touch rows of keys that the batch has. With ``once`` = (source, number), a batch whose number that
        source is known to have passed does nothing.
        """
        state = self.state()
        if once and state["done"].get(once[0], -1) >= once[1]:
            return []
        touched = sorted(r["b"] for r in batch.select(self.bucket().alias("b")).distinct().collect())  # at most as many as there are buckets
        number = max(pointer.numbers(self.spark, self.root), default=-1) + 1
        if touched:
            rows = change(self.read(touched), batch).select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema))
            # large buckets are split over tasks, small ones put together
            rows.withColumn("bucket", self.bucket()).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/v={number}")
            state["at"] = {b: v for b, v in state["at"].items() if int(b) not in touched}
            state["at"] |= {n.partition("=")[2]: number for n in pointer.folders(self.spark, f"{self.root}/v={number}") if n.startswith("bucket=")}
        if once:
            state["done"][once[0]] = once[1]
        if touched or once:
            pointer.put(self.spark, self.root, state)
        return touched

    def prune(self) -> None:
        """Delete the files of merges that the last pointer does not name any more; no reader may be left from before."""
        live = {str(v) for v in self.state()["at"].values()}
        for name in pointer.folders(self.spark, self.root):
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
            inside = pointer.folders(self.spark, f"{self.root}/{name}") if name.startswith("v=") else []
            for part in inside:
                if part.startswith("bucket=") and str(self.state()["at"].get(part.partition("=")[2])) != name[2:]:
                    fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(path, part), True)
            if inside and name[2:] not in live:
                fs.delete(path, True)
